"""Shingles that many texts share, counted over all texts.

The counts only order the shingles of a text, rare ones first and then by steps of their count,
so a short key that now and then unites two shingles costs nothing but a little balance.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.words import batches, encoded, shingle_sets

# A shingle is hot from this many texts on; the bound rises by steps, STEPS of which double it,
# until at most MOST_HOT are left: what is sent to the executors is at most 9 bytes * MOST_HOT.
LEAST_HOT = 16
STEPS = 4
MOST_HOT = 1 << 20

# At most 2^16 ranges, so that the key of a shingle needs no more than its upper six bytes.
MOST_BITS = 16

# Bytes of text whose shingles are sorted together: the more, the smaller the gaps between them.
SORTED_BYTES = 1 << 23

COUNTED = "bucket int, size int, keys binary"
HOT = "key long, level int"


@dataclass(frozen=True)
class HotShingles:
    """Sorted keys and their levels; the key of a shingle is its hash without the lowest ``cut`` bits."""

    keys: np.ndarray
    levels: np.ndarray
    cut: int

    def level(self, shingles: np.ndarray) -> np.ndarray:
        """0 for a rare shingle, else 1 and more, rising with the number of texts that hold it."""
        if not len(self.keys):
            return np.zeros(len(shingles), dtype=np.uint8)
        keys = shingles >> np.uint64(self.cut)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.levels[at], 0).astype(np.uint8)

    def holds(self, shingles: np.ndarray) -> np.ndarray:
        return self.level(shingles) > 0


def packed(keys: np.ndarray) -> bytes:
    """Sorted 32-bit keys as gaps: their lower two bytes as they are, the upper two compressed."""
    planes = np.diff(keys, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return planes[:2].tobytes() + zlib.compress(planes[2:].tobytes(), 1)


def unpacked(content: bytes, size: int) -> np.ndarray:
    """The ``size`` keys that ``packed`` made ``content`` of."""
    planes = content[: 2 * size] + zlib.decompress(content[2 * size :])
    gaps = np.frombuffer(planes, dtype=np.uint8).reshape(4, size).T.copy().view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.uint32)


def hot_shingles(texts: DataFrame, width: int, partitions: int) -> HotShingles:
    """The shingles that at least LEAST_HOT distinct texts hold (column ``text``).

    The hashes go out by range in packed arrays, two to three bytes a shingle: the range has the
    upper bits, the array the gaps between the next 32. The arrays of a range are sorted and
    counted. Copies of a text within a batch count once.
    """
    bits = min(max(6, int(partitions - 1).bit_length()), MOST_BITS)
    cut = 32 - bits

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            distinct = list(dict.fromkeys(encoded(frame["text"])))
            for first, last in batches(distinct, SORTED_BYTES):
                keys = np.concatenate([*shingle_sets(distinct[first:last], width), np.zeros(0, np.uint64)])
                keys >>= np.uint64(cut)
                keys.sort()
                edges = np.searchsorted(keys >> np.uint64(32), np.arange((1 << bits) + 1, dtype=np.uint64)).tolist()
                low = keys.astype("<u4")
                ranges = [(k, x, y) for k, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if x < y]
                rows = [(k, y - x, packed(low[x:y])) for k, x, y in ranges]
                yield pd.DataFrame(rows, columns=["bucket", "size", "keys"])

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        lists = [unpacked(content, size) for content, size in zip(frame["keys"], frame["size"], strict=True)]
        found, counts = np.unique(np.concatenate(lists), return_counts=True)
        hot = counts >= LEAST_HOT
        keys = (int(frame["bucket"].iloc[0]) << 32) + found[hot].astype(np.int64)
        return pd.DataFrame({"key": keys, "level": (STEPS * np.log2(counts[hot] / LEAST_HOT)).astype(np.int32)})

    counted = texts.select("text").mapInPandas(pack, COUNTED).groupBy("bucket").applyInPandas(count, HOT).persist()
    try:
        by_level = {r["level"]: r["count"] for r in counted.groupBy("level").count().collect()}
        level, left = 0, sum(by_level.values())
        while left > MOST_HOT:
            left -= by_level.get(level, 0)
            level += 1
        found = counted.filter(F.col("level") >= level).toPandas().sort_values("key")
    finally:
        counted.unpersist()
    levels = np.minimum(found["level"].to_numpy(dtype=np.int64) + 1, 255).astype(np.uint8)
    return HotShingles(found["key"].to_numpy(dtype=np.int64).astype(np.uint64), levels, cut)
