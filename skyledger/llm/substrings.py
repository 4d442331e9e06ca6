"""Passages of whole words that were there before, found through difference-cover anchors.

A window is WINDOW consecutive words of one document. Anchors are runs of ANCHOR words at the
positions p of a document with p mod PERIOD in COVER, a perfect difference set: for any two
positions there is one shift below PERIOD that puts both on the cover. PERIOD - 1 + ANCHOR words
are a window, so two equal windows share an anchor at the same place in both. About a third of
the positions are hashed; where no anchor is found twice, no window can be.

Three passes over the documents, which are written once in blocks in ascending order of their ids:

1. The anchors of a block are asked about by range of hash; the reply is a bit for each of its
   distinct anchors: found in another block.
2. Anchors found twice are extended: the windows that hold one are asked about by a 96-bit hash of
   their words, each distinct one of a block once; the reply says whether an earlier block has it.
3. Words of windows that started earlier, in the block or before it, go.

A passage of all copies is one row per block that holds it, so no key gathers more rows than
there are blocks, and no pairs of copies are made.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from skyledger.llm.blocks import (
    SERIAL_BITS,
    arrays_as_ids,
    block_name,
    blocks_of,
    buckets_for,
    cut,
    each_block,
    ids_as_arrays,
    ordered_texts,
    read_arrays,
    read_replies,
    write_arrays,
    write_replies,
)
from skyledger.llm.hot_shingles import packed, unpacked
from skyledger.llm.shared import scratch_path, shuffle_partitions
from skyledger.llm.words import AS_IS, _keys, batches, mix, word_hashes

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)

# Bytes of text that a task holds with their hashes at a time: about eight times as much memory.
BLOCK_BYTES = 1 << 25

RUN_KEYS = _keys(11, 256) | np.uint64(1)
CHECK_KEYS = _keys(12, 256) | np.uint64(1)

ASKED = "block long, bucket int, size int, keys binary"
ANSWERED = "block long, bucket int, size int, bits binary"
KEPT = "doc_id long, n_words long, n_removed long, kept string"


def run_hashes(words: np.ndarray, at: np.ndarray, width: int, keys: np.ndarray) -> np.ndarray:
    """A hash of the ``width`` words from each position on."""
    total = np.zeros(len(at), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total += words[at + k] * keys[k]
        return mix(total)


class Block:
    """The words of a block's documents as hashes, with their places."""

    def __init__(self, texts: list[bytes], window: int) -> None:
        hashes, counts, before = [], [], 0
        for first, last in batches(texts):
            words, upto = word_hashes(texts[first:last], letters=AS_IS)
            hashes.append(words)
            counts.append(np.diff(upto, prepend=0))
        self.words = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        self.counts = np.concatenate([*counts, np.zeros(0, np.int64)]).astype(np.int64)
        ends = np.cumsum(self.counts)
        self.starts = ends - self.counts
        self.window, self.anchor = window, window - PERIOD + 1
        # Words from here to the end of the document, and where in it here is.
        number = np.arange(len(self.words), dtype=np.int64)
        place = number - np.repeat(self.starts, self.counts)
        left = np.repeat(ends, self.counts) - number
        self.fits = left >= window
        on_cover = np.zeros(PERIOD, dtype=bool)
        on_cover[list(COVER)] = True
        long_enough = np.repeat(self.counts >= window, self.counts)
        self.anchors = np.flatnonzero(on_cover[place % PERIOD] & (left >= self.anchor) & long_enough)

    def anchor_keys(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of ``bits`` + 32 bits, the number of each anchor among them, and how often they occur."""
        keys = run_hashes(self.words, self.anchors, self.anchor, RUN_KEYS) >> np.uint64(32 - bits)
        return np.unique(keys, return_inverse=True, return_counts=True)

    def candidates(self, twice: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold an anchor of ``twice`` (a flag per anchor) with its words."""
        found = np.zeros(len(self.words) + PERIOD + 1, dtype=np.int32)
        found[self.anchors[twice] + 1] = 1
        upto = np.cumsum(found, dtype=np.int32)
        number = np.arange(len(self.words))
        return np.flatnonzero(self.fits & (upto[number + PERIOD] > upto[number]))

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the windows at ``at``: which is the first of its words here (by number), those firsts' keys and checks
        in ascending order, and for each window the number of its words in that order."""
        keys = run_hashes(self.words, at, self.window, RUN_KEYS)
        checks = (run_hashes(self.words, at, self.window, CHECK_KEYS) >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((checks, keys))
        keys, checks = keys[order], checks[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
        number = np.empty(len(at), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        return order[new], keys[new], checks[new], number

    def removed(self, repeated: np.ndarray) -> np.ndarray:
        """A flag per word: it lies in one of the windows that start at ``repeated``."""
        edges = np.zeros(len(self.words) + 1, dtype=np.int32)
        np.add.at(edges, repeated, 1)
        np.add.at(edges, repeated + self.window, -1)
        return np.cumsum(edges[:-1]) > 0


def _rows(block: int, bits: int, keys: np.ndarray, width: int, content) -> pd.DataFrame:
    """One row per bucket of sorted keys of ``width`` bits; a block always has a row."""
    edges = np.searchsorted(keys >> np.uint64(width - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).tolist()
    found = [(k, a, b) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b] or [(0, 0, 0)]
    return pd.DataFrame([(block, k, b - a, content(a, b)) for k, a, b in found], columns=["block", "bucket", "size", "keys"])


def _answers(frame: pd.DataFrame, flags: np.ndarray) -> pd.DataFrame:
    """The rows of a bucket with one flag per key of theirs."""
    ends = np.cumsum(frame["size"].to_numpy(dtype=np.int64)).tolist()
    bits = [np.packbits(flags[a:b]).tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"], "size": frame["size"], "bits": bits})


def _in_two_blocks(frame: pd.DataFrame) -> pd.DataFrame:
    keys = [unpacked(c, n) if n else np.zeros(0, np.uint32) for c, n in zip(frame["keys"], frame["size"], strict=True)]
    every = np.concatenate(keys)
    found, place, counts = np.unique(every, return_inverse=True, return_counts=True)
    return _answers(frame, counts[place] > 1)


def _in_earlier_block(frame: pd.DataFrame) -> pd.DataFrame:
    sizes = frame["size"].to_numpy(dtype=np.int64)
    keys = np.concatenate([np.frombuffer(c, dtype="<u8", count=n) for c, n in zip(frame["keys"], sizes, strict=True)])
    checks = np.concatenate([np.frombuffer(c, dtype="<u4", offset=8 * n) for c, n in zip(frame["keys"], sizes, strict=True)])
    order = np.lexsort((np.repeat(frame["block"].to_numpy(), sizes), checks, keys))
    keys, checks = keys[order], checks[order]
    again = np.zeros(len(keys), dtype=bool)
    again[1:] = (keys[1:] == keys[:-1]) & (checks[1:] == checks[:-1])
    flags = np.empty(len(keys), dtype=bool)
    flags[order] = again
    return _answers(frame, flags)


def remove_repeats(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` per row of ``docs``.

    A word goes if a window of ``window`` words over it also starts earlier: in a document with a
    smaller id, or before it in the same one. All windows are judged on the input. ``kept`` has
    the other words with one space between them. A null text has no words. Rows that share an id
    are documents of their own, ordered by a hash of their texts, and of equal rows one is the earlier;
    null ids come before all others. An empty table has no rows.

    ``window`` is at least PERIOD. The documents are written to the shared folder in blocks of
    about ``block_bytes``; more memory per task allows larger blocks and fewer, longer questions.
    """
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    spark: SparkSession = docs.sparkSession
    folder = scratch_path(spark, "passages")
    bits = buckets_for(shuffle_partitions(spark))
    numbered = ordered_texts(docs)

    def anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for serial, (ids, texts) in enumerate(blocks_of(frames, block_bytes)):
            number = part << SERIAL_BITS | serial
            sizes = np.array([len(t) for t in texts], dtype="<i8")
            write_arrays(folder, block_name(number, "texts"), [*ids_as_arrays(ids), sizes, b"".join(texts)])
            keys, _, _ = Block(texts, window).anchor_keys(bits)
            low = keys.astype("<u4")
            yield _rows(number, bits, keys, bits + 32, lambda a, b, low=low: packed(low[a:b]) if a < b else b"")

    def opened(number: int) -> tuple[pd.Series, list[bytes], Block, np.ndarray]:
        known, null, sizes, text = read_arrays(folder, block_name(number, "texts"))
        texts = cut(text, np.frombuffer(sizes, dtype="<i8"))
        block = Block(texts, window)
        keys, place, counts = block.anchor_keys(bits)
        twice = read_replies(folder, number, "anchors", len(keys)) | (counts > 1)
        return arrays_as_ids(known, null), texts, block, block.candidates(twice[place])

    def windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number in frame["block"].tolist():
                _, _, block, at = opened(number)
                _, keys, checks, _ = block.windows(at)
                keys, checks = keys.astype("<u8"), checks.astype("<u4")
                yield _rows(number, bits, keys, 64, lambda a, b, k=keys, c=checks: k[a:b].tobytes() + c[a:b].tobytes())

    def kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number in frame["block"].tolist():
                ids, texts, block, at = opened(number)
                first, keys, _, place = block.windows(at)
                repeated = read_replies(folder, number, "windows", len(keys))[place]
                later = np.ones(len(at), dtype=bool)
                later[first] = False
                gone = block.removed(at[repeated | later])
                upto = np.concatenate([[0], np.cumsum(gone)])
                removed = upto[block.starts + block.counts] - upto[block.starts]
                for low, high in batches(texts):
                    out = []
                    for k in range(low, high):
                        words = texts[k].split()
                        if removed[k]:
                            words = compress(words, ~gone[block.starts[k] : block.starts[k] + block.counts[k]])
                        out.append(b" ".join(words).decode("utf-8", "replace"))
                    yield pd.DataFrame(
                        {"doc_id": ids[low:high], "n_words": block.counts[low:high], "n_removed": removed[low:high], "kept": out}
                    )

    asked = numbered.mapInPandas(anchors, ASKED)
    blocks = write_replies(asked.groupBy("bucket").applyInPandas(_in_two_blocks, ANSWERED), folder, "anchors")
    extended = each_block(blocks).mapInPandas(windows, ASKED)
    blocks = write_replies(extended.groupBy("bucket").applyInPandas(_in_earlier_block, ANSWERED), folder, "windows")
    return each_block(blocks).mapInPandas(kept, KEPT)
