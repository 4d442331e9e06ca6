"""Token ids as wavelet matrices: one compressed file a shard, with rank and select on bit planes.

Level k of a wavelet matrix holds bit k (from the highest) of every id, in an order that is
stable-sorted by the bits above. The number of zeros of a level and a count of ones per block of
512 bits are all that rank needs, and select is a search over rank. From one file one can read
any token, count an id in a range of positions, and find its k-th occurrence.

File: magic, levels, tokens, documents, then as zstd frames the document table (id, place of the
first token within the range of documents, tokens) and for each level its zeros and packed bits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.files import SharedFolder
from skyledger.llm.shared import for_python, id_and_text, ids_of, scratch_path, shuffle_partitions
from skyledger.llm.tokens import encoder

MAGIC = b"WVMX0002"
HEADER = struct.Struct("<8sIQQ")
LEVEL = struct.Struct("<QQ")
BLOCK_BITS = 512

# A shard is closed at this many tokens; a document stays whole, so one may be longer.
SHARD_TOKENS = 1 << 22

# Characters of texts that are encoded together.
BATCH_CHARACTERS = 1 << 22

WRITTEN = "range int, shard int, tokens long"
READ = "range int, doc_id long, place long, n_tokens long, ids_crc32 long"


def _packed(content: np.ndarray) -> bytes:
    return pa.compress(content.tobytes(), codec="zstd", asbytes=True)


def _unpacked(content: bytes, size: int) -> bytes:
    return pa.decompress(content, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def encode_shard(ids: np.ndarray, doc_ids: np.ndarray, doc_null: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> bytes:
    """The file of one shard; ``ids`` are the tokens of its documents one after the other."""
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    table = np.stack([doc_ids, doc_null.astype(np.int64), places, sizes]).astype("<i8")
    out = [HEADER.pack(MAGIC, levels, len(ids), len(doc_ids))]
    docs = _packed(table)
    out += [struct.pack("<Q", len(docs)), docs]
    left = ids.astype(np.uint16) if levels <= 16 else ids.astype(np.uint32)
    for level in range(levels - 1, -1, -1):
        bits = (left >> left.dtype.type(level)) & left.dtype.type(1)
        ones = bits.astype(bool)
        plane = _packed(np.packbits(ones, bitorder="little"))
        out += [LEVEL.pack(len(left) - int(np.count_nonzero(ones)), len(plane)), plane]
        if level:
            # Much faster than a mask as an index.
            left = np.concatenate([np.compress(~ones, left), np.compress(ones, left)])
    return b"".join(out)


class WaveletShard:
    """Read side of a shard file."""

    def __init__(self, content: bytes) -> None:
        magic, self.levels, self.tokens, documents = HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        at = HEADER.size
        (size,) = struct.unpack_from("<Q", content, at)
        table = np.frombuffer(_unpacked(content[at + 8 : at + 8 + size], 32 * documents), dtype="<i8").reshape(4, documents)
        self.doc_ids, self.doc_null, self.places, self.sizes = table[0], table[1].astype(bool), table[2], table[3]
        at += 8 + size
        self.zeros, self.planes = [], []
        for _ in range(self.levels):
            zeros, size = LEVEL.unpack_from(content, at)
            at += LEVEL.size
            self.zeros.append(zeros)
            self.planes.append(np.frombuffer(_unpacked(content[at : at + size], -(-self.tokens // 8)), dtype=np.uint8))
            at += size
        self._blocks: list[np.ndarray] | None = None

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.tokens, bitorder="little").view(bool)

    def all_tokens(self) -> np.ndarray:
        """Every id in order, undone level by level from the lowest bit."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        right = np.zeros(self.tokens, dtype=kind)
        for level in range(self.levels - 1, -1, -1):
            ones = self._bits(level)
            values = np.empty(self.tokens, dtype=kind)
            values[np.flatnonzero(~ones)] = right[: self.zeros[level]]
            values[np.flatnonzero(ones)] = right[self.zeros[level] :] | kind(1 << (self.levels - 1 - level))
            right = values
        return right.astype("<u4")

    def _rank(self, level: int, position: int) -> int:
        """Ones of a level before ``position``."""
        if self._blocks is None:
            self._blocks = []
            for plane in self.planes:
                padded = np.zeros(-(-len(plane) // (BLOCK_BITS // 8)) * (BLOCK_BITS // 8), dtype=np.uint8)
                padded[: len(plane)] = plane
                counts = np.bitwise_count(padded).reshape(-1, BLOCK_BITS // 8).sum(axis=1)
                self._blocks.append(np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]))
        block, rest = divmod(position, BLOCK_BITS)
        first = block * BLOCK_BITS // 8
        part = np.unpackbits(self.planes[level][first : first + BLOCK_BITS // 8], bitorder="little")[:rest]
        return int(self._blocks[level][block]) + int(part.sum())

    def access(self, position: int) -> int:
        """The id at a position."""
        if not 0 <= position < self.tokens:
            raise IndexError(position)
        value = 0
        for level in range(self.levels):
            ones = self._rank(level, position)
            bit = self._rank(level, position + 1) - ones
            position = self.zeros[level] + ones if bit else position - ones
            value = value << 1 | bit
        return value

    def _narrow(self, token: int, first: int, last: int) -> tuple[int, int]:
        if token >> self.levels:
            return 0, 0
        for level in range(self.levels):
            a, b = self._rank(level, first), self._rank(level, last)
            if token >> (self.levels - 1 - level) & 1:
                first, last = self.zeros[level] + a, self.zeros[level] + b
            else:
                first, last = first - a, last - b
        return first, last

    def count(self, token: int, first: int = 0, last: int | None = None) -> int:
        """Occurrences of an id in a range of positions."""
        low, high = self._narrow(token, first, self.tokens if last is None else last)
        return high - low

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of an id; IndexError if there are fewer."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        low, high = 0, self.tokens
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if self.count(token, 0, middle) > k else (middle, high)
        return low


def write_wavelet_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Encode every whole text and write the shard files; returns ``range, shard, tokens`` per file.

    Documents are range partitioned by id and sorted, so the names of the files (range, shard)
    run in ascending doc_id order; a null id comes first, rows that share an id stay side by
    side, in the order of their texts. A null or empty text is the end id alone. The result is lazy: every run of it writes
    the same files anew under the same names.
    """
    parts = shuffle_partitions(docs.sparkSession)
    ordered = id_and_text(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered = for_python(ordered).withColumn("range", F.spark_partition_id())
    end = struct.pack("<I", end_id)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code, out = encoder(vocabulary), SharedFolder(folder)
        held: list[bytes] = []
        doc_ids: list[int | None] = []
        place = shard = tokens = 0

        def close() -> pd.DataFrame:
            sizes = np.array([len(x) // 4 for x in held], dtype=np.int64)
            places = place - int(sizes.sum()) + np.cumsum(sizes) - sizes
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            null = np.array([x is None for x in doc_ids])
            known = np.array([0 if x is None else x for x in doc_ids], dtype=np.int64)
            out.write(f"{number:08d}-{shard:08d}.wvm", encode_shard(ids, known, null, places, sizes))
            return pd.DataFrame({"range": [number], "shard": [shard], "tokens": [tokens]})

        for frame in frames:
            number = int(frame["range"].iloc[0]) if len(frame) else 0
            for doc_id, content in zip(ids_of(frame), code.encode_all(frame["text"], BATCH_CHARACTERS), strict=True):
                ids = content + end
                held.append(ids)
                doc_ids.append(None if doc_id is pd.NA else doc_id)
                tokens += len(ids) // 4
                place += len(ids) // 4
                if tokens >= SHARD_TOKENS:
                    yield close()
                    held, doc_ids, tokens, shard = [], [], 0, shard + 1
        if held:
            yield close()

    return ordered.mapInPandas(write, WRITTEN)


def read_wavelet_files(files: DataFrame) -> DataFrame:
    """Per document of the shard files (``path, content``): range, place in it, tokens, crc32."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                shard = WaveletShard(content)
                ids = memoryview(shard.all_tokens().tobytes())
                ends = np.cumsum(shard.sizes) * 4
                starts = ends - shard.sizes * 4
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pd.DataFrame(
                    {
                        "range": np.full(len(crcs), int(path.rpartition("/")[2].split("-")[0]), dtype=np.int32),
                        "doc_id": pd.array(shard.doc_ids, dtype="Int64").copy(),
                        "place": shard.places,
                        "n_tokens": shard.sizes,
                        "ids_crc32": np.array(crcs, dtype=np.int64),
                    }
                ).assign(doc_id=lambda f, null=shard.doc_null: f["doc_id"].mask(null))

    return files.select("path", "content").mapInPandas(read, READ)


def wavelet_round_trip(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the ids of all documents as wavelet files and read them back.

    Returns ``doc_id, start, n_tokens, ids_crc32`` per row of ``docs``, from the files: ``start``
    counts the ids of all documents before it in doc_id order (null ids first, repeated rows one
    after the other). An empty table gives no file and no row.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "wavelet")
    written = write_wavelet_files(docs, folder, vocabulary, end_id)
    # One number per range: as many rows as there are shuffle partitions.
    totals = {r["range"]: r["tokens"] for r in written.groupBy("range").agg(F.sum("tokens").alias("tokens")).collect()}
    if not totals:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    before, rows = 0, []
    for number in sorted(totals):
        rows.append((number, before))
        before += totals[number]
    offsets = spark.createDataFrame(rows, "range int, before long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(folder)
    back = read_wavelet_files(files).join(F.broadcast(offsets), "range")
    return back.select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
