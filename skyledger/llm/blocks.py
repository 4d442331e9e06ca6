"""Files of a few arrays each, one for a block of documents, in the shared folder.

A block is what one task handles at a time. Its documents are written once, so later passes read
the same rows in the same order, whatever happens to the executors, and each pass finds the
replies to its questions under the name of the block.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.files import SharedFolder
from skyledger.llm.shared import for_python, id_and_text, ids_of, materialize, shuffle_partitions
from skyledger.llm.words import encoded

SIZES = struct.Struct("<QQ")

# The range of documents is in the upper bits of a block's number, so blocks run in their order.
SERIAL_BITS = 32

REPLIED = "block long"


def write_arrays(folder: str, name: str, arrays: Sequence[np.ndarray | bytes]) -> None:
    """One compressed file of the bytes of ``arrays``."""
    codec, out = pa.Codec("zstd", compression_level=1), [struct.pack("<Q", len(arrays))]
    for x in arrays:
        raw = x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes()
        small = codec.compress(raw, asbytes=True)
        out += [SIZES.pack(len(raw), len(small)), small]
    SharedFolder(folder).write(name, b"".join(out))


def read_arrays(folder: str, name: str) -> list[bytes]:
    """What ``write_arrays`` wrote, as bytes."""
    content = memoryview(SharedFolder(folder).read_all(name))
    codec, out, at = pa.Codec("zstd"), [], 8
    for _ in range(struct.unpack_from("<Q", content)[0]):
        size, small = SIZES.unpack_from(content, at)
        at += SIZES.size
        out.append(codec.decompress(content[at : at + small], decompressed_size=size, asbytes=True) if size else b"")
        at += small
    return out


def block_name(block: int, kind: str) -> str:
    return f"{block:016x}.{kind}"


def ordered_texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``no_id`` and ``text``, range partitioned and sorted by id (null first), then by a hash of the text."""
    parts = shuffle_partitions(docs.sparkSession)
    texts = id_and_text(docs).withColumn("__hash", F.xxhash64("text"))
    ordered = texts.repartitionByRange(parts, "doc_id", "__hash").sortWithinPartitions("doc_id", "__hash")
    return for_python(ordered.drop("__hash"))


def blocks_of(frames: Iterator[pd.DataFrame], limit: int) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Ids and texts of about ``limit`` bytes together; a longer text is alone."""
    ids: list[int | None] = []
    texts: list[bytes] = []
    held = 0
    for frame in frames:
        for doc_id, text in zip(ids_of(frame), encoded(frame["text"]), strict=True):
            if texts and held + len(text) > limit:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(None if doc_id is pd.NA else doc_id)
            texts.append(text)
            held += len(text)
    if texts:
        yield ids, texts


def ids_as_arrays(ids: Sequence[int | None]) -> list[np.ndarray]:
    """Ids and which of them are null."""
    null = np.array([x is None for x in ids], dtype=bool)
    return [np.array([0 if x is None else x for x in ids], dtype="<i8"), null]


def arrays_as_ids(known: bytes, null: bytes) -> pd.Series:
    ids = pd.Series(np.frombuffer(known, dtype="<i8").copy()).astype("Int64")
    return ids.mask(np.frombuffer(null, dtype=bool))


def cut(text: bytes, sizes: np.ndarray) -> list[bytes]:
    """A buffer cut at the given sizes."""
    ends = np.cumsum(sizes).tolist()
    return [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def buckets_for(partitions: int) -> int:
    """Bits of a bucket's number, so that there are at least as many buckets as partitions."""
    return min(max(4, int(partitions - 1).bit_length()), 16)


def write_replies(answers: DataFrame, folder: str, kind: str) -> DataFrame:
    """One file of bits per block from ``block, bucket, size, bits``, in the order of the buckets.

    Returns the numbers of the blocks as a written table.
    """

    def write(frame: pd.DataFrame) -> pd.DataFrame:
        block = int(frame["block"].iloc[0])
        frame = frame.sort_values("bucket")
        bits = [
            np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n) for b, n in zip(frame["bits"], frame["size"], strict=True)
        ]
        write_arrays(folder, block_name(block, kind), [np.packbits(np.concatenate(bits))])
        return pd.DataFrame({"block": [block]})

    return materialize(answers.groupBy("block").applyInPandas(write, REPLIED), "blocks")


def read_replies(folder: str, block: int, kind: str, count: int) -> np.ndarray:
    bits = np.frombuffer(read_arrays(folder, block_name(block, kind))[0], dtype=np.uint8)
    return np.unpackbits(bits, count=count).view(bool)


def each_block(blocks: DataFrame) -> DataFrame:
    """The block numbers dealt to as many tasks as a shuffle has, whatever their few bytes."""
    return blocks.repartition(shuffle_partitions(blocks.sparkSession))
