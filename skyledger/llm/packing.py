"""Cost-balanced packing of token sequences.

Attention over a piece of n tokens costs about n + n * n / QUADRATIC. Full pieces are cut off as
sequences of their own; the rests of a group of documents are dealt out, most costly first, each
to the sequence that has cost the least so far and still has room. A group's sequences have in
total exactly the room its tokens need: as many full ones as go, then powers of two, which need
no padding. A rest that fits nowhere whole is cut over the sequences with most room.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.shared import for_python, id_and_text, ids_of
from skyledger.llm.tokens import encoder

LENGTH = 2048

# Tokens at which linear and quadratic cost of a piece are equal.
QUADRATIC = 4096

# Rests are dealt out when this many tokens of them are together.
GROUP_TOKENS = 1 << 19

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, capacity long"
)

# A task has its own range of sequence ids.
TASK_BITS = 33


def cost(length: np.ndarray | int) -> np.ndarray | float:
    return length + length * length / QUADRATIC


def capacities(tokens: int, length: int) -> np.ndarray:
    """Rooms that hold ``tokens`` exactly: full sequences and then powers of two."""
    full, rest = divmod(tokens, length)
    powers = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return np.array([length] * full + powers, dtype=np.int64)


def deal(sizes: np.ndarray, length: int) -> list[tuple[int, int, int, int, int]]:
    """(piece, start in it, tokens, sequence, offset there) for rests of ``sizes`` tokens."""
    room = capacities(int(sizes.sum()), length)
    total, spent, filled = room.copy(), np.zeros(len(room)), np.zeros(len(room), dtype=np.int64)
    out = []
    for piece in np.lexsort((np.arange(len(sizes)), -sizes)).tolist():
        start, left = 0, int(sizes[piece])
        while left:
            fits = room >= left
            k = int(np.argmin(np.where(fits, spent, np.inf))) if fits.any() else int(np.argmax(room))
            part = min(left, int(room[k]))
            out.append((piece, start, part, k, int(filled[k])))
            room[k] -= part
            filled[k] += part
            spent[k] += cost(part)
            start, left = start + part, left - part
    assert (filled == total).all()
    return out


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` tokens: see PIECES.

    Each row is one document: its ids and the end id, a null text is empty. Every id is in one
    piece. ``capacity`` is the length of the sequence, which its pieces fill without a gap. Rows
    with a null or repeated id are documents of their own. Documents of a task are packed
    together where they are read, so no row moves, and a task that runs again packs the same.
    An empty table gives no piece.
    """
    if length < 1:
        raise ValueError("a sequence has at least one token")
    texts = for_python(id_and_text(docs)).withColumn("task", F.spark_partition_id())

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code, end = encoder(vocabulary), np.array([end_id], dtype="<u4").tobytes()
        serial = 0
        rests: list[tuple[int | None, bytes, int, int]] = []
        waiting = 0

        def closed() -> list[tuple]:
            nonlocal serial
            sizes = np.array([len(rest) // 4 for _, rest, _, _ in rests], dtype=np.int64)
            rows = []
            rooms = capacities(int(sizes.sum()), length)
            for piece, at, tokens, k, offset in deal(sizes, length):
                doc_id, rest, start, doc_tokens = rests[piece]
                crc = zlib.crc32(rest[4 * at : 4 * (at + tokens)])
                rows.append((doc_id, start + at, tokens, crc, doc_tokens, serial + k, offset, int(rooms[k])))
            serial += len(rooms)
            return rows

        def frame_of(rows: list[tuple], task: int) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
            out["sequence_id"] += task << TASK_BITS
            return out.astype({"doc_id": "Int64"})

        task = 0
        for frame in frames:
            rows = []
            for task, doc_id, content in zip(frame["task"].tolist(), ids_of(frame), code.encode_all(frame["text"]), strict=True):
                ids = content + end
                tokens = len(ids) // 4
                whole = tokens // length * length
                for start in range(0, whole, length):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, zlib.crc32(part), tokens, serial, 0, length))
                    serial += 1
                if whole < tokens:
                    rests.append((doc_id, ids[4 * whole :], whole, tokens))
                    waiting += tokens - whole
                if waiting >= GROUP_TOKENS:
                    rows += closed()
                    rests, waiting = [], 0
            if rows:
                yield frame_of(rows, task)
        if rests:
            yield frame_of(closed(), task)

    return texts.mapInPandas(pack, PIECES)
