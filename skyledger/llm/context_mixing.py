"""Probabilities of texts by logistic mixing of context bit predictors.

A byte is predicted bit by bit. For each of several orders, a predictor knows how often a 1 and
a 0 came after the last bytes and the bits of the byte so far. The stretched predictions
are added with weights that a gate selects (the bit, and how many orders know their context), squashed, and refined by a table of
what became of such predictions.

A byte and the bytes before it that matter are one key. Blocks of texts send their distinct keys
to the bucket of the last two bytes before, the shortest context: every longer one ends with it, so a
bucket has the counts of all its contexts of all orders, one for each context seen, without hashing.
Each bucket moves the weights along its own training keys and fills the refining table; the
buckets' moves are added, each by the curvature it was made with, and so are the tables, so that the
weights hardly depend on the number of buckets. Then each bucket answers the
blocks with the probabilities of the keys they asked for; equal keys are worked out once.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.blocks import arrays_as_ids, cut, ids_as_arrays, read_arrays, write_arrays
from skyledger.llm.shared import for_python, id_and_text, ids_of, materialize, scratch_path, shuffle_partitions
from skyledger.llm.words import batches, encoded, mix, word_hashes

ORDERS = (2, 3, 4, 6)
LONGEST = max(ORDERS)
RANGES = 32

# Stands before and after every text; no UTF-8 text has it.
END = 0xFF

PRIOR = 0.2
START_WEIGHT = 0.35
RIDGE = 16.0
SURE = 13.0
CELLS = 33
CELL_TRUST = 16.0

# Bytes of text whose keys are worked out together: more have fewer distinct keys.
BATCH_BYTES = 1 << 22

# Slices in which a bucket's keys move the weights, at least, and keys of a slice, at most.
STEPS = 16
SLICE_KEYS = 1 << 17

# Buckets of keys for each shuffle partition.
BUCKETS = 2

# Rows whose words and keys are looked up together: more have fewer distinct keys to ask for.
LOOKUP_ROWS = 4096

TABLES = "kind int, range int, content binary"
REQUESTS = "bucket int, block long, words binary, counts binary"
KEY_REQUESTS = "bucket int, block long, size int, keys binary, counts binary"
TEXTS = "block long, part int, rows int, content binary"
REPLIES = "block long, bucket int, counts binary"
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
    "n_bytes long"
)


def byte_keys(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The key of every byte and end of the texts, and per text the number of keys up to its end."""
    gap = bytes([END]) * LONGEST
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    buffer = np.frombuffer(gap + gap.join([*texts, b""]), dtype=np.uint8)
    keys = np.zeros(len(buffer) - LONGEST, dtype=np.uint64)
    for k in range(LONGEST + 1):
        keys = keys << np.uint64(8) | buffer[k : len(buffer) - LONGEST + k]
    starts = np.cumsum(sizes + LONGEST) - (sizes + LONGEST)
    upto = np.cumsum(sizes + 1)
    # Of the gap after a text, only the first sign is predicted.
    places = np.arange(int((sizes + 1).sum())) + np.repeat(starts - (upto - sizes - 1), sizes + 1)
    return keys[places], upto


def _nodes(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each bit of the byte: the gate (a 1 and the bits so far), and the bit."""
    byte = keys & np.uint64(0xFF)
    for k in range(8):
        yield np.uint64(1 << k) | byte >> np.uint64(8 - k), (byte >> np.uint64(7 - k)) & np.uint64(1)


def start_weights() -> np.ndarray:
    """Weights by bit of the byte, gate, and order; the last one is of a constant."""
    weights = np.full((8, len(ORDERS) + 1, len(ORDERS) + 1), START_WEIGHT)
    weights[..., -1] = 0.0
    return weights


def _inputs(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Stretched predictions and a constant as columns, and the gate: how many orders know the context."""
    x = np.ones((len(columns[0]), len(columns) + 1), dtype=np.float32)
    for k, column in enumerate(columns):
        x[:, k] = column
    return x, np.count_nonzero(x[:, :-1], axis=1)


def _mixed(weights: np.ndarray, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
    return np.clip(np.einsum("ij,ij->i", weights.astype(np.float32)[gate], x), -SURE, SURE)


def _squashed(total: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-total))


def _cells(node: np.ndarray, total: np.ndarray) -> np.ndarray:
    return node.astype(np.int64) * CELLS + np.rint((total + SURE) * ((CELLS - 1) / (2 * SURE))).astype(np.int64)


def stretch(counts: np.ndarray) -> np.ndarray:
    """Log-odds of a 1 from the counts of 0 and 1 in the last axis; 0 for what was not seen."""
    return np.log((counts[..., 1] + np.float32(PRIOR)) / (counts[..., 0] + np.float32(PRIOR)))


def start_curves() -> np.ndarray:
    """Curvature by bit, gate, and two orders before any key: how firmly the weights stay where they start."""
    size = len(ORDERS) + 1
    return np.broadcast_to(RIDGE * np.eye(size), (8, size, size, size)).copy()


def joined_weights(curves: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The weights from the sums over buckets of curvature, less the start's, and of curvature times move."""
    return start_weights() + np.linalg.solve(curves + start_curves(), moves[..., None])[..., 0]


def _learn_slice(
    weights: np.ndarray,
    curves: np.ndarray,
    cells: np.ndarray,
    keys: np.ndarray,
    times: np.ndarray,
    counts: Iterator[list[np.ndarray]],
) -> None:
    """One step of ``weights`` along the keys; ``counts`` has per bit the (0, 1) counts of each order without the bit itself.

    A step is the slope over the curvature of all keys so far, so steps get shorter. A squared error counts as
    curvature where it is the larger: a prediction that is sure and wrong has next to none of its own.
    """
    for place, ((node, bit), known) in enumerate(zip(_nodes(keys), counts, strict=True)):
        x, _ = _inputs([stretch(n) for n in known])
        gate = _known(known)
        total = _mixed(weights[place], x, gate)
        p = _squashed(total)
        cell = _cells(node, total)
        cells[1] += np.bincount(cell, times, len(cells[1]))
        cells[0] += np.bincount(cell, times * bit, len(cells[0]))
        error = bit - p
        slope, curve = times * error, times * np.maximum(p * (1 - p), error * error)
        for k in range(weights.shape[1]):
            at = np.flatnonzero(gate == k)
            if len(at):
                own = x[at].astype(np.float64)
                curves[place, k] += (own * curve[at, None]).T @ own
                weights[place, k] += np.linalg.solve(curves[place, k], own.T @ slope[at])


def _known(counts: list[np.ndarray]) -> np.ndarray:
    """How many orders have seen the context and the bits so far."""
    return np.sum([n.sum(axis=1) > 0 for n in counts], axis=0, dtype=np.int64)


def _log10(weights: np.ndarray, ones: np.ndarray, seen: np.ndarray, keys: np.ndarray, inputs: Iterator[tuple]) -> np.ndarray:
    """log10 of the probability of each key's byte; ``inputs`` has predictions and gate per bit."""
    # Half the mixed prediction and half what the cell has seen, as a slope and a shift per cell.
    trust = 0.5 / (seen + CELL_TRUST)
    slope, shift = (0.5 + CELL_TRUST * trust).astype(np.float32), (ones * trust).astype(np.float32)
    out = np.ones(len(keys))
    for place, ((node, bit), (x, gate)) in enumerate(zip(_nodes(keys), inputs, strict=True)):
        total = _mixed(weights[place], x, gate)
        cell = _cells(node, total)
        p = _squashed(total) * slope[cell] + shift[cell]
        out *= np.where(bit == 1, p, 1 - p)
    return np.log10(out)


@dataclass(frozen=True)
class Learnt:
    """Weights by bit, gate and order, the refining table, and the buckets whose requests lie in ``folder``."""

    weights: np.ndarray
    ones: np.ndarray
    total: np.ndarray
    folder: str = ""
    buckets: frozenset[int] = frozenset()


class Contexts:
    """Exact counts of all contexts of a bucket's distinct sorted keys.

    ``sums[order][d]`` has for each key how often its context and the first d bits of its byte were seen.
    """

    def __init__(self, keys: np.ndarray, times: np.ndarray) -> None:
        self.keys, self.times = keys, times
        self.sums = []
        for length in ORDERS:
            own = keys & np.uint64((1 << 8 * (length + 1)) - 1)
            order = np.argsort(own, kind="stable")
            sorted_keys, upto = own[order], np.concatenate([[0], np.cumsum(times[order])])
            sums = np.empty((9, len(keys)), dtype=np.float32)
            for depth in range(9):
                prefix = sorted_keys >> np.uint64(8 - depth)
                edges = _edges(prefix)
                sums[depth, order] = np.repeat(np.diff(upto[edges]), np.diff(edges))
            self.sums.append(sums)

    def counts(self, at: np.ndarray, without: int) -> Iterator[list[np.ndarray]]:
        """Per bit the (0, 1) counts of each order for the keys ``at``, less ``without`` of the key's own bit."""
        for place, (_, bit) in enumerate(_nodes(self.keys[at])):
            found = []
            for sums in self.sums:
                own, both = sums[place + 1, at], sums[place, at]
                two = np.stack([np.maximum(own - without, 0), both - own], axis=1)
                found.append(np.where((bit == 1)[:, None], two[:, ::-1], two))
            yield found

    def slices(self, at: np.ndarray) -> Iterator[np.ndarray]:
        count = max(STEPS, -(-len(at) // SLICE_KEYS))
        yield from (at[k::count] for k in range(count) if k < len(at))

    def learn(self, weights: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Move ``weights`` along the keys that training texts have, note in ``cells`` what became of each; the curvature."""
        curves = start_curves()
        for at in self.slices(np.flatnonzero(self.times)):
            _learn_slice(weights, curves, cells, self.keys[at], self.times[at].astype(np.float32), self.counts(at, 1))
        return curves

    def log10(self, learnt: Learnt) -> np.ndarray:
        """log10 of the probability of each key's byte after its context."""
        out = np.zeros(len(self.keys))
        for at in self.slices(np.arange(len(self.keys))):
            inputs = ((_inputs([stretch(n) for n in known])[0], _known(known)) for known in self.counts(at, 0))
            out[at] = _log10(learnt.weights, learnt.ones, learnt.total, self.keys[at], inputs)
        return out


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as gaps, byte by byte, compressed."""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zlib.compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked_keys(content: bytes, size: int) -> np.ndarray:
    gaps = np.frombuffer(zlib.decompress(content), dtype=np.uint8).reshape(8, size).T.copy().view("<u8").ravel()
    return np.cumsum(gaps, dtype=np.uint64)


def _owners(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key, by the two bytes before its byte: all its contexts end with them."""
    return (mix(keys >> np.uint64(8) & np.uint64(0xFFFF)) % np.uint64(buckets)).astype(np.int64)


def _tallied_keys(texts: list[bytes], training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys of the texts and their counts in the training ones."""
    found, counts = [], []
    for first, last in batches(texts, BATCH_BYTES):
        keys, upto = byte_keys(texts[first:last])
        # A key has 56 bits, so there is one left for whether it is learnt from.
        keys <<= np.uint64(1)
        keys |= np.repeat(training[first:last], np.diff(np.concatenate([[0], upto]))).astype(np.uint64)
        keys.sort()
        learnt = np.concatenate([[0], np.cumsum(keys & np.uint64(1), dtype=np.int64)])
        keys >>= np.uint64(1)
        edges = _edges(keys)
        found.append(keys[edges[:-1]])
        counts.append(np.diff(learnt[edges]))
    if len(found) == 1:
        return found[0], counts[0]
    distinct, place = np.unique(np.concatenate(found), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)


def _edges(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]])


def _whole_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """The rows of each block of a partition together, however they are cut into batches."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        # A partition has its blocks one after the other; the last one may go on in the next batch.
        open_block = frame["block"].iloc[-1] if len(frame) else None
        whole = frame["block"] != open_block
        yield from frame[whole].groupby("block", sort=False)
        rest = frame[~whole]
    if rest is not None:
        yield from rest.groupby("block", sort=False)


def _key_requests(rows: DataFrame, buckets: int) -> DataFrame:
    """Per block and bucket: its distinct keys and how often its training texts have them."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, part in _whole_blocks(frames):
            distinct, counts = _tallied_keys(encoded(part["text"]), part["training"].to_numpy(dtype=bool))
            owner = _owners(distinct, buckets)
            order = np.argsort(owner, kind="stable")
            edges = np.searchsorted(owner[order], np.arange(buckets + 1))
            out = []
            for k in range(buckets):
                chosen = order[edges[k] : edges[k + 1]]
                if len(chosen):
                    own = zlib.compress(counts[chosen].astype("<u4").tobytes(), 1)
                    out.append((k, block, len(chosen), packed_keys(distinct[chosen]), own))
            yield pd.DataFrame(out, columns=["bucket", "block", "size", "keys", "counts"])

    return rows.mapInPandas(ask, KEY_REQUESTS)


def _gathered(frame: pd.DataFrame) -> tuple[Contexts, list[np.ndarray]]:
    """The contexts of a bucket, and what each of its requests asked for as places of their keys."""
    asked = [unpacked_keys(k, n) for k, n in zip(frame["keys"], frame["size"], strict=True)]
    counts = np.concatenate([np.frombuffer(zlib.decompress(x), dtype="<u4") for x in frame["counts"]])
    distinct, place = np.unique(np.concatenate(asked), return_inverse=True)
    times = np.bincount(place, counts, len(distinct)).astype(np.int64)
    return Contexts(distinct, times), np.split(place, np.cumsum(frame["size"].to_numpy(np.int64))[:-1])


def _store_requests(folder: str, bucket: int, frame: pd.DataFrame) -> None:
    """The requests of a bucket as one file, so that they are shuffled once for learning and answering."""
    sizes = [np.array([len(x) for x in frame[c]], dtype="<i8") for c in ("keys", "counts")]
    numbers = [frame["block"].to_numpy("<i8"), frame["size"].to_numpy("<i8"), *sizes]
    write_arrays(folder, _bucket_name(bucket), [*numbers, b"".join(frame["keys"]), b"".join(frame["counts"])])


def _stored_requests(folder: str, bucket: int) -> pd.DataFrame:
    *numbers, keys, counts = read_arrays(folder, _bucket_name(bucket))
    block, size, of_keys, of_counts = (np.frombuffer(x, dtype="<i8") for x in numbers)
    return pd.DataFrame({"block": block, "size": size, "keys": cut(keys, of_keys), "counts": cut(counts, of_counts)})


def _bucket_name(bucket: int) -> str:
    return f"{bucket:08x}.requests"


def _key_replies(spark: SparkSession, learnt: Broadcast, buckets: int) -> DataFrame:
    """The probabilities (log10) that each block asked for, in the order of its keys; buckets count from -1 down."""

    def answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bucket in (k for frame in frames for k in frame["id"].tolist() if k in learnt.value.buckets):
            asked = _stored_requests(learnt.value.folder, bucket)
            contexts, places = _gathered(asked)
            logs = contexts.log10(learnt.value).astype("<f4")
            yield pd.DataFrame({"block": asked["block"], "bucket": -1 - bucket, "counts": [logs[p].tobytes() for p in places]})

    return spark.range(0, buckets, 1, shuffle_partitions(spark)).mapInPandas(answer, REPLIES)


def log10_of_texts(texts: Sequence[bytes], buckets: int, replies: dict[int, np.ndarray]) -> np.ndarray:
    """log10 of the probability of each whole text and its end, from the replies by bucket to their block."""
    keys, _ = _tallied_keys(list(texts), np.zeros(len(texts), dtype=bool))
    order = np.argsort(_owners(keys, buckets), kind="stable")
    logs = np.empty(len(keys))
    logs[order] = np.concatenate([replies[k] for k in sorted(replies)])
    out = np.zeros(len(texts))
    for first, last in batches(texts, BATCH_BYTES):
        own, upto = byte_keys(texts[first:last])
        order = np.argsort(own)
        edges = _edges(own[order])
        of_key = np.empty(len(own))
        of_key[order] = np.repeat(logs[np.searchsorted(keys, own[order[edges[:-1]]])], np.diff(edges))
        sums = np.concatenate([[0.0], np.cumsum(of_key)])
        ends = np.concatenate([[0], upto])
        out[first:last] = sums[ends[1:]] - sums[ends[:-1]]
    return out


def _summed(tables: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Sum of the arrays of each kind and range, added up while they stream through a task."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for frame in frames:
            for kind, part, content in zip(frame["kind"], frame["range"], frame["content"], strict=True):
                own = np.frombuffer(zlib.decompress(content), dtype="<f8")
                sums[kind, part] = sums[kind, part] + own if (kind, part) in sums else own
        for (kind, part), total in sums.items():
            packed = zlib.compress(total.astype("<f8").tobytes(), 1)
            yield pd.DataFrame([(kind, part, packed)], columns=["kind", "range", "content"])

    parts = min(shuffle_partitions(tables.sparkSession), RANGES * len(ORDERS))
    rows = tables.repartition(parts, "kind", "range").mapInPandas(add, TABLES).collect()
    return {(r["kind"], r["range"]): np.frombuffer(zlib.decompress(r["content"]), dtype="<f8") for r in rows}


def train_mixer(requests: DataFrame) -> Learnt:
    """Learn from the counts of all key requests. What reaches the driver has a fixed size.

    Without any text all predictions are even. Each bucket leaves its requests in a file, to be answered from it.
    """
    folder = scratch_path(requests.sparkSession, "key-requests")

    def weigh(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block", ignore_index=True)
        bucket = int(frame["bucket"].iloc[0])
        _store_requests(folder, bucket, frame)
        contexts, _ = _gathered(frame)
        weights, cells = start_weights(), np.zeros((2, 256 * CELLS))
        curves = contexts.learn(weights, cells)
        moves = (curves @ (weights - start_weights())[..., None])[..., 0]
        size = float(contexts.times.sum())
        arrays = (moves.ravel(), np.array([size]), cells[0], cells[1], (curves - start_curves()).ravel())
        rows = [(kind, 0, zlib.compress(a.astype("<f8").tobytes(), 1)) for kind, a in enumerate(arrays)]
        rows.append((len(arrays), bucket, zlib.compress(b"", 1)))
        return pd.DataFrame(rows, columns=["kind", "range", "content"])

    learnt = _summed(requests.groupBy("bucket").applyInPandas(weigh, TABLES))
    stored = frozenset(bucket for kind, bucket in learnt if kind == 5)
    if not learnt or not learnt[1, 0][0]:
        none = np.zeros(256 * CELLS)
        return Learnt(start_weights(), none, none, folder, stored)
    curves = learnt[4, 0].reshape(start_curves().shape)
    weights = joined_weights(curves, learnt[0, 0].reshape(start_weights().shape))
    return Learnt(weights, learnt[2, 0], learnt[3, 0], folder, stored)


END_WORD = np.uint64(0)


def _word_table(words: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of the texts, each followed by its end, and the number of tokens up to each end."""
    return np.insert(words, upto, END_WORD), upto + np.arange(1, len(upto) + 1)


def _numbered(docs: DataFrame, training: Column) -> DataFrame:
    """Rows with ``block``, the same on every read: some rows of a partition in its order."""
    rows = for_python(id_and_text(docs)).withColumn("training", F.when(F.col("no_id"), F.lit(True)).otherwise(training))
    return rows.withColumn("block", F.floor(F.monotonically_increasing_id() / LOOKUP_ROWS))


def _packed_texts(rows: DataFrame) -> DataFrame:
    """The rows of each block as a few compressed ones, since whole texts are shuffled to their replies."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = pa.Codec("zstd", compression_level=1)
        for block, part in _whole_blocks(frames):
            ids, texts = [None if x is pd.NA else x for x in ids_of(part)], encoded(part["text"])
            training = part["training"].to_numpy(dtype=bool)
            for k, (first, last) in enumerate(batches(texts, BATCH_BYTES)):
                own = texts[first:last]
                sizes = np.array([len(t) for t in own], dtype="<i8")
                numbers = [*ids_as_arrays(ids[first:last]), training[first:last], sizes]
                raw = b"".join([*(x.tobytes() for x in numbers), *own])
                content = struct.pack("<Q", len(raw)) + codec.compress(raw, asbytes=True)
                yield pd.DataFrame([(block, k, len(own), content)], columns=["block", "part", "rows", "content"])

    return rows.mapInPandas(pack, TEXTS)


def _unpacked_texts(frame: pd.DataFrame) -> tuple[pd.Series, np.ndarray, list[bytes]]:
    """Ids, whether they are learnt from, and texts of a block."""
    ids, training, texts = [], [], []
    frame = frame.sort_values("part")
    for rows, content in zip(frame["rows"].tolist(), frame["content"], strict=True):
        (size,) = struct.unpack_from("<Q", content)
        raw = pa.decompress(memoryview(content)[8:], decompressed_size=size, codec="zstd", asbytes=True)
        ids.append(arrays_as_ids(raw[: 8 * rows], raw[8 * rows : 9 * rows]))
        training.append(np.frombuffer(raw, dtype=bool, count=rows, offset=9 * rows))
        texts += cut(raw[18 * rows :], np.frombuffer(raw, dtype="<i8", count=rows, offset=10 * rows))
    return pd.concat(ids, ignore_index=True), np.concatenate(training), texts


def _by_owner(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of sorted words by the bucket that counts them, and where each bucket begins."""
    owner = (words % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return order, np.searchsorted(owner[order], np.arange(buckets + 1))


def _requests(rows: DataFrame, buckets: int) -> DataFrame:
    """Per block and range of hashes: its distinct words and how often its training texts have them."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, part in _whole_blocks(frames):
            distinct, counts = _tally(encoded(part["text"]), part["training"].to_numpy(dtype=bool))
            order, edges = _by_owner(distinct, buckets)
            out = []
            for k in range(buckets):
                chosen = order[edges[k] : edges[k + 1]]
                if len(chosen):
                    own = counts[chosen].astype("<u4")
                    out.append((k, block, distinct[chosen].astype("<u8").tobytes(), own.tobytes()))
            yield pd.DataFrame(out, columns=["bucket", "block", "words", "counts"])

    return rows.mapInPandas(ask, REQUESTS)


def _tally(texts: list[bytes], training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of the texts and their counts in the training ones."""
    found, counts = [np.array([END_WORD])], [np.zeros(1, np.int64)]
    for first, last in batches(texts):
        tokens, upto = _word_table(*word_hashes(texts[first:last]))
        weight = np.repeat(training[first:last].astype(np.int64), np.diff(np.concatenate([[0], upto])))
        distinct, place = np.unique(tokens, return_inverse=True)
        found.append(distinct)
        counts.append(np.bincount(place, weight, len(distinct)).astype(np.int64))
    distinct, place = np.unique(np.concatenate(found), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)


def _replies(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The counts in the whole corpus of what each block asked for, in its order, and totals per bucket."""

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        words = [np.frombuffer(x, dtype="<u8") for x in frame["words"]]
        counts = np.concatenate([np.frombuffer(x, dtype="<u4") for x in frame["counts"]])
        distinct, place = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(place, counts, len(distinct)).astype("<i8")
        ends = np.cumsum([len(x) for x in words])[:-1]
        out = frame[["block", "bucket"]].copy()
        out["counts"] = [total[p].tobytes() for p in np.split(place, ends)]
        sums = np.array([total.sum(), np.count_nonzero(total)], dtype="<i8")
        own = pd.DataFrame([(-1, int(frame["bucket"].iloc[0]), sums.tobytes())], columns=list(out.columns))
        return pd.concat([out, own], ignore_index=True)

    answered = materialize(requests.groupBy("bucket").applyInPandas(answer, REPLIES), "word-counts")
    return answered.filter("block >= 0"), answered.filter("block < 0")


def score_texts(docs: DataFrame, training: Column) -> DataFrame:
    """Per row of ``docs`` what SCORES lists: a word model's and the mixer's log10 probability.

    ``training`` (over doc_id) says which rows are learnt from; rows without id are. A null text
    is empty: its only token, and the only sign the mixer predicts, is the end. ``n_known``
    counts tokens that training texts have. Repeated rows count and are scored each time. Without training
    rows N and V are 0 and the base score is a sum of log10(0.5 / 0.5).
    """
    rows = _numbered(docs, training)
    buckets = max(4, shuffle_partitions(docs.sparkSession))
    replies, totals = _replies(_requests(rows, buckets))
    # One row per bucket, as many as shuffle partitions.
    sums = [np.frombuffer(r["counts"], dtype="<i8") for r in totals.select("counts").collect()]
    tokens, distinct = (int(x) for x in np.sum([*sums, np.zeros(2, np.int64)], axis=0))
    key_buckets = BUCKETS * buckets
    learnt = docs.sparkSession.sparkContext.broadcast(train_mixer(_key_requests(rows, key_buckets)))
    replies = replies.select("block", "bucket", "counts").union(_key_replies(docs.sparkSession, learnt, key_buckets))

    def score(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        of_keys = found[found["bucket"] < 0]
        logs_of = {-1 - b: np.frombuffer(x, dtype="<f4") for b, x in zip(of_keys["bucket"], of_keys["counts"], strict=True)}
        found = found[found["bucket"] >= 0].sort_values("bucket")
        ids, training, coded = _unpacked_texts(texts)
        tables = [_word_table(*word_hashes(coded[first:last])) for first, last in batches(coded)]
        # The block's own words, in the order in which they were asked for.
        words = np.unique(np.concatenate([np.unique(own) for own, _ in tables]))
        counts = np.empty(len(words), dtype=np.int64)
        counts[_by_owner(words, buckets)[0]] = np.concatenate([np.frombuffer(x, dtype="<i8") for x in found["counts"]])
        parts = []
        for own, upto in tables:
            c = counts[np.searchsorted(words, own)]
            logs = np.log10((c + 0.5) / (tokens + 0.5 * (distinct + 1)))
            begins = np.concatenate([[0], upto[:-1]])
            parts.append((upto - begins, np.add.reduceat((c > 0).astype(np.int64), begins), np.add.reduceat(logs, begins)))
        sizes, known, base = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pd.DataFrame(
            {
                "doc_id": ids,
                "held_out": ~training,
                "n_tokens": sizes,
                "n_known": known,
                "train_tokens": tokens,
                "base_score": base,
                "score": log10_of_texts(coded, key_buckets, logs_of),
                "n_bytes": [len(t) for t in coded],
            }
        )

    asked = _packed_texts(rows).groupBy("block").cogroup(replies.groupBy("block"))
    scored = asked.applyInPandas(score, SCORES)
    bits = -F.col("score") * float(np.log2(10)) / F.greatest(F.col("n_bytes"), F.lit(1))
    return scored.withColumn("bits_per_byte", bits)
