"""Exact top-k inner products by blocks of candidates and bounds on what a block can reach.

Each component of a vector is a term. Candidates are dealt to groups by ranges of their ids; a
group is cut to blocks that keep their largest and smallest value of every term, and its vectors
as a forward index. For a query, the sum over the terms of the best a block can give bounds its
scores; blocks are scored in falling order of that bound, until it is below the k-th score found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.shared import materialize, shuffle_partitions

SCALE = 256
BLOCK = 64

# Rows that a packed batch of candidates or of queries holds at most.
GROUP = 8192
QUERIES = 1024

# Sums below this are exact in doubles; other vectors are multiplied as Python integers.
EXACT = 2.0**53

PACKED = "batch long, ids binary, lengths binary, kind string, values binary"
SCORED = "query_id long, vec_id long, score long"


def whole_vectors(table: DataFrame) -> DataFrame:
    """``vec_id, vector``: floor(SCALE * x) of each component; rows with nulls or non-finite parts are out.

    Repeated rows count once.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    # Floor as a double: exact, and wide enough for any float.
    vector = F.transform("embedding", lambda x: F.rint((x * SCALE) - F.pmod(x * SCALE, F.lit(1.0))))
    return rows.select("vec_id", vector.alias("vector")).distinct()


def _pack(rows: DataFrame, most: int) -> DataFrame:
    """The vectors of each partition in batches of at most ``most`` rows, in the partition's order."""
    marked = rows.withColumn("part", F.spark_partition_id())

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        serial, rest = 0, None
        for frame in frames:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            while len(rest) >= most:
                yield packed(rest.iloc[:most], serial)
                rest, serial = rest.iloc[most:], serial + 1
        if rest is not None and len(rest):
            yield packed(rest, serial)

    def packed(part: pd.DataFrame, serial: int) -> pd.DataFrame:
        vectors = [np.asarray(v, dtype="<f8") for v in part["vector"]]
        lengths = np.array([len(v) for v in vectors], dtype="<i4")
        flat = np.concatenate([*vectors, np.zeros(0)])
        kind = "<i2" if float(np.abs(flat).max(initial=0)) < 1 << 15 else "<f8"
        number = (int(part["part"].iloc[0]) << 33) + serial
        row = (number, part["vec_id"].to_numpy("<i8").tobytes(), lengths.tobytes(), kind, flat.astype(kind).tobytes())
        return pd.DataFrame([row], columns=["batch", "ids", "lengths", "kind", "values"])

    return marked.mapInPandas(pack, PACKED)


def _matrix(lengths: bytes, values: bytes, kind: str, width: int) -> np.ndarray:
    """One row per vector; a shorter vector ends in zeros."""
    sizes, flat = np.frombuffer(lengths, dtype="<i4"), np.frombuffer(values, dtype=kind)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond a long they stop at its ends."""
    if not a.shape[1] or float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)
    big = [[sum(int(p) * int(q) for p, q in zip(x, y, strict=True)) for y in b] for x in a]
    ends = np.iinfo(np.int64)
    return np.array([[min(max(v, ends.min), ends.max) for v in row] for row in big], dtype=np.int64).reshape(len(a), len(b))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores.astype(np.float64)))[:k] if len(ids) > k else np.arange(len(ids))
    return ids[order], scores[order]


def search_batch(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple]:
    """(query_id, vec_id, score) of the k best of a group for each query, by falling bounds."""
    if not len(ids):
        return []
    edges = np.arange(0, len(ids), BLOCK)
    high = np.maximum.reduceat(vectors, edges, axis=0)
    low = np.minimum.reduceat(vectors, edges, axis=0)
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    # Sums that may be rounded get a margin, so no block is left out by rounding.
    bounds = bounds + np.abs(bounds) * 1e-9 + 1
    order = np.argsort(-bounds, axis=1, kind="stable")
    # A step scores several blocks at once.
    step = max(1, 4096 // BLOCK // 4)
    out = []
    for q in range(len(query_ids)):
        best_ids, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for first in range(0, len(edges), step):
            blocks = order[q, first : first + step]
            if len(best_ids) == k:
                blocks = blocks[bounds[q, blocks] >= best_scores.min()]
                if not len(blocks):
                    break
            rows = (edges[blocks][:, None] + np.arange(BLOCK)).ravel()
            rows = rows[rows < len(ids)]
            rows = rows[ids[rows] != query_ids[q]]
            scores = _exact(queries[q : q + 1], vectors[rows])[0]
            if len(best_ids) == k:
                keep = scores >= best_scores.min()
                rows, scores = rows[keep], scores[keep]
            best_ids, best_scores = _best(np.concatenate([best_ids, ids[rows]]), np.concatenate([best_scores, scores]), k)
        out += [(int(query_ids[q]), int(i), int(s)) for i, s in zip(best_ids, best_scores, strict=True)]
    return out


def top_products(table: DataFrame, every: int, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of all other rows for each id divisible by ``every``.

    Ties go to the smaller id. Rows that share an id are not candidates of one another; as
    queries they give the best over all of them. Each batch of queries meets each group of
    candidates as one row of packed arrays, and only k scores per query and group go on.
    """
    rows = materialize(whole_vectors(table), "vectors")
    ordered = rows.repartitionByRange(max(1, -(-rows.count() // GROUP)), "vec_id").sortWithinPartitions("vec_id")
    groups = materialize(_pack(ordered, GROUP), "groups")
    queries = rows.filter(F.col("vec_id") % every == 0)
    asked = _pack(queries.repartition(max(1, -(-queries.count() // QUERIES))), QUERIES)
    asked = materialize(asked.select(*[F.col(c).alias(f"q_{c}") for c in ("batch", "ids", "lengths", "kind", "values")]), "queries")
    # Every batch of queries meets every group by name, in lists dealt by hash; then the arrays join.
    names = groups.groupBy(F.pmod(F.xxhash64("batch"), F.lit(64)).alias("list")).agg(F.collect_list("batch").alias("batches"))
    lists = F.explode(F.sequence(F.lit(0), F.lit(63)).cast("array<bigint>"))
    meetings = asked.select("q_batch", lists.alias("list")).join(names, "list").select("q_batch", F.explode("batches").alias("batch"))
    dealt = meetings.repartition(shuffle_partitions(rows.sparkSession), "q_batch", "batch")
    meetings = dealt.join(asked, "q_batch").join(groups, "batch")

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                sizes = (np.frombuffer(x, dtype="<i4") for x in (row.lengths, row.q_lengths))
                width = max(int(x.max(initial=0)) for x in sizes)
                ids, query_ids = np.frombuffer(row.ids, dtype="<i8"), np.frombuffer(row.q_ids, dtype="<i8")
                queries = _matrix(row.q_lengths, row.q_values, row.q_kind, width)
                vectors = _matrix(row.lengths, row.values, row.kind, width)
                found = search_batch(query_ids, queries, ids, vectors, k)
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"], dtype="int64")

    # Rows that share an id can give a pair twice, with other scores: the best counts.
    scored = meetings.mapInPandas(search, SCORED).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
