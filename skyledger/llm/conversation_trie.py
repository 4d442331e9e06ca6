"""A trie of conversation prefixes in flat arrays, addressed by a minimal perfect hash.

Every prefix of a conversation has a 128-bit digest, a sum over its turns of a hash of place, role
and text, so all digests are running sums and a conversation of any length is summed over many
tasks: turns are sorted by range, summed inside their range, and carried over by a table of at
most one row per range. Equal digests are one node; that they have one parent and one last turn
is checked, not assumed.

The nodes are dealt to shards by subtree. A node under which more than ``shard_rows`` turns lie
belongs to the crown, its children below that size are the tops of subtrees, and each subtree is
in one shard. In a shard each digest has a slot of a minimal perfect hash, verified against the
stored digest; counts are scattered into numpy arrays and summed through parent slots from the
deepest level up. The crown, at each depth at most all turns / ``shard_rows`` nodes, is summed
in the same direction in one stream that holds one depth at a time.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.perfect_hash import PerfectHash
from skyledger.llm.shared import materialize, shuffle_partitions
from skyledger.llm.words import _keys, mix
from skyledger.operators.ordering import POSITION, RANGE, order_ranges

# A conversation takes its first turns from the one that opens its family.
FAMILY = 5
HEADS = 9

# More turns than this under a node: its children are dealt to shards of their own.
SHARD_ROWS = 1 << 17

# Ids of one row on the way to the hash of a node's ids.
MOST_IDS = 1 << 16

LANES = ["l0", "l1", "l2", "l3"]
LANE = (1 << 32) - 1
SEEDS = _keys(31, 64)

NODE = "k1 long, k2 long, depth long, conv_id long, n_convs long"
SUMS = "n_children long, n_leaves long, saved_tokens long"
FOLDED = f"{NODE}, {SUMS}, p1 long, p2 long, parent_conv_id long"
CROWN = f"{NODE}, {SUMS}, p1 long, p2 long"
NO_IDS = hashlib.sha256(b"").hexdigest()


def _lanes(at: Column) -> list[Column]:
    """Four numbers of 32 bits for the turn ``d1, d2`` at a place."""
    halves = [F.xxhash64(F.lit(seed), at, F.col("d1"), F.col("d2")) for seed in (1, 2)]
    parts = [x for half in halves for x in (F.shiftrightunsigned(half, 32), half.bitwiseAND(F.lit(LANE)))]
    return [x.alias(name) for x, name in zip(parts, LANES, strict=True)]


def _keys_of(lanes: list[Column], names: tuple[str, str]) -> list[Column]:
    """The digest as two longs: each lane modulo 2^32."""
    low = [x.bitwiseAND(F.lit(LANE)) for x in lanes]
    return [F.shiftleft(low[2 * k], 32).bitwiseOR(low[2 * k + 1]).alias(name) for k, name in enumerate(names)]


def _family(conv_id: Column) -> Column:
    return conv_id - conv_id % FAMILY


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations and their turns as two written tables.

    Conversations: ``conv_id, n``. Turns: ``conv_id, i`` (from 1)``, n, k1, k2`` (the prefix up to this
    turn)``, p1, p2`` (the one before)``, d1, d2`` (the turn)``, bytes`` of its text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        role.alias("role"),
        F.xxhash64(F.lit(1), digest).alias("d1"),
        F.xxhash64(F.lit(2), digest).alias("d2"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), *[F.col(c).asc() for c in ("role", "d1", "d2")]]
    ordered = order_ranges(turns, order).drop("turn", "role")

    # At most one conversation of a range began before it, so the carried tables have a row per range at most.
    before = Window.partitionBy("conv_id").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    pieces = ordered.groupBy("conv_id", RANGE).agg(F.count("*").alias("rows"), F.min(POSITION).alias("first"))
    pieces = materialize(pieces.withColumn("carried", F.coalesce(F.sum("rows").over(before), F.lit(0))), "pieces")
    place = (F.col(POSITION) - F.col("first") + F.col("carried") + 1).alias("p")

    family = _family(F.col("conv_id"))
    heads = ordered.filter(family == F.col("conv_id")).join(pieces.filter(F.col("carried") < HEADS), ["conv_id", RANGE])
    heads = heads.select("conv_id", place, "d1", "d2", "bytes").filter(F.col("p") < HEADS)
    running = Window.partitionBy("conv_id").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    heads = heads.select("*", *_lanes(F.col("p")))
    own = [F.col(x).alias(f"own_{x}") for x in LANES]
    heads = heads.select("conv_id", "p", "d1", "d2", "bytes", *own, *[F.sum(x).over(running).alias(x) for x in LANES])
    heads = materialize(heads.withColumnRenamed("conv_id", "family"), "heads")

    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = pieces.groupBy("conv_id").agg(F.sum("rows").alias("rows"))
    convs = convs.select("conv_id", "rows", family.alias("family"), F.when(family == F.col("conv_id"), 0).otherwise(head).alias("h"))
    there = heads.groupBy("family").agg(F.max("p").alias("there"))
    convs = convs.join(there, "family", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    at = heads.select("family", F.col("p").alias("taken"), *LANES)
    convs = convs.join(at, ["family", "taken"], "left")
    n = F.col("taken") + F.greatest(F.lit(0), F.col("rows") - F.col("h"))
    convs = convs.select("conv_id", "family", "h", "taken", n.alias("n"), *[F.coalesce(x, F.lit(0)).alias(f"from_{x}") for x in LANES])
    convs = materialize(convs, "conversations")

    # Own turns after the first h, at their new places, summed within a range.
    joined = ordered.join(pieces.join(convs, "conv_id"), ["conv_id", RANGE])
    joined = joined.select("*", place).filter(F.col("p") > F.col("h"))
    joined = joined.withColumn("i", F.col("p") - F.col("h") + F.col("taken"))
    joined = joined.select("*", *_lanes(F.col("i")))
    within = Window.partitionBy("conv_id", RANGE).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(x).over(within).alias(x) for x in LANES]
    kept = ["conv_id", RANGE, "i", "n", "carried", "d1", "d2", "bytes"]
    summed = joined.select(*kept, *[F.col(x).alias(f"own_{x}") for x in LANES], *[f"from_{x}" for x in LANES], *sums)
    summed = materialize(summed, "turns")

    spread = pieces.groupBy("conv_id").agg(F.max("carried").alias("most")).filter(F.col("most") > 0).select("conv_id")
    totals = summed.join(spread, "conv_id").groupBy("conv_id", RANGE).agg(*[F.max(x).alias(x) for x in LANES])
    carry = totals.select("conv_id", RANGE, *[F.sum(x).over(before).alias(f"carry_{x}") for x in LANES])
    carry = carry.filter(F.col("carry_l0").isNotNull())
    summed = summed.join(F.broadcast(carry), ["conv_id", RANGE], "left")

    def row(upto: list[Column]) -> list[Column]:
        less = [x - F.col(f"own_{name}") for x, name in zip(upto, LANES, strict=True)]
        return [*_keys_of(upto, ("k1", "k2")), *_keys_of(less, ("p1", "p2")), F.col("d1"), F.col("d2"), F.col("bytes")]

    upto = [F.col(x) + F.col(f"from_{x}") + F.coalesce(F.col(f"carry_{x}"), F.lit(0)) for x in LANES]
    own_rows = summed.select("conv_id", "i", "n", *row(upto))
    taken = convs.filter(F.col("taken") > 0).select("conv_id", "family", "taken", "n").join(heads, "family")
    head_rows = taken.filter(F.col("p") <= F.col("taken")).select("conv_id", F.col("p").alias("i"), "n", *row([F.col(x) for x in LANES]))
    return convs.select("conv_id", "n"), materialize(own_rows.unionByName(head_rows), "rebuilt")


def distinct_nodes(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of at least one turn; ``below`` counts the turns after it in its members."""
    nodes = turns.groupBy("k1", "k2", F.col("i").alias("depth")).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("bytes").alias("bytes"),
        F.sum(F.col("n") - F.col("i")).alias("below"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("p1", "p2", "d1", "d2") for f in (F.min, F.max)],
    )
    same = F.lit(True)
    for c in ("p1", "p2", "d1", "d2"):
        same = same & (F.col(f"min_{c}") == F.col(f"max_{c}"))
    checked = F.when(same, F.col("min_p1")).otherwise(F.raise_error(F.lit("two prefixes have one digest")).cast("long"))
    return nodes.select("k1", "k2", "depth", "conv_id", "n_convs", "bytes", "below", checked.alias("p1"), F.col("min_p2").alias("p2"))


def _mixed(k1: np.ndarray, k2: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(k1.view(np.uint64) + SEEDS[seed]) ^ mix(k2.view(np.uint64) * (SEEDS[seed] | np.uint64(1)))


class NodeTable:
    """Slots of the digests of one shard; a digest that is not there has slot -1."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray) -> None:
        self.seed = 0
        while len(np.unique(_mixed(k1, k2, self.seed))) < len(k1):
            self.seed += 1
        keys = _mixed(k1, k2, self.seed)
        self.hash = PerfectHash.build(keys)
        self.k1, self.k2 = np.zeros(len(k1), np.int64), np.zeros(len(k1), np.int64)
        at = self.hash.slots(keys)
        self.k1[at], self.k2[at] = k1, k2

    def slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        at = self.hash.slots(_mixed(k1, k2, self.seed))
        return np.where((at >= 0) & (self.k1[at] == k1) & (self.k2[at] == k2), at, -1)


def fold(frame: pd.DataFrame) -> pd.DataFrame:
    """The sums of every subtree of one shard, and the parent's conversation where it is in the shard."""
    k1, k2, p1, p2, depth, conv_id, n_convs, size = (
        frame[c].to_numpy(dtype=np.int64) for c in ("k1", "k2", "p1", "p2", "depth", "conv_id", "n_convs", "bytes")
    )
    table = NodeTable(k1, k2)
    slot, parent = table.slots(k1, k2), table.slots(p1, p2)
    nodes = len(frame)
    saved, owner, up = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64), np.full(nodes, -1)
    saved[slot], owner[slot], up[slot] = (n_convs - 1) * size, conv_id, parent
    children = np.bincount(parent[parent >= 0], minlength=nodes)
    leaves = (children == 0).astype(np.int64)
    by_depth = slot[np.argsort(depth, kind="stable")]
    edges = np.flatnonzero(np.diff(np.sort(depth), prepend=-1, append=-1)).tolist()
    for first, last in reversed(list(itertools.pairwise(edges))):
        level = by_depth[first:last]
        level = level[up[level] >= 0]
        np.add.at(saved, up[level], saved[level])
        np.add.at(leaves, up[level], leaves[level])
    out = frame[["k1", "k2", "depth", "conv_id", "n_convs"]].copy()
    out["n_children"], out["n_leaves"], out["saved_tokens"] = children[slot], leaves[slot], saved[slot]
    out["p1"], out["p2"] = p1, p2
    out["parent_conv_id"] = pd.Series(owner[parent], index=out.index).astype("Int64").mask(parent < 0)
    return out


def _fold_crown(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Crown nodes from the deepest up; holds what the nodes of one depth hand to their parents."""
    waiting: dict[tuple[int, int], list[int]] = {}
    handed: dict[tuple[int, int], list[int]] = {}
    depth = -1
    for frame in frames:
        sums = []
        columns = ("k1", "k2", "p1", "p2", "depth", "n_convs", "bytes", "n_children", "n_leaves", "saved_tokens")
        for k1, k2, p1, p2, here, n_convs, size, children, leaves, saved in zip(*(frame[c].tolist() for c in columns), strict=True):
            if here != depth:
                waiting, handed, depth = handed, {}, here
            more = waiting.pop((k1, k2), [0, 0, 0])
            children, leaves, saved = children + more[0], leaves + more[1], saved + more[2] + (n_convs - 1) * size
            leaves = leaves if children else 1
            sums.append((children, leaves, saved))
            if here:
                total = handed.setdefault((p1, p2), [0, 0, 0])
                total[0], total[1], total[2] = total[0] + 1, total[1] + leaves, total[2] + saved
        out = frame[["k1", "k2", "depth", "conv_id", "n_convs", "p1", "p2"]].copy()
        out[["n_children", "n_leaves", "saved_tokens"]] = np.array(sums, dtype=np.int64).reshape(-1, 3)
        yield out


def _hashes_of_ids(ends: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256`` from ``k1, k2, conv_id``: ids as decimal numbers, ascending, comma-joined.

    The ids of a node in a range of ids travel as one row per MOST_IDS; a node's rows then pass one
    by one through its hash, so a node at which a third of all conversations end needs no memory.
    """
    codec = "zstd"

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.sort_values(["k1", "k2", "conv_id"])
            k1, k2, ids = (frame[c].to_numpy(dtype=np.int64) for c in ("k1", "k2", "conv_id"))
            new = np.ones(len(ids), dtype=bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            starts = np.flatnonzero(new)
            rows = []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)], strict=True):
                for x in range(a, b, MOST_IDS):
                    part = ids[x : min(b, x + MOST_IDS)]
                    packed = pa.compress(np.diff(part, prepend=0).astype("<i8").tobytes(), codec=codec, asbytes=True)
                    rows.append((k1[a], k2[a], part[0], len(part), packed))
            yield pd.DataFrame(rows, columns=["k1", "k2", "first", "size", "ids"])

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, out = None, None, []
        for frame in frames:
            for k1, k2, size, ids in zip(frame["k1"], frame["k2"], frame["size"], frame["ids"], strict=True):
                raw = pa.decompress(ids, decompressed_size=8 * size, codec=codec, asbytes=True)
                text = ",".join(map(str, np.cumsum(np.frombuffer(raw, dtype="<i8")).tolist())).encode()
                if now == (k1, k2):
                    state.update(b"," + text)
                    continue
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = (k1, k2), hashlib.sha256(text)
            if out:
                yield pd.DataFrame(out, columns=["k1", "k2", "ends_sha256"])
                out = []
        if now is not None:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=["k1", "k2", "ends_sha256"])

    parts = shuffle_partitions(ends.sparkSession)
    # A batch of a sorted range is a range itself.
    ranged = ends.repartitionByRange(parts, "conv_id").sortWithinPartitions("conv_id")
    packed = ranged.mapInPandas(pack, "k1 long, k2 long, first long, size int, ids binary")
    by_node = packed.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return by_node.mapInPandas(digest, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conv_id`` (smallest member), ``depth, parent_conv_id`` (of the root: null)``, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by ``turn``, null first; rows that tie are ordered by role and then by a
    digest of role and text, and repeated rows are turns of their own. A null role or text is
    empty; rows without ``conv_id`` belong to no conversation and are left out. Conversation c
    begins with the first h turns of conversation c - c % 5 (for negative ids the remainder has
    the sign of c) and goes on with its own after its first h, h = crc32(c) % 9. Every
    conversation is a member of the root, also one that has no turn. An empty table has no node.
    """
    spark = conversations.sparkSession
    convs, turns = rebuilt_turns(conversations)
    nodes = materialize(distinct_nodes(turns), "nodes")
    crown = nodes.filter(F.col("below") > shard_rows)
    all_turns = turns.count()

    # The subtree of a node is named by the turn of its conversation that follows the last one in the crown.
    if crown.isEmpty():
        tops = turns.filter("i = 1")
    else:
        covered = turns.join(crown.select("k1", "k2"), ["k1", "k2"]).groupBy("conv_id").agg(F.max("i").alias("covered"))
        tops = turns.join(covered, "conv_id", "left").filter(F.col("i") == F.coalesce("covered", F.lit(0)) + 1)
    shards = max(shuffle_partitions(spark), 4 * all_turns // shard_rows)
    tops = tops.select("conv_id", F.pmod(F.xxhash64("k1", "k2"), F.lit(shards)).alias("shard"))
    dealt = nodes.filter(F.col("below") <= shard_rows).drop("below").join(tops, "conv_id")
    folded = materialize(dealt.groupBy("shard").applyInPandas(fold, FOLDED), "folded")

    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    zeros = [F.lit(0).cast("long").alias(c) for c in ("k1", "k2", "depth", "bytes", "p1", "p2")]
    crown = crown.drop("below").unionByName(root.select("conv_id", "n_convs", *zeros))
    handed = folded.filter("parent_conv_id IS NULL").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    handed = handed.agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    crown = crown.join(handed, ["k1", "k2"], "left").fillna(0, ["n_children", "n_leaves", "saved_tokens"])
    crown = crown.coalesce(1).sortWithinPartitions(F.col("depth").desc())
    crown = materialize(crown.mapInPandas(_fold_crown, CROWN), "crown")

    owners = crown.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("owner"))
    tops = folded.filter("parent_conv_id IS NULL").drop("parent_conv_id")
    tops = tops.unionByName(crown.filter("depth > 0")).join(owners, ["p1", "p2"]).withColumnRenamed("owner", "parent_conv_id")
    whole = folded.filter("parent_conv_id IS NOT NULL").unionByName(tops)
    whole = whole.unionByName(crown.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))

    zero = F.lit(0).cast("long")
    ends = turns.filter("i = n").select("k1", "k2", "conv_id")
    ends = ends.unionByName(convs.filter("n = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id"))
    hashed = whole.join(_hashes_of_ids(ends), ["k1", "k2"], "left")
    return hashed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
    )
