"""Set-similarity join of documents by grouped prefixes, and the near-duplicate groups it links.

The shingles of a document are ordered rare before hot, hot ones by their count in steps, then by
hash. Two sets that reach the
threshold share one of the first n - ceil(t * n) + 1 shingles of each, its prefix. Documents
with equal sets are one class; classes with equal prefix and size are one group, and only groups
are paired. A pair of groups must have sizes within the threshold, and the places of a shared
shingle must leave room for the overlap that is needed. What is left is expanded to classes
and verified on the whole texts.

A shingle with more than SHORT_LIST groups would make a number of pairs that grows with its
square. Such a list is joined in three steps. First its members are compared with a few of them,
its hubs, the same ones for all lists that hold them; then, in some orders by hash and in ROUNDS
rounds, with one member of another component. That links nearly all that belongs together, so
that few pairs are left for the third step. A list is cut for these steps only where it has more
than LONGEST members, and each round deals them anew.
Then, exactly, all pairs of the list that are not yet in one component. Long lists are cut to
blocks, and each pair of blocks is a task's work of its own. No pair is left out: two classes
of one component need no further link to be in it, and a group whose classes are in several
components is split into its classes before the second and the third step.

In all three steps, and before whole texts are read, a pair must pass a sketch of whole sets: one bit for each hash slot, set
where an odd number of shingles falls. Two sets differ in at least as many shingles as their
sketches do in bits, so a pair whose sketches differ in more bits than the threshold allows
cannot link. That is a bound, not an estimate: it drops no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.components import components, united
from skyledger.llm.hot_shingles import hot_shingles
from skyledger.llm.shared import batches_of_bytes, for_python, id_and_text, ids_of, materialize, plans_not_compiled, rows_of_ids, shuffle_partitions
from skyledger.llm.words import batches, encoded, mix, shingle_sets

WIDTH = 5
PERCENT = 75

# Groups of one list that are paired at once, hubs of a longer list, orders in which its members
# meet their neighbours in a round, rounds, and members of a block.
SHORT_LIST = 16
HUBS = 2
TURNS = 2
ROUNDS = 2
BLOCK = 512

# Classes that share a group; a larger one is left as single classes.
LARGEST_GROUP = 16

# Groups of one list that are in one task in the first two steps.
LONGEST = 4096

# Bits of a sketch: the power of two from the size of the set on, within these.
SKETCH_BITS = (256, 8192)

# Bytes of a shingle's hash that a prefix keeps: two that agree in them cost a pair to verify, no link.
TOKEN_BYTES = 6

# Bytes of prefixes that are opened at once.
POSTED = 1 << 20

# Bytes of sketches that are compared at once, pairs that wait for it, and distinct pairs that a task holds before it passes them on.
COMPARED = 1 << 23
MOST_WAITING = 1 << 18
MOST_HELD = 1 << 20

# Bytes of rows that go to a worker at once, and pairs of texts that are opened at once.
SENT = 1 << 23
VERIFIED = 256

SETS = "doc_id long, n_shingles long, sig_a long, sig_b long, prefix_sig long, prefix binary, sketch binary"
POSTINGS = "token long, list long, gid long, size int, place int"
FOUND = f"a long, b long, {POSTINGS}"
COLUMNS = ["a", "b", "token", "list", "gid", "size", "place"]
PAIRS = "a long, b long"


def _prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def upper_bytes(shingles: np.ndarray) -> bytes:
    """The upper TOKEN_BYTES of each hash."""
    return shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - TOKEN_BYTES :].tobytes()


def from_upper_bytes(content: bytes) -> np.ndarray:
    """The hashes that ``upper_bytes`` made ``content`` of, their lower bytes 0."""
    upper = np.frombuffer(content, dtype=np.uint8).reshape(-1, TOKEN_BYTES)
    whole = np.zeros((len(upper), 8), dtype=np.uint8)
    whole[:, 8 - TOKEN_BYTES :] = upper
    return whole.view("<u8").ravel()


def sketch(shingles: np.ndarray) -> bytes:
    """The parity of the number of shingles in each slot, a power of two of them."""
    bits = min(max(1 << max(len(shingles) - 1, 0).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").tobytes()


def _folded(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches of ``width`` bytes and more, folded to ``width``, as rows of 64-bit words."""
    rows = np.empty((len(sketches), width // 8), dtype=np.uint64)
    for k, one in enumerate(sketches):
        rows[k] = np.bitwise_xor.reduce(np.frombuffer(one, dtype=np.uint64).reshape(-1, width // 8), axis=0)
    return rows


def _near(frame: pd.DataFrame, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sketches of two rows leave room for the threshold; true where one has none.

    ``slack``, if there is one, is the number of bits by which a row's sets may differ from its sketch.
    """
    size = frame["size"].to_numpy(np.int64)
    slack = frame["slack"].to_numpy(np.int64) if "slack" in frame else np.zeros(len(frame), np.int64)
    sketches = [b"" if one is None else one for one in frame["sketch"]]
    length = np.array([len(one) for one in sketches], dtype=np.int64)
    widths = np.minimum(length[x], length[y])
    allowed = size[x] + size[y] - 2 * -(-percent * (size[x] + size[y]) // (100 + percent))
    allowed += slack[x] + slack[y]
    near = np.ones(len(x), dtype=bool)
    for width in np.unique(widths[widths > 0]).tolist():
        of_width = np.flatnonzero(widths == width)
        used, at = np.unique(np.concatenate([x[of_width], y[of_width]]), return_inverse=True)
        rows = _folded([sketches[k] for k in used], width)
        at_x, at_y = at[: len(of_width)], at[len(of_width) :]
        step = max(COMPARED // width, 1)
        for k in range(0, len(of_width), step):
            differ = np.bitwise_count(rows[at_x[k : k + step]] ^ rows[at_y[k : k + step]]).sum(axis=1, dtype=np.int64)
            near[of_width[k : k + step]] = differ <= allowed[of_width[k : k + step]]
    return near


def described_sets(texts: DataFrame, hot: Broadcast, width: int, percent: int) -> DataFrame:
    """Per row: size of the set, two signatures and a sketch of it, and its ordered prefix with a signature."""

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for shingles in shingle_sets(encoded(frame["text"]), width):
                n = len(shingles)
                if not n:
                    rows.append((0, 0, 0, 0, b"", b""))
                    continue
                first = _prefix_size(n, percent)
                prefix = shingles[np.argsort(hot.value.level(shingles), kind="stable")[:first]]
                with np.errstate(over="ignore"):
                    odd = shingles | np.uint64(1)
                    sig_a, sig_b = np.bitwise_xor.reduce(mix(shingles)), np.sum(odd * odd * odd)
                    places = np.arange(1, first + 1, dtype=np.uint64)
                    prefix_sig = np.sum(mix(prefix + mix(places)))
                signs = np.array([sig_a, sig_b, prefix_sig], dtype=np.uint64).astype(np.int64)
                rows.append((n, *signs.tolist(), upper_bytes(prefix), sketch(shingles)))
            out = pd.DataFrame(rows, columns=["n_shingles", "sig_a", "sig_b", "prefix_sig", "prefix", "sketch"])
            out.insert(0, "doc_id", ids_of(frame).array)
            yield out

    return for_python(texts).mapInPandas(describe, SETS)


def grouped(sets: DataFrame) -> DataFrame:
    """Classes: ``rep`` (smallest id), ``gid`` (the leader of its group), ``size``, ``single`` (alone in it)."""
    classes = (
        sets.filter("n_shingles > 0")
        .groupBy("n_shingles", "sig_a", "sig_b", "prefix_sig")
        .agg(F.min("doc_id").alias("rep"))
        .filter("rep IS NOT NULL")
    )
    key = ["n_shingles", "prefix_sig"]
    groups = classes.groupBy(*key).agg(F.count(F.lit(1)).alias("members"), F.min("rep").alias("leader"))
    joined = classes.join(groups.filter("members > 1"), key, "left")
    shared = F.coalesce(F.col("members") <= LARGEST_GROUP, F.lit(False))
    gid = F.when(shared, F.col("leader")).otherwise(F.col("rep"))
    size = F.col("n_shingles").cast("int").alias("size")
    return materialize(joined.select("rep", gid.alias("gid"), size, (~shared).alias("single")), "classes")


def postings(sets: DataFrame, classes: DataFrame, hot: Broadcast) -> DataFrame:
    """``token, list, gid, size, place`` of every shingle of a group's prefix.

    ``list`` is the token, but that of a hot shingle is cut by hash to lists of about LONGEST
    groups even if all groups hold it.
    """
    leaders = classes.filter("rep = gid").select(F.col("gid").alias("doc_id"))
    prefixes = sets.filter("n_shingles > 0").select("doc_id", "n_shingles", "prefix")
    prefixes = prefixes.join(leaders, "doc_id", "left_semi")
    cuts = np.uint64(-(-sets.count() // LONGEST))

    def explode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first, last in batches(frame["prefix"], POSTED):
                part = frame.iloc[first:last]
                lengths = np.array([len(x) // TOKEN_BYTES for x in part["prefix"]], dtype=np.int64)
                token = from_upper_bytes(b"".join(part["prefix"]))
                gid = np.repeat(part["doc_id"].to_numpy(np.int64), lengths)
                with np.errstate(over="ignore"):
                    cut = mix(token + mix(gid.astype(np.uint64)) % cuts)
                is_hot = hot.value.holds(token)
                place = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                yield pd.DataFrame(
                    {
                        "token": token.astype(np.int64),
                        "list": np.where(is_hot, cut, token).astype(np.int64),
                        "gid": gid,
                        "size": np.repeat(part["n_shingles"].to_numpy(np.int32), lengths),
                        "place": place.astype(np.int32),
                    }
                )

    return prefixes.mapInPandas(explode, POSTINGS)


def _room(size: np.ndarray, place: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether two sets that first meet at these places can reach the threshold."""
    needed = -(-percent * (size[x] + size[y]) // (100 + percent))
    return np.minimum(size[x] - place[x], size[y] - place[y]) >= needed


def _runs(keys: np.ndarray) -> np.ndarray:
    """Edges of the runs of equal sorted keys."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]).astype(np.int64)


def _unique_pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    if not found:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    x = np.concatenate([p[0] for p in found])
    y = np.concatenate([p[1] for p in found])
    apart = x != y
    pairs = np.unique(np.stack([np.minimum(x, y)[apart], np.maximum(x, y)[apart]]), axis=1)
    return pd.DataFrame({"a": pairs[0], "b": pairs[1]})


def _near_pairs(frame: pd.DataFrame, found: list[tuple[np.ndarray, np.ndarray]], percent: int) -> pd.DataFrame:
    """The distinct pairs of groups among pairs of rows whose sketches are near enough."""
    x = np.concatenate([p[0] for p in found] + [np.zeros(0, np.int64)])
    y = np.concatenate([p[1] for p in found] + [np.zeros(0, np.int64)])
    keep = _near(frame, x, y, percent)
    gid = frame["gid"].to_numpy(np.int64)
    return _unique_pairs([(gid[x[keep]], gid[y[keep]])])


def _once(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct pairs of a task: two texts meet in the list of each shingle they share."""
    held = _unique_pairs([])
    for pairs in found:
        held = _unique_pairs([(part["a"].to_numpy(), part["b"].to_numpy()) for part in (held, pairs)])
        if len(held) >= MOST_HELD:
            yield held
            held = _unique_pairs([])
    yield held


def _with_nulls(part: pd.DataFrame) -> pd.DataFrame:
    """The columns of FOUND, null where the rows lack one; whole numbers keep all their digits."""
    lacking = pd.array([None] * len(part), dtype="Int64")
    return pd.DataFrame({c: part[c].astype("Int64").array if c in part else lacking for c in COLUMNS})


def _by_list(postings: DataFrame) -> DataFrame:
    return postings.repartition(shuffle_partitions(postings.sparkSession), "list").sortWithinPartitions("list")


def _lists(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole lists of a partition that is sorted by list, many at a time."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        tokens = frame["list"].to_numpy()
        edge = int(np.searchsorted(tokens, tokens[-1], "left")) if len(tokens) else 0
        if edge:
            yield frame.iloc[:edge]
        rest = frame.iloc[edge:]
    if rest is not None and len(rest):
        yield rest


def cut_lists(long_lists: DataFrame, *by: str | Column) -> DataFrame:
    """The postings with ``list``: the token, with a piece of about LONGEST members where it has more.

    Members are dealt to the pieces by a hash of ``by``. Only longer lists are broadcast, 16 bytes
    for each LONGEST postings at most.
    """
    lengths = long_lists.groupBy("token").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > LONGEST)
    pieces = lengths.select("token", F.ceil(F.col("members") / LONGEST).alias("pieces"))
    piece = F.xxhash64("token", F.pmod(F.xxhash64(*by), F.col("pieces")))
    dealt = long_lists.join(F.broadcast(pieces), "token", "left")
    return dealt.withColumn("list", F.when(F.col("pieces").isNull(), F.col("token")).otherwise(piece)).drop("pieces")


def short_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs of the short lists: ``a, b``.

    The postings of long or cut lists come along, as rows with ``token``.
    """

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _lists(frames):
            names, gid = frame["list"].to_numpy(), frame["gid"].to_numpy(np.int64)
            size, place = frame["size"].to_numpy(np.int64), frame["place"].to_numpy(np.int64)
            edges = _runs(names)
            length = np.diff(edges)
            found = []
            begin = np.repeat(edges[:-1], length)
            later = (frame["token"].to_numpy() != names) | np.repeat(length > SHORT_LIST, length)
            for distance in range(1, SHORT_LIST):
                x = np.flatnonzero(~later & (begin + distance <= np.arange(len(gid))))
                if not len(x):
                    break
                y = x - distance
                keep = _room(size, place, x, y, percent)
                found.append((gid[x[keep]], gid[y[keep]]))
            for part in (_unique_pairs(found), frame[later]):
                yield _with_nulls(part)

    return lists.mapInPandas(pair, FOUND)


def _sketches(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, size, sketch`` of the ids (``doc_id``) whose rows all have one size and one sketch."""
    rows = rows_of_ids(sets.filter("n_shingles > 0").select("doc_id", "n_shingles", "sketch"), ids)
    both = F.struct(F.col("n_shingles").cast("int").alias("size"), "sketch")
    one = rows.groupBy("doc_id").agg(F.min(both).alias("first"), F.max(both).alias("last"))
    return one.filter("first = last").select("doc_id", "first.size", "first.sketch")


def sketched(long_lists: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """The postings with ``sketch`` and ``slack`` of their groups.

    A group of several classes has the sketch of one of them, and the slack is the largest number
    of bits in which another one differs from it. The sketch is null where an id has several sets.
    """
    gids = long_lists.select("gid").distinct()
    members = classes.join(gids, "gid", "left_semi").select("gid", F.col("rep").alias("doc_id"))
    own = members.join(_sketches(sets, members.select("doc_id").distinct()), "doc_id", "left")
    of_group = own.groupBy("gid").agg(F.collect_list("sketch").alias("sketches"), F.count(F.lit(1)).alias("members"))

    def one(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            first, slack = [], []
            for sketches in frame["sketches"]:
                rows = _folded(list(sketches), len(sketches[0]))
                first.append(sketches[0])
                slack.append(int(np.bitwise_count(rows ^ rows[0]).sum(axis=1, dtype=np.int64).max()))
            yield pd.DataFrame({"gid": frame["gid"], "sketch": first, "slack": slack})

    whole = of_group.filter(F.size("sketches") == F.col("members")).select("gid", "sketches")
    bounds = whole.mapInPandas(one, "gid long, sketch binary, slack int")
    return long_lists.join(bounds, "gid", "left").fillna(0, ["slack"])


def near_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a, b``) of classes whose sketches leave room for the threshold."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sketches = _sketches(sets, ids)
    for end in ("a", "b"):
        own = sketches.select(F.col("doc_id").alias(end), F.col("size").alias(f"size_{end}"), F.col("sketch").alias(f"sketch_{end}"))
        pairs = pairs.join(own, end, "left").fillna(0, [f"size_{end}"])

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ends = [frame[[f"size_{end}", f"sketch_{end}"]].set_axis(["size", "sketch"], axis=1) for end in "ab"]
            x = np.arange(len(frame))
            yield frame.loc[_near(pd.concat(ends, ignore_index=True), x, x + len(frame), percent), ["a", "b"]]

    return pairs.mapInPandas(keep, PAIRS)


def hub_pairs(long_lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of the members of long lists with their hubs, those whose ids have the smallest hashes."""

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _lists(frames):
            gid = frame["gid"].to_numpy(np.int64)
            size, place = frame["size"].to_numpy(np.int64), frame["place"].to_numpy(np.int64)
            dealt = mix(gid.astype(np.uint64))
            found = []
            edges = _runs(frame["list"].to_numpy())
            for first, last in zip(edges[:-1], edges[1:], strict=True):
                members = np.arange(first, last)
                for hub in members[np.argsort(dealt[first:last], kind="stable")[:HUBS]]:
                    others = members[gid[members] != gid[hub]]
                    at = np.full(len(others), hub)
                    keep = _room(size, place, at, others, percent)
                    found.append((at[keep], others[keep]))
            yield _near_pairs(frame, found, percent)

    return _by_list(cut_lists(long_lists, "gid")).mapInPandas(lambda frames: _once(pair(frames)), PAIRS).distinct()


def _across(names: np.ndarray, component: np.ndarray) -> np.ndarray:
    """For rows sorted by list and component: the place of each row's partner in its list.

    The partner stands as many places further, round the list, as its largest component has
    members. A member so meets one of another component wherever the list has enough of them.
    """
    edges = _runs(names)
    starts = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]) | (component[1:] != component[:-1])]))
    largest = np.maximum.reduceat(np.diff(np.append(starts, len(names))), np.searchsorted(starts, edges[:-1]))
    length = np.diff(edges)
    begin = np.repeat(edges[:-1], length)
    return begin + (np.arange(len(names)) - begin + np.repeat(largest, length)) % np.repeat(length, length)


def neighbour_pairs(long_lists: DataFrame, percent: int, done: int = 0) -> DataFrame:
    """Pairs of long lists across their components, one a member in each of TURNS orders by hash.

    After ``done`` rounds the orders and the pieces of a list are others.
    """

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _lists(frames):
            names, gid = frame["list"].to_numpy(), frame["gid"].to_numpy(np.int64)
            component = frame["component"].to_numpy(np.int64)
            size, place = frame["size"].to_numpy(np.int64), frame["place"].to_numpy(np.int64)
            found = []
            for turn in range(TURNS * done + 1, TURNS * (done + 1) + 1):
                with np.errstate(over="ignore"):
                    dealt = mix(mix(gid.astype(np.uint64) + np.uint64(turn)) + names.astype(np.uint64))
                order = np.lexsort((dealt, component, names))
                x, y = order, order[_across(names[order], component[order])]
                apart = component[x] != component[y]
                x, y = x[apart], y[apart]
                keep = _room(size, place, x, y, percent)
                found.append((x[keep], y[keep]))
            yield _near_pairs(frame, found, percent)

    lists = cut_lists(long_lists, "gid", "token", F.lit(done))
    return _by_list(lists).mapInPandas(lambda frames: _once(pair(frames)), PAIRS).distinct()


def block_pairs(long_lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of the members of long lists (with ``component``) that are in different components.

    A list is dealt to blocks by hash, and each two blocks meet in a partition of their own. A list
    of one component has no such pair.
    """
    lengths = long_lists.groupBy("token").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
        F.min("component").alias("one"), F.max("component").alias("other"),
    )
    dealt = long_lists.join(lengths.filter("one <> other").select("token", "blocks"), "token").withColumn("own", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int"))
    meetings = F.expr("transform(sequence(0, blocks - 1), k -> struct(least(own, k) AS one, greatest(own, k) AS two))")
    dealt = dealt.withColumn("meeting", F.explode(meetings)).select(
        F.xxhash64("token", "meeting.one", "meeting.two").alias("list"),
        "gid", "size", "place", "component", "sketch", "slack", "own", (F.col("meeting.one") == F.col("meeting.two")).alias("alone"),
    )

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _lists(frames):
            edges = _runs(frame["list"].to_numpy())
            component = frame["component"].to_numpy(np.int64)
            size, place = frame["size"].to_numpy(np.int64), frame["place"].to_numpy(np.int64)
            own, alone = frame["own"].to_numpy(), frame["alone"].to_numpy()
            found, waiting = [], 0
            for first, last in zip(edges[:-1], edges[1:], strict=True):
                for x in range(first, last - 1):
                    y = np.arange(x + 1, last)
                    y = y[(component[y] != component[x]) & (alone[x] | (own[y] != own[x]))]
                    y = y[_room(size, place, np.full(len(y), x), y, percent)]
                    if len(y):
                        found.append((np.full(len(y), x), y))
                        waiting += len(y)
                    if waiting >= MOST_WAITING:
                        yield _near_pairs(frame, found, percent)
                        found, waiting = [], 0
            yield _near_pairs(frame, found, percent)

    return _by_list(dealt).mapInPandas(lambda frames: _once(pair(frames)), PAIRS).distinct()


def several_components(sets: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``gid, rep, size, component, sketch`` of the classes of groups that are not in one component."""
    of_class = labels.select(F.col("node").alias("rep"), "component")
    own = classes.filter("NOT single").join(of_class, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    # A group has at most LARGEST_GROUP classes.
    group = Window.partitionBy("gid")
    parted = own.withColumns({"one": F.min("component").over(group), "other": F.max("component").over(group)})
    split = materialize(parted.filter("one <> other").select("gid", "rep", "size", "component"), "split")
    if split.isEmpty():
        return split.withColumn("sketch", F.lit(None).cast("binary"))
    reps = split.select(F.col("rep").alias("doc_id")).distinct()
    sketches = _sketches(sets, reps).select(F.col("doc_id").alias("rep"), "sketch")
    return materialize(split.join(sketches, "rep", "left"), "split-sketches")


def with_components(long_lists: DataFrame, split: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings with ``component``; those of the groups of ``split`` once for each class, as a group of its own."""
    of_group = labels.select(F.col("node").alias("gid"), "component")
    whole = long_lists.join(split.select("gid").distinct(), "gid", "left_anti").join(of_group, "gid", "left")
    whole = whole.withColumn("component", F.coalesce("component", "gid"))
    parts = long_lists.drop("sketch", "slack").join(split, ["gid", "size"]).drop("gid")
    parts = parts.withColumnRenamed("rep", "gid").withColumn("slack", F.lit(0))
    return whole.unionByName(parts)


def ungrouped(classes: DataFrame, split: DataFrame) -> DataFrame:
    """``gid, rep`` of all classes; those of ``split`` are groups of their own."""
    whole = classes.join(split.select("gid").distinct(), "gid", "left_anti").select("gid", "rep")
    return whole.union(split.select(F.col("rep").alias("gid"), "rep"))


def expanded(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of groups as pairs of their classes; a group has at most LARGEST_GROUP."""
    one = members.select(F.col("gid").alias("a"), F.col("rep").alias("ra"))
    two = members.select(F.col("gid").alias("b"), F.col("rep").alias("rb"))
    return pairs.join(one, "a").join(two, "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))


def inner_pairs(members: DataFrame) -> DataFrame:
    """Pairs of classes within a group."""
    several = members.groupBy("gid").agg(F.collect_list("rep").alias("reps")).filter("size(reps) > 1")
    return several.select(
        F.inline(
            F.expr(
                "flatten(transform(reps, x -> transform(filter(reps, y -> y > x), y -> struct(x AS a, y AS b))))"
            )
        )
    )


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (``a, b``) whose whole texts reach the threshold."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    needed = rows_of_ids(texts, ids)
    one = needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kept = []
            for first in range(0, len(frame), VERIFIED):
                part = frame.iloc[first : first + VERIFIED]
                left = shingle_sets(encoded(part["text_a"]), width)
                right = shingle_sets(encoded(part["text_b"]), width)
                for x, y in zip(left, right, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    kept.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield frame.loc[kept, ["a", "b"]]

    return pairs.join(one, "a").join(two, "b").mapInPandas(check, PAIRS)


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    Two documents link when 100 * shared >= percent * united of their distinct word shingles
    (a text of fewer than ``width`` words is one shingle). The component is the smallest doc_id
    that links reach. An empty text has 0 shingles and links with nothing, not even its copies.
    A row without id takes the component of the rows with an equal set, else null; rows that share an id are
    one node with the links of all of them. Repeated rows come back as often as they went in.
    Sets are compared by 64-bit hashes of their shingles.
    """
    texts = id_and_text(docs)
    spark = docs.sparkSession
    # All that runs in Python is written here, so the limit need not outlive this call.
    with batches_of_bytes(spark, SENT), plans_not_compiled(spark):
        hot = spark.sparkContext.broadcast(hot_shingles(texts, width, shuffle_partitions(spark)))
        sets = materialize(described_sets(texts, hot, width, percent), "sets")
        classes = grouped(sets)
        found = materialize(short_pairs(_by_list(postings(sets, classes, hot)), percent), "found")
        long_lists = found.filter("token IS NOT NULL").select("token", "gid", "size", "place")
        long_lists = materialize(sketched(long_lists, sets, classes), "long")
        own = texts.filter("doc_id IS NOT NULL")
        paired = found.filter("token IS NULL").select("a", "b").union(hub_pairs(long_lists, percent)).distinct()
        first = expanded(paired, classes).union(inner_pairs(classes))
        first = near_pairs(materialize(first.distinct(), "pairs"), sets, percent)
        links = materialize(verified(materialize(first, "near"), own, width, percent).distinct(), "links")
        labels = components(links)
        for done in range(ROUNDS + 1):
            split = several_components(sets, classes, labels)
            labelled = with_components(long_lists, split, labels)
            candidates = neighbour_pairs(labelled, percent, done) if done < ROUNDS else block_pairs(labelled, percent)
            rest = expanded(candidates, ungrouped(classes, split))
            rest = rest.join(links, ["a", "b"], "left_anti").distinct()
            rest = near_pairs(materialize(rest, "pairs"), sets, percent)
            more = materialize(verified(materialize(rest, "near"), own, width, percent).distinct(), "links")
            labels = united(labels, components(_lifted(more, labels)))
            links = links.union(more)
        return _labelled(sets, labels)


def _lifted(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between the components of their ends."""
    for end in ("a", "b"):
        step = labels.select(F.col("node").alias(end), F.col("component").alias("up"))
        links = links.join(step, end, "left").withColumn(end, F.coalesce("up", end)).drop("up")
    return links.filter("a <> b").select("a", "b").distinct()


def _labelled(sets: DataFrame, linked: DataFrame) -> DataFrame:
    key = ["n_shingles", "sig_a", "sig_b"]
    reps = sets.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    labels = linked.select(F.col("node").alias("rep"), "component")
    reps = reps.join(labels, "rep", "left").select(*key, F.coalesce("component", "rep").alias("component"))
    return sets.join(reps, key, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
