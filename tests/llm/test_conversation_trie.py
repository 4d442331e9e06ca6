"""The conversation trie against a brute-force version, and its perfect hash."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from skyledger.llm import conversation_trie, queries
from skyledger.llm.perfect_hash import PerfectHash
from skyledger.llm.shipping import ship_package

SCHEMA = "conv_id long, turn long, role string, text string, n long, k1 string, depth string, shard int, __range int"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def _table(spark, rows):
    return spark.createDataFrame([(*r, None, "x", None, 7, None) for r in rows], SCHEMA)


def _brute(rows):
    turns = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in turns.items()}
    members, ends = {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        opening = turns.get(c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5)), [])
        new = opening[:h] + own[h:]
        for d in range(len(new) + 1):
            members.setdefault(tuple(new[:d]), []).append(c)
        ends.setdefault(tuple(new), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[c] for c in below) if below else 1
        saved[p] = sum(saved[c] for c in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return sorted(
        (
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children.get(p, [])), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p in members
    )


def _conversations(seed, long_turns):
    rng = random.Random(seed)
    texts = ["", None, "héllo", "a", "b", "x" * 3000, "🙂 ok"]
    rows = []
    for c in range(-12, 150):
        if rng.random() < 0.15:
            continue
        first = rng.choice(texts)
        for t in range(rng.randint(1, 12)):
            text = first if t == 0 else rng.choice(texts)
            rows.append((c, None if t == 0 and rng.random() < 0.2 else t, rng.choice(["user", "assistant", None]), text))
    same = [(t, "user", f"turn {t}") for t in range(6)]
    rows += [(c, *turn) for c in range(1000, 1090) for turn in same]
    rows += [(2000, t, "user", f"t{t % 3}") for t in range(long_turns)] + [(2001, t, "user", f"t{t % 3}") for t in range(long_turns - 5)]
    rows += [(None, 0, "user", "nobody's"), (3000, 1, "user", "tie"), (3000, 1, "user", "tie"), (3000, 1, "assistant", "tie")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "shard_rows"), [(1, 1 << 17), (2, 40), (3, 3)])
def test_trie_equals_brute_force(spark, many_ranges, seed, shard_rows):
    rows = _conversations(seed, long_turns=300)
    got = conversation_trie.prefix_trie(_table(spark, rows).repartition(5), shard_rows)
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows)


def test_trie_equals_sql(spark, sf_dir):
    got = sorted(tuple(r) for r in queries.QUERIES["op12_prefix_trie"](spark, sf_dir).select(*COLUMNS).collect())
    with duckdb.connect() as sql:
        sql.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
        cursor = sql.execute(queries.ORACLE["op12_prefix_trie"])
        names = [c[0] for c in cursor.description]
        rows = [tuple(row[names.index(c)] for c in COLUMNS) for row in cursor.fetchall()]
    assert got == sorted(rows)


def test_edges(spark):
    assert conversation_trie.prefix_trie(_table(spark, [])).collect() == []
    # 4 has no turn left: its family has no opening conversation and its own turns are among its first h.
    rows = [(4, 0, "user", "gone")]
    assert zlib.crc32(b"4") % 9 >= 1
    got = [tuple(r) for r in conversation_trie.prefix_trie(_table(spark, rows)).collect()]
    assert got == _brute(rows) and len(got) == 1 and got[0][1:4] == (0, None, 1)


def test_perfect_hash_is_minimal_and_survives_its_parts():
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 63, 20000).astype(np.uint64))
    table = PerfectHash.build(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    again = PerfectHash.from_parts(*[x.tobytes() for x in table.parts()])
    assert (again.slots(keys) == table.slots(keys)).all()
    assert PerfectHash.build(np.zeros(0, np.uint64)).slots(keys[:3]).tolist() == [-1, -1, -1]
    with pytest.raises(ValueError, match="distinct"):
        PerfectHash.build(np.array([1, 1], dtype=np.uint64))


def test_node_table_knows_only_its_digests():
    k1, k2 = np.arange(1000), np.arange(1000) * 7
    table = conversation_trie.NodeTable(k1, k2)
    assert sorted(table.slots(k1, k2).tolist()) == list(range(1000))
    assert (table.slots(k1, k2 + 1) == -1).all()
