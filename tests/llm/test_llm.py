"""The operators of the llm subpackage against brute force, round trips and edge cases."""

import collections
import hashlib
import math
import os
import random
import re
import time
import zlib
from importlib import resources

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyledger.llm import (
    block_search,
    components,
    context_mixing,
    decontamination,
    jaccard_join,
    licences,
    nbsvm,
    packing,
    pii,
    queries,
    warc,
    wavelet,
)
from skyledger.llm import shared
from skyledger.llm.shipping import ship_package
from skyledger.llm.tokens import Encoder
from skyledger.llm.words import IS_MARK, encoded, shingle_sets, word_hashes

TABLES = "documents embeddings pages benchmark labels conversations".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def _docs(spark, rows, extra=True):
    """Documents with columns whose names operators use for results."""
    clash = "score double, spans string, __score double, component_id long, no_id string, task string"
    full = [(i, t, "en", "s", None, *([None] * 6 if extra else [])) for i, t in rows]
    return spark.createDataFrame(full, f"{DOCS}, {clash}" if extra else DOCS)


EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (4, "a"), (None, "b c d e f g"), (5, "x" * 30000), (6, "é ñ 🙂")]


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


# Every query whose rows SQL can give, on the smallest driver tables.


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(name, spark, sf_dir):
    sql = duckdb.connect()
    for table in TABLES:
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    cursor = sql.execute(queries.ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(map(repr, (tuple(r[columns.index(c)] for c in sorted(columns)) for r in cursor.fetchall())))
    assert sorted(repr(tuple(r[c] for c in sorted(columns))) for r in df.collect()) == want


# Words and tokens


def test_word_hashes_tell_words_apart():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB \n.1é") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    hashes, upto = word_hashes(encoded(texts))
    flat = [w for t in texts for w in _words(t)]
    assert len(hashes) == len(flat) == upto[-1]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))
    assert len(word_hashes(encoded(["a.b, c"]), IS_MARK)[0]) == 3


@pytest.mark.parametrize("plain_names", [False, True])
@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(file, plain_names, spark, sf_dir):
    path = public_tokenizers.path(file)
    plain, own, rng = Tokenizer.from_file(path), Encoder(path, plain_names), random.Random(2)
    if plain_names:
        plain.encode_special_tokens = True
    signs = ["a", "B", " ", "  ", "\n", "\t", "\xa0", " ", "é", "'s", "!", "12", "\x1c", "́", "<|endoftext|>", "Σ", "中", "🙂", "İ", "..."]
    signs += ["<|ENDOFTEXT|>", "<|", "\nWord", "\n\n", "ab.", "Élan,"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    for text, together in zip(texts, own.encode_all(texts), strict=True):
        ids = plain.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == together == np.array(ids, dtype="<u4").tobytes(), ascii(text)


def test_wavelet_files_keep_every_token(spark, sf_dir, many_ranges):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Encoder(path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs[:80]] + EDGES
    got = [tuple(r) for r in wavelet.wavelet_round_trip(_docs(spark, rows), path, end_id=2).collect()]
    want, start = [], 0
    ids = {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        code = own.encode(text or "") + (2).to_bytes(4, "little")
        ids.setdefault(doc_id, []).append((len(code) // 4, zlib.crc32(code)))
        want.append(doc_id)
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == want
    for doc_id, first, size, crc in got:
        assert first == start and (size, crc) in ids[doc_id]
        ids[doc_id].remove((size, crc))
        start += size
    assert wavelet.wavelet_round_trip(_docs(spark, []), path, end_id=2).collect() == []


def test_wavelet_shard_access_count_select():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 700, 5000).astype("<u4")
    one = np.array([5000])
    shard = wavelet.WaveletShard(wavelet.encode_shard(ids, np.array([7]), np.array([False]), np.array([0]), one))
    assert (shard.all_tokens() == ids).all()
    for i in rng.integers(0, 5000, 40).tolist():
        token = int(ids[i])
        assert shard.access(i) == token
        assert shard.count(token, 10, i) == int((ids[10:i] == token).sum()) if i >= 10 else True
        k = int((ids[:i] == token).sum())
        assert shard.select(token, k) == i
    with pytest.raises(IndexError):
        shard.select(100000, 0)


def test_wavelet_levels_are_not_parted_by_masks():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50000, 1 << 19).astype("<u4")
    ones = rng.integers(0, 2, len(ids)).astype(bool)
    one, least = np.array([len(ids)]), {"file": 1e9, "masks": 1e9}
    for _ in range(5):
        begin = time.process_time()
        content = wavelet.encode_shard(ids, np.array([7]), np.array([False]), np.array([0]), one)
        back = wavelet.WaveletShard(content).all_tokens()
        middle = time.process_time()
        part = ids.astype(np.uint16)
        for _ in range(16):
            both = np.concatenate([part[~ones], part[ones]])
            part[~ones], part[ones] = both[: len(ids) - ones.sum()], both[len(ids) - ones.sum() :]
        end = time.process_time()
        least = {"file": min(least["file"], middle - begin), "masks": min(least["masks"], end - middle)}
    assert (back == ids).all()
    # Writing and reading a file, compression included, takes less than parting its levels by masks alone.
    assert least["file"] < least["masks"]


def test_packing_keeps_every_id_once(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    own = Encoder(path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"] + 100, r["text"]) for r in docs] + EDGES
    pieces = packing.pack_documents(_docs(spark, rows), path, end_id=1).collect()
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
    for own_pieces in sequences.values():
        at = 0
        for p in sorted(own_pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == own_pieces[0]["capacity"] and (at == 2048 or at & (at - 1) == 0)
    texts = {i: t for i, t in rows if i not in (4, None)}
    by_doc = collections.defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
    assert set(by_doc) == {i for i, _ in rows}
    for doc_id, text in texts.items():
        ids, at = own.encode(text or "") + (1).to_bytes(4, "little"), 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            part = ids[4 * at : 4 * (at + p["length"])]
            assert (p["start"], p["ids_crc32"], p["doc_tokens"]) == (at, zlib.crc32(part), len(ids) // 4)
            at += p["length"]
        assert at == len(ids) // 4
    assert packing.pack_documents(_docs(spark, []), path, end_id=1).collect() == []


def test_dealing_balances_cost():
    sizes = np.random.default_rng(1).integers(1, 2048, 700)
    dealt = packing.deal(sizes, 2048)
    rooms = packing.capacities(int(sizes.sum()), 2048)
    spent = collections.Counter()
    for _, _, tokens, k, _ in dealt:
        spent[k] += float(packing.cost(tokens))
    full = [spent[k] for k in range(len(rooms)) if rooms[k] == 2048]
    assert sum(rooms) == sizes.sum() and max(full) / np.mean(full) < 1.5


# Near duplicates


def _brute_components(rows, percent=75):
    sets = []
    for _, text in rows:
        w = _words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(rows[a][0]), find(rows[b][0])))
                parent[y] = x
    return {(i, len(s), find(i)) for (i, _), s in zip(rows, sets, strict=True)}


def _families(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for family in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 60, 90]))] + (passage if family % 2 else [])
        for _ in range(rng.choice([3, 45])):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    rows += [(len(rows) * 3 + 1 + k, t) for k, t in enumerate(["", "A b", "a B", " a  b ", "one two three four five", None])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_match_all_pairs(spark, monkeypatch, seed):
    # Few hubs, short lists and small blocks, so that every step has work on few rows.
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 4)
    monkeypatch.setattr(jaccard_join, "HUBS", 1)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "LONGEST", 32)
    rows = _families(seed)
    got = jaccard_join.near_duplicates(_docs(spark, rows)).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == _brute_components(rows)
    assert len(got) == len(rows)


def test_near_duplicates_edge_rows(spark):
    got = sorted(map(repr, map(tuple, jaccard_join.near_duplicates(_docs(spark, [*EDGES, (9, "b c d e f g")])).collect())))
    want = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (None, 2, 9), (5, 1, 5), (6, 1, 6), (9, 2, 9)]
    assert got == sorted(map(repr, want))
    assert jaccard_join.near_duplicates(_docs(spark, [])).collect() == []


def test_near_duplicates_of_groups_in_several_components(spark):
    # Edited copies of a body, each once with either footer: the two have one prefix and size, so they are
    # a group, but they do not link. Bridges link the copies with the first footer, and they are the hubs.
    rng = random.Random(7)
    body, common = [f"b{k}" for k in range(80)], [f"c{k}" for k in range(4)]
    footers = [common + [f"f{n}x{k}" for k in range(20)] for n in range(2)]
    ids = [*range(1, 70)]
    dealt = jaccard_join.mix(np.array(ids, dtype=np.uint64))
    bridges = [ids[k] for k in np.argsort(dealt)[:19]]
    others = [i for i in ids if i not in bridges]

    def edited(*places):
        return [f"u{k // 3}" if k in places else w for k, w in enumerate(body)]

    rows = [(others[n * 20 + k], " ".join(edited(2 + 3 * k) + footers[n])) for n in range(2) for k in range(20)]
    rows += [(bridges[k], " ".join(edited(2 + 3 * k, 5 + 3 * k) + footers[0])) for k in range(19)]
    for i in range(200):
        rows.append((100 + i, " ".join([f"r{rng.randrange(10**6)}" for _ in range(60)] + footers[i % 2])))
    want = _brute_components(rows)
    assert len({c for i, _, c in want if i < 100}) == 2
    got = jaccard_join.near_duplicates(_docs(spark, rows)).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == want


def test_neighbours_meet_in_whole_lists(spark, monkeypatch):
    # Links through hot shingles only: few pairs may be left for the exact step, however many documents there are.
    monkeypatch.setattr(jaccard_join, "LONGEST", 64)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    left = []
    exact = jaccard_join.block_pairs
    monkeypatch.setattr(jaccard_join, "block_pairs", lambda *a: left.append(exact(*a).count()) or exact(*a))
    rng = random.Random(11)
    body = [f"b{k}" for k in range(100)]
    rows = []
    for i in range(48):
        words = list(body)
        words[rng.randrange(100)] = f"u{i}"
        rows.append((i, " ".join(words)))
    for i in range(1500):
        rows.append((100 + i, " ".join(f"r{rng.randrange(10**6)}" for _ in range(10))))
    got = jaccard_join.near_duplicates(_docs(spark, rows)).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == _brute_components(rows)
    assert left == [0]


def test_batches_are_bounded_by_bytes_and_the_limit_is_put_back(spark, monkeypatch):
    limits = []
    found = jaccard_join.described_sets
    monkeypatch.setattr(jaccard_join, "described_sets", lambda *a: limits.append(spark.conf.get(shared.BATCH_LIMIT)) or found(*a))
    before = spark.conf.get(shared.BATCH_LIMIT)
    jaccard_join.near_duplicates(_docs(spark, [(1, "a b c")])).collect()
    assert limits == [f"{jaccard_join.SENT}b"] and spark.conf.get(shared.BATCH_LIMIT) == before
    rows = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('x', 1000) AS text")
    with shared.batches_of_bytes(spark, 1 << 18):
        sizes = rows.mapInPandas(lambda frames: (pd.DataFrame({"n": [len(f)]}) for f in frames), "n long").collect()
    assert max(r["n"] for r in sizes) < 1000 and sum(r["n"] for r in sizes) == 4000


def test_sketches_bound_the_difference_of_sets():
    rng = np.random.default_rng(5)
    for size, common in [(40, 30), (300, 240), (3000, 2000), (20000, 17000), (300, 0)]:
        both = rng.integers(0, 1 << 63, common, dtype=np.uint64)
        sets = [np.unique(np.concatenate([both, rng.integers(0, 1 << 63, n, dtype=np.uint64)])) for n in (size - common, size)]
        frame = pd.DataFrame({"size": [len(s) for s in sets] + [1], "sketch": [*map(jaccard_join.sketch, sets), None]})
        near = jaccard_join._near(frame, np.array([0, 0]), np.array([1, 2]), 75)
        shared = len(np.intersect1d(*sets))
        assert near[1] and (near[0] or 100 * shared < 75 * (len(sets[0]) + len(sets[1]) - shared))
        assert not near[0] or common


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(60)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100}


def test_shingles_are_exact():
    sets = list(shingle_sets(encoded(["a b c d e f", "A b\nc d e", "a b", ""])))
    assert [len(s) for s in sets] == [2, 1, 1, 0] and sets[1][0] in sets[0]


# Licences


def test_licences(spark):
    notice = dict(licences.LICENCES)["Apache-2.0"]
    full = licences.LICENCES[0][1]
    rows = [
        (1, "Copyright (c) 2020 Someone\n" + full.replace("License", "licence").upper()),
        (2, f"Some text.\n  {licences.LICENCES[4][1].lower()} \nMore."),
        (3, "LICENSED under the apache licence version 2.0"),
        (4, "Not a licence. Released under the MIT License, really."),
        *EDGES,
    ]
    got = {tuple(r) for r in licences.scan_licences(_docs(spark, rows)).collect()}
    assert got == {(1, "text", -1, "MIT"), (2, "line", 1, "Apache-2.0"), (3, "text", -1, "Apache-2.0")}, notice
    assert licences.scan_licences(_docs(spark, [])).collect() == []


def test_licences_as_whole_texts_and_creative_commons(spark):
    def file(name):
        return (resources.files("skyledger.llm") / "licence_texts" / f"{name}.txt").read_text("utf-8")

    apache, gpl = file("Apache-2.0"), file("GPL-3.0")
    bsd = licences._BSD_HEAD + "\n- " + "\n- ".join(licences._BSD_CLAUSES[:2]) + "\n" + licences._BSD_REST.replace("{many}", "COPYRIGHT HOLDERS").replace("{one}", "COPYRIGHT OWNER")
    rows = [
        (1, "Some text.\nLicensed under CC BY-NC 4.0.\nMore."),
        (2, "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License."),
        (3, apache),
        (4, apache.replace("[yyyy] [name of copyright owner]", "2020 Someone").upper()),
        (5, gpl[: gpl.index("How to Apply")]),
        (6, "Copyright (c) 2020, Someone\nAll rights reserved.\n\n" + bsd),
        (7, file("MPL-2.0").replace("\n", "\r\n")),
        (8, file("GPL-2.0") + "\n"),
        (9, gpl[: len(gpl) // 2]),
    ]
    got = {tuple(r) for r in licences.scan_licences(_docs(spark, rows)).collect() if r["scope"] == "text" or r["doc_id"] == 1}
    names = {2: "CC-BY-NC-SA-3.0", 3: "Apache-2.0", 4: "Apache-2.0", 5: "GPL-3.0", 6: "BSD-2-Clause", 7: "MPL-2.0", 8: "GPL-2.0"}
    assert got == {(1, "line", 1, "CC-BY-NC-4.0")} | {(k, "text", -1, name) for k, name in names.items()}


# Context mixing


def test_word_scores_and_mixer(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(120).collect()
    rows = [(r["doc_id"] + 50, r["text"]) for r in docs] + EDGES
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    got = context_mixing.score_texts(_docs(spark, rows), ~queries.in_bucket("doc_id", 5, 1)).collect()
    counts = collections.Counter(w for i, t in rows if not held[i] for w in [*_words(t), None])
    total = sum(counts.values())
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append([*_words(t), None])
    assert len(got) == len(rows)
    for r in got:
        words = min(texts[r["doc_id"]], key=lambda w: abs(len(w) - r["n_tokens"]))
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in words)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(words), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in words) and math.isclose(base, r["base_score"], rel_tol=1e-9)
        assert r["score"] < 0
    long = [r for r in got if r["held_out"] and r["doc_id"] and r["doc_id"] >= 50 and r["n_bytes"] > 300]
    bits = -sum(r["score"] for r in long) * math.log2(10) / sum(r["n_bytes"] for r in long)
    assert bits < 3.2
    assert context_mixing.score_texts(_docs(spark, []), ~queries.in_bucket("doc_id", 5, 1)).collect() == []


def test_contexts_are_counted_one_by_one():
    # More contexts than hashed tables had slots: none shares its counts with another.
    rng = np.random.default_rng(4)
    text = bytes(rng.integers(97, 123, 400_000, dtype=np.uint8))
    keys, times = context_mixing._tallied_keys([text, b"not learnt"], np.array([True, False]))
    contexts = context_mixing.Contexts(keys, times)
    padded = bytes([context_mixing.END]) * context_mixing.LONGEST + text + bytes([context_mixing.END])
    for length, sums in zip(context_mixing.ORDERS, contexts.sums, strict=True):
        seen = collections.Counter(padded[k - length : k] for k in range(context_mixing.LONGEST, len(padded)))
        whole = [int(k).to_bytes(7, "big") for k in keys[::997]]
        assert [seen[k[6 - length : 6]] for k in whole] == sums[0, ::997].astype(int).tolist()
    assert (contexts.sums[-1][8] == times).all() and times.sum() == len(text) + 1
    assert len(keys) * 8 > 1 << 20
    at = np.flatnonzero(contexts.keys & np.uint64(0xFF))[:50]
    for place, counts in enumerate(contexts.counts(at, 0)):
        bit = (keys[at] >> np.uint64(7 - place) & np.uint64(1)).astype(int)
        for sums, n in zip(contexts.sums, counts, strict=True):
            assert (n[np.arange(len(at)), bit] == sums[place + 1, at]).all() and (n.sum(axis=1) == sums[place, at]).all()


def _plain_log10(text, seen, learnt):
    """log10 of the probability of a text: contexts looked up in counters, one bit after the other."""
    padded = bytes([context_mixing.END]) * context_mixing.LONGEST + text + bytes([context_mixing.END])
    total = 0.0
    for at in range(context_mixing.LONGEST, len(padded)):
        for place in range(8):
            node = 1 << place | padded[at] >> (8 - place)
            bit = padded[at] >> (7 - place) & 1
            pairs = [[seen[o, padded[at - o : at], 2 * node + b] for b in (0, 1)] for o in context_mixing.ORDERS]
            gate = sum(sum(p) > 0 for p in pairs)
            x = [math.log((p[1] + context_mixing.PRIOR) / (p[0] + context_mixing.PRIOR)) for p in pairs] + [1.0]
            mixed = sum(w * v for w, v in zip(learnt.weights[place][gate], x, strict=True))
            mixed = min(max(mixed, -context_mixing.SURE), context_mixing.SURE)
            cell = node * context_mixing.CELLS + round((mixed + context_mixing.SURE) * (context_mixing.CELLS - 1) / (2 * context_mixing.SURE))
            p = 1 / (1 + math.exp(-mixed))
            refined = (learnt.ones[cell] + context_mixing.CELL_TRUST * p) / (learnt.total[cell] + context_mixing.CELL_TRUST)
            p = 0.5 * p + 0.5 * refined
            total += math.log10(p if bit else 1 - p)
    return total


def test_scores_equal_a_plain_mixer(spark):
    rng = random.Random(3)
    vocabulary = ["the", "cat", "sat", "on", "mats", "é", "und", "x1"]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12)))) for k in range(60)] + [(70, None), (None, "cat")]
    docs, training = _docs(spark, rows), ~queries.in_bucket("doc_id", 5, 1)
    got = {r["doc_id"]: r["score"] for r in context_mixing.score_texts(docs, training).collect()}
    numbered = context_mixing._numbered(docs, training)
    buckets = context_mixing.BUCKETS * max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    learnt = context_mixing.train_mixer(context_mixing._key_requests(numbered, buckets))
    seen = collections.Counter()
    for doc_id, text in rows:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1:
            continue
        padded = bytes([context_mixing.END]) * context_mixing.LONGEST + (text or "").encode() + bytes([context_mixing.END])
        for at in range(context_mixing.LONGEST, len(padded)):
            for o in context_mixing.ORDERS:
                for place in range(8):
                    node = 1 << place | padded[at] >> (8 - place)
                    seen[o, padded[at - o : at], 2 * node + (padded[at] >> (7 - place) & 1)] += 1
    for doc_id, text in rows:
        assert math.isclose(got[doc_id], _plain_log10((text or "").encode(), seen, learnt), rel_tol=2e-3, abs_tol=1e-3), text


@pytest.mark.parametrize("batch", ["60", "10000"])
def test_blocks_over_the_edges_of_batches(spark, batch):
    rows = [(k, f"text {k % 97} of {k % 7}") for k in range(12000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = context_mixing.score_texts(docs, ~queries.in_bucket("doc_id", 5, 1)).select("doc_id", "n_tokens", "score").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == 12000 and {r["n_tokens"] for r in got} == {5}
    scores = {}
    for r in got:
        scores.setdefault((r["doc_id"] % 97, r["doc_id"] % 7), []).append(r["score"])
    assert all(max(x) - min(x) < 1e-6 for x in scores.values())
    EDGE_SCORES[batch] = sum(x[0] for x in scores.values())
    if len(EDGE_SCORES) == 2:
        assert math.isclose(*EDGE_SCORES.values(), rel_tol=1e-6)


EDGE_SCORES = {}


def test_exact_mixer_is_a_distribution():
    text = b"the cat sat on the mat " * 20
    before = b"cat sa"
    every = int.from_bytes(before + bytes([0]), "big") + np.arange(256, dtype=np.uint64)
    keys, times = context_mixing._tallied_keys([text], np.array([True]))
    joined = np.union1d(keys, every)
    all_times = np.zeros(len(joined), np.int64)
    all_times[np.searchsorted(joined, keys)] = times
    contexts = context_mixing.Contexts(joined, all_times)
    weights, cells = context_mixing.start_weights(), np.zeros((2, 256 * context_mixing.CELLS))
    contexts.learn(weights, cells)
    logs = contexts.log10(context_mixing.Learnt(weights, cells[0], cells[1]))[np.searchsorted(joined, every)]
    assert math.isclose((10**logs).sum(), 1.0, rel_tol=1e-3) and logs.argmax() == ord("t")
    packed = context_mixing.packed_keys(joined)
    assert (context_mixing.unpacked_keys(packed, len(joined)) == joined).all()


def test_weights_do_not_depend_on_the_number_of_buckets(spark, sf_dir):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(120).collect()]
    docs = _docs(spark, list(enumerate(texts)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    bits = []
    for partitions in ("4", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            got = context_mixing.score_texts(docs, ~queries.in_bucket("doc_id", 5, 1)).filter("held_out").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        bits.append(-sum(r["score"] for r in got) * math.log2(10) / sum(r["n_bytes"] for r in got))
    assert math.isclose(*bits, rel_tol=0.02), bits


# Vector search


def test_block_search_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [(k, [float(x) for x in np.round(rng.normal(size=8), 1)]) for k in range(700)]
    vectors += [(700, None), (701, [1.0, None]), (702, [float("nan")] * 8), (703, [float("inf")]), (704, []), (705, [1.0])]
    vectors += [(750, [3e38] * 8), vectors[5], (None, [1.0] * 8)]
    table = spark.createDataFrame([(i, v, 0, 1) for i, v in vectors], "vec_id long, embedding array<float>, rank int, score long")
    table = table.withColumn("embedding", table["embedding"].cast("array<float>"))
    got = sorted(tuple(r) for r in block_search.top_products(table, 50, 5).collect())
    stored = {r["vec_id"]: r["embedding"] for r in table.collect() if r["embedding"] is not None and r["vec_id"] is not None}
    whole = {
        i: [math.floor(256 * x) for x in v] for i, v in stored.items() if all(x is not None and math.isfinite(x) for x in v)
    }
    want, most = [], 2**63 - 1
    for q in (i for i in whole if i % 50 == 0):
        scored = [(-max(min(sum(a * b for a, b in zip(whole[q], v)), most), -most - 1), i) for i, v in whole.items() if i != q]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:5])]
    assert got == sorted(want)
    assert block_search.top_products(table.limit(0), 50, 5).collect() == []


# WARC


def test_archives_edge_rows(spark):
    pages = [(1, "u", "a"), (2, "u\nv", "a"), (3, None, None), (4, "x", ""), (4, "x", ""), (None, "y", "a"), (None, "z", "q"), (5, "w", "é" * 70000)]
    table = spark.createDataFrame([(*p, 1, "t") for p in pages], "page_id long, url string, html string, length int, file string")
    got = warc.archive_round_trip(table)
    rows = sorted(repr((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"])) for r in got.collect())
    want = [(1, "revisit", 2, 1), (2, "response", None, 1), (3, "revisit", 4, 0), (4, "response", None, 0), (4, "response", None, 0)]
    want += [(None, "revisit", 2, 1), (None, "response", None, 1), (5, "response", None, 140000)]
    assert rows == sorted(map(repr, want))
    assert warc.archive_round_trip(table.limit(0)).collect() == []


def test_selected_records_by_ranges(spark, tmp_path, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    index = warc.write_archives(pages, str(tmp_path))
    some = index.filter("page_id % 7 = 3")
    assert warc.byte_ranges(some).count() <= some.count()
    text = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    for r in warc.read_records(some, str(tmp_path)).collect():
        assert bytes(r["payload"]) == (text[r["page_id"]] if r["record_type"] == "response" else b"")


# Test items


def test_items_in_texts(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(rng.choice([13, 30, 80])))) for k in range(40)] + [(90, None), (91, ""), (92, "q")]
    filler = lambda n: " ".join(word() for _ in range(n))
    rows = [(k, f"{filler(rng.randint(0, 150))} {items[k][1].upper().replace(' ', ', ')} {filler(20)}") for k in range(40)]
    rows += [(100 + k, filler(300)) for k in range(20)] + [(200, " ".join(items[3][1].split()[:4]) + filler(50)), *EDGES[:4]]
    benchmark = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id long")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_items(_docs(spark, rows), benchmark).collect()}
    assert {(d, i) for d, i in found if d >= 40 or d not in (1, 2, 3, 4)} == {(k, k) for k in range(40) if k not in (1, 2, 3, 4)}
    assert {(k, k) for k in (1, 2, 3, 4)} <= found
    assert decontamination.find_items(_docs(spark, rows), benchmark.limit(0)).collect() == []
    assert decontamination.find_items(_docs(spark, []), benchmark).collect() == []


def test_wand_finds_what_scoring_all_finds():
    rng = random.Random(6)
    words = [f"t{k}" for k in range(60)]
    (index,) = decontamination.build_indexes([(k, " ".join(rng.choice(words) for _ in range(12))) for k in range(50)])
    for _ in range(60):
        terms = np.unique(np.array([rng.randrange(len(index.terms)) for _ in range(30)]))
        scores = collections.Counter()
        for t in terms.tolist():
            for p in range(int(index.first[t]), int(index.first[t + 1])):
                scores[int(index.parts[p])] += float(index.weights[p])
        want = {p for p, s in scores.items() if s >= 0.6}
        assert {p for p, _ in decontamination.block_max_wand(index, terms, 0.6)} == want


# Personal data


def _luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return sum(v if k % 2 == 0 else v * 2 - 9 * (v > 4) for k, v in enumerate(values)) % 10 == 0


def _brute_spans(text):
    found = []
    patterns = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]
    for kind, pattern in patterns:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")))
            good = good or (kind == "card" and 16 <= len(digits) <= 19 and _luhn(digits))
            if good or (kind == "phone" and 8 <= len(digits) <= 15):
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(found)


def test_base_spans_match_brute_force(spark):
    rng = random.Random(7)
    parts = ["1", "255", "256", "007", ".", "-", " ", "+", "@", "a", "b.c", "4539578763621486", "(", ")", "é", "🙂", "a@b.c", "1.2.3.4", "+1 (017) 555-7713", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(2500)]
    texts += [None, "", "1" * 9000, "a" * 9000 + "@", "a." * 4000 + "@b" + ".c" * 4000, "1.2.3.4 " * 700]
    got = pii.base_report(_docs(spark, list(enumerate(texts)))).collect()
    assert len(got) == len(texts)
    for r in got:
        want = _brute_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert r["spans"].startswith(want)
        kinds = collections.Counter(s.split(":")[0] for s in want.split(",") if s)
        assert [r[f"n_{k}"] for k in pii.BASE] == [kinds[k] for k in pii.BASE]


def test_added_kinds_and_redaction(spark):
    rows = [
        (1, "My IBAN DE89 3704 0044 0532 0130 00 is here"),
        (2, "My IBAN DE88 3704 0044 0532 0130 00 is wrong"),
        (3, "ssn 123-45-6789 and then a number far away from any such word, in any case: 123-45-6789"),
        (4, "write a@b.co or +1 (017) 555-7713."),
        (5, None),
    ]
    docs = _docs(spark, rows)
    spans = {r["doc_id"]: [s["kind"] for s in r["pii_spans"]] for r in pii.find_spans(docs).collect()}
    assert spans == {1: ["iban"], 2: [], 3: ["ssn"], 4: ["email", "phone"], 5: []}
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[1] == "My IBAN [iban] is here" and texts[2] == rows[1][1] and texts[5] is None
    assert texts[4] == "write [email] or [phone]."


def test_pii_plan_has_no_python(spark, sf_dir):
    plan = queries.QUERIES["op9_personal_data"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Quality


def test_quality_on_held_out_rows(spark, sf_dir):
    larger = sf_dir.replace("sf0.001", "sf0.1")
    larger = larger if os.path.exists(larger) else sf_dir
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    got = [r for r in queries.QUERIES["op10_quality"](spark, larger).collect() if r["held_out"] and r["doc_id"] in labels]
    right = np.mean([r["predicted"] == labels[r["doc_id"]] for r in got])
    kept = np.mean([r["predicted"] for r in got if labels[r["doc_id"]] == 1])
    assert right > 0.9 and kept > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_repeated_rows_of_an_id_are_learnt_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labelled = labels.filter("quality IN (0, 1)").select("doc_id").join(docs, "doc_id").orderBy("doc_id").limit(1)
    repeated = docs.union(labelled.join(spark.range(100).select(), F.lit(True)))
    one, many = (nbsvm.train(d, labels, F.lit(True)) for d in (docs, repeated))
    assert one.weights.any() and (one.weights == many.weights).all() and one.bias == many.bias


def test_quality_without_labels_and_edges(spark):
    docs = _docs(spark, EDGES)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int, label int")
    usable = ~queries.in_bucket("doc_id", 4, 2)
    scored = nbsvm.with_quality(docs, nbsvm.train(docs, none, usable), "score")
    assert [r["score"] for r in scored.collect()] == [0.5] * len(EDGES)
    labels = spark.createDataFrame([(1, 1, 0, 0), (2, 0, 0, 0), (4, 1, 0, 0), (None, 1, 0, 0), (5, 7, 0, 0)], none.schema)
    scored = nbsvm.with_quality(docs, nbsvm.train(docs, labels, usable), "score").collect()
    assert len(scored) == len(EDGES) and all(0 <= r["score"] <= 1 for r in scored)
    assert nbsvm.with_quality(docs.limit(0), nbsvm.train(docs.limit(0), labels, usable)).collect() == []


def test_descent_separates():
    rng = np.random.default_rng(0)
    texts = [b"good words in a row %d" % k if k % 2 else b"### $$$ %%% " * 3 + b"%d" % k for k in rng.permutation(200)]
    labels = np.array([int(t.startswith(b"good")) for t in texts])
    weights, bias, slope, shift = nbsvm.fit(texts, labels, np.array([0.5, 0.5]))
    model, seen = nbsvm.Model(weights[0], weights[1], bias, slope, shift), np.zeros(nbsvm.SLOTS, bool)
    assert nbsvm.probability(model, b"good words", seen) > 0.9 > 0.1 > nbsvm.probability(model, b"### %%%", seen)


# Pipeline


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.keep_quality(spark, docs, sf_dir)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    one = {r["doc_id"] for r in corpus_pipeline.keep_one_of_near_duplicates(spark, docs, sf_dir).collect()}
    assert one == {i for i, _, c in _brute_components(rows) if i == c}
    items = {r["text"].lower() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    left = corpus_pipeline.drop_test_items(spark, docs, sf_dir)
    holding = {i for i, t in rows if any(x in t.lower() for x in items)}
    assert {i for i, _ in rows} - {r["doc_id"] for r in left.collect()} == holding
    clean = corpus_pipeline.redact_personal_data(spark, docs, sf_dir)
    assert clean.columns == docs.columns
    assert all(not _brute_spans(r["text"]) for r in clean.collect())
    edges = _docs(spark, EDGES)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edges, sf_dir).columns == edges.columns
        assert stage(spark, edges.limit(0), sf_dir).collect() == []
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert pieces.select("doc_id").distinct().count() > 0
