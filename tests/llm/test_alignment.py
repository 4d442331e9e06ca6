"""Tokens of two vocabularies aligned, against a brute-force version."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from skyledger.llm import alignment, queries
from skyledger.llm.shipping import ship_package
from skyledger.llm.tokens import BYTE_LETTERS

COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups".split()
A_PATH, B_PATH = queries.BYTE_VOCABULARY, queries.PIECE_MODEL


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def _docs(spark, rows):
    schema = "doc_id long, text string, lang string, n_a long, shard int, block string, groups string, no_id int"
    return spark.createDataFrame([(i, t, "en", None, None, None, None, None) for i, t in rows], schema)


def _brute(rows):
    first = Tokenizer.from_file(A_PATH)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = {v: k for k, v in BYTE_LETTERS.items()}
    aligned = []
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        a_bytes = [bytes(letters[c] for c in first.id_to_token(x)) for x in a]
        b_bytes = [
            bytes([int(second.id_to_piece(x)[3:5], 16)]) if second.is_byte(x) else second.id_to_piece(x).replace("▁", " ").encode() for x in b
        ]
        groups = []
        if text and b"".join(a_bytes) == whole == b"".join(b_bytes):
            i = j = 0
            while i < len(a):
                ga, gb, la, lb = [], [], 0, 0
                while not ga or la != lb:
                    if la <= lb:
                        ga.append(a[i])
                        la += len(a_bytes[i])
                        i += 1
                    else:
                        gb.append(b[j])
                        lb += len(b_bytes[j])
                        j += 1
                groups.append((ga, gb))
        aligned.append((doc_id, groups))
    counts = collections.Counter()
    for _, groups in aligned:
        counts.update({(x, y) for ga, gb in groups for x in ga for y in gb})
    highest = collections.Counter()
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, groups in aligned:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        text = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        best = sum(counts[p] == highest[p[0]] for p in links)
        n_a, n_b = sum(len(ga) for ga, _ in groups), sum(len(gb) for _, gb in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), text))
    return sorted(out, key=repr)


def _rows(spark, sf_dir):
    rng = random.Random(4)
    signs = ["a", "B", " ", "   ", "\n", "\t", "é", "'s", "!", "12", "中文", "🙂", "<|endoftext|>", "<s>", "</s>", "▁", "\x00", "ﬁ", "é", "\xa0"]
    rows = [(k, "".join(rng.choice(signs) for _ in range(rng.randint(0, 25)))) for k in range(150)]
    rows += [(1000 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    rows += [(2000, None), (2001, ""), (2002, " "), (2003, " " * 700), (2004, "x" * 9000), (2004, "x" * 9000), (None, "no id"), (2005, "▁")]
    rows += [(3000 + k, "the same text of many") for k in range(40)]
    return rows


@pytest.mark.parametrize("block_bytes", [1 << 22, 300])
def test_alignment_equals_brute_force(spark, sf_dir, monkeypatch, block_bytes):
    monkeypatch.setattr(alignment, "FAN_IN", 3)
    rows = _rows(spark, sf_dir)
    got = alignment.align_documents(_docs(spark, rows).repartition(6), A_PATH, B_PATH, block_bytes)
    assert sorted([tuple(r[c] for c in COLUMNS) for r in got.collect()], key=repr) == _brute(rows)


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    sizes = alignment.token_bytes(A_PATH, B_PATH)
    both = list(sizes.encode(["a  b" + " " * 300 + "c", "x" * 500]))
    n_a, n_b = (np.array([len(x[k]) for x in both]) for k in (0, 1))
    a, b = (np.concatenate([x[k] for x in both]) for k in (0, 1))
    seen = []
    for most in (1 << 12, 1):
        monkeypatch.setattr(alignment, "MOST_OPEN", most)
        doc, pair, times = alignment.Alignment(a, b, n_a, n_b, sizes).links(len(sizes.b))
        total = collections.Counter()
        for d, p, n in zip(doc.tolist(), pair.tolist(), times.tolist(), strict=True):
            total[d, p] += n
        seen.append(total)
    assert seen[0] == seen[1]


def test_empty_table_and_query(spark, sf_dir):
    assert alignment.align_documents(_docs(spark, []), A_PATH, B_PATH).collect() == []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = queries.QUERIES["op11_token_alignment"](spark, sf_dir).collect()
    want = {r[0]: r for r in _brute([(r["doc_id"], r["text"]) for r in docs.collect()])}
    assert len(got) == len(want)
    for r in got:
        w = want[r["doc_id"]]
        assert tuple(r[c] for c in COLUMNS[:-1]) == w[:-1]
        assert r["groups_sha256"] == (hashlib.sha256(w[-1].encode()).hexdigest() if w[1] else "")


def test_vocabularies_are_where_the_query_looks():
    assert public_tokenizers.path("piece_bpe_32k.model") == B_PATH


def test_pieces_of_the_last_batches_outlive_a_full_table(monkeypatch):
    monkeypatch.setattr(alignment, "MOST_KEPT", 30)
    tables, fresh = alignment.TokenBytes(A_PATH, B_PATH), alignment.TokenBytes(A_PATH, B_PATH)
    learnt = collections.Counter()
    learn = tables._learn
    monkeypatch.setattr(tables, "_learn", lambda pieces: (learnt.update(pieces), learn(pieces)))
    for k in range(12):
        texts = [f"the same words and also {'x' * 300} number{k} number{k}th, bit{k}", "", "ends in  ", "a\tb"]
        monkeypatch.setattr(fresh, "of_a", {})
        monkeypatch.setattr(fresh, "of_b", {})
        fresh.last.clear()
        for got, want in zip(tables.encode(texts), fresh.encode(texts), strict=True):
            assert all((x == y).all() and len(x) == len(y) for x, y in zip(got, want, strict=True))
        assert not any(len(p) > 64 for p in tables.of_b)
    # The table was full and started anew, without forgetting what every batch has.
    assert len(tables.of_b) < sum(1 for p in learnt if len(p) <= 64)
    assert learnt[" same"] == learnt[" words"] == 1 and tables.of_a.keys() == tables.of_b.keys()
