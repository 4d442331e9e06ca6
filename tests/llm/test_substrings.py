"""Repeated passages against a brute-force version."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import substrings
from skyledger.llm.shipping import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def _docs(spark, rows):
    schema = "doc_id long, text string, lang string, kept string, n_words long, block long, no_id string, __hash int"
    return spark.createDataFrame([(i, t, "en", None, None, None, None, None) for i, t in rows], schema)


def _brute(rows, window):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            run = tuple(words[i : i + window])
            if run in seen:
                gone.update(range(i, i + window))
            seen.add(run)
        out.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def _corpus(seed, copies):
    rng = random.Random(seed)
    vocabulary = [f"W{k}é" if k % 7 == 0 else f"w{k}" for k in range(300)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(15, 60))] for _ in range(12)]
    rows = []
    for doc in range(80):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice(passages) if rng.random() < 0.4 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 40))]
        rows.append((doc, rng.choice([" ", "\n", " \t "]).join(words)))
    same = " ".join(rng.choice(vocabulary) for _ in range(90))
    rows += [(1000 + k, same) for k in range(copies)] + [(2000, "a " * 700), (2001, " ".join(["x y"] * 300))]
    rows += [(3000, None), (3001, ""), (3002, " \n\t"), (3003, "one"), (3004, " ".join(vocabulary[:19])), (3005, " ".join(vocabulary[:20]))]
    rows += [(None, same), (3006, "z" * 50000 + " " + same), (3007, same.upper()), (3008, same.replace(" ", " "))]
    return rows


@pytest.mark.parametrize(("seed", "window", "block_bytes"), [(1, 20, 1 << 25), (2, 20, 3000), (3, 13, 2000), (4, 27, 1)])
def test_removed_passages_equal_brute_force(spark, seed, window, block_bytes):
    rows = _corpus(seed, copies=60)
    got = substrings.remove_repeats(_docs(spark, rows).repartition(7), window, block_bytes).collect()
    assert sorted([tuple(r) for r in got], key=repr) == _brute(rows, window)


def test_rows_that_share_an_id_and_equal_rows(spark):
    text = " ".join(f"w{k}" for k in range(40))
    got = substrings.remove_repeats(_docs(spark, [(1, text), (1, text), (1, text + " end"), (0, "a b")]), 20, 1).collect()
    assert sorted(r["n_removed"] for r in got) == [0, 0, 40, 40]
    assert len(got) == 4


def test_empty_table_and_short_window(spark):
    assert substrings.remove_repeats(_docs(spark, [])).collect() == []
    with pytest.raises(ValueError, match="at least"):
        substrings.remove_repeats(_docs(spark, []), 12)


def test_cover_is_a_difference_cover():
    cover = set(substrings.COVER)
    for i in range(substrings.PERIOD):
        for j in range(substrings.PERIOD):
            assert any((i + k) % substrings.PERIOD in cover and (j + k) % substrings.PERIOD in cover for k in range(substrings.PERIOD))


def test_anchors_are_on_a_third_of_the_positions():
    text = " ".join(f"w{k}" for k in range(5000)).encode()
    block = substrings.Block([text], 20)
    assert 0.29 < len(block.anchors) / 5000 < 0.32
    keys, _, counts = block.anchor_keys(6)
    assert (counts == 1).all()
    assert len(block.candidates(np.zeros(len(block.anchors), dtype=bool))) == 0


def test_query_keeps_every_document_once(spark, sf_dir):
    from skyledger.llm.queries import QUERIES

    found = QUERIES["op13_repeated_passages"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found.count() == docs.count() == found.select("doc_id").distinct().count()
    assert found.filter(F.col("n_removed") > 0).count() > 0
