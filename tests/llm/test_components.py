"""Components of links: against brute force, and how many tables they take."""

import random

import numpy as np
import pytest

from skyledger.llm import components as C
from skyledger.llm import jaccard_join
from skyledger.llm.shared import WHOLE_STAGE


def brute(links):
    top = {n: n for link in links for n in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(top[a], top[b])
            changed |= top[a] != low or top[b] != low
            top[a] = top[b] = low
    return top


def some_links(seed):
    rng = random.Random(seed)
    path = [(k, k + 1) for k in range(100, 160)] + [(7, 900 - k) for k in range(40)]
    return path + [tuple(rng.sample(range(300, 420), 2)) for _ in range(70)]


@pytest.mark.parametrize("seed", range(3))
def test_the_links_of_a_chunk_are_contracted(seed):
    links = some_links(seed)
    nodes, top = C.smallest_reachable(*np.array(links).T)
    assert dict(zip(nodes.tolist(), top.tolist(), strict=True)) == brute(links)


@pytest.mark.parametrize("chunk", [1 << 20, 1])
def test_components_of_one_chunk_and_of_many(spark, monkeypatch, chunk):
    monkeypatch.setattr(C, "CHUNK", chunk)
    links = some_links(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        found = C.components(spark.createDataFrame(links, "a long, b long")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["component"] for r in found} == brute(links)


def test_a_table_that_fits_a_task_takes_one_round(spark, monkeypatch):
    written, write = [], C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, name: written.append(name) or write(df, name))
    found = C.components(spark.createDataFrame(some_links(1), "a long, b long"))
    assert len(written) <= 2 and found.filter("component = 100").count() == 61


def test_no_links_have_no_components(spark):
    assert C.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_stages_are_compiled_again_after_the_join(spark, monkeypatch):
    before, seen, first = spark.conf.get(WHOLE_STAGE), [], jaccard_join.hot_shingles
    monkeypatch.setattr(jaccard_join, "hot_shingles", lambda *a: seen.append(spark.conf.get(WHOLE_STAGE)) or first(*a))
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    jaccard_join.near_duplicates(docs)
    assert seen == ["false"] and spark.conf.get(WHOLE_STAGE) == before
