"""Rows without id and rows that share an id in the pipeline's stages."""

import collections

import pytest

import corpus_pipeline
from skyledger.llm import decontamination
from skyledger.llm.shared import with_row_keys
from skyledger.llm.shipping import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __key string, rows int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, "x", 3) for i, t in rows], SCHEMA)


SAME = "one two three four five six seven eight nine ten"
OTHER = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
ALONE = "red orange yellow green blue indigo violet black white grey"


def test_near_duplicates_keep_one_row_of_each_group(spark, sf_dir):
    rows = [(1, SAME), (None, SAME), (None, SAME), (2, SAME), (3, ALONE), (3, OTHER), (7, OTHER), (None, "lonely words " + ALONE[:9]), (None, ""), (8, None), (9, ALONE.upper())]
    docs = _docs(spark, rows).drop("__key")
    got = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, sf_dir)
    kept = collections.Counter((r["doc_id"], r["text"]) for r in got.collect())
    assert kept == collections.Counter([(1, SAME), (3, ALONE), (3, OTHER), (None, "lonely words " + ALONE[:9]), (None, ""), (8, None)])


def test_equal_rows_are_one_and_a_group_without_ids_keeps_one(spark, sf_dir):
    docs = _docs(spark, [(5, SAME), (5, SAME), (None, OTHER), (None, OTHER), (None, OTHER + " ")]).drop("__key")
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, sf_dir).collect()
    assert len(kept) == 2 and {r["doc_id"] for r in kept} == {5, None}
    assert corpus_pipeline.keep_one_of_near_duplicates(spark, docs.limit(0), sf_dir).collect() == []


def test_items_are_dropped_by_row(spark):
    question = "which river flows through the old town of brimstone and past the seven mills before the sea"
    answer = "the river is called the amber and it passes all seven mills on its western bank every spring"
    items = spark.createDataFrame([(0, f"{question} {answer}")], "item_id long, text string")
    found = f"Some words before. {question} {answer} Some words after."
    clean = "Nothing to see here but a few plain words about the weather in autumn and the price of wool."
    docs = _docs(spark, [(1, found), (2, clean), (3, found), (3, clean), (None, found), (None, clean), (2, clean), (4, None)]).drop("__key")
    left = decontamination.without_items(docs, items)
    assert left.columns == docs.columns
    kept = collections.Counter((r["doc_id"], r["text"]) for r in left.collect())
    assert kept == collections.Counter({(2, clean): 2, (3, clean): 1, (None, clean): 1, (4, None): 1})


def test_row_keys_are_ids_where_those_are_unique(spark):
    docs = _docs(spark, [(1, "a"), (2, "b"), (2, "c"), (2, "c"), (None, "b"), (3, None)])
    keys = [(r["doc_id"], r["text"], r["key"]) for r in with_row_keys(docs, "key").collect()]
    assert {k for i, t, k in keys if i in (1, 3)} == {1, 3}
    assert len({k for i, t, k in keys}) == 5 and all(k >= 1 << 62 for i, t, k in keys if i in (2, None))
