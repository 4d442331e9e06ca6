"""Packed keys come back as they were, and the join keeps ids that a float cannot hold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm.hot_shingles import packed, unpacked
from skyledger.llm.jaccard_join import POSTINGS, _across, from_upper_bytes, near_duplicates, sketch, sketched, upper_bytes


@pytest.mark.parametrize("keys", [[], [0], [2**32 - 1], [0, 0, 5, 2**16, 2**16, 2**31, 2**32 - 1]])
def test_packed_keys_come_back(keys):
    keys = np.array(keys, dtype=np.uint32)
    assert unpacked(packed(keys), len(keys)).tolist() == keys.tolist()


def test_many_packed_keys_come_back():
    keys = np.sort(np.random.default_rng(3).integers(0, 2**32, 10_000, dtype=np.uint32))
    assert unpacked(packed(keys), len(keys)).tolist() == keys.tolist()


def test_ids_above_the_whole_floats_are_linked(spark):
    first = 2**60 + 1
    words = " ".join(f"w{k}" for k in range(40))
    rows = [(first + k, f"{words} tail{k}") for k in range(6)] + [(first + 100 + k, f"own{k} text") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, F.col("doc_id"))
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert found == {i: first if i < first + 100 else i for i, _ in rows}


def test_group_sketch_with_slack_bounds_every_class(spark):
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(1, 2**63, 400, dtype=np.uint64))
    members = [np.unique(np.concatenate([base[: 400 - 7 * k], base[:1] + np.arange(7 * k, dtype=np.uint64)])) for k in range(4)]
    rows = [(k, 400, bytearray(sketch(m))) for k, m in enumerate(members)] + [(9, 400, None)]
    sets = spark.createDataFrame(rows, "doc_id long, n_shingles int, sketch binary")
    classes = spark.createDataFrame([(k, 0) for k in range(4)] + [(9, 9)], "rep long, gid long")
    postings = spark.createDataFrame([(0, 0, 0, 400, 0), (9, 9, 9, 400, 0)], POSTINGS)
    found = {r["gid"]: r for r in sketched(postings, sets, classes).collect()}
    assert found[9]["sketch"] is None
    bits = np.frombuffer(found[0]["sketch"], dtype=np.uint64)
    for member in members:
        own = np.frombuffer(sketch(member), dtype=np.uint64)
        assert np.bitwise_count(bits ^ own).sum() <= found[0]["slack"]


def test_upper_bytes_of_hashes_come_back():
    hashes = np.array([0, 2**16 - 1, 2**63 + 12345678901, 2**64 - 1], dtype=np.uint64)
    kept = from_upper_bytes(upper_bytes(hashes))
    assert kept.tolist() == [int(h) >> 16 << 16 for h in hashes]


def test_partners_are_of_the_same_list_and_of_other_components():
    names = np.array([1, 1, 1, 1, 1, 2, 2, 2, 3])
    component = np.array([1, 1, 5, 6, 6, 1, 1, 1, 9])
    partners = _across(names, component)
    assert (names[partners] == names).all()
    assert (component[partners[:5]] != component[:5]).all()
    assert sorted(partners.tolist()) == list(range(9))
