"""Intermediate tables are owned and removed."""

import os

import pytest
from pyspark.sql import functions as F

from skyledger.folders import folder_exists, remove_folder
from skyledger.operators.clean import impute_neighbour_mean
from skyledger.operators.dimensions import surrogate_key
from skyledger.session import application_dir, intermediates, materialize, remove_intermediates, scratch_path


def left(spark):
    top = application_dir(spark).removeprefix("file:")
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_a_block_leaves_no_table(spark, tmp_path):
    before = left(spark)
    with intermediates(spark):
        rows = spark.range(50).withColumn("x", F.when(F.col("id") % 3 > 0, F.col("id").cast("double")))
        keyed = surrogate_key(impute_neighbour_mean(rows, ["id"], "x"), ["id"], "k", "key")
        assert left(spark) > before
        keyed.write.parquet(str(tmp_path / "out"))
    assert left(spark) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_a_block_that_fails_leaves_no_table(spark):
    before = left(spark)
    with pytest.raises(RuntimeError, match="stop"):
        with intermediates(spark):
            materialize(spark.range(3))
            raise RuntimeError("stop")
    assert left(spark) == before


def test_kept_tables_go_to_the_block_around(spark):
    before = left(spark)
    with intermediates(spark):
        with intermediates(spark) as inner:
            first, second = materialize(spark.range(3), "first"), materialize(spark.range(4), "second")
            inner.keep(first.filter("id > 0"))
        assert first.count() == 3
        assert not folder_exists(second.inputFiles()[0]) and len(left(spark) - before) == 1
    assert left(spark) == before
    with intermediates(spark) as scope:
        third = scope.keep(materialize(spark.range(5), "third"))
    assert third.count() == 5 and len(left(spark) - before) == 1
    for name in left(spark) - before:
        remove_folder(f"{application_dir(spark)}/{name}")


def test_tables_of_an_application_are_removed_by_its_id(spark, tmp_path):
    assert scratch_path(spark, "x").startswith(application_dir(spark))
    gone = application_dir(spark, "application-of-yesterday")
    spark.range(2).write.parquet(f"{gone}/table")
    assert folder_exists(gone)
    remove_intermediates(spark, "application-of-yesterday")
    remove_intermediates(spark, "application-of-yesterday")
    assert not folder_exists(gone)
