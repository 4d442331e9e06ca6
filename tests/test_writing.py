"""Versioned tables, checks made while writing, and rejects."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.operators.rejects import cast_with_rejects
from skyledger.sources import (
    MALFORMED,
    CheckFailed,
    remove_old_versions,
    replace_table,
    scan_delimited_checked,
    scan_json_checked,
    scan_version,
    table_log,
    write_checked,
)


def jobs_of(spark, action):
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_a_write_that_dies_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(10), path)
    before = scan_version(spark, path)
    dies = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        replace_table(dies, path)
    assert scan_version(spark, path).count() == 10 == before.count()
    assert [r["version"] for r in table_log(spark, path).collect()] == [1]
    replace_table(scan_version(spark, path).filter("id < 3"), path)
    assert scan_version(spark, path).count() == 3
    # A plan made before goes on reading the version it was made from.
    assert before.count() == 10 == scan_version(spark, path, version=1).count()


def test_a_version_that_breaks_a_rule_is_not_published(spark, tmp_path):
    path = str(tmp_path / "t")
    rules = {"small": F.col("id") < 5}
    counts = replace_table(spark.range(5), path, rules=rules)
    assert {r["check_name"]: r["row_count"] for r in counts.collect()} == {"rows": 5, "small": 0}
    with pytest.raises(CheckFailed, match="small"):
        replace_table(spark.range(8), path, rules=rules)
    assert scan_version(spark, path).count() == 5
    replace_table(spark.range(8), path, rules=rules, allowed={"small": 3})
    assert scan_version(spark, path).count() == 8


def test_schema_changes_with_the_version_and_partitions_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(4), path)
    wide = spark.range(4).select("id", (F.col("id") % 2).cast("string").alias("part"), F.lit(1.5).alias("x"))
    replace_table(wide, path, partition_by=["part"])
    newest = scan_version(spark, path)
    assert newest.columns == ["id", "part", "x"] and dict(newest.dtypes)["part"] == "string"
    assert scan_version(spark, path, version=1).columns == ["id"]
    assert newest.filter("part = '1'").count() == 2


def test_old_versions_are_removed_and_missing_ones_named(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no version"):
        scan_version(spark, path)
    assert table_log(spark, path).count() == 0
    for k in range(1, 5):
        replace_table(spark.range(k), path)
    remove_old_versions(spark, path, keep=2)
    remove_old_versions(spark, path, keep=2)
    assert len(os.listdir(tmp_path / "t" / "data")) == 2
    assert scan_version(spark, path).count() == 4 and scan_version(spark, path, version=3).count() == 3
    with pytest.raises(ValueError, match="no version 9"):
        scan_version(spark, path, version=9)
    with pytest.raises(ValueError, match="newest"):
        remove_old_versions(spark, path, keep=0)


def test_empty_table_is_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(0), path, rules={"any": F.col("id") > 0})
    assert scan_version(spark, path).count() == 0


def test_checks_are_made_by_the_write_job(spark, tmp_path):
    rows = spark.range(100).withColumn("x", F.when(F.col("id") % 4 > 0, F.col("id")))
    counts = []

    def write():
        counts.append(write_checked(rows, str(tmp_path / "t"), {"x small": F.col("x") < 50, "a`b": F.col("id") >= 0}, ["x"]))

    assert jobs_of(spark, write) == 1
    found = {r["check_name"]: r["row_count"] for r in counts[0].collect()}
    assert found == {"rows": 100, "x small": 38, "a`b": 0, "x is null": 25}
    with pytest.raises(ValueError, match="one name"):
        write_checked(rows, str(tmp_path / "t"), {"x is null": F.col("id") > 0}, ["x"])


def test_rejects_have_reasons_and_nothing_is_lost(spark):
    rows = [
        ("1", "10", "2024-01-05", "A"),
        ("2", "ten", "2024-13-01", "B"),
        ("3", None, " ", "A"),
        (None, "4.0", "2024-02-30", None),
        ("5", "", "x", "C"),
        ("5", "", "x", "C"),
    ]
    raw = spark.createDataFrame(rows, "key string, n string, day string, code string")
    typed = cast_with_rejects(raw, {"n": "int", "day": "date"}, ["key"], required=["key", "n"], domains={"code": ["A", "B"]})
    rejects = sorted((tuple(r) for r in typed.rejects.collect()), key=repr)
    assert rejects == sorted(
        [
            ("2", "n", "ten", "not a int"),
            ("2", "day", "2024-13-01", "not a date"),
            ("3", "n", None, "missing"),
            (None, "day", "2024-02-30", "not a date"),
            (None, "key", None, "missing"),
            *[("5", "n", "", "missing"), ("5", "day", "x", "not a date"), ("5", "code", "C", "not in domain")] * 2,
        ],
        key=repr,
    )
    assert tuple(typed.balance.first()) == (6, 1, 5, 11)
    assert typed.kept.count() + typed.rejected.count() == 6 == typed.nulled.count()
    assert [tuple(r) for r in typed.kept.collect()] == [("1", 10, date(2024, 1, 5), "A")]
    assert {(r["column_name"], r["reason"]): r["reject_count"] for r in typed.summary.collect()}["day", "not a date"] == 4


def test_rows_without_checks_and_empty_tables(spark):
    raw = spark.createDataFrame([("a", 1)], "x string, y int")
    plain = cast_with_rejects(raw, {}, ["x"])
    assert plain.rejects.count() == 0 and plain.kept.collect() == raw.collect()
    empty = cast_with_rejects(raw.limit(0), {"x": "int"}, ["x"])
    assert tuple(empty.balance.first()) == (0, 0, 0, 0)


def test_malformed_records_are_rejects(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.txt").write_text("1|a\n2\n3|c|extra\n4|d\n")
    raw = scan_delimited_checked(spark, str(tmp_path / "d"), ["k", "v"], sep="|")
    assert MALFORMED in raw.columns
    typed = cast_with_rejects(raw, {"k": "int"}, ["k"])
    assert sorted(r["raw_value"] for r in typed.rejects.collect()) == ["2", "3|c|extra"]
    assert {r["reason"] for r in typed.rejects.collect()} == {"malformed record"}
    assert sorted(tuple(r) for r in typed.kept.collect()) == [(1, "a"), (4, "d")] == sorted(tuple(r) for r in typed.nulled.collect())
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "x.json").write_text('{"k": "1"}\n{"k": \n{"k": "x"}\n')
    typed = cast_with_rejects(scan_json_checked(spark, str(tmp_path / "j"), "k string"), {"k": "int"}, ["k"])
    assert sorted((r["raw_value"], r["reason"]) for r in typed.rejects.collect()) == [("x", "not a int"), ('{"k": ', "malformed record")]


def test_the_source_is_scanned_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(20).select(F.col("id").cast("string").alias("k")).write.parquet(path)
    typed = cast_with_rejects(spark.read.parquet(path), {"k": "int"}, ["k"])
    for frame in (typed.kept, typed.rejects, typed.balance, typed.rejected):
        assert path not in frame._jdf.queryExecution().toString()
