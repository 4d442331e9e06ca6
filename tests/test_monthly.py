"""Tables by month: refresh where the source changed, pruning, and what a reader sees."""

import os
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from skyledger.plans.context import Filter, Model, Relationship, filter_date_between
from skyledger.plans.measures import Aggregate, evaluate
from skyledger.sources import month_log, month_of, month_of_day, refresh_months, scan_months

SCHEMA = "day date, amount double, tag string"
MONTHS = [date(2024, m, d) for m in range(1, 13) for d in (1, 15, 28)]


def _source(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _build(rows):
    key = F.year("day") * 10000 + F.month("day") * 100 + F.dayofmonth("day")
    return rows.select(key.alias("date_key"), "amount", "tag")


def _refresh(spark, rows, path, **more):
    changed = refresh_months(_source(spark, rows), path, month_of_day(F.col("day")), _build, **more)
    return {r["month_key"]: r["row_count"] for r in changed.collect()}


def _files(path):
    return {os.path.join(d, x): os.stat(os.path.join(d, x)).st_mtime_ns for d, _, names in os.walk(path) for x in names if x.endswith(".parquet")}


def _rows(spark, path):
    return sorted((tuple(r) for r in scan_months(spark, path).select("date_key", "amount", "tag").collect()), key=repr)


@pytest.fixture
def rows():
    return [(d, float(i), "a") for i, d in enumerate(MONTHS)] + [(None, 5.0, "undated"), (None, 5.0, "undated")]


def test_only_changed_months_are_rebuilt(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert _refresh(spark, rows, path) == {0: 2} | {202400 + m: 3 for m in range(1, 13)}
    before = _files(path)
    assert _refresh(spark, list(reversed(rows)), path) == {} and _files(path) == before
    rows[4] = (rows[4][0], 99.0, "a")
    rows.append((date(2025, 1, 3), 1.0, None))
    rows.remove((None, 5.0, "undated"))
    assert _refresh(spark, rows, path) == {0: 1, 202402: 3, 202501: 1}
    after = _files(path)
    assert all(after[name] == stamp for name, stamp in before.items()) and len(after) > len(before)
    want = sorted(((None if d is None else d.year * 10000 + d.month * 100 + d.day, a, t) for d, a, t in rows), key=repr)
    assert _rows(spark, path) == want


def test_months_vanish_and_come_back(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    _refresh(spark, rows, path)
    fewer = [r for r in rows if r[0] is None or r[0].month != 7]
    assert _refresh(spark, fewer, path) == {202407: 0}
    assert all(r[0] is None or r[0] // 100 != 202407 for r in _rows(spark, path))
    assert _refresh(spark, fewer, path) == {}
    assert _refresh(spark, rows, path) == {202407: 3}
    assert len(_rows(spark, path)) == len(rows)


def test_a_refresh_that_dies_changes_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    _refresh(spark, rows, path)
    seen, log = _rows(spark, path), month_log(spark, path).count()
    changed = [(d, -1.0, t) for d, _, t in rows]

    def dies(part):
        broken = F.when(F.col("date_key") % 3 == 0, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("amount"))
        return _build(part).withColumn("amount", broken)

    with pytest.raises(Exception, match="lost"):
        refresh_months(_source(spark, changed), path, month_of_day(F.col("day")), dies)
    assert _rows(spark, path) == seen and month_log(spark, path).count() == log


def test_a_changed_dimension_rebuilds_all(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    _refresh(spark, rows, path, salt="v1")
    assert _refresh(spark, rows, path, salt="v1") == {}
    assert len(_refresh(spark, rows, path, salt="v2")) == 13


def test_equal_rows_count_and_empty_sources_work(spark, tmp_path):
    path = str(tmp_path / "t")
    one = (date(2024, 5, 5), 1.0, "x")
    assert _refresh(spark, [one, one], path) == {202405: 2}
    assert _refresh(spark, [one, one, one, one], path) == {202405: 4}
    assert _refresh(spark, [], path) == {202405: 0}
    assert _rows(spark, path) == []


def _partition_lines(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "FileScan" in line and "month_key" in line]


@pytest.fixture
def star(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    _refresh(spark, rows, path)
    calendar = [(d.year * 10000 + d.month * 100 + d.day, d, f"Q{(d.month + 2) // 3}") for d in MONTHS]
    return Model(
        facts={"sales": scan_months(spark, path)},
        dimensions={"dim_date": spark.createDataFrame(calendar, "date_key int, date date, quarter string")},
        relationships=(Relationship("sales", "date_key", "dim_date"),),
    )


TOTAL = {"total": Aggregate("sales", ("amount",), lambda: F.sum("amount"))}


def _partitions_read(df):
    """Numbers of partitions of the scans of the fact, from the metrics of the run."""
    df.collect()
    node, found = [df._jdf.queryExecution().executedPlan()], []
    while node:
        x = node.pop()
        if x.nodeName().startswith("AdaptiveSparkPlan"):
            node.append(x.executedPlan())
            continue
        if "QueryStage" in x.nodeName():
            node.append(x.plan())
        if x.nodeName().startswith("Scan parquet") and x.metrics().contains("numPartitions"):
            found.append(x.metrics().apply("numPartitions").value())
        children = x.children()
        node += [children.apply(i) for i in range(children.size())]
    return found


def test_a_date_slicer_lists_only_its_months(spark, star):
    slicer = filter_date_between("dim_date", "date", date(2024, 3, 10), date(2024, 5, 1))
    df = evaluate(star, ["total"], filters=[slicer], registry=TOTAL)
    assert df.first()["total"] == sum(i for i, d in enumerate(MONTHS) if date(2024, 3, 10) <= d < date(2024, 5, 1))
    scan = _partition_lines(df)[0]
    assert "month_key#" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0] and "202403" in scan and "202404" in scan
    assert set(_partitions_read(df)) == {2}


def test_other_filters_of_the_calendar_prune_at_run_time(spark, star):
    df = evaluate(star, ["total"], filters=[Filter("dim_date", F.col("quarter") == "Q2")], registry=TOTAL)
    assert df.first()["total"] == sum(i for i, d in enumerate(MONTHS) if d.month in (4, 5, 6))
    scan = _partition_lines(df)[0]
    assert "dynamicpruning" in scan
    assert set(_partitions_read(df)) == {3}


def test_without_a_filter_all_current_months_are_read(spark, star, tmp_path):
    df = evaluate(star, ["total"], registry=TOTAL)
    assert df.first()["total"] == sum(range(36)) + 10.0
    assert set(_partitions_read(df)) == {13}
    plain = replace(star, facts={"sales": star.facts["sales"].drop("month_key")})
    slicer = filter_date_between("dim_date", "date", date(2024, 3, 10), date(2024, 5, 1))
    assert evaluate(plain, ["total"], filters=[slicer], registry=TOTAL).first() == evaluate(star, ["total"], filters=[slicer], registry=TOTAL).first()


def test_month_before_a_key():
    from skyledger.plans.context import _month_before

    assert [_month_before(k) for k in (20240501, 20240502, 20240101)] == [202404, 202405, 202312]


def test_month_of_keys(spark):
    df = spark.createDataFrame([(20240131,), (None,), (19991201,)], "date_key int").select(month_of("date_key").alias("m"))
    assert [r["m"] for r in df.collect()] == [202401, 0, 199912]
