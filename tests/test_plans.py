"""Shape of the plans: what must hold at any scale."""

import os
import re

import pytest

from driver_queries.all_queries import QUERIES
from driver_queries.airport_tables import model
from skyledger.plans.context import filter_date_between
from skyledger.plans.measures import evaluate
from skyledger.session import materialize, shared_dir
from skyledger.sources import jdbc_options, sink_overwrite

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_pairwise_join_and_no_python_in_plans(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", ["surrogate_key_wide", "impute_neighbour_mean_rows", "build_fact_passenger_flow"])
def test_single_partition_windows_see_one_row_per_range_only(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # Below the single partition there is an aggregate per range, not the rows.
            assert "HashAggregate" in lines[i + 1] or "SortAggregate" in lines[i + 1], text


def test_date_filter_and_columns_reach_the_scan(spark, sf_dir):
    from datetime import date

    slicer = filter_date_between("dim_date", "date", date(1996, 1, 1), date(1997, 1, 1))
    text = plan(evaluate(model(spark, sf_dir), ["Total Passengers"], filters=[slicer]))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "passenger_count" in line)
    assert "GreaterThanOrEqual(date_key,19960101)" in scan and "LessThan(date_key,19970101)" in scan
    assert "ReadSchema: struct<date_key:int,passenger_count:int>" in scan


def test_measures_of_one_fact_share_one_scan(spark, sf_dir):
    names = ["Total Flights", "Load Factor %", "On-Time Performance %", "Average Delay Minutes", "Cancelled Flights"]
    assert plan(evaluate(model(spark, sf_dir), names)).count("FileScan") == 1


def test_library_does_not_collect():
    forbidden = re.compile(r"\.(collect|toPandas|toLocalIterator|localCheckpoint|crossJoin|rdd)\b")
    for folder, below, files in os.walk(os.path.join(ROOT, "skyledger")):
        # The training-data operators list in their own tests what they may bring to the driver.
        below[:] = [name for name in below if name != "llm"]
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as source:
                    assert not forbidden.search(source.read()), name


def test_jdbc_options_need_the_whole_partitioning():
    plain = jdbc_options("jdbc:x", "flights")
    assert plain == {"url": "jdbc:x", "dbtable": "flights", "fetchsize": "10000"}
    split = jdbc_options(
        "jdbc:x", "flights", partition_column="id", lower_bound=0, upper_bound=10, num_partitions=4
    )
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "flights", partition_column="id")


def test_written_tables_go_to_the_folder_of_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        assert shared_dir(spark) == folder.rstrip("/")
    written = materialize(spark.range(3))
    assert written.count() == 3
    assert all(shared_dir(spark).removeprefix("file:") in path for path in written.inputFiles())


def test_overwrite_of_a_table_by_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    sink_overwrite(spark.range(10), path)
    sink_overwrite(spark.read.parquet(path).filter("id < 3"), path, reads_target=True)
    assert spark.read.parquet(path).count() == 3


def test_any_number_of_lookups_scans_the_fact_once_more(spark, tmp_path, no_broadcast):
    from skyledger.operators.facts import Lookup, lookup_keys

    path = str(tmp_path / "fact")
    spark.range(500).selectExpr("id", "id % 3 AS a", "if(id % 2 = 0, 7, id) AS b", "cast(id % 5 as string) AS c", "id * 2 AS big").write.parquet(path)
    members = {k: spark.range(600).selectExpr(f"cast(id as {kind}) AS {k}", f"id + 1 AS {k}_key") for k, kind in (("a", "int"), ("b", "bigint"), ("c", "string"))}
    lookups = [Lookup(df, k, f"{k}_key") for k, df in members.items()]
    spark.sparkContext.setJobGroup("lookups", "lookups")
    try:
        joined = lookup_keys(spark.read.parquet(path), lookups)
    finally:
        spark.sparkContext.setJobGroup("", "")
    # The sketches of all keys were written by one scan; the plan itself scans the fact once.
    assert plan(joined).count(f"{path}]") == 1
    got = joined.selectExpr("count(*)", "sum(a_key)", "sum(b_key)", "sum(c_key)").first()
    want = spark.read.parquet(path).selectExpr("count(*)", "sum(a + 1)", "sum(b + 1)", "sum(cast(c as bigint) + 1)").first()
    assert tuple(got) == tuple(want)


def test_shares_and_salts_follow_the_partitions(spark):
    from skyledger.operators.joins import hot_share, salts_for

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        seen = []
        for partitions in ("8", "1000", "100000"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            seen.append((hot_share(spark), salts_for(spark)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen == [(1 / 200, 64), (1 / 2000, 1000), (1 / 4000, 1024)]


def test_a_filtered_fact_reads_the_same_columns_on_both_paths(spark, tmp_path):
    from skyledger.plans.context import Filter, Model, Relationship
    from skyledger.plans.measures import Aggregate
    from pyspark.sql import functions as F

    path = str(tmp_path / "fact")
    spark.range(50).selectExpr("id % 7 AS key", "id AS x", "id AS y", "'long text' AS note").write.parquet(path)
    dim = spark.range(7).selectExpr("id AS key", "id % 2 AS odd")
    star = Model({"f": spark.read.parquet(path)}, {"d": dim}, (Relationship("f", "key", "d"),))
    measures = {"sum x": Aggregate("f", ("x",), lambda: F.sum("x"))}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    schemas, totals = [], []
    for limit in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            df = evaluate(star, ["sum x"], filters=[Filter("d", F.col("odd") == 1)], registry=measures)
            totals.append(df.first()[0])
            schemas.append({re.search(r"ReadSchema: struct<(.*)>", line)[1] for line in plan(df).splitlines() if path in line})
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert totals[0] == totals[1] == sum(i for i in range(50) if i % 7 % 2)
    assert max(schemas[0], key=len) == max(schemas[1], key=len) == "key:bigint,x:bigint"


def test_large_lookups_are_not_sorted_and_unread_columns_not_written(spark, sf_dir):
    from driver_queries.airport_tables import FACT_BUILDERS, ModelTables, model
    from skyledger.operators.facts import Lookup, lookup_keys

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, dim = spark.range(40).selectExpr("id AS a", "id % 3 AS b"), spark.range(40).selectExpr("id AS a", "id AS a_key")
        for unique in (True, False):
            joined = lookup_keys(fact, [Lookup(dim, "a", "a_key", unique=unique)])
            assert "SortMergeJoin" not in plan(joined) and joined.filter("a = a_key").count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "bag_event_id" not in model(spark, sf_dir).facts["fact_baggage_operations"].columns
    assert "bag_event_id" in ModelTables(spark, sf_dir, FACT_BUILDERS)["fact_baggage_operations"].columns
