"""Sources and sinks: a driver table written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from driver_queries.airport_tables import LANDED_EVENTS, landed, with_tables
from driver_queries.registry import f, n, query, t, table
from skyledger.operators.clean import flatten_struct
from skyledger.session import scratch_path
from skyledger.sources import (
    literal_rows,
    scan_csv_strings,
    scan_delimited_noheader,
    scan_json_nested,
    scan_layer,
    scan_table,
    schemas,
    sink_overwrite,
    sink_overwrite_schema,
)


@query("scan_csv_strings", with_tables("SELECT * FROM l_commercial_transactions"))
def _(spark, sf):
    path = scratch_path(spark, "csv")
    landed(spark, sf, "commercial_transactions").write.option("header", True).option("escape", "\\").csv(path)
    return scan_csv_strings(spark, path, schemas.COMMERCIAL_COLUMNS)


@query("scan_json_nested", with_tables("SELECT * FROM l_flight_operational_events"))
def _(spark, sf):
    path = scratch_path(spark, "json")
    landed(spark, sf, "flight_operational_events").write.json(path)
    paths = {
        "event_id": "event_id",
        "flight.flight_id": "flight_id",
        "flight.flight_number": "flight_number",
        "flight.airline": "airline",
        "operation.direction": "direction",
        "operation.gate": "gate",
        "operation.status": "status",
        "timing.scheduled": "scheduled",
        "timing.actual": "actual",
        "timing.delay.minutes": "minutes",
        "timing.delay.reason": "reason",
        "source_system": "source_system",
    }
    assert list(paths.values()) == [name for name, _ in LANDED_EVENTS["flight_operational_events"][1]]
    return flatten_struct(scan_json_nested(spark, path, schemas.FLIGHT_EVENTS), paths)


FEEDBACK_LIKE = [
    ("feedback_id", "'00' || CAST(c_custkey AS STRING)"),
    ("feedback_date", "CASE WHEN c_custkey % 9 = 0 THEN 'bad-date' ELSE '2024-01-0' || CAST(1 + c_custkey % 9 AS STRING) END"),
    ("feedback_text", "c_mktsegment || ' café, ' || c_name"),
]


@query(
    "scan_delimited_noheader",
    "SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in FEEDBACK_LIKE) + " FROM customer",
)
def _(spark, sf):
    path = scratch_path(spark, "text")
    rows = table(spark, sf, "customer").selectExpr(*[f"{expr} AS {name}" for name, expr in FEEDBACK_LIKE])
    rows.write.option("sep", "|").option("header", False).csv(path)
    return scan_delimited_noheader(spark, path, schemas.FEEDBACK_COLUMNS)


@query("scan_table", f"SELECT s_suppkey, s_name, {n('s_nationkey')} AS s_nationkey, {f('s_acctbal')} AS s_acctbal FROM supplier")
def _(spark, sf):
    name = f"supplier_{uuid.uuid4().hex}"
    table(spark, sf, "supplier").write.option("path", scratch_path(spark, "catalog")).saveAsTable(name)
    rows = scan_table(spark, name)
    # The table is external: forgetting its name keeps the files that the plan reads.
    rows.schema
    spark.sql(f"DROP TABLE {name}")
    return rows


@query(
    "scan_layer",
    f"SELECT c_custkey, c_name, {n('c_nationkey')} AS c_nationkey, {f('c_acctbal')} AS c_acctbal, c_mktsegment FROM customer",
)
def _(spark, sf):
    layer = scratch_path(spark, "silver")
    customer = table(spark, sf, "customer")
    sink_overwrite(customer, f"{layer}/customer")
    return scan_layer(spark, layer, "customer", schema=customer.schema)


@query(
    "sink_overwrite",
    f"SELECT o_orderkey, {f('o_totalprice * 2')} AS o_totalprice FROM orders",
)
def _(spark, sf):
    path = scratch_path(spark, "orders")
    sink_overwrite(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), path)
    # The second write reads the table that it replaces.
    schema = "o_orderkey bigint, o_totalprice double"
    doubled = spark.read.schema(schema).parquet(path).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    sink_overwrite(doubled, path, reads_target=True)
    return spark.read.schema(schema).parquet(path)


@query(
    "sink_overwrite_partitions",
    f"""SELECT o_orderkey, o_orderpriority,
        {f("CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END")} AS o_totalprice
        FROM orders""",
)
def _(spark, sf):
    path = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    sink_overwrite(orders, path, partition_by=["o_orderpriority"])
    urgent = orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    sink_overwrite(urgent, path, partition_by=["o_orderpriority"])
    return spark.read.schema(orders.schema).parquet(path)


@query("sink_overwrite_schema", f"SELECT p_partkey, {t('p_size')} AS p_size_text FROM part")
def _(spark, sf):
    path = scratch_path(spark, "part")
    part = table(spark, sf, "part")
    sink_overwrite(part.select("p_partkey", "p_name", "p_size"), path)
    sink_overwrite_schema(part.select("p_partkey", F.col("p_size").cast("string").alias("p_size_text")), path)
    return spark.read.parquet(path)


@query(
    "literal_rows",
    """SELECT s.status_name, count(*) AS order_count FROM orders
       JOIN (VALUES ('F', 'On Time'), ('O', 'Delayed'), ('P', 'Cancelled')) AS s(code, status_name)
       ON o_orderstatus = s.code GROUP BY ALL""",
)
def _(spark, sf):
    names = literal_rows(
        spark, [("F", "On Time"), ("O", "Delayed"), ("P", "Cancelled")], "o_orderstatus string, status_name string"
    )
    counts = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("order_count"))
    return counts.join(names, "o_orderstatus").select("status_name", "order_count")
