"""Tables replaced as a whole, checks made by the write job, and rejects with reasons."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.dirty import dirty, dirty_sql
from driver_queries.registry import f, n, query, t, table
from skyledger.operators.rejects import cast_with_rejects
from skyledger.session import scratch_path
from skyledger.sources import (
    CheckFailed,
    replace_table,
    scan_delimited_checked,
    scan_json_checked,
    scan_version,
    table_log,
    write_checked,
)

RULES = {
    "discount below 8 %": "l_discount < 0.08",
    "shipped since June 1992": "l_shipdate >= DATE '1992-06-01'",
    "some units": "l_quantity > 0",
}


@query("sink_replace", f"SELECT o_orderkey, {f('o_totalprice * 2')} AS o_totalprice FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "orders")
    replace_table(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), path)
    # The second version is made of the first, which is still there while it is written.
    first = scan_version(spark, path)
    replace_table(first.withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    return scan_version(spark, path)


@query(
    "sink_replace_refused",
    f"SELECT o_orderkey, {f('o_totalprice')} AS o_totalprice, CAST(1 AS BIGINT) AS version FROM orders",
)
def _(spark, sf):
    path = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    replace_table(orders, path)
    try:
        replace_table(orders.withColumn("o_totalprice", -F.col("o_totalprice")), path, rules={"price": F.col("o_totalprice") > 0})
    except CheckFailed:
        pass
    newest = table_log(spark, path).agg(F.max("version").alias("version"))
    return scan_version(spark, path).select("*", newest.scalar().alias("version"))


@query(
    "sink_replace_log",
    f"""SELECT v AS version, {n("CASE v WHEN 1 THEN (SELECT count(*) FROM customer) ELSE (SELECT count(*) FROM customer WHERE c_acctbal > 0) END")}
        AS row_count FROM (VALUES (1::BIGINT), (2::BIGINT)) AS versions(v)""",
)
def _(spark, sf):
    path = scratch_path(spark, "customer")
    customer = table(spark, sf, "customer")
    replace_table(customer, path)
    replace_table(customer.filter("c_acctbal > 0"), path, rules={"balance": F.col("c_acctbal") > 0})
    return table_log(spark, path).select("version", "row_count")


@query(
    "write_checked",
    "SELECT 'rows' AS check_name, count(*) AS row_count FROM lineitem "
    + "".join(f"UNION ALL SELECT '{name}', count(*) FILTER (WHERE NOT ({sql})) FROM lineitem " for name, sql in RULES.items())
    + "UNION ALL SELECT 'l_shipdate is null', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem",
)
def _(spark, sf):
    rules = {name: F.expr(sql) for name, sql in RULES.items()}
    return write_checked(table(spark, sf, "lineitem"), scratch_path(spark, "lineitem"), rules, ["l_shipdate"])


@query(
    "write_checked_nulls",
    f"""SELECT 'rows' AS check_name, count(*) AS row_count FROM events
        UNION ALL SELECT 'value is null', count(*) FILTER (WHERE value IS NULL) FROM {dirty_sql('events_null_value')} e
        UNION ALL SELECT 'event_type is null', CAST(0 AS BIGINT)""",
)
def _(spark, sf):
    events = dirty(spark, sf, "events_null_value").select("event_id", "event_type", "value")
    return write_checked(events, scratch_path(spark, "events"), {}, ["value", "event_type"]).filter(
        F.col("check_name").isin("rows", "value is null", "event_type is null")
    )


# Order lines as text with faults put in by rule: bad numbers and dates, missing keys, unknown codes.
LINE_TEXT = [
    ("l_orderkey", "CAST(l_orderkey AS STRING)"),
    ("l_linenumber", "CAST(l_linenumber AS STRING)"),
    ("l_suppkey", "CASE WHEN l_orderkey % 31 = 0 THEN NULL WHEN l_orderkey % 37 = 0 THEN ' ' ELSE CAST(l_suppkey AS STRING) END"),
    ("l_quantity", "CASE WHEN l_orderkey % 29 = 0 THEN 'many' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END"),
    ("l_shipdate", "CASE WHEN l_orderkey % 41 = 0 THEN 'soon' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END"),
    ("l_returnflag", "CASE WHEN l_orderkey % 43 = 0 THEN 'Z' ELSE l_returnflag END"),
]
LINE_TYPES = {"l_orderkey": "bigint", "l_linenumber": "bigint", "l_suppkey": "bigint", "l_quantity": "double", "l_shipdate": "date"}
LINES_SQL = "(SELECT " + ", ".join(f"{expr.replace('STRING', 'VARCHAR')} AS {name}" for name, expr in LINE_TEXT) + " FROM lineitem)"
REJECTS_SQL = f"""
    SELECT l_orderkey, l_linenumber, 'l_suppkey' AS column_name, l_suppkey AS raw_value, 'missing' AS reason
    FROM {LINES_SQL} a WHERE coalesce(trim(l_suppkey), '') = ''
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_quantity', l_quantity, 'not a double' FROM {LINES_SQL} b WHERE l_quantity = 'many'
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_shipdate', l_shipdate, 'not a date' FROM {LINES_SQL} c WHERE l_shipdate = 'soon'
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_returnflag', l_returnflag, 'not in domain' FROM {LINES_SQL} d WHERE l_returnflag = 'Z'"""


def typed_lines(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr(*[f"{expr} AS {name}" for name, expr in LINE_TEXT])
    return cast_with_rejects(
        raw, LINE_TYPES, ["l_orderkey", "l_linenumber"], required=["l_orderkey", "l_suppkey"], domains={"l_returnflag": ["A", "N", "R"]}
    )


@query(
    "rejects_with_reasons",
    f"SELECT * REPLACE (CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM ({REJECTS_SQL})",
)
def _(spark, sf):
    return typed_lines(spark, sf).rejects


@query(
    "rows_kept_beside_rejects",
    f"""SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        CAST(l_suppkey AS BIGINT) AS l_suppkey, {f('TRY_CAST(l_quantity AS DOUBLE)')} AS l_quantity, l_shipdate, l_returnflag
        FROM {LINES_SQL} x WHERE coalesce(trim(l_suppkey), '') <> '' AND l_quantity <> 'many' AND l_shipdate <> 'soon' AND l_returnflag <> 'Z'""",
)
def _(spark, sf):
    return typed_lines(spark, sf).kept


IS_REJECTED = "coalesce(trim(l_suppkey), '') = '' OR l_quantity = 'many' OR l_shipdate = 'soon' OR l_returnflag = 'Z'"


@query(
    "reject_balance",
    f"""SELECT count(*) AS row_count, count(*) FILTER (WHERE NOT ({IS_REJECTED})) AS kept_count,
        count(*) FILTER (WHERE {IS_REJECTED}) AS rejected_count, (SELECT count(*) FROM ({REJECTS_SQL})) AS reject_count FROM {LINES_SQL} x""",
)
def _(spark, sf):
    return typed_lines(spark, sf).balance


# Records with a field too many or too few.
RECORD = "concat_ws('|', CAST(c_custkey AS STRING), c_mktsegment, CASE WHEN c_custkey % 11 = 0 THEN 'x|y' ELSE CAST(CAST(c_acctbal AS INT) AS STRING) END)"


@query(
    "scan_delimited_rejects",
    """SELECT CAST(c_custkey AS VARCHAR) || '|' || c_mktsegment || '|x|y' AS raw_value, 'malformed record' AS reason, CAST(NULL AS VARCHAR) AS column_name
        FROM customer WHERE c_custkey % 11 = 0""",
)
def _(spark, sf):
    path = scratch_path(spark, "records")
    table(spark, sf, "customer").selectExpr(f"{RECORD} AS value").write.text(path)
    raw = scan_delimited_checked(spark, path, ["c_custkey", "c_mktsegment", "c_acctbal"], sep="|")
    return cast_with_rejects(raw, {"c_custkey": "bigint", "c_acctbal": "double"}, []).rejects


@query(
    "scan_json_rejects",
    f"""SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_mktsegment FROM customer WHERE c_custkey % 13 <> 0""",
)
def _(spark, sf):
    path = scratch_path(spark, "records")
    line = """CASE WHEN c_custkey % 13 = 0 THEN '{"c_custkey": ' || CAST(c_custkey AS STRING)
        ELSE to_json(named_struct('c_custkey', c_custkey, 'c_mktsegment', c_mktsegment)) END"""
    table(spark, sf, "customer").selectExpr(f"{line} AS value").write.text(path)
    raw = scan_json_checked(spark, path, "c_custkey string, c_mktsegment string")
    return cast_with_rejects(raw, {"c_custkey": "bigint"}, ["c_custkey"]).kept


@query(
    "bad_timestamps_rejected",
    f"""SELECT CAST(event_id AS BIGINT) AS event_id, 'ts' AS column_name, ts AS raw_value, 'not a date' AS reason
        FROM {dirty_sql('events_bad_ts')} e WHERE ts = 'bad-date'""",
)
def _(spark, sf):
    events = dirty(spark, sf, "events_bad_ts").select("event_id", "ts")
    return cast_with_rejects(events, {"ts": "date"}, ["event_id"]).rejects
