"""Fact operators on the driver tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from driver_queries.airport_tables import DIMENSION_BUILDERS, ModelTables, cleaned, model, with_tables
from driver_queries.dirty import dirty, dirty_sql
from driver_queries.registry import f, n, query, t, table
from skyledger.operators import facts as FA
from skyledger.operators.facts import with_date_key
from skyledger.operators.joins import salted_join
from skyledger.plans import airport
from skyledger.plans.context import filter_date_between
from skyledger.plans.measures import evaluate
from skyledger.session import scratch_path
from skyledger.sources import month_of, month_of_day, refresh_months, scan_months


@query(
    "lookup_keys",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, {n('l_linenumber')} AS l_linenumber, s_name, p_name
        FROM {dirty_sql('lineitem_null_supplier')} LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN part ON l_partkey = p_partkey""",
)
def _(spark, sf):
    lines = dirty(spark, sf, "lineitem_null_supplier").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return FA.lookup_keys(
        lines,
        [
            FA.Lookup(table(spark, sf, "supplier"), "l_suppkey", "s_name", "s_suppkey"),
            FA.Lookup(table(spark, sf, "part"), "l_partkey", "p_name", "p_partkey"),
        ],
    )


# The orders as they were before some of them were corrected, cancelled or dated.
def _orders_before(orders):
    late = F.col("o_orderdate") >= "1996-06-01"
    fixed = F.when(late & (F.col("o_orderkey") % 5 == 0), F.lit(0.0)).otherwise(F.col("o_totalprice"))
    return orders.withColumn("o_totalprice", fixed).filter(~((F.year("o_orderdate") == 1995) & (F.month("o_orderdate") == 3)))


def _fact_orders(rows):
    return with_date_key(rows, "o_orderdate").select("o_orderkey", "date_key", "o_totalprice")


def _refreshed(spark, sf):
    path = scratch_path(spark, "orders-by-month")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    month = month_of_day(F.col("o_orderdate"))
    refresh_months(_orders_before(orders), path, month, _fact_orders)
    return path, refresh_months(orders, path, month, _fact_orders)


@query(
    "refresh_months",
    f"""SELECT o_orderkey, {n("strftime(o_orderdate, '%Y%m%d')")} AS date_key, {f('o_totalprice')} AS o_totalprice,
        {n("strftime(o_orderdate, '%Y%m')")} AS month_key FROM orders""",
)
def _(spark, sf):
    path, _ = _refreshed(spark, sf)
    return scan_months(spark, path)


@query(
    "refresh_months_changed",
    f"""SELECT month_key, count(*) AS row_count FROM (
            SELECT {n("strftime(o_orderdate, '%Y%m')")} AS month_key,
                o_orderdate >= DATE '1996-06-01' AND o_orderkey % 5 = 0 AND o_totalprice <> 0 AS fixed FROM orders)
        GROUP BY month_key HAVING month_key = 199503 OR bool_or(fixed)""",
)
def _(spark, sf):
    return _refreshed(spark, sf)[1]


@query(
    "month_facts_slicer",
    with_tables(
        f"""SELECT revenue_category, count(*) AS transactions, {f('sum(amount_cad)', 4)} AS revenue FROM fact_commercial_transactions
            JOIN dim_date USING (date_key) WHERE "date" >= DATE '1995-11-01' AND "date" < DATE '1996-02-15' GROUP BY ALL"""
    ),
    digits=4,
)
def _(spark, sf):
    path = scratch_path(spark, "commercial-by-month")
    star = model(spark, sf)
    refresh_months(star.facts["fact_commercial_transactions"], path, month_of("date_key"))
    by_month = replace(star, facts={"fact_commercial_transactions": scan_months(spark, path)})
    slicer = filter_date_between("dim_date", "date", date(1995, 11, 1), date(1996, 2, 15))
    by = [("fact_commercial_transactions", "revenue_category")]
    result = evaluate(by_month, ["Total Transactions", "Total Commercial Revenue"], by, [slicer])
    return result.toDF("revenue_category", "transactions", "revenue").withColumn("revenue", F.col("revenue").cast("double"))


# A third of the rows points to one order and some rows to none.
HOT = "CASE WHEN l_partkey % 3 = 0 THEN 7 WHEN l_partkey % 31 = 0 THEN NULL ELSE l_orderkey END"


@query(
    "lookup_keys_skewed",
    f"""SELECT o_key, o_orderstatus, count(*) AS line_count, CAST(sum(l_partkey) AS BIGINT) AS part_sum
        FROM (SELECT {HOT} AS o_key, l_partkey FROM lineitem) LEFT JOIN orders ON o_key = o_orderkey GROUP BY ALL""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.expr(HOT).alias("o_key"), "l_partkey", "l_linenumber")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("o_key"), "o_orderstatus")
    joined = salted_join(lines, orders, ["o_key"], "left")
    return joined.groupBy("o_key", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("l_partkey").alias("part_sum")
    )


@query(
    "lookup_keys_mixed_types",
    f"""SELECT o_key, o_orderstatus, count(*) AS line_count, CAST(sum(l_partkey) AS BIGINT) AS part_sum
        FROM (SELECT {HOT} AS o_key, l_partkey FROM lineitem) LEFT JOIN orders ON o_key = o_orderkey GROUP BY ALL""",
)
def _(spark, sf):
    hot = F.expr(HOT).cast("decimal(20,2)").alias("o_key")
    lines = table(spark, sf, "lineitem").select(hot, "l_partkey")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("int").alias("o_key"), "o_orderstatus")
    joined = salted_join(lines, orders, ["o_key"], "left")
    return joined.groupBy(F.col("o_key").cast("bigint").alias("o_key"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("l_partkey").alias("part_sum")
    )


@query(
    "map_unknown_key",
    f"""SELECT l_orderkey, l_partkey, coalesce(s_name, 'Unknown') AS s_name FROM {dirty_sql('lineitem_bad_supplier')}
        LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def _(spark, sf):
    lines = dirty(spark, sf, "lineitem_bad_supplier").select("l_orderkey", "l_partkey", "l_suppkey")
    keyed = FA.lookup_keys(lines, [FA.Lookup(table(spark, sf, "supplier"), "l_suppkey", "s_name", "s_suppkey")])
    return FA.map_unknown_key(keyed, "s_name", "Unknown").drop("l_suppkey")


@query(
    "date_key",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key FROM orders",
)
def _(spark, sf):
    return FA.with_date_key(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop(
        "o_orderdate"
    )


K = "TRY_CAST(regexp_extract(props, '\"k\": (\\d+)', 1) AS BIGINT)"


@query(
    "aggregate_to_grain",
    f"""SELECT {t('CAST(ts AS DATE)')} AS "date", {n('hour(ts)')} AS "hour", event_type, CAST(sum(k) AS BIGINT) AS k,
        {f('sum(value * k) / nullif(sum(k), 0)', 9)} AS mean_value
        FROM (SELECT *, {K} AS k FROM {dirty_sql('events_null_value')}) GROUP BY ALL""",
    digits=9,
)
def _(spark, sf):
    events = dirty(spark, sf, "events_null_value").select(
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        "event_type",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        "value",
    )
    return FA.aggregate_to_grain(
        events, ["date", "hour", "event_type"], ["k"], {"mean_value": (F.col("value"), F.col("k"))}
    )


@query(
    "borrow_parent_date",
    f"""SELECT l_orderkey, l_partkey, {n('l_linenumber')} AS l_linenumber, {t('CAST(o_orderdate AS DATE)')} AS order_date
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return FA.borrow_parent_date(lines, table(spark, sf, "orders"), "l_orderkey", "o_orderdate", "order_date", "o_orderkey")


def _dims(spark, sf):
    return ModelTables(spark, sf, DIMENSION_BUILDERS)


@query(
    "build_fact_flight",
    with_tables(
        f"""SELECT * REPLACE ({n('date_key')} AS date_key, {t('scheduled_time')} AS scheduled_time,
            {t('actual_time')} AS actual_time, {n('seat_capacity')} AS seat_capacity,
            {n('passenger_count')} AS passenger_count, {n('delay_minutes')} AS delay_minutes,
            {t('gate_in_time')} AS gate_in_time, {t('gate_out_time')} AS gate_out_time) FROM fact_flight_operations"""
    ),
)
def _(spark, sf):
    dims = _dims(spark, sf)
    return airport.build_fact_flight(
        cleaned(spark, sf, "flights"), dims["dim_flight"], dims["dim_airline"], dims["dim_gate"]
    )


@query(
    "build_fact_passenger_flow",
    with_tables(
        f"""SELECT * REPLACE ({n('date_key')} AS date_key, {n('"hour"')} AS "hour",
            {f('avg_security_wait_min')} AS avg_security_wait_min) FROM fact_passenger_flow"""
    ),
)
def _(spark, sf):
    return airport.build_fact_passenger_flow(
        cleaned(spark, sf, "passenger_flow"), _dims(spark, sf)["dim_terminal_zone"]
    )


@query(
    "build_fact_baggage",
    with_tables(f"SELECT * REPLACE ({n('date_key')} AS date_key) FROM fact_baggage_operations"),
)
def _(spark, sf):
    return airport.build_fact_baggage(
        cleaned(spark, sf, "baggage_events"), cleaned(spark, sf, "flights"), _dims(spark, sf)["dim_flight"]
    )


@query(
    "build_fact_commercial",
    with_tables(
        f"""SELECT * REPLACE ({n('date_key')} AS date_key, {t('"timestamp"')} AS "timestamp",
            {f('amount_cad')} AS amount_cad) FROM fact_commercial_transactions"""
    ),
)
def _(spark, sf):
    return airport.build_fact_commercial(
        cleaned(spark, sf, "commercial_transactions"), _dims(spark, sf)["dim_terminal_zone"]
    )


@query(
    "build_fact_sustainability",
    with_tables(
        f"""SELECT {n('date_key')} AS date_key, {f('electricity_kwh')} AS electricity_kwh, {f('water_m3')} AS water_m3,
            {f('waste_tonnes')} AS waste_tonnes, {f('estimated_co2e_tonnes')} AS estimated_co2e_tonnes
            FROM fact_sustainability_daily"""
    ),
)
def _(spark, sf):
    return airport.build_fact_sustainability(cleaned(spark, sf, "sustainability_daily"))


@query(
    "build_fact_feedback",
    with_tables(
        f"SELECT {n('feedback_id')} AS feedback_id, {n('date_key')} AS date_key, feedback_text FROM fact_passenger_feedback"
    ),
)
def _(spark, sf):
    return airport.build_fact_feedback(cleaned(spark, sf, "passenger_feedback"))
