"""Profiling and data-quality checks on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.airport_tables import ModelTables, FACT_BUILDERS, cleaned, model, with_tables
from driver_queries.dirty import dirty, dirty_sql
from driver_queries.registry import f, n, query, t, table
from skyledger.operators import quality as Q

EVENTS = dirty_sql("events_null_value")
LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts):
    return " UNION ALL ".join(parts)


EVENT_TYPES = [
    ("event_id", "bigint"),
    ("ts", "timestamp_ntz"),
    ("user_id", "bigint"),
    ("event_type", "string"),
    ("value", "double"),
    ("props", "string"),
]


@query(
    "profile_shape",
    _union(
        f"SELECT (SELECT count(*) FROM events) AS row_count, {n(6)} AS column_count, {n(i)} AS position, "
        f"'{name}' AS column_name, '{kind}' AS data_type"
        for i, (name, kind) in enumerate(EVENT_TYPES, start=1)
    ),
)
def _(spark, sf):
    return Q.profile_shape(dirty(spark, sf, "events_null_value"))


@query(
    "profile_nulls",
    _union(
        f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) AS null_count FROM {EVENTS}"
        for name, _ in EVENT_TYPES
    ),
)
def _(spark, sf):
    return Q.profile_nulls(dirty(spark, sf, "events_null_value"))


@query(
    "value_ranges",
    _union(
        f"SELECT '{name}' AS column_name, {f(f'min({name})')} AS min_value, {f(f'max({name})')} AS max_value, "
        f"{f(f'avg({name})', 4)} AS avg_value FROM lineitem"
        for name in LINES
    ),
    digits=4,
)
def _(spark, sf):
    return Q.value_ranges(table(spark, sf, "lineitem"), LINES)


@query(
    "profile_numeric",
    _union(
        f"SELECT count(*) AS row_count, '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) AS null_count, "
        f"{f(f'min({name})', 4)} AS min_value, {f(f'max({name})', 4)} AS max_value, "
        f"{f(f'avg({name})', 4)} AS avg_value FROM {EVENTS}"
        for name in ("value", "user_id")
    ),
    digits=4,
)
def _(spark, sf):
    return Q.profile_numeric(dirty(spark, sf, "events_null_value"), ["value", "user_id"])


@query(
    "duplicate_keys",
    f"""SELECT l_orderkey, {n('l_linenumber')} AS l_linenumber, count(*) AS row_count FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark, sf):
    return Q.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_keys_after_cleaning",
    with_tables(
        f"""SELECT {t('"date"')} AS "date", {n('"hour"')} AS "hour", terminal_zone, traffic_type, count(*) AS row_count
            FROM c_passenger_flow GROUP BY ALL HAVING count(*) > 1"""
    ),
)
def _(spark, sf):
    return Q.duplicate_keys(
        cleaned(spark, sf, "passenger_flow"), ["date", "hour", "terminal_zone", "traffic_type"]
    )


@query(
    "domain_values",
    _union(
        [
            "SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS row_count FROM orders GROUP BY ALL",
            "SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL",
        ]
    ),
)
def _(spark, sf):
    return Q.domain_values(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    "domain_values_variants",
    f"SELECT 'event_type' AS column_name, event_type AS value, count(*) AS row_count "
    f"FROM {dirty_sql('events_variant_type')} GROUP BY ALL",
)
def _(spark, sf):
    return Q.domain_values(dirty(spark, sf, "events_variant_type"), ["event_type"])


@query("date_bounds", f"SELECT {t('CAST(min(l_shipdate) AS DATE)')} AS min_date, {t('CAST(max(l_shipdate) AS DATE)')} AS max_date FROM lineitem")
def _(spark, sf):
    return Q.date_bounds(table(spark, sf, "lineitem"), "l_shipdate")


@query(
    "rows_with_nulls",
    f"SELECT event_id, user_id, event_type FROM {EVENTS} WHERE value IS NULL OR event_type IS NULL",
)
def _(spark, sf):
    rows = Q.rows_with_nulls(dirty(spark, sf, "events_null_value"), ["value", "event_type"])
    return rows.select("event_id", "user_id", "event_type")


@query(
    "top_rows",
    f"""SELECT o_orderkey, {f('o_totalprice')} AS o_totalprice FROM orders
        ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return Q.top_rows(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


@query("preview", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10")
def _(spark, sf):
    return Q.preview(table(spark, sf, "customer").select("c_custkey", "c_name"), 10, [F.asc("c_custkey")])


@query(
    "orphan_rows",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, {n('l_linenumber')} AS l_linenumber
        FROM {dirty_sql('lineitem_null_supplier')} l
        WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l.l_suppkey)""",
)
def _(spark, sf):
    lines = dirty(spark, sf, "lineitem_null_supplier").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return Q.orphan_rows(lines, table(spark, sf, "supplier"), "l_suppkey", "s_suppkey")


@query(
    "orphan_rows_nonnull",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, {n('l_linenumber')} AS l_linenumber
        FROM {dirty_sql('lineitem_null_supplier')} l
        WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l.l_suppkey)""",
)
def _(spark, sf):
    lines = dirty(spark, sf, "lineitem_null_supplier").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return Q.orphan_rows_nonnull(lines, table(spark, sf, "supplier"), "l_suppkey", "s_suppkey")


@query(
    "rule_violations",
    f"""SELECT l_orderkey, l_partkey, {n('l_linenumber')} AS l_linenumber, {f('l_quantity')} AS l_quantity
        FROM lineitem WHERE l_quantity > 49""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return Q.rule_violations(lines, F.col("l_quantity") <= 49)


@query(
    "rule_violations_across_tables",
    f"""SELECT l_orderkey, l_partkey, {n('l_linenumber')} AS l_linenumber FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""",
)
def _(spark, sf):
    from skyledger.operators.joins import keyed_join

    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    joined = keyed_join(lines, orders, ["l_orderkey"], "inner")
    return Q.rule_violations(joined, F.col("l_shipdate") >= F.col("o_orderdate")).select(
        "l_orderkey", "l_partkey", "l_linenumber"
    )


@query(
    "rule_violations_bags",
    with_tables(
        """SELECT bag_event_id, 'last bag before first' AS rule FROM c_baggage_events WHERE last_bag_min < first_bag_min
           UNION ALL SELECT bag_event_id, 'more mishandled than processed' FROM c_baggage_events
           WHERE mishandled_bags > bags_processed"""
    ),
)
def _(spark, sf):
    bags = cleaned(spark, sf, "baggage_events")
    late = Q.rule_violations(bags, F.col("last_bag_min") >= F.col("first_bag_min"))
    lost = Q.rule_violations(bags, F.col("mishandled_bags") <= F.col("bags_processed"))
    return late.select("bag_event_id", F.lit("last bag before first").alias("rule")).unionByName(
        lost.select("bag_event_id", F.lit("more mishandled than processed").alias("rule"))
    )


@query(
    "bad_dates",
    f"SELECT event_id, ts FROM {dirty_sql('events_bad_ts')} WHERE TRY_CAST(ts AS DATE) IS NULL",
)
def _(spark, sf):
    return Q.bad_dates(dirty(spark, sf, "events_bad_ts").select("event_id", "ts"), "ts")


@query(
    "point_lookup",
    with_tables(f"""SELECT {t('"date"')} AS "date", {f('water_m3')} AS water_m3 FROM c_sustainability_daily
                    WHERE "date" = DATE '1996-03-07'"""),
)
def _(spark, sf):
    from datetime import date

    days = cleaned(spark, sf, "sustainability_daily").select("date", "water_m3")
    return Q.point_lookup(days, "date", date(1996, 3, 7))


@query(
    "fk_null_counts",
    with_tables(
        """SELECT count(*) FILTER (WHERE flight_key IS NULL) AS flight_key_nulls,
                  count(*) FILTER (WHERE date_key IS NULL) AS date_key_nulls FROM fact_baggage_operations"""
    ),
)
def _(spark, sf):
    facts = ModelTables(spark, sf, FACT_BUILDERS)
    return Q.fk_null_counts(facts["fact_baggage_operations"], ["flight_key", "date_key"])


@query(
    "fk_containment",
    f"""SELECT l_orderkey, l_suppkey FROM {dirty_sql('lineitem_bad_supplier')} l
        WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def _(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    lines = dirty(spark, sf, "lineitem_bad_supplier").select("l_orderkey", "l_suppkey")
    return Q.fk_containment(lines, suppliers, "l_suppkey")


@query(
    "fk_containment_dates",
    with_tables(
        """SELECT 'fact_passenger_feedback' AS fact, count(*) AS missing FROM fact_passenger_feedback
           WHERE date_key IS NOT NULL AND date_key NOT IN (SELECT date_key FROM dim_date)"""
    ),
)
def _(spark, sf):
    m = model(spark, sf)
    missing = Q.fk_containment(m.facts["fact_passenger_feedback"], m.dimensions["dim_date"], "date_key")
    return missing.agg(F.count(F.lit(1)).alias("missing")).select(
        F.lit("fact_passenger_feedback").alias("fact"), "missing"
    )


@query(
    "grain_uniqueness",
    with_tables(
        f"""SELECT bag_event_id, count(*) AS row_count FROM fact_baggage_operations
            GROUP BY ALL HAVING count(*) > 1"""
    ),
)
def _(spark, sf):
    return Q.grain_uniqueness(ModelTables(spark, sf, FACT_BUILDERS)["fact_baggage_operations"], ["bag_event_id"])
