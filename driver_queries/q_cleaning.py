"""Cleaning operators on faulty views of the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.airport_tables import cleaned, landed, with_tables
from driver_queries.dirty import dirty, dirty_sql
from driver_queries.registry import f, n, query, t, table
from skyledger.operators import clean as C


@query(
    "standardize_values",
    f"""SELECT event_id, CASE WHEN event_type = 'PUR' THEN 'purchase' ELSE event_type END AS event_type
        FROM {dirty_sql('events_variant_type')}""",
)
def _(spark, sf):
    events = dirty(spark, sf, "events_variant_type").select("event_id", "event_type")
    return C.standardize_values(events, "event_type", {"PUR": "purchase"})


@query(
    "standardize_values_from_table",
    """SELECT o_orderkey, coalesce(v.canonical, o_orderpriority) AS o_orderpriority FROM orders
       LEFT JOIN (SELECT DISTINCT o_orderpriority AS variant, substr(o_orderpriority, 3) AS canonical FROM orders
                  WHERE o_orderpriority <> '5-LOW') v ON o_orderpriority = v.variant""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    mapping = (
        orders.filter("o_orderpriority <> '5-LOW'")
        .select(F.col("o_orderpriority").alias("variant"), F.expr("substr(o_orderpriority, 3)").alias("canonical"))
        .distinct()
    )
    return C.standardize_values(orders, "o_orderpriority", mapping)


@query(
    "null_invalid_refs",
    f"""SELECT l_orderkey, l_partkey, CASE WHEN l_suppkey = -1 THEN NULL ELSE l_suppkey END AS l_suppkey
        FROM {dirty_sql('lineitem_bad_supplier')}""",
)
def _(spark, sf):
    lines = dirty(spark, sf, "lineitem_bad_supplier").select("l_orderkey", "l_partkey", "l_suppkey")
    return C.null_invalid_refs(lines, "l_suppkey", reference=table(spark, sf, "supplier"), reference_key="s_suppkey")


@query(
    "fill_from_column",
    f"""SELECT event_id, {f("CASE WHEN value IS NULL AND event_type = 'view' THEN 0 ELSE value END")} AS value
        FROM {dirty_sql('events_null_value')}""",
)
def _(spark, sf):
    events = dirty(spark, sf, "events_null_value").select("event_id", "event_type", "value")
    filled = C.fill_from_column(events, "value", F.col("event_type") == "view", F.lit(0.0))
    return filled.select("event_id", "value")


@query(
    "cast_columns",
    f"""SELECT event_id, {t('TRY_CAST(ts AS DATE)')} AS ts FROM {dirty_sql('events_bad_ts')}""",
)
def _(spark, sf):
    return C.cast_columns(dirty(spark, sf, "events_bad_ts").select("event_id", "ts"), {"ts": "date"})


@query(
    "cast_columns_numbers",
    with_tables(
        f"""SELECT {t('"date"')} AS "date", {n('"hour"')} AS "hour", terminal_zone, traffic_type,
            {n('passengers_processed')} AS passengers_processed, {f('avg_security_wait_min')} AS avg_security_wait_min
            FROM c_passenger_flow"""
    ),
)
def _(spark, sf):
    return cleaned(spark, sf, "passenger_flow")


DAILY = f"""SELECT CAST(ts AS DATE) AS "date", sum(value) AS total FROM {dirty_sql('events_null_value')} GROUP BY ALL"""
HOURLY = f"""SELECT event_type, date_trunc('hour', ts) AS "hour", sum(CAST(user_id AS DOUBLE)) AS total
    FROM events GROUP BY ALL"""
NEIGHBOURS = """last_value(total IGNORE NULLS) OVER ({p}ORDER BY {o} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    AS before, first_value(total IGNORE NULLS) OVER ({p}ORDER BY {o} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
    AS after"""


@query(
    "impute_neighbour_mean",
    f"""WITH d AS (SELECT "date", CASE WHEN day("date") % 7 < 2 THEN NULL ELSE total END AS total FROM ({DAILY})),
        w AS (SELECT *, {NEIGHBOURS.format(p='', o='"date"')} FROM d)
        SELECT {t('"date"')} AS "date", {f('CASE WHEN total IS NULL THEN (before + after) / 2 ELSE total END')} AS total
        FROM w""",
)
def _(spark, sf):
    events = dirty(spark, sf, "events_null_value")
    daily = events.groupBy(F.to_date("ts").alias("date")).agg(F.sum("value").alias("total"))
    gaps = daily.withColumn("total", F.when(F.dayofmonth("date") % 7 >= 2, F.col("total")))
    return C.impute_neighbour_mean(gaps, ["date"], "total")


@query(
    "impute_neighbour_mean_series",
    f"""WITH d AS (SELECT event_type, "hour", CASE WHEN (hour("hour") + day("hour")) % 3 = 0 THEN NULL ELSE total END
            AS total FROM ({HOURLY})),
        w AS (SELECT *, {NEIGHBOURS.format(p='PARTITION BY event_type ', o='"hour"')} FROM d)
        SELECT event_type, {t('"hour"')} AS "hour",
            {f('CASE WHEN total IS NULL THEN (before + after) / 2 ELSE total END')} AS total FROM w""",
)
def _(spark, sf):
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("hour")
    hourly = (
        table(spark, sf, "events")
        .groupBy("event_type", hour)
        .agg(F.sum(F.col("user_id").cast("double")).alias("total"))
    )
    gaps = hourly.withColumn("total", F.when((F.hour("hour") + F.dayofmonth("hour")) % 3 != 0, F.col("total")))
    return C.impute_neighbour_mean(gaps, ["hour"], "total", series=["event_type"])


@query(
    "impute_neighbour_mean_rows",
    f"""WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS total FROM events),
        w AS (SELECT *, {NEIGHBOURS.format(p='', o='event_id')} FROM e)
        SELECT event_id, {f('CASE WHEN total IS NULL THEN (before + after) / 2 ELSE total END')} AS total FROM w""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("total")
    )
    return C.impute_neighbour_mean(events, ["event_id"], "total")


PROPS = "struct<k: bigint>"


@query(
    "flatten_struct",
    "SELECT event_id, event_type, TRY_CAST(regexp_extract(props, '\"k\": (\\d+)', 1) AS BIGINT) AS k FROM events",
)
def _(spark, sf):
    nested = table(spark, sf, "events").select(
        "event_id", F.struct("event_type", F.from_json("props", PROPS).alias("props")).alias("detail")
    )
    return C.flatten_struct(nested, {"event_id": "event_id", "detail.event_type": "event_type", "detail.props.k": "k"})


@query("rename_positional", "SELECT conv_id AS thread_id, turn AS position, role AS speaker FROM conversations")
def _(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return C.rename_positional(rows, ["thread_id", "position", "speaker"])


@query(
    "drop_blank_text",
    f"""SELECT conv_id, turn, text FROM {dirty_sql('conversations_blank_text')}
        WHERE text IS NOT NULL AND trim(text) <> ''""",
)
def _(spark, sf):
    return C.drop_blank_text(dirty(spark, sf, "conversations_blank_text").select("conv_id", "turn", "text"), "text")


POLICY = ["actual_time", "delay_minutes", "passenger_count", "gate_id"]


@query(
    "keep_business_nulls",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{stage}' AS stage, count(*) AS row_count, "
            + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in POLICY)
            + f" FROM {source}"
            for stage, source in (("before", "l_flights"), ("after", "c_flights"))
        )
    ),
)
def _(spark, sf):
    return C.null_policy_report(landed(spark, sf, "flights"), cleaned(spark, sf, "flights"), POLICY)


def _cleaned_query(name: str, select: str) -> None:
    @query(f"clean_{name}", with_tables(f"SELECT {select} FROM c_{name}"))
    def _(spark, sf):
        return cleaned(spark, sf, name)


_cleaned_query(
    "flights",
    f"""* REPLACE ({t('scheduled_time')} AS scheduled_time, {t('actual_time')} AS actual_time,
        {n('seat_capacity')} AS seat_capacity, {n('passenger_count')} AS passenger_count,
        {n('delay_minutes')} AS delay_minutes, {t('gate_in_time')} AS gate_in_time, {t('gate_out_time')} AS gate_out_time)""",
)
_cleaned_query(
    "commercial_transactions", f"""* REPLACE ({t('"timestamp"')} AS "timestamp", {f('amount_cad')} AS amount_cad)"""
)
_cleaned_query(
    "sustainability_daily",
    f"""{t('"date"')} AS "date", {f('electricity_kwh')} AS electricity_kwh, {f('water_m3')} AS water_m3,
        {f('waste_tonnes')} AS waste_tonnes, {f('estimated_co2e_tonnes')} AS estimated_co2e_tonnes""",
)
_cleaned_query(
    "flight_operational_events",
    f"""* REPLACE ({t('scheduled_time')} AS scheduled_time, {t('actual_time')} AS actual_time,
        {n('delay_minutes')} AS delay_minutes)""",
)
_cleaned_query("baggage_events", "*")
_cleaned_query(
    "passenger_feedback",
    f"{n('feedback_id')} AS feedback_id, {t('feedback_date')} AS feedback_date, feedback_text",
)
