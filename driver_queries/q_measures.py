"""Measures: aggregates over the driver tables, and the whole registry over the airport model."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.airport_tables import model, sql_key, with_tables
from driver_queries.registry import f, n, query, t, table
from skyledger.functions.numeric import blank_if_zero, div, div0, weighted_avg
from skyledger.operators.facts import Lookup, lookup_keys
from skyledger.plans import airport
from skyledger.plans.measures import MEASURES, TARGET_CARDS, drill_across, evaluate, long_form
from skyledger.plans.targets import kpi_vs_target, target_asof

STATUS = "CASE l_returnflag WHEN 'A' THEN 'On Time' WHEN 'R' THEN 'Delayed' ELSE 'Cancelled' END"


@query(
    "on_time_by_carrier",
    f"""SELECT n_name AS carrier, count(*) AS total_flights, count(*) FILTER (WHERE l_returnflag = 'A') AS on_time_flights,
        {f("count(*) FILTER (WHERE l_returnflag = 'A') / CAST(count(*) AS DOUBLE)")} AS on_time_performance
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
        GROUP BY ALL""",
)
def _(spark, sf):
    flights = table(spark, sf, "lineitem").select("l_suppkey", F.expr(STATUS).alias("status"))
    # Counted per supplier first: only the counts are joined to the carriers, not the flights.
    counts = flights.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("total_flights"), F.count_if(F.col("status") == "On Time").alias("on_time_flights")
    )
    keyed = lookup_keys(
        counts,
        [
            Lookup(table(spark, sf, "supplier"), "l_suppkey", "s_nationkey", "s_suppkey", unique=True),
            Lookup(table(spark, sf, "nation"), "s_nationkey", "n_name", "n_nationkey"),
        ],
    )
    return (
        keyed.groupBy(F.col("n_name").alias("carrier"))
        .agg(F.sum("total_flights").alias("total_flights"), F.sum("on_time_flights").alias("on_time_flights"))
        .withColumn("on_time_performance", div0(F.col("on_time_flights"), F.col("total_flights")))
        .orderBy(F.desc("on_time_performance"), "carrier")
    )


@query(
    "simple_agg",
    f"""SELECT l_returnflag, count(*) AS row_count, {f('sum(l_quantity)')} AS total_quantity,
        {f('avg(l_quantity)')} AS avg_quantity, {f('max(l_extendedprice)')} AS max_price FROM lineitem GROUP BY ALL""",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("l_quantity").alias("total_quantity"),
        F.avg("l_quantity").alias("avg_quantity"),
        F.max("l_extendedprice").alias("max_price"),
    )


@query(
    "conditional_agg",
    f"""SELECT l_linestatus, count(*) AS total, count(*) FILTER (WHERE l_returnflag = 'A') AS on_time,
        count(*) FILTER (WHERE l_returnflag = 'R') AS delayed,
        {f("sum(l_quantity) FILTER (WHERE l_returnflag = 'R')")} AS delayed_quantity FROM lineitem GROUP BY ALL""",
)
def _(spark, sf):
    delayed = F.col("l_returnflag") == "R"
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("l_returnflag") == "A").alias("on_time"),
        F.count_if(delayed).alias("delayed"),
        F.sum(F.when(delayed, F.col("l_quantity"))).alias("delayed_quantity"),
    )


@query(
    "ratio_measure",
    f"""SELECT l_suppkey, {f('CASE WHEN coalesce(refunds, 0) = 0 THEN 0 ELSE total / refunds END')} AS alternate_ratio,
        {f('total / nullif(refunds, 0)')} AS plain_ratio
        FROM (SELECT l_suppkey, sum(l_quantity) AS total,
                nullif(count(*) FILTER (WHERE l_tax = 0 AND l_discount = 0), 0) AS refunds FROM lineitem GROUP BY ALL)""",
)
def _(spark, sf):
    sums = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("total"),
        blank_if_zero(F.count_if((F.col("l_tax") == 0) & (F.col("l_discount") == 0))).alias("refunds"),
    )
    return sums.select(
        "l_suppkey",
        div0(F.col("total"), F.col("refunds")).alias("alternate_ratio"),
        div(F.col("total"), F.col("refunds")).alias("plain_ratio"),
    )


@query(
    "weighted_avg",
    f"""SELECT event_type, {f('sum(value * k) / nullif(sum(CASE WHEN k IS NOT NULL THEN k END), 0)')} AS weighted_value
        FROM (SELECT event_type, CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS value, user_id % 40 AS k
              FROM events) GROUP BY ALL""",
)
def _(spark, sf):
    value = F.when(F.col("event_id") % 97 != 0, F.col("value"))
    return table(spark, sf, "events").groupBy("event_type").agg(
        weighted_avg(value, F.col("user_id") % 40).alias("weighted_value")
    )


@query(
    "avg_of_group_sums",
    f"""SELECT event_type, {f('avg(users)')} AS avg_users_per_hour FROM
        (SELECT event_type, CAST(ts AS DATE) AS d, hour(ts) AS h, sum(user_id) AS users FROM events GROUP BY ALL)
        GROUP BY ALL""",
)
def _(spark, sf):
    hourly = table(spark, sf, "events").groupBy(
        "event_type", F.to_date("ts").alias("d"), F.hour("ts").alias("h")
    ).agg(F.sum("user_id").alias("users"))
    return hourly.groupBy("event_type").agg(F.avg("users").alias("avg_users_per_hour"))


@query(
    "refund_measures",
    f"""SELECT c_mktsegment, {f('sum(c_acctbal) FILTER (WHERE c_acctbal < 0)', 2)} AS refund_amount,
        nullif(count(*) FILTER (WHERE c_acctbal < 0), 0) AS refund_rows,
        {f('nullif(count(*) FILTER (WHERE c_acctbal < 0), 0) / CAST(count(*) AS DOUBLE)', 2)} AS refund_rate
        FROM customer GROUP BY ALL""",
    digits=2,
)
def _(spark, sf):
    negative = F.col("c_acctbal") < 0
    sums = table(spark, sf, "customer").groupBy("c_mktsegment").agg(
        F.sum(F.when(negative, F.col("c_acctbal"))).alias("refund_amount"),
        blank_if_zero(F.count_if(negative)).alias("refund_rows"),
        F.count(F.lit(1)).alias("__rows"),
    )
    return sums.withColumn("refund_rate", div0(F.col("refund_rows"), F.col("__rows"))).drop("__rows")


@query(
    "drill_across",
    f"""SELECT {t('coalesce(o.d, l.d)')} AS "date", order_count, line_quantity,
        {f('CASE WHEN coalesce(line_quantity, 0) = 0 THEN 0 ELSE order_count / line_quantity END')} AS orders_per_unit
        FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS order_count FROM orders GROUP BY ALL) o
        FULL OUTER JOIN (SELECT CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS line_quantity FROM lineitem GROUP BY ALL) l
        ON o.d = l.d""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date"))
    lines = table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("date"))
    both = drill_across(
        [orders.agg(F.count(F.lit(1)).alias("order_count")), lines.agg(F.sum("l_quantity").alias("line_quantity"))],
        ["date"],
    )
    return both.withColumn("orders_per_unit", div0(F.col("order_count"), F.col("line_quantity")))


# Flights know date and airline; revenue and passenger flow know the date only.
FLIGHTS_BY_DAY = """(SELECT "date", airline_name, count(*) AS flights, count(*) FILTER (WHERE status = 'On Time') AS on_time
    FROM fact_flight_operations LEFT JOIN dim_date USING (date_key) LEFT JOIN dim_airline USING (airline_key) GROUP BY ALL)"""
REVENUE_BY_DAY = """(SELECT "date", sum(amount_cad) AS revenue FROM fact_commercial_transactions
    LEFT JOIN dim_date USING (date_key) GROUP BY ALL)"""
FLOW_BY_DAY = """(SELECT "date", sum(passengers_processed) AS passengers FROM fact_passenger_flow
    LEFT JOIN dim_date USING (date_key) GROUP BY ALL)"""


@query(
    "drill_across_partial",
    with_tables(f"""SELECT {t('x."date"')} AS "date", airline_name, {n('flights')} AS total_flights,
        {f('nullif(on_time, 0) / CAST(flights AS DOUBLE)', 4)} AS on_time, {f('revenue', 4)} AS revenue
        FROM {FLIGHTS_BY_DAY} x LEFT JOIN {REVENUE_BY_DAY} y ON x."date" IS NOT DISTINCT FROM y."date\""""),
    digits=4,
)
def _(spark, sf):
    names = ["Total Flights", "On-Time Performance %", "Total Commercial Revenue"]
    by = [("dim_date", "date"), ("dim_airline", "airline_name")]
    result = evaluate(model(spark, sf), names, by)
    return result.toDF("date", "airline_name", "total_flights", "on_time", "revenue").withColumn("revenue", F.col("revenue").cast("double"))


@query(
    "drill_across_partial_derived",
    with_tables(f"""SELECT {t('x."date"')} AS "date", airline_name, {n('flights')} AS total_flights,
        {n('passengers')} AS passengers, {f('CASE WHEN coalesce(passengers, 0) = 0 THEN 0 ELSE revenue / passengers END', 4)} AS revenue_per_passenger
        FROM {FLIGHTS_BY_DAY} x LEFT JOIN {REVENUE_BY_DAY} y ON x."date" IS NOT DISTINCT FROM y."date"
        LEFT JOIN {FLOW_BY_DAY} z ON x."date" IS NOT DISTINCT FROM z."date\""""),
    digits=4,
)
def _(spark, sf):
    names = ["Total Flights", "Total Passengers Processed", "Revenue per Passenger"]
    by = [("dim_date", "date"), ("dim_airline", "airline_name")]
    result = evaluate(model(spark, sf), names, by)
    return result.toDF("date", "airline_name", "total_flights", "passengers", "revenue_per_passenger")


# Targets derived from the parts: one open or closed period per part, a KPI code per brand.
PART_TARGETS = [
    ("kpi_name", "p_name || ' ' || CAST(p_partkey AS STRING)"),
    ("kpi_code", "upper(p_brand)"),
    ("business_area", "' ' || p_type"),
    ("unit", "CASE WHEN p_size % 2 = 0 THEN 'minutes' ELSE '%' END"),
    ("target_value", "CAST(p_size AS STRING) || '.5'"),
    ("target_direction", "CASE WHEN p_partkey % 2 = 0 THEN '>=' ELSE '<=' END"),
    ("effective_start_date", "CAST(DATE '1995-01-01' + CAST(p_partkey % 900 AS INT) AS STRING)"),
    (
        "effective_end_date",
        "CASE WHEN p_partkey % 4 = 0 THEN NULL "
        "ELSE CAST(DATE '1995-01-01' + CAST(p_partkey % 900 + p_size * 20 AS INT) AS STRING) END",
    ),
]
PART_TARGETS_SQL = f"""(SELECT kpi_name, kpi_code, trim(business_area) AS business_area, unit,
    CAST(target_value AS DOUBLE) AS target_value, target_direction, CAST(effective_start_date AS DATE) AS effective_start_date,
    CAST(effective_end_date AS DATE) AS effective_end_date
    FROM (SELECT {', '.join(f'{expr} AS {name}' for name, expr in PART_TARGETS)} FROM part))"""


def part_targets(spark, sf):
    rows = table(spark, sf, "part").selectExpr(*[f"{expr} AS {name}" for name, expr in PART_TARGETS])
    return airport.clean_targets(rows)


@query(
    "build_targets",
    f"""SELECT {sql_key('ot', 'kpi_name, effective_start_date')} AS target_key, * REPLACE (
        {f('target_value')} AS target_value, {t('effective_start_date')} AS effective_start_date,
        {t('effective_end_date')} AS effective_end_date) FROM {PART_TARGETS_SQL}""",
)
def _(spark, sf):
    return airport.build_targets(part_targets(spark, sf))


ORDER_DAYS = "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"


@query(
    "target_asof",
    f"""SELECT {t('d')} AS "date", kpi_code, {f('max(target_value)')} AS target_value FROM {ORDER_DAYS}
        JOIN {PART_TARGETS_SQL} ON effective_start_date <= d AND (effective_end_date IS NULL OR effective_end_date >= d)
        GROUP BY ALL""",
)
def _(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"))
    return target_asof(days, "date", part_targets(spark, sf))


def _versus_sql(blank_as_zero: bool) -> str:
    a, g = ("coalesce(actual, 0)", "coalesce(target_value, 0)") if blank_as_zero else ("actual", "target_value")
    variance = f"{a} - {g}"
    if blank_as_zero:
        variance = f"CASE WHEN actual IS NOT NULL OR target_value IS NOT NULL THEN {variance} END"
    return f"""WITH goals AS (SELECT kpi_code, max(target_value) AS target_value, min(target_direction) AS target_direction
            FROM {PART_TARGETS_SQL} GROUP BY ALL),
        actuals AS (SELECT upper(p_brand) AS kpi_code, avg(CASE WHEN p_brand NOT LIKE '%3' THEN l_quantity END) AS actual
            FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY ALL)
        SELECT kpi_code, {f('actual')} AS actual, {f('target_value')} AS target_value, target_direction,
            {f(variance)} AS variance,
            CASE WHEN (CASE target_direction WHEN '>=' THEN {a} >= {g} ELSE {a} <= {g} END) THEN 'Met'
                 WHEN NOT (CASE target_direction WHEN '>=' THEN {a} >= {g} ELSE {a} <= {g} END) THEN 'Not Met'
                 END AS target_status
        FROM goals LEFT JOIN actuals USING (kpi_code)"""


def _versus(spark, sf, blank_as_zero):
    goals = part_targets(spark, sf).groupBy("kpi_code").agg(
        F.max("target_value").alias("target_value"), F.min("target_direction").alias("target_direction")
    )
    # One row per part before the join, so a part with most of the lines is no hot key.
    lines = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("quantity"), F.count("l_quantity").alias("lines")
    )
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.upper("p_brand").alias("kpi_code"))
    # Some brands were not measured: their actuals are blank.
    measured = ~F.col("kpi_code").endswith("3")
    actuals = parts.join(lines, "l_partkey", "left").groupBy("kpi_code").agg(
        F.try_divide(F.sum(F.when(measured, F.col("quantity"))), F.sum(F.when(measured, F.col("lines")))).alias("actual")
    )
    return kpi_vs_target(goals.join(actuals, "kpi_code", "left"), blank_as_zero=blank_as_zero).select(
        "kpi_code", "actual", "target_value", "target_direction", "variance", "target_status"
    )


@query("kpi_vs_target", _versus_sql(False))
def _(spark, sf):
    return _versus(spark, sf, False)


@query("kpi_vs_target_blank_as_zero", _versus_sql(True))
def _(spark, sf):
    return _versus(spark, sf, True)


@query(
    "unused_targets",
    f"""SELECT DISTINCT kpi_code FROM {PART_TARGETS_SQL} WHERE kpi_code NOT IN
        (SELECT upper(p_brand) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 49 AND l_tax > 0.07)""",
)
def _(spark, sf):
    used = (
        table(spark, sf, "lineitem")
        .filter("l_quantity > 49 AND l_tax > 0.07")
        .select(F.col("l_partkey").alias("p_partkey"))
        .join(table(spark, sf, "part").select("p_partkey", F.upper("p_brand").alias("kpi_code")), "p_partkey")
        .select("kpi_code")
        .distinct()
    )
    return part_targets(spark, sf).select("kpi_code").distinct().join(used, "kpi_code", "left_anti")


# ---------------------------------------------------------------- SQL text of the registry's measures


def _ratio0(a: str, b: str) -> str:
    return f"CASE WHEN coalesce({b}, 0) = 0 THEN 0 ELSE {a} / CAST({b} AS DOUBLE) END"


def _blank(count: str) -> str:
    return f"nullif({count}, 0)"


# fact: measure -> aggregate over the fact with its dimensions joined
FACT_SQL: dict[str, dict[str, str]] = {
    "fact_flight_operations": {
        "Total Flights": _blank("count(*)"),
        "Total Passengers": "sum(passenger_count)",
        "Total Seat Capacity": "sum(seat_capacity)",
        "Load Factor %": _ratio0("sum(passenger_count)", "sum(seat_capacity)"),
        "Delayed Flights": _blank("count(*) FILTER (WHERE status = 'Delayed')"),
        "Cancelled Flights": _blank("count(*) FILTER (WHERE status = 'Cancelled')"),
        "On-Time Flights": _blank("count(*) FILTER (WHERE status = 'On Time')"),
        "On-Time Performance %": _ratio0(_blank("count(*) FILTER (WHERE status = 'On Time')"), "count(*)"),
        "Cancellation Rate %": _ratio0(_blank("count(*) FILTER (WHERE status = 'Cancelled')"), "count(*)"),
        "Average Delay Minutes": "avg(delay_minutes)",
    },
    "fact_passenger_flow": {
        "Total Passengers Processed": "sum(passengers_processed)",
        "Average Security Wait Time": "sum(avg_security_wait_min * passengers_processed) / nullif(sum(passengers_processed), 0)",
        "Maximum Security Wait Time": "max(avg_security_wait_min)",
    },
    "fact_baggage_operations": {
        "Total Bags Processed": "sum(bags_processed)",
        "Mishandled Bags": "sum(mishandled_bags)",
        "Mishandled Baggage Rate %": _ratio0("sum(mishandled_bags)", "sum(bags_processed)"),
        "Average First Bag Time": "avg(first_bag_min)",
        "Average Last Bag Time": "avg(last_bag_min)",
    },
    "fact_commercial_transactions": {
        "Total Commercial Revenue": "sum(amount_cad)",
        "Total Transactions": _blank("count(*)"),
        "Average Transaction Value": "avg(amount_cad)",
        "Refund Adjustment Amount": "sum(amount_cad) FILTER (WHERE amount_cad < 0)",
        "Refund Adjustment Transactions": _blank("count(*) FILTER (WHERE amount_cad < 0)"),
        "Refund Adjustment Rate %": _ratio0(_blank("count(*) FILTER (WHERE amount_cad < 0)"), "count(*)"),
    },
    "fact_sustainability_daily": {
        "Total Electricity Consumption": "sum(electricity_kwh)",
        "Average Daily Electricity Consumption": "avg(electricity_kwh)",
        "Total Water Consumption": "sum(water_m3)",
        "Average Daily Water Consumption": "avg(water_m3)",
        "Total Waste Generated": "sum(waste_tonnes)",
        "Total Estimated CO2e Emissions": "sum(estimated_co2e_tonnes)",
    },
    "fact_passenger_feedback": {
        "Total Feedback": _blank("count(*)"),
        "Undated Feedback": _blank("count(*) FILTER (WHERE date_key IS NULL)"),
        "Feedback with Valid Date": _blank("count(*) FILTER (WHERE date_key IS NOT NULL)"),
        "Dated Feedback Rate %": _ratio0(_blank("count(*) FILTER (WHERE date_key IS NOT NULL)"), "count(*)"),
    },
}
TARGET_CODES = {
    "Average Delay Target": "AVG_DELAY",
    "On-Time Performance Target": "ON_TIME_PERFORMANCE",
    "Security Wait Time Target": "SECURITY_WAIT_TIME",
    "Average Last Bag Time Target": "LAST_BAG_TIME",
    "Revenue per Passenger Target": "REVENUE_PER_PASSENGER",
    "Energy per Passenger Target": "ENERGY_PER_PASSENGER",
}
CROSS_FACT = {
    "Revenue per Passenger": ("Total Commercial Revenue", "Total Passengers Processed"),
    "Energy per Passenger": ("Total Electricity Consumption", "Total Passengers Processed"),
}
STATUS_DIRECTION = {
    "Average Delay Minutes": "<=",
    "On-Time Performance %": ">=",
    "Average Security Wait Time": "<=",
    "Average Last Bag Time": "<=",
    "Revenue per Passenger": ">=",
    "Energy per Passenger": "<=",
}


def totals_sql(where: str = "TRUE") -> str:
    """One row ``totals`` with every measure over the whole model, or over the dates of ``where``.

    ``where`` is a condition on a column ``d`` of dates.
    """
    keys = "" if where == "TRUE" else f" WHERE date_key IN (SELECT date_key FROM dim_date WHERE {where.replace('d ', chr(34) + 'date' + chr(34) + ' ')})"
    facts = []
    for fact, measures in FACT_SQL.items():
        columns = ", ".join(f'{body} AS "{name}"' for name, body in measures.items())
        facts.append(f"(SELECT {columns} FROM {fact}{keys})")
    facts.append(
        f"""(SELECT avg(p) AS "Average Passengers per Hour" FROM (SELECT date_key, "hour",
            sum(passengers_processed) AS p FROM fact_passenger_flow{keys} GROUP BY ALL))"""
    )
    targets = ", ".join(
        f"""max(target_value) FILTER (WHERE kpi_code = '{code}') AS "{name}" """ for name, code in TARGET_CODES.items()
    )
    condition = where.replace("d ", '"date" ')
    facts.append(
        f"""(SELECT {targets} FROM c_operational_targets,
            (SELECT max("date") AS as_of FROM dim_date WHERE {condition})
            WHERE effective_start_date <= as_of AND (effective_end_date IS NULL OR effective_end_date >= as_of))"""
    )
    base = "SELECT * FROM " + " CROSS JOIN ".join(facts)
    cross = ", ".join(
        f'{_ratio0(chr(34) + a + chr(34), chr(34) + b + chr(34))} AS "{name}"' for name, (a, b) in CROSS_FACT.items()
    )
    versus = []
    for actual, (target, variance, status) in TARGET_CARDS.items():
        versus.append(f'"{actual}" - "{target}" AS "{variance}"')
        versus.append(
            f"""CASE WHEN "{actual}" {STATUS_DIRECTION[actual]} "{target}" THEN 'Met'
                WHEN "{actual}" IS NOT NULL AND "{target}" IS NOT NULL THEN 'Not Met' END AS "{status}" """
        )
    return f"SELECT *, {', '.join(versus)} FROM (SELECT *, {cross} FROM ({base}))"


def _all_measures_sql(digits: int, where: str = "TRUE") -> str:
    rows = []
    for name in MEASURES:
        if name.endswith("Status"):
            rows.append(f"""SELECT '{name}' AS measure, CAST(NULL AS DOUBLE) AS value, "{name}" AS text_value FROM totals""")
        else:
            rows.append(f"""SELECT '{name}' AS measure, {f(f'"{name}"', digits)} AS value, NULL AS text_value FROM totals""")
    return with_tables(" UNION ALL ".join(rows), totals=totals_sql(where))


@query("measures_all", _all_measures_sql(4), digits=4)
def _(spark, sf):
    names = list(MEASURES)
    return long_form(evaluate(model(spark, sf), names), [], names)


RATIOS = {"Load Factor %", "On-Time Performance %", "Cancellation Rate %", "Mishandled Baggage Rate %",
          "Refund Adjustment Rate %", "Dated Feedback Rate %"}


def grouped_sql(
    fact: str, measures: list[str], key: str, joins: str = "", digits: int = 4, where: str = "TRUE", members: str = ""
) -> str:
    """Measures per ``key``. ``members`` selects the key of every member of its dimension; where a
    ratio with alternate 0 is asked for, members without a fact row have 0 for it."""
    columns = ", ".join(f"{f(FACT_SQL[fact][name], digits)} AS \"{name}\"" for name in measures)
    alias = key.split(" AS ")[-1] if " AS " in key and "(" not in key.split(" AS ")[-1] else key
    if not members or not RATIOS.intersection(measures):
        groups = f"SELECT {key}, {columns} FROM {fact} {joins} WHERE {where} GROUP BY ALL"
        return with_tables(f"SELECT * FROM ({groups}) WHERE {_any_value(measures)}")
    groups = f"SELECT {key}, TRUE AS present, {columns} FROM {fact} {joins} WHERE {where} GROUP BY ALL"
    filled = ", ".join(
        f'CASE WHEN present IS NULL THEN 0.0 ELSE "{name}" END AS "{name}"' if name in RATIOS else f'"{name}"'
        for name in measures
    )
    return with_tables(
        f"""SELECT * FROM (SELECT coalesce(g.{alias}, m.{alias}) AS {alias}, {filled} FROM ({groups}) g
            FULL OUTER JOIN (SELECT DISTINCT {members}) m ON g.{alias} = m.{alias}) WHERE {_any_value(measures)}"""
    )


def _any_value(measures: list[str]) -> str:
    return " OR ".join(f'"{name}" IS NOT NULL' for name in measures)


DATE_MEMBERS = f"""{t('"date"')} AS "date" FROM dim_date"""
AIRLINE_MEMBERS = "airline_name FROM dim_airline"
DATE_JOIN = "LEFT JOIN dim_date USING (date_key)"
DATE_COLUMN = f"""{t('dim_date."date"')} AS "date\""""

for _name, _fact in [
    ("measures_flights_by_date", "fact_flight_operations"),
    ("measures_baggage_by_date", "fact_baggage_operations"),
    ("measures_commercial_by_date", "fact_commercial_transactions"),
    ("measures_sustainability_by_date", "fact_sustainability_daily"),
    ("measures_feedback_by_date", "fact_passenger_feedback"),
    ("measures_flow_by_date", "fact_passenger_flow"),
]:

    def _by_date(spark, sf, fact=_fact):
        names = list(FACT_SQL[fact])
        result = evaluate(model(spark, sf), names, by=[("dim_date", "date")])
        return result.select("date", *[F.col(f"`{name}`").cast("double").alias(name) for name in names])

    query(
        _name, grouped_sql(_fact, list(FACT_SQL[_fact]), DATE_COLUMN, DATE_JOIN, members=DATE_MEMBERS), digits=4
    )(_by_date)


@query(
    "measures_flights_by_airline",
    grouped_sql(
        "fact_flight_operations",
        list(FACT_SQL["fact_flight_operations"]),
        "airline_name",
        "LEFT JOIN dim_airline USING (airline_key)",
        members=AIRLINE_MEMBERS,
    ),
    digits=4,
)
def _(spark, sf):
    names = list(FACT_SQL["fact_flight_operations"])
    result = evaluate(model(spark, sf), names, by=[("dim_airline", "airline_name")])
    return result.select("airline_name", *[F.col(f"`{name}`").cast("double").alias(name) for name in names])


@query(
    "measures_targets_by_month",
    with_tables(
        f"""SELECT {n('y')} AS "year", {n('m')} AS "month", {f('delay', 4)} AS "Average Delay Minutes", {f('goal', 4)} AS "Average Delay Target",
            {f('delay - goal', 4)} AS "Average Delay Variance",
            CASE WHEN delay <= goal THEN 'Met' WHEN delay > goal THEN 'Not Met' END AS "Average Delay Target Status"
            FROM (SELECT DISTINCT "year" AS y, "month" AS m FROM dim_date)
            LEFT JOIN (SELECT "year" AS y, "month" AS m, avg(delay_minutes) AS delay FROM fact_flight_operations
                  JOIN dim_date USING (date_key) GROUP BY ALL) USING (y, m)
            LEFT JOIN (SELECT "year" AS y, "month" AS m, max(target_value) AS goal FROM
                  (SELECT "year", "month", max("date") AS as_of FROM dim_date GROUP BY ALL) JOIN c_operational_targets
                  ON effective_start_date <= as_of AND (effective_end_date IS NULL OR effective_end_date >= as_of)
                  WHERE kpi_code = 'AVG_DELAY' GROUP BY ALL) USING (y, m)"""
    ),
    digits=4,
)
def _(spark, sf):
    names = ["Average Delay Minutes", *TARGET_CARDS["Average Delay Minutes"]]
    return evaluate(model(spark, sf), names, by=[("dim_date", "year"), ("dim_date", "month")])

