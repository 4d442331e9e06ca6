"""Governed KPI queries over the airport model."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from driver_queries.airport_tables import model, with_tables
from driver_queries.q_measures import FACT_SQL, _ratio0, totals_sql
from driver_queries.registry import f, n, query, t, table
from skyledger.functions.dates import PERIOD_KINDS, make_period
from skyledger.plans import kpi as K
from skyledger.plans import requests as R

MONTH = K.Period("March 1996", date(1996, 3, 1), date(1996, 3, 31))
WEEK = K.Period("First week of March 1996", date(1996, 3, 1), date(1996, 3, 7))
YEAR = K.Period("1997", date(1997, 1, 1), date(1997, 12, 31))
EMPTY = K.Period("August 2026", date(2026, 8, 1), date(2026, 8, 31))


def _where(period: K.Period) -> str:
    return f"d >= DATE '{period.start}' AND d <= DATE '{period.end}'"


def _keys(period: K.Period) -> str:
    return f"""date_key IN (SELECT date_key FROM dim_date WHERE "date" BETWEEN DATE '{period.start}' AND DATE '{period.end}')"""


@query(
    "kpi_lookup",
    with_tables(
        f"""SELECT 'On-Time Performance %' AS metric, 'all available dates' AS period,
                {f('"On-Time Performance %"')} AS value FROM everything
            UNION ALL SELECT 'Energy per Passenger', 'March 1996', {f('"Energy per Passenger"')} FROM one_month""",
        everything=totals_sql(),
        one_month=totals_sql(_where(MONTH)),
    ),
)
def _(spark, sf):
    m = model(spark, sf)
    return K.kpi_lookup(m, "on-time performance %").unionByName(K.kpi_lookup(m, "Energy per Passenger", MONTH))


COMPARED = [MONTH, WEEK, YEAR, EMPTY]


def _compare_sql(metric: str) -> str:
    rows = []
    for number, p in enumerate(COMPARED, start=1):
        rows.append(
            f"""SELECT {n(number)} AS period_no, '{p.label}' AS label, '{p.start}' AS start_date, '{p.end}' AS end_date,
                '{metric}' AS metric, {f(f'"{metric}"', 4)} AS value FROM p{number}"""
        )
    extra = {f"p{number}": totals_sql(_where(p)) for number, p in enumerate(COMPARED, start=1)}
    return with_tables(" UNION ALL ".join(rows), **extra)


@query("kpi_compare", _compare_sql("Average Delay Minutes"), digits=4)
def _(spark, sf):
    return K.kpi_compare(model(spark, sf), "Average Delay Minutes", COMPARED)


def _flights(measure: str) -> str:
    return FACT_SQL["fact_flight_operations"][measure]


@query(
    "kpi_breakdown",
    with_tables(
        f"""SELECT gate_id AS member, {f(_flights('Load Factor %'))} AS value FROM fact_flight_operations
            RIGHT JOIN dim_gate USING (gate_key) GROUP BY ALL HAVING value IS NOT NULL"""
    ),
)
def _(spark, sf):
    return K.kpi_breakdown(model(spark, sf), "Load Factor %", "gate")


@query(
    "kpi_breakdown_period",
    with_tables(
        f"""SELECT airline_name AS member, CASE WHEN count(flight_key) = 0 THEN 0.0
                ELSE {f(_flights('On-Time Performance %'))} END AS value
            FROM (SELECT * FROM fact_flight_operations WHERE {_keys(MONTH)})
            RIGHT JOIN dim_airline USING (airline_key) GROUP BY ALL HAVING value IS NOT NULL"""
    ),
)
def _(spark, sf):
    return K.kpi_breakdown(model(spark, sf), "On-Time Performance %", "airline", MONTH)


@query(
    "kpi_breakdown_unrelated",
    with_tables(
        f"""SELECT DISTINCT airline_name AS member, (SELECT {f('sum(amount_cad)', 2)} FROM fact_commercial_transactions) AS value
            FROM dim_airline"""
    ),
    digits=2,
)
def _(spark, sf):
    return K.kpi_breakdown(model(spark, sf), "Total Commercial Revenue", "airline")


@query(
    "drop_blank_members",
    with_tables(
        f"""SELECT flight_id AS member, {f('avg(delay_minutes)')} AS value FROM fact_flight_operations
            LEFT JOIN dim_flight USING (flight_key) GROUP BY ALL HAVING avg(delay_minutes) IS NOT NULL"""
    ),
)
def _(spark, sf):
    return K.kpi_breakdown(model(spark, sf), "Average Delay Minutes", "flight")


def _ranking_sql(direction: str, key: str, join: str, value: str, fact: str, size: int) -> str:
    return with_tables(
        f"""SELECT member, {f('value')} AS value FROM (
            SELECT *, rank() OVER (ORDER BY value {direction} NULLS LAST) AS place FROM (
                SELECT {key} AS member, {value} AS value FROM {fact} {join} GROUP BY ALL) WHERE value IS NOT NULL)
            WHERE place <= {size}"""
    )


@query(
    "kpi_ranking",
    _ranking_sql(
        "DESC", "airline_name", "LEFT JOIN dim_airline USING (airline_key)",
        _flights("On-Time Performance %"), "fact_flight_operations", 1,
    ),
)
def _(spark, sf):
    return K.kpi_ranking(model(spark, sf), "On-Time Performance %", "airline")


@query(
    "kpi_ranking_lowest",
    _ranking_sql(
        "ASC", "gate_id", "RIGHT JOIN dim_gate USING (gate_key)",
        _flights("Load Factor %"), "fact_flight_operations", 3,
    ),
)
def _(spark, sf):
    return K.kpi_ranking(model(spark, sf), "Load Factor %", "gate", n=3, ascending=True)


@query(
    "kpi_ranking_ties",
    _ranking_sql(
        "DESC", "flight_id", "LEFT JOIN dim_flight USING (flight_key)",
        _flights("Average Delay Minutes"), "fact_flight_operations", 1,
    ),
)
def _(spark, sf):
    return K.kpi_ranking(model(spark, sf), "Average Delay Minutes", "dimflight")


@query(
    "kpi_query",
    with_tables(
        f"""SELECT 'lookup' AS intent, 'Total Bags Processed' AS member,
                {f('(SELECT sum(bags_processed) FROM fact_baggage_operations WHERE ' + _keys(YEAR) + ')')} AS value
            UNION ALL SELECT 'compare', '1997',
                {f('(SELECT sum(bags_processed) FROM fact_baggage_operations WHERE ' + _keys(YEAR) + ')')}
            UNION ALL SELECT 'compare', 'March 1996',
                {f('(SELECT sum(bags_processed) FROM fact_baggage_operations WHERE ' + _keys(MONTH) + ')')}
            UNION ALL SELECT 'breakdown', terminal_zone, {f('sum(passengers_processed)')} FROM fact_passenger_flow
                LEFT JOIN dim_terminal_zone USING (terminal_zone_key) GROUP BY ALL"""
    ),
)
def _(spark, sf):
    m = model(spark, sf)
    lookup = K.kpi_query(m, "lookup", "total bags processed", periods=[YEAR, MONTH])
    compare = K.kpi_query(m, "compare", "Total Bags Processed", periods=[YEAR, MONTH])
    breakdown = K.kpi_query(m, "breakdown", "Total Passengers Processed", "terminal zone")

    def part(intent, df, member):
        return df.select(
            F.lit(intent).alias("intent"), F.col(member).alias("member"), F.col("value").cast("double").alias("value")
        )

    return (
        part("lookup", lookup, "metric")
        .unionByName(part("compare", compare, "label"))
        .unionByName(part("breakdown", breakdown, "member"))
    )


NAME_TEXT = (
    "CASE event_id % 6 WHEN 0 THEN ' On-Time PERFORMANCE % ' WHEN 1 THEN 'total feedback' WHEN 2 THEN 'otp' "
    "WHEN 3 THEN 'Energy per Passenger' WHEN 4 THEN event_type ELSE 'LOAD FACTOR %' END"
)


@query(
    "validate_metric",
    f"""SELECT event_id, CASE lower(trim({NAME_TEXT})) WHEN 'on-time performance %' THEN 'On-Time Performance %'
        WHEN 'total feedback' THEN 'Total Feedback' WHEN 'energy per passenger' THEN 'Energy per Passenger'
        WHEN 'load factor %' THEN 'Load Factor %' END AS metric FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", K.validate_metric(F.expr(NAME_TEXT)).alias("metric"))


DIMENSION_TEXT = (
    "CASE event_id % 6 WHEN 0 THEN 'Airline' WHEN 1 THEN ' terminal zone ' WHEN 2 THEN 'DimGate' "
    "WHEN 3 THEN 'flight' WHEN 4 THEN event_type ELSE 'terminal' END"
)


@query(
    "resolve_dimension",
    f"""SELECT event_id, table_name, column_name FROM (SELECT event_id, lower(trim({DIMENSION_TEXT})) AS spelling FROM events)
        LEFT JOIN (VALUES ('airline', 'dim_airline', 'airline_name'), ('terminal zone', 'dim_terminal_zone', 'terminal_zone'),
            ('terminal', 'dim_terminal_zone', 'terminal_zone'), ('dimgate', 'dim_gate', 'gate_id'),
            ('flight', 'dim_flight', 'flight_id')) AS v(spelling, table_name, column_name) USING (spelling)""",
)
def _(spark, sf):
    resolved = table(spark, sf, "events").select("event_id", K.resolve_dimension(F.expr(DIMENSION_TEXT)).alias("d"))
    return resolved.select(
        "event_id", F.col("d.dimension").alias("table_name"), F.col("d.column").alias("column_name")
    )


KIND_SQL = "CASE o_orderkey % 6 " + " ".join(f"WHEN {i} THEN '{kind}'" for i, kind in enumerate(PERIOD_KINDS)) + " ELSE 'decade' END"


@query(
    "make_period",
    f"""SELECT o_orderkey, kind, kind || ' ' || CAST(year(d) AS VARCHAR) AS label,
        {t('''CASE kind WHEN 'year' THEN make_date(year(d), 1, 1) WHEN 'month' THEN first WHEN 'first_week' THEN first
           WHEN 'last_week' THEN last - 6 WHEN 'end_of_month' THEN last - 6 END''')} AS start_date,
        {t('''CASE kind WHEN 'year' THEN make_date(year(d), 12, 31) WHEN 'month' THEN last WHEN 'first_week' THEN first + 6
           WHEN 'last_week' THEN last WHEN 'end_of_month' THEN last END''')} AS end_date
        FROM (SELECT o_orderkey, {KIND_SQL} AS kind, CAST(o_orderdate AS DATE) AS d,
              CAST(date_trunc('month', o_orderdate) AS DATE) AS first, last_day(CAST(o_orderdate AS DATE)) AS last FROM orders)""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.expr(KIND_SQL).alias("kind"))
    label = F.concat_ws(" ", "kind", F.year("o_orderdate").cast("string"))
    period = make_period(label, F.col("kind"), F.year("o_orderdate"), F.month("o_orderdate"))
    return orders.select("o_orderkey", "kind", period.alias("p")).select("o_orderkey", "kind", "p.*")


@query(
    "kpi_by_period",
    with_tables(
        f"""SELECT label, {t('start_date')} AS start_date, {t('end_date')} AS end_date, 'Revenue per Passenger' AS measure,
            {f(_ratio0('revenue', 'passengers'), 4)} AS value
            FROM (SELECT strftime(first, '%B %Y') AS label, first AS start_date, last_day(first) AS end_date FROM
                  (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS first FROM orders))
            LEFT JOIN (SELECT strftime("date", '%B %Y') AS label, sum(amount_cad) AS revenue FROM fact_commercial_transactions
                JOIN dim_date USING (date_key) GROUP BY ALL) USING (label)
            LEFT JOIN (SELECT strftime("date", '%B %Y') AS label, sum(passengers_processed) AS passengers
                FROM fact_passenger_flow JOIN dim_date USING (date_key) GROUP BY ALL) USING (label)"""
    ),
    digits=4,
)
def _(spark, sf):
    day = F.to_date("o_orderdate")
    first = F.make_date(F.year(day), F.month(day), F.lit(1))
    months = table(spark, sf, "orders").select(first.alias("start_date")).distinct()
    periods = months.select(
        F.date_format("start_date", "MMMM yyyy").alias("label"), "start_date", F.last_day("start_date").alias("end_date")
    )
    return K.kpi_by_period(model(spark, sf), ["Revenue per Passenger"], periods)


# A request per order: each asks for a metric, some by airline or gate, over a period of its own.
ASKED = [
    ("request_id", "o_orderkey"),
    ("period_no", "1"),
    ("intent", "CASE o_orderkey % 4 WHEN 0 THEN 'breakdown' WHEN 1 THEN 'lookup' WHEN 2 THEN 'ranking' ELSE 'lookup' END"),
    ("metric", "CASE o_orderkey % 3 WHEN 0 THEN 'total flights' WHEN 1 THEN 'Load Factor %' ELSE 'Total Commercial Revenue' END"),
    ("dimension", "CASE WHEN o_orderkey % 2 = 0 THEN 'airline' END"),
    ("start_date", "CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderdate AS DATE) END"),
    ("end_date", "CASE WHEN o_orderkey % 7 > 0 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) END"),
    ("size", "CASE WHEN o_orderkey % 8 = 2 THEN 2 END"),
    ("ascending", "o_orderkey % 5 = 0"),
]
DAYS_OF = {
    "asked": f"SELECT {', '.join(f'{e} AS {c}' for c, e in ASKED)} FROM orders",
    "days": """SELECT "date" AS d, airline_name AS member, count(*) AS flights, sum(passenger_count) AS seated, sum(seat_capacity) AS seats
        FROM fact_flight_operations LEFT JOIN dim_date USING (date_key) LEFT JOIN dim_airline USING (airline_key) GROUP BY ALL""",
    "money": """SELECT "date" AS d, sum(amount_cad) AS v FROM fact_commercial_transactions LEFT JOIN dim_date USING (date_key) GROUP BY ALL""",
    "periods": "SELECT DISTINCT start_date, end_date FROM asked",
    "by_airline": """SELECT start_date, end_date, member, sum(flights) AS flights, sum(seated) AS seated, sum(seats) AS seats
        FROM periods JOIN days ON start_date IS NULL OR d BETWEEN start_date AND end_date GROUP BY ALL""",
    "everything": """SELECT start_date, end_date, sum(flights) AS flights, sum(seated) AS seated, sum(seats) AS seats FROM by_airline GROUP BY ALL""",
    "revenue": """SELECT start_date, end_date, sum(v) AS v FROM periods JOIN money ON start_date IS NULL OR d BETWEEN start_date AND end_date GROUP BY ALL""",
    "airlines": "SELECT DISTINCT airline_name AS member FROM dim_airline",
    "single": f"""SELECT a.*, CAST(NULL AS VARCHAR) AS member, CASE metric WHEN 'total flights' THEN CAST(e.flights AS DOUBLE)
            WHEN 'Load Factor %' THEN CASE WHEN coalesce(seats, 0) = 0 THEN 0 ELSE seated / CAST(seats AS DOUBLE) END ELSE v END AS value
        FROM asked a LEFT JOIN everything e ON a.start_date IS NOT DISTINCT FROM e.start_date AND a.end_date IS NOT DISTINCT FROM e.end_date
        LEFT JOIN revenue r ON a.start_date IS NOT DISTINCT FROM r.start_date AND a.end_date IS NOT DISTINCT FROM r.end_date
        WHERE dimension IS NULL""",
    "split": """SELECT a.*, b.member, CASE metric WHEN 'total flights' THEN CAST(flights AS DOUBLE)
            ELSE CASE WHEN coalesce(seats, 0) = 0 THEN 0 ELSE seated / CAST(seats AS DOUBLE) END END AS value
        FROM asked a JOIN (
            SELECT p.start_date, p.end_date, m.member, flights, seated, seats FROM periods p CROSS JOIN airlines m
            LEFT JOIN by_airline b ON p.start_date IS NOT DISTINCT FROM b.start_date AND p.end_date IS NOT DISTINCT FROM b.end_date AND m.member = b.member
            UNION ALL SELECT * FROM by_airline WHERE member IS NULL) b
        ON a.start_date IS NOT DISTINCT FROM b.start_date AND a.end_date IS NOT DISTINCT FROM b.end_date
        WHERE dimension IS NOT NULL AND metric <> 'Total Commercial Revenue'
        UNION ALL SELECT a.*, m.member, r.v FROM asked a CROSS JOIN airlines m
        JOIN revenue r ON a.start_date IS NOT DISTINCT FROM r.start_date AND a.end_date IS NOT DISTINCT FROM r.end_date
        WHERE dimension IS NOT NULL AND metric = 'Total Commercial Revenue'""",
    "placed": """SELECT *, rank() OVER (PARTITION BY request_id ORDER BY CASE WHEN ascending THEN value ELSE -value END) AS place
        FROM split WHERE value IS NOT NULL""",
}


@query(
    "kpi_request_batch",
    with_tables(
        f"""SELECT request_id, {n('period_no')} AS period_no, CASE metric WHEN 'total flights' THEN 'Total Flights' ELSE metric END AS metric,
            member, {f('value', 4)} AS value, CAST(NULL AS VARCHAR) AS reason FROM (
            SELECT request_id, period_no, metric, member, value FROM single
            UNION ALL SELECT request_id, period_no, metric, member, value FROM placed WHERE intent = 'breakdown' OR place <= coalesce(size, 1))""",
        **DAYS_OF,
    ),
    digits=4,
)
def _(spark, sf):
    return R.answer_requests(model(spark, sf), table(spark, sf, "orders").selectExpr(*[f"{e} AS {c}" for c, e in ASKED]))


# One period per order, of up to 400 days: most overlap.
DAILY = {
    "revenue": "SELECT \"date\" AS d, sum(amount_cad) AS v FROM fact_commercial_transactions JOIN dim_date USING (date_key) GROUP BY ALL",
    "wait": "SELECT \"date\" AS d, max(avg_security_wait_min) AS v FROM fact_passenger_flow JOIN dim_date USING (date_key) GROUP BY ALL",
}


@query(
    "kpi_overlapping_periods",
    with_tables(
        f"""SELECT label, {t('start_date')} AS start_date, {t('end_date')} AS end_date, measure, {f('value', 4)} AS value FROM (
            SELECT label, start_date, end_date, 'Total Commercial Revenue' AS measure, sum(v) AS value
            FROM spans LEFT JOIN revenue ON d BETWEEN start_date AND end_date GROUP BY ALL
            UNION ALL SELECT label, start_date, end_date, 'Maximum Security Wait Time', max(v)
            FROM spans LEFT JOIN wait ON d BETWEEN start_date AND end_date GROUP BY ALL)""",
        **DAILY,
        spans="""SELECT CAST(o_orderkey AS VARCHAR) AS label, CAST(o_orderdate AS DATE) AS start_date,
            CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS end_date FROM orders""",
    ),
    digits=4,
)
def _(spark, sf):
    start = F.to_date("o_orderdate")
    periods = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("label"),
        start.alias("start_date"),
        F.date_add(start, (F.col("o_orderkey") % 400).cast("int")).alias("end_date"),
    )
    return K.kpi_by_period(model(spark, sf), ["Total Commercial Revenue", "Maximum Security Wait Time"], periods)


@query(
    "alias_conflicts",
    """SELECT alias, count(DISTINCT p_type) AS metric_count FROM (SELECT lower(p_name) AS alias, p_type FROM part)
       GROUP BY ALL HAVING count(DISTINCT p_type) > 1""",
)
def _(spark, sf):
    aliases = table(spark, sf, "part").select(F.lower("p_name").alias("alias"), F.col("p_type").alias("metric"))
    return K.alias_conflicts(aliases)
