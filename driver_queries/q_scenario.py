"""What-if projections: assumptions built from the events, baselines from the airport model."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.airport_tables import model, with_tables
from driver_queries.q_measures import _ratio0, totals_sql
from driver_queries.q_questions import QUESTIONS_SQL, questions
from driver_queries.registry import f, query, table
from skyledger.plans import scenario as S
from skyledger.plans.questions import MONTH_YEAR_PATTERN, extract_periods

# A tenth of all assumptions belongs to one request.
REQUEST = "CASE WHEN event_id % 10 = 0 THEN -1 ELSE CAST(FLOOR(event_id / 2) AS BIGINT) END"
LABEL = (
    "CASE event_id % 7 WHEN 0 THEN 'Passenger Traffic' WHEN 1 THEN 'OTP' WHEN 2 THEN 'Commercial-Revenue' "
    "WHEN 3 THEN 'electricity' WHEN 4 THEN CASE WHEN event_id % 3 = 0 THEN event_type ELSE 'load factor' END "
    "WHEN 5 THEN 'Load factor' ELSE 'Energy per Passenger' END"
)
OPERATION = (
    "CASE event_id % 9 WHEN 0 THEN 'absolute_change' WHEN 1 THEN 'percentage_point_change' WHEN 2 THEN 'set_target' "
    "WHEN 8 THEN CASE WHEN event_id % 4 = 0 THEN 'double_it' ELSE 'percentage_point_change' END "
    "ELSE 'percentage_change' END"
)
VALUE = (
    "CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN CAST('NaN' AS DOUBLE) "
    "WHEN event_id % 61 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE CAST(user_id % 200 - 120 AS DOUBLE) END"
)
PERIOD = "CASE WHEN event_id % 23 = 0 THEN 'all available dates' ELSE {month} || ' ' || CAST(1996 + event_id % 7 AS STRING) END"
SPARK_MONTH = "date_format(make_date(2024, CAST(1 + event_id % 12 AS INT), 1), 'MMMM')"
SQL_MONTH = "strftime(make_date(2024, CAST(1 + event_id % 12 AS INT), 1), '%B')"

METRICS = [
    "Total Passengers Processed",
    "On-Time Performance %",
    "Total Commercial Revenue",
    "Total Electricity Consumption",
    "Load Factor %",
    "Energy per Passenger",
]


def assumptions(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.expr(REQUEST).alias("request_id"),
        F.expr(LABEL).alias("label"),
        F.expr(OPERATION).alias("operation"),
        F.expr(VALUE).alias("value"),
        F.expr(PERIOD.format(month=SPARK_MONTH)).alias("period"),
    )


def baselines(spark, sf):
    """The metrics per month that any assumption names, in long form."""
    named = assumptions(spark, sf).filter(F.col("period") != S.ALL_DATES).select("period").distinct()
    periods = extract_periods(named, "period").select("label", "start_date", "end_date")
    return S.scenario_baselines(model(spark, sf), METRICS, periods)


def accepted(spark, sf):
    return S.split_requests(S.validate_assumptions(assumptions(spark, sf)))[0]


CTES = {
    "a0": f"""SELECT event_id, {REQUEST} AS request_id, {LABEL} AS label, {OPERATION} AS operation, {VALUE} AS value,
        {PERIOD.format(month=SQL_MONTH)} AS period FROM events""",
    "a1": """SELECT a0.*, metric, page, kind FROM a0 LEFT JOIN (VALUES
            ('passenger traffic', 'Total Passengers Processed', 'Passenger', 'nonnegative'),
            ('otp', 'On-Time Performance %', 'Flights', 'rate'),
            ('commercial-revenue', 'Total Commercial Revenue', 'Commercial', 'signed'),
            ('electricity', 'Total Electricity Consumption', 'Sustainability', 'nonnegative'),
            ('load factor', 'Load Factor %', 'Flights', 'rate'),
            ('energy per passenger', 'Energy per Passenger', 'Sustainability', 'nonnegative'))
            AS v(alias, metric, page, kind) ON lower(a0.label) = v.alias""",
    "a2": """SELECT *, CASE
            WHEN operation = 'double_it' THEN 'unsupported operation'
            WHEN value IS NULL OR isnan(value) OR isinf(value) THEN 'value is not finite'
            WHEN metric IS NULL THEN 'unknown metric'
            WHEN operation = 'percentage_point_change' AND kind <> 'rate' THEN 'percentage points apply to rates only'
            WHEN operation = 'absolute_change' AND kind = 'rate' THEN 'a rate needs a percentage or percentage points'
            END AS reason FROM a1""",
    "verdict": """SELECT request_id, CASE WHEN count(*) > 5 THEN 'more than five assumptions'
            WHEN count(reason) > 0 THEN 'invalid assumption'
            WHEN count(metric) > count(DISTINCT metric) THEN 'several adjustments of one metric' END AS request_reason
            FROM a2 GROUP BY ALL""",
    "validated": "SELECT * FROM a2 JOIN verdict USING (request_id)",
    "monthly": f"""SELECT * FROM (SELECT DISTINCT period FROM a0 WHERE period <> 'all available dates') LEFT JOIN (SELECT strftime("date", '%B %Y') AS period, sum(passengers_processed) AS passengers
                FROM fact_passenger_flow JOIN dim_date USING (date_key) GROUP BY ALL) USING (period)
            LEFT JOIN (SELECT strftime("date", '%B %Y') AS period,
                {_ratio0("nullif(count(*) FILTER (WHERE status = 'On Time'), 0)", "count(*)")} AS otp, count(*) AS flights,
                {_ratio0('sum(passenger_count)', 'sum(seat_capacity)')} AS load_factor
                FROM fact_flight_operations JOIN dim_date USING (date_key) GROUP BY ALL) USING (period)
            LEFT JOIN (SELECT strftime("date", '%B %Y') AS period, sum(amount_cad) AS revenue
                FROM fact_commercial_transactions JOIN dim_date USING (date_key) GROUP BY ALL) USING (period)
            LEFT JOIN (SELECT strftime("date", '%B %Y') AS period, sum(electricity_kwh) AS electricity
                FROM fact_sustainability_daily JOIN dim_date USING (date_key) GROUP BY ALL) USING (period)""",
    "everything": totals_sql(),
    "base": f"""SELECT 'Total Passengers Processed' AS metric, period, CAST(passengers AS DOUBLE) AS baseline FROM monthly
            UNION ALL SELECT 'On-Time Performance %', period, CASE WHEN flights IS NULL THEN 0 ELSE otp END FROM monthly
            UNION ALL SELECT 'Load Factor %', period, coalesce(load_factor, 0) FROM monthly
            UNION ALL SELECT 'Total Commercial Revenue', period, revenue FROM monthly
            UNION ALL SELECT 'Total Electricity Consumption', period, electricity FROM monthly
            UNION ALL SELECT 'Energy per Passenger', period, {_ratio0('electricity', 'passengers')} FROM monthly
            {' '.join(f"""UNION ALL SELECT '{name}', 'all available dates', CAST("{name}" AS DOUBLE) FROM everything"""
                      for name in METRICS)}""",
    "joined": """SELECT v.*, baseline, CASE WHEN baseline IS NULL THEN 'missing baseline'
            WHEN kind = 'rate' AND (baseline < 0 OR baseline > 1) THEN 'baseline is not a rate between 0 and 1' END AS baseline_reason
            FROM validated v LEFT JOIN base USING (metric, period) WHERE request_reason IS NULL""",
    "projected": """SELECT *, CASE WHEN baseline_reason IS NULL THEN CASE operation
            WHEN 'percentage_change' THEN baseline * (1 + value / 100) WHEN 'absolute_change' THEN baseline + value
            WHEN 'set_target' THEN CASE kind WHEN 'rate' THEN value / 100 ELSE value END
            WHEN 'percentage_point_change' THEN baseline + value / 100 END END AS projected FROM joined""",
    "results": """SELECT *, coalesce(baseline_reason, CASE
            WHEN kind = 'rate' AND (projected < 0 OR projected > 1) THEN 'projected rate is outside 0 to 1'
            WHEN kind = 'nonnegative' AND projected < 0 THEN 'projected value is negative' END) AS reject_reason FROM projected""",
}


def _sql(final: str) -> str:
    return with_tables(final, **CTES)


@query("validate_assumptions", _sql("SELECT event_id, request_id, metric, kind, page, reason, request_reason FROM validated"))
def _(spark, sf):
    validated = S.validate_assumptions(assumptions(spark, sf))
    return validated.select("event_id", "request_id", "metric", "kind", "page", "reason", "request_reason")


@query(
    "baseline_join",
    _sql(f"SELECT event_id, metric, period, {f('baseline', 4)} AS baseline, baseline_reason FROM joined"),
    digits=4,
)
def _(spark, sf):
    joined = S.baseline_join(accepted(spark, sf), baselines(spark, sf))
    return joined.select("event_id", "metric", "period", "baseline", "baseline_reason")


@query(
    "project_scenario",
    _sql(f"SELECT event_id, operation, {f('projected', 4)} AS projected FROM results WHERE baseline_reason IS NULL"),
    digits=4,
)
def _(spark, sf):
    joined = S.baseline_join(accepted(spark, sf), baselines(spark, sf)).filter(F.col("baseline_reason").isNull())
    projected = S.project_scenario(F.col("baseline"), F.col("operation"), F.col("value"), F.col("kind"))
    return joined.select("event_id", "operation", projected.alias("projected"))


@query("validate_projection", _sql("SELECT event_id, kind, reject_reason FROM results"))
def _(spark, sf):
    results = S.run_scenarios(accepted(spark, sf), baselines(spark, sf))
    return results.select("event_id", "kind", "reject_reason")


@query(
    "projection_deltas",
    _sql(
        f"""SELECT event_id, {f('projected - baseline', 4)} AS absolute_change,
            {f('(projected - baseline) / nullif(baseline, 0) * 100', 4)} AS relative_change_percent FROM results"""
    ),
    digits=4,
)
def _(spark, sf):
    results = S.run_scenarios(accepted(spark, sf), baselines(spark, sf))
    return results.select("event_id", "absolute_change", "relative_change_percent")


@query(
    "scenario_pages",
    _sql(
        """SELECT request_id, CASE WHEN count(DISTINCT page) = 1 THEN min(page) END AS page, count(*) AS projection_count
           FROM results WHERE reject_reason IS NULL GROUP BY ALL"""
    ),
)
def _(spark, sf):
    results = S.run_scenarios(accepted(spark, sf), baselines(spark, sf))
    return S.scenario_pages(results.filter(F.col("reject_reason").isNull()))


TIMED = "CASE WHEN event_id % 10 = 3 THEN NULL WHEN event_id % 10 = 5 THEN '  ' ELSE text END"


@query(
    "scenario_period",
    f"""WITH q AS (SELECT event_id, {TIMED} AS time_expression, lower({TIMED}) AS s FROM {QUESTIONS_SQL}),
        c AS (SELECT *, regexp_extract_all(s, '{MONTH_YEAR_PATTERN}') AS found,
              CAST(contains(s, 'first week') AS INT) + CAST(contains(s, 'last week') OR contains(s, 'end of') AS INT) AS kinds
              FROM q),
        p AS (SELECT event_id, CASE WHEN time_expression IS NULL OR trim(time_expression) = '' THEN 'all available dates'
              WHEN len(list_distinct(found)) = 1 AND kinds <= 1 THEN
                CASE WHEN contains(s, 'first week') THEN 'First week of ' WHEN contains(s, 'last week') THEN 'Last week of '
                     WHEN contains(s, 'end of') THEN 'End of ' ELSE '' END
                || upper(substr(regexp_extract(s, '{MONTH_YEAR_PATTERN}', 1), 1, 1))
                || substr(regexp_extract(s, '{MONTH_YEAR_PATTERN}', 1), 2) || ' ' || regexp_extract(s, '{MONTH_YEAR_PATTERN}', 2)
              END AS period FROM c)
        SELECT event_id, period, CASE WHEN period IS NULL THEN 'one supported period is needed' END AS period_reason FROM p""",
)
def _(spark, sf):
    rows = questions(spark, sf).withColumn("time_expression", F.expr(TIMED))
    return S.request_period(rows, "time_expression").select("event_id", "period", "period_reason")
