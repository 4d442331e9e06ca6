"""The airport's landed tables derived from the driver tables, and the SQL text of every later stage.

nation -> airlines, supplier -> gates, orders -> flights, flight events and transactions,
lineitem -> passenger flow, baggage events and daily sustainability, conversations -> feedback.
The derivation uses the same expressions in Spark and in the SQL text; everything after it is
written twice, as DataFrame plans in ``skyledger`` and as SQL here.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import table
from skyledger.plans import airport
from skyledger.plans.context import Model
from skyledger.session import materialize

CARRIER = (
    "CASE WHEN o_custkey % 25 = 0 AND o_orderkey % 2 = 0 THEN 'Air Canada' "
    "WHEN o_custkey % 25 = 0 THEN 'AC' ELSE 'N' || CAST(o_custkey % 25 AS STRING) END"
)
GATE = "CASE WHEN o_orderkey % 101 = 0 THEN 'Gate-99' ELSE 'G' || CAST(o_custkey % 10 AS STRING) END"
STATUS = "CASE o_orderstatus WHEN 'F' THEN 'On Time' WHEN 'O' THEN 'Delayed' ELSE 'Cancelled' END"
DELAY = (
    "CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN CAST(5 + o_orderkey % 140 AS INT) ELSE CAST(0 AS INT) END"
)
ACTUAL = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END"
REASON = "CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END"
FLOW_DAY = "CAST(l_shipdate AS DATE)"

# table: (driver table, group by, [(column, expression)])
LANDED: dict[str, tuple[str, str | None, list[tuple[str, str]]]] = {
    "airlines": (
        "nation",
        None,
        [
            ("airline_code", "CASE n_nationkey WHEN 0 THEN 'AC' ELSE 'N' || CAST(n_nationkey AS STRING) END"),
            ("airline_name", "n_name"),
            ("service_type", "CASE WHEN n_regionkey < 3 THEN 'Passenger' ELSE 'Cargo' END"),
        ],
    ),
    "gates": (
        "supplier",
        None,
        [
            ("gate_id", "'G' || CAST(s_suppkey AS STRING)"),
            (
                "terminal_zone",
                "CASE s_nationkey % 3 WHEN 0 THEN 'Domestic' WHEN 1 THEN 'Transborder' ELSE 'International' END",
            ),
            ("capacity_class", "CASE WHEN s_acctbal > 5000 THEN 'Wide-body' ELSE 'Narrow-body' END"),
        ],
    ),
    "flights": (
        "orders",
        None,
        [
            ("flight_id", "'F' || CAST(o_orderkey AS STRING)"),
            ("airline_code", CARRIER),
            ("flight_number", "'FL' || CAST(o_custkey % 500 AS STRING)"),
            ("direction", "CASE WHEN o_orderkey % 2 = 0 THEN 'Arrival' ELSE 'Departure' END"),
            ("origin", "'Y' || CAST(o_custkey % 9 AS STRING)"),
            ("destination", "'Z' || CAST(o_orderkey % 7 AS STRING)"),
            (
                "traffic_type",
                "CASE o_orderkey % 4 WHEN 0 THEN 'DOM' WHEN 1 THEN 'Domestic' "
                "WHEN 2 THEN 'International' ELSE 'Transborder' END",
            ),
            ("scheduled_time", "o_orderdate"),
            ("actual_time", ACTUAL),
            ("gate_id", GATE),
            ("seat_capacity", "CAST(100 + o_custkey % 200 AS INT)"),
            (
                "passenger_count",
                "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(50 + o_orderkey % 60 AS INT) END",
            ),
            ("status", STATUS),
            ("delay_minutes", DELAY),
            ("delay_reason", REASON),
            ("gate_in_time", ACTUAL),
            ("gate_out_time", ACTUAL),
        ],
    ),
    "passenger_flow": (
        "lineitem",
        None,
        [
            ("date", f"CAST({FLOW_DAY} AS STRING)"),
            ("hour", "CAST(l_partkey % 24 AS STRING)"),
            (
                "terminal_zone",
                "CASE WHEN l_orderkey % 50 = 0 THEN NULL WHEN l_suppkey % 3 = 0 THEN 'International' "
                "WHEN l_suppkey % 3 = 1 THEN 'Domestic' ELSE 'Transborder' END",
            ),
            (
                "traffic_type",
                "CASE WHEN l_orderkey % 50 = 0 THEN 'INTL' WHEN l_linenumber % 3 = 0 THEN 'International' "
                "WHEN l_linenumber % 3 = 1 THEN 'Domestic' ELSE 'Transborder' END",
            ),
            (
                "passengers_processed",
                "CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 83 = 0 THEN '0.0' "
                "ELSE CAST(CAST(l_quantity AS INT) AS STRING) || '.0' END",
            ),
            ("avg_security_wait_min", "CAST(l_partkey % 31 AS STRING)"),
        ],
    ),
    "commercial_transactions": (
        "orders",
        None,
        [
            ("transaction_id", "'T' || CAST(o_orderkey AS STRING)"),
            ("timestamp", "CAST(o_orderdate AS STRING)"),
            (
                "revenue_category",
                "CASE o_custkey % 5 WHEN 0 THEN 'F&B' WHEN 1 THEN 'Food & Beverage' WHEN 2 THEN 'Retail' "
                "WHEN 3 THEN 'Parking' ELSE 'Ground Transportation' END",
            ),
            (
                "amount_cad",
                "CASE WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN '-2.5' "
                "ELSE CAST(CAST(FLOOR(o_totalprice) AS INT) AS STRING) || '.25' END",
            ),
            ("payment_method", "o_orderpriority"),
            (
                "terminal_zone",
                "CASE o_orderkey % 3 WHEN 0 THEN 'Domestic' WHEN 1 THEN 'Transborder' ELSE 'Unmapped' END",
            ),
        ],
    ),
    "sustainability_daily": (
        "lineitem",
        FLOW_DAY,
        [
            ("date", f"CAST({FLOW_DAY} AS STRING)"),
            ("electricity_kwh", "CAST(SUM(CAST(l_quantity AS BIGINT)) * 10 AS STRING) || '.5'"),
            (
                "water_m3",
                f"CASE WHEN DAY({FLOW_DAY}) % 7 < 2 THEN NULL "
                "ELSE CAST(SUM(CAST(l_partkey % 50 AS BIGINT)) AS STRING) END",
            ),
            ("waste_tonnes", "CAST(COUNT(*) AS STRING) || '.25'"),
            ("estimated_co2e_tonnes", "CAST(SUM(CAST(l_linenumber AS BIGINT)) AS STRING) || '.75'"),
        ],
    ),
    "passenger_feedback": (
        "conversations",
        None,
        [
            ("feedback_id", "'00' || CAST(conv_id * 100 + turn AS STRING)"),
            (
                "feedback_date",
                "CASE WHEN conv_id % 9 = 0 THEN 'bad-date' "
                "ELSE CAST(DATE '1996-01-01' + CAST(conv_id * 7 % 700 AS INT) AS STRING) END",
            ),
            ("feedback_text", "CASE WHEN turn % 5 = 4 THEN '   ' ELSE text END"),
        ],
    ),
}

# Flat forms of the nested events; the Spark side nests them before it reads them.
LANDED_EVENTS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "flight_operational_events": (
        "orders",
        [
            ("event_id", "'E' || CAST(o_orderkey AS STRING)"),
            ("flight_id", "'F' || CAST(o_orderkey AS STRING)"),
            ("flight_number", "'FL' || CAST(o_custkey % 500 AS STRING)"),
            ("airline", CARRIER),
            ("direction", "CASE WHEN o_orderkey % 2 = 0 THEN 'Arrival' ELSE 'Departure' END"),
            ("gate", GATE),
            ("status", STATUS),
            ("scheduled", "CAST(o_orderdate AS STRING)"),
            ("actual", f"CAST({ACTUAL} AS STRING)"),
            ("minutes", DELAY),
            ("reason", REASON),
            ("source_system", "'ops'"),
        ],
    ),
    "baggage_events": (
        "lineitem",
        [
            (
                "bag_event_id",
                "'B' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) "
                "|| '-' || CAST(l_partkey AS STRING)",
            ),
            (
                "flight_id",
                "CASE WHEN l_orderkey % 101 = 0 THEN 'F-1' ELSE 'F' || CAST(l_orderkey AS STRING) END",
            ),
            ("bags_processed", "CAST(l_quantity AS BIGINT)"),
            ("mishandled_bags", "CAST(l_suppkey % 3 AS BIGINT)"),
            ("first_bag_min", "CAST(l_partkey % 30 AS BIGINT)"),
            ("last_bag_min", "CAST(l_partkey % 30 + l_linenumber - 2 AS BIGINT)"),
        ],
    ),
}

TARGET_ROWS = [
    ("On-Time Performance", "ON_TIME_PERFORMANCE", " Operational", "%", "0.30", ">=", "1995-01-01", "1997-12-31"),
    ("On-Time Performance", "ON_TIME_PERFORMANCE", " Operational", "%", "0.35", ">=", "1998-01-01", None),
    ("Average Delay Minutes", "AVG_DELAY", "Operational", "minutes", "40.0", "<=", "1995-01-01", None),
    ("Average Delay Minutes", "AVG_DELAY", "Operational", "minutes", "30.0", "<=", "1996-06-01", "1999-05-31"),
    ("Average Security Wait Time", "SECURITY_WAIT_TIME", "Passenger", "minutes", "15.0", "<=", "1995-01-01", None),
    ("Average Last Bag Time", "LAST_BAG_TIME", "Passenger", "minutes", "20.0", "<=", "1996-01-01", None),
    ("Revenue per Passenger", "REVENUE_PER_PASSENGER", "Commercial", "CAD", "18.0", ">=", "1995-01-01", "2000-12-31"),
    ("Revenue per Passenger", "REVENUE_PER_PASSENGER", "Commercial", "CAD", "2500.0", ">=", "2001-01-01", None),
    ("Energy per Passenger", "ENERGY_PER_PASSENGER", "Sustainability", "kWh", "5.5", "<=", "1995-01-01", None),
    ("Passenger Satisfaction", "PASS_SATIS", "Feedback", "score/5", "4.3", ">=", "1995-01-01", None),
]
TARGET_SCHEMA = (
    "kpi_name string, kpi_code string, business_area string, unit string, target_value string, "
    "target_direction string, effective_start_date string, effective_end_date string"
)


# ---------------------------------------------------------------- Spark side


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One landed table."""
    if name == "operational_targets":
        return spark.createDataFrame(TARGET_ROWS, TARGET_SCHEMA)
    if name in LANDED_EVENTS:
        source, columns = LANDED_EVENTS[name]
        flat = table(spark, sf_dir, source).selectExpr(*[f"{expr} AS `{column}`" for column, expr in columns])
        return _nest_flight_events(flat) if name == "flight_operational_events" else _nest_baggage_events(flat)
    source, group, columns = LANDED[name]
    rows = table(spark, sf_dir, source)
    if group is None:
        return rows.selectExpr(*[f"{expr} AS `{column}`" for column, expr in columns])
    aggregates = [F.expr(expr).alias(column) for column, expr in columns]
    return rows.groupBy(F.expr(group)).agg(*aggregates).select(*[column for column, _ in columns])


def _nest_flight_events(flat: DataFrame) -> DataFrame:
    delay = F.struct("minutes", "reason").alias("delay")
    return flat.select(
        "event_id",
        F.struct("flight_id", "flight_number", "airline").alias("flight"),
        F.struct("direction", "gate", "status").alias("operation"),
        F.struct("scheduled", "actual", delay).alias("timing"),
        "source_system",
    )


def _nest_baggage_events(flat: DataFrame) -> DataFrame:
    return flat.select(
        "bag_event_id",
        "flight_id",
        "bags_processed",
        "mishandled_bags",
        F.struct("first_bag_min", "last_bag_min").alias("arrival"),
    )


def cleaned(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One cleaned table."""
    return airport.clean_tables({name: landed(spark, sf_dir, name)})[name]


# Cleaned tables that wrote an intermediate table, by application, input and name.
_CLEANED: dict[tuple[str, str, str], DataFrame] = {}


class CleanTables(Mapping):
    """Cleaned tables by name, built when first asked for."""

    NAMES = [*LANDED, *LANDED_EVENTS, "operational_targets"]

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _CLEANED:
            _CLEANED[key] = cleaned(self.spark, self.sf_dir, name)
        return _CLEANED[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def __contains__(self, name) -> bool:
        return name in self.NAMES


FACT_BUILDERS = {
    "fact_flight_operations": lambda c, m: airport.build_fact_flight(
        c["flights"], m["dim_flight"], m["dim_airline"], m["dim_gate"]
    ),
    "fact_passenger_flow": lambda c, m: airport.build_fact_passenger_flow(
        c["passenger_flow"], m["dim_terminal_zone"]
    ),
    "fact_baggage_operations": lambda c, m: airport.build_fact_baggage(
        c["baggage_events"], c["flights"], m["dim_flight"]
    ),
    "fact_commercial_transactions": lambda c, m: airport.build_fact_commercial(
        c["commercial_transactions"], m["dim_terminal_zone"]
    ),
    "fact_sustainability_daily": lambda c, m: airport.build_fact_sustainability(c["sustainability_daily"]),
    "fact_passenger_feedback": lambda c, m: airport.build_fact_feedback(c["passenger_feedback"]),
}
# Columns that no measure, attribute or relationship of the model reads: its facts do without them, so
# they are in no join and no file.
UNREAD = {
    "fact_flight_operations": ["scheduled_time", "actual_time", "gate_in_time", "gate_out_time"],
    "fact_baggage_operations": ["bag_event_id"],
}
MEASURED_BUILDERS = FACT_BUILDERS | {
    name: lambda c, m, name=name, unread=unread: FACT_BUILDERS[name](c, m).drop(*unread) for name, unread in UNREAD.items()
}
DIMENSION_BUILDERS = {
    "dim_date": lambda c, m: airport.build_dim_date(c),
    "dim_airline": lambda c, m: airport.build_dim_airline(c["airlines"]),
    "dim_gate": lambda c, m: airport.build_dim_gate(c["gates"]),
    "dim_flight": lambda c, m: airport.build_dim_flight(c["flights"]),
    "dim_terminal_zone": lambda c, m: airport.build_dim_terminal_zone(c["gates"]),
}

# Tables of the model that were already written to the shared folder, by application, input, name and builder.
_WRITTEN: dict[tuple, DataFrame] = {}


class ModelTables(Mapping):
    """Tables of the model, each written once to the shared folder when first asked for.

    The measures read the written facts, as a dashboard reads its star schema, and do not
    rebuild them per query.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, builders: Mapping):
        self.spark, self.sf_dir, self.builders = spark, sf_dir, builders

    def __getitem__(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name, self.builders[name])
        if key not in _WRITTEN:
            clean = CleanTables(self.spark, self.sf_dir)
            dimensions = ModelTables(self.spark, self.sf_dir, DIMENSION_BUILDERS)
            _WRITTEN[key] = materialize(self.builders[name](clean, dimensions), name)
        return _WRITTEN[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self.builders)

    def __len__(self) -> int:
        return len(self.builders)

    def __contains__(self, name) -> bool:
        return name in self.builders


def model(spark: SparkSession, sf_dir: str, revenue_by_zone: bool = False) -> Model:
    extra = (airport.REVENUE_ZONE,) if revenue_by_zone else ()
    return Model(
        facts=ModelTables(spark, sf_dir, MEASURED_BUILDERS),
        dimensions=ModelTables(spark, sf_dir, DIMENSION_BUILDERS),
        relationships=airport.RELATIONSHIPS + extra,
        targets=airport.clean_targets(landed(spark, sf_dir, "operational_targets")),
    )


# ---------------------------------------------------------------- SQL side


def _landed_sql(name: str) -> str:
    if name in LANDED_EVENTS:
        source, columns = LANDED_EVENTS[name]
        group = None
    else:
        source, group, columns = LANDED[name]
    select = ", ".join(f'{expr} AS "{column}"' for column, expr in columns)
    return f"SELECT {select} FROM {source}" + (f" GROUP BY {group}" if group else "")


def _values_sql() -> str:
    def literal(value):
        return "NULL" if value is None else "'" + value.replace("'", "''") + "'"

    rows = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in TARGET_ROWS)
    names = ", ".join(part.split()[0] for part in TARGET_SCHEMA.split(", "))
    return f"SELECT * FROM (VALUES {rows}) AS v({names})"


def sql_number(expression: str) -> str:
    return f"CAST(TRUNC(TRY_CAST({expression} AS DOUBLE)) AS INTEGER)"


def sql_date_key(expression: str) -> str:
    return f"CAST(strftime({expression}, '%Y%m%d') AS INTEGER)"


def sql_key(prefix: str, order: str) -> str:
    number = f"row_number() OVER (ORDER BY {order})"
    text = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || CASE WHEN length({text}) < 4 THEN lpad({text}, 4, '0') ELSE {text} END"


CTES: dict[str, str] = {f"l_{name}": _landed_sql(name) for name in [*LANDED, *LANDED_EVENTS]}
CTES["l_operational_targets"] = _values_sql()
CTES |= {
    "c_flights": """
        SELECT * REPLACE (
            CASE WHEN airline_code = 'Air Canada' THEN 'AC' ELSE airline_code END AS airline_code,
            CASE WHEN traffic_type = 'DOM' THEN 'Domestic' ELSE traffic_type END AS traffic_type,
            CASE WHEN gate_id = 'Gate-99' THEN NULL ELSE gate_id END AS gate_id)
        FROM l_flights""",
    "c_passenger_flow": f"""
        SELECT CAST("date" AS DATE) AS "date", {sql_number('"hour"')} AS "hour",
            CASE WHEN terminal_zone IS NULL AND traffic_type IN ('INTL', 'International')
                THEN 'International' ELSE terminal_zone END AS terminal_zone,
            CASE WHEN traffic_type = 'INTL' THEN 'International' ELSE traffic_type END AS traffic_type,
            {sql_number('passengers_processed')} AS passengers_processed,
            TRY_CAST(avg_security_wait_min AS DOUBLE) AS avg_security_wait_min
        FROM l_passenger_flow""",
    "c_commercial_transactions": """
        SELECT * REPLACE (
            TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp",
            CASE WHEN revenue_category = 'F&B' THEN 'Food & Beverage' ELSE revenue_category END AS revenue_category,
            TRY_CAST(amount_cad AS DOUBLE) AS amount_cad)
        FROM l_commercial_transactions""",
    "c_operational_targets": """
        SELECT trim(kpi_name) AS kpi_name, trim(kpi_code) AS kpi_code, trim(business_area) AS business_area,
            trim(unit) AS unit, TRY_CAST(target_value AS DOUBLE) AS target_value,
            trim(target_direction) AS target_direction,
            TRY_CAST(effective_start_date AS DATE) AS effective_start_date,
            TRY_CAST(effective_end_date AS DATE) AS effective_end_date
        FROM l_operational_targets""",
    "s_typed": """
        SELECT CAST("date" AS DATE) AS "date", CAST(electricity_kwh AS DOUBLE) AS electricity_kwh,
            CAST(water_m3 AS DOUBLE) AS water_m3, CAST(waste_tonnes AS DOUBLE) AS waste_tonnes,
            CAST(estimated_co2e_tonnes AS DOUBLE) AS estimated_co2e_tonnes
        FROM l_sustainability_daily""",
    "s_neighbours": """
        SELECT *,
            last_value(water_m3 IGNORE NULLS) OVER (
                ORDER BY "date" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_water,
            first_value(water_m3 IGNORE NULLS) OVER (
                ORDER BY "date" ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_water
        FROM s_typed""",
    "c_sustainability_daily": """
        SELECT "date", electricity_kwh,
            CASE WHEN water_m3 IS NULL THEN (prev_water + next_water) / 2 ELSE water_m3 END AS water_m3,
            waste_tonnes, estimated_co2e_tonnes
        FROM s_neighbours""",
    "c_flight_operational_events": """
        SELECT event_id, flight_id, flight_number,
            CASE WHEN airline = 'Air Canada' THEN 'AC' ELSE airline END AS airline_code, direction,
            CASE WHEN gate = 'Gate-99' THEN NULL ELSE gate END AS gate_id, status,
            TRY_CAST(scheduled AS TIMESTAMP) AS scheduled_time, TRY_CAST(actual AS TIMESTAMP) AS actual_time,
            minutes AS delay_minutes, reason AS delay_reason, source_system
        FROM l_flight_operational_events""",
    "c_baggage_events": "SELECT * FROM l_baggage_events",
    "c_passenger_feedback": f"""
        SELECT {sql_number('feedback_id')} AS feedback_id, TRY_CAST(feedback_date AS DATE) AS feedback_date,
            feedback_text
        FROM l_passenger_feedback WHERE feedback_text IS NOT NULL AND trim(feedback_text) <> ''""",
    "all_dates": """
        SELECT CAST(scheduled_time AS DATE) AS "date" FROM c_flights
        UNION ALL SELECT "date" FROM c_passenger_flow
        UNION ALL SELECT CAST("timestamp" AS DATE) FROM c_commercial_transactions
        UNION ALL SELECT "date" FROM c_sustainability_daily
        UNION ALL SELECT feedback_date FROM c_passenger_feedback""",
    "dim_date": f"""
        SELECT {sql_date_key('d')} AS date_key, d AS "date", day(d) AS "day", strftime(d, '%A') AS day_name,
            weekofyear(d) AS week_of_year, month(d) AS "month", strftime(d, '%B') AS month_name,
            quarter(d) AS quarter, year(d) AS "year", dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
            FROM (SELECT CAST(min("date") AS TIMESTAMP) AS lo, CAST(max("date") AS TIMESTAMP) AS hi FROM all_dates))""",
    "dim_airline": f"""
        SELECT {sql_key('da', 'airline_code')} AS airline_key, airline_code, airline_name, service_type
        FROM l_airlines""",
    "dim_gate": f"""
        SELECT 'dg0000' AS gate_key, 'UNKNOWN' AS gate_id, 'Unknown' AS terminal_zone, 'Unknown' AS capacity_class
        UNION ALL SELECT {sql_key('dg', 'gate_id')}, gate_id, terminal_zone, capacity_class FROM l_gates""",
    "dim_flight": f"""
        SELECT {sql_key('df', 'flight_id')} AS flight_key, flight_id, flight_number, origin, destination
        FROM c_flights""",
    "dim_terminal_zone": f"""
        SELECT {sql_key('dt', 'terminal_zone')} AS terminal_zone_key, terminal_zone
        FROM (SELECT DISTINCT terminal_zone FROM l_gates WHERE terminal_zone IS NOT NULL)""",
    "fact_flight_operations": f"""
        SELECT f.flight_key, {sql_date_key('c.scheduled_time')} AS date_key, a.airline_key,
            coalesce(g.gate_key, 'dg0000') AS gate_key, direction, traffic_type, scheduled_time, actual_time,
            seat_capacity, passenger_count, status, delay_minutes, delay_reason, gate_in_time, gate_out_time
        FROM c_flights c LEFT JOIN dim_flight f ON c.flight_id = f.flight_id
            LEFT JOIN dim_airline a ON c.airline_code = a.airline_code
            LEFT JOIN dim_gate g ON c.gate_id = g.gate_id""",
    "flow_grain": """
        SELECT "date", "hour", terminal_zone, traffic_type, CAST(sum(passengers_processed) AS BIGINT) AS passengers_processed,
            sum(avg_security_wait_min * passengers_processed) / nullif(sum(passengers_processed), 0)
                AS avg_security_wait_min
        FROM c_passenger_flow GROUP BY ALL""",
    "flow_keyed": f"""
        SELECT {sql_key('pf', '"date" NULLS FIRST, "hour" NULLS FIRST, terminal_zone NULLS FIRST, traffic_type NULLS FIRST')}
            AS passenger_flow_key, * FROM flow_grain""",
    "fact_passenger_flow": f"""
        SELECT passenger_flow_key, {sql_date_key('"date"')} AS date_key, terminal_zone_key, "hour", traffic_type,
            passengers_processed, avg_security_wait_min
        FROM flow_keyed LEFT JOIN dim_terminal_zone USING (terminal_zone)""",
    "fact_baggage_operations": f"""
        SELECT bag_event_id, flight_key, {sql_date_key('c.scheduled_time')} AS date_key, bags_processed,
            mishandled_bags, first_bag_min, last_bag_min
        FROM c_baggage_events b LEFT JOIN c_flights c ON b.flight_id = c.flight_id
            LEFT JOIN dim_flight f ON b.flight_id = f.flight_id""",
    "fact_commercial_transactions": f"""
        SELECT transaction_id, {sql_date_key('"timestamp"')} AS date_key, terminal_zone_key, "timestamp",
            revenue_category, payment_method, amount_cad
        FROM c_commercial_transactions LEFT JOIN dim_terminal_zone USING (terminal_zone)""",
    "fact_sustainability_daily": f"""
        SELECT {sql_date_key('"date"')} AS date_key, electricity_kwh, water_m3, waste_tonnes, estimated_co2e_tonnes
        FROM c_sustainability_daily""",
    "fact_passenger_feedback": f"""
        SELECT feedback_id, {sql_date_key('feedback_date')} AS date_key, feedback_text
        FROM c_passenger_feedback""",
    "operational_targets": f"""
        SELECT {sql_key('ot', 'kpi_name, effective_start_date')} AS target_key, * FROM c_operational_targets""",
}


def with_tables(final: str, **extra: str) -> str:
    """``final`` behind the definitions of all airport tables and of the ``extra`` ones."""
    parts = [f"{name} AS ({body.strip()})" for name, body in {**CTES, **extra}.items()]
    return "WITH " + ",\n".join(parts) + "\n" + final
