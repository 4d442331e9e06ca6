"""Governed KPI queries: an approved metric, an approved dimension, inclusive periods, a result table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.text import normalize_text
from skyledger.plans import daily
from skyledger.plans.context import Filter, Model, filter_date_between
from skyledger.plans.measures import MEASURES, derive, evaluate, evaluate_base, long_form
from skyledger.session import materialize

# Metric, page, unit, kind (nonnegative, rate or signed), aliases.
KPI_REGISTRY = [
    ("Total Flights", "Flights", "flights", "nonnegative", ["flight count"]),
    (
        "On-Time Performance %",
        "Flights",
        "percent",
        "rate",
        ["otp", "on time performance", "flight punctuality"],
    ),
    ("Average Delay Minutes", "Flights", "minutes", "nonnegative", ["average flight delay"]),
    ("Load Factor %", "Flights", "percent", "rate", ["load factor"]),
    ("Cancellation Rate %", "Flights", "percent", "rate", ["cancellation rate"]),
    ("Total Passengers", "Flights", "passengers", "nonnegative", ["flight passengers"]),
    (
        "Total Passengers Processed",
        "Passenger",
        "passengers",
        "nonnegative",
        [
            "passenger traffic",
            "passenger throughput",
            "passenger volume",
            "passengers processed",
            "total number of passengers processed",
            "number of passengers processed",
            "total passenger traffic",
        ],
    ),
    ("Average Security Wait Time", "Passenger", "minutes", "nonnegative", ["security wait time"]),
    ("Total Bags Processed", "Baggage", "bags", "nonnegative", ["baggage volume"]),
    ("Mishandled Baggage Rate %", "Baggage", "percent", "rate", ["mishandled baggage rate"]),
    ("Average First Bag Time", "Baggage", "minutes", "nonnegative", ["first bag time"]),
    ("Average Last Bag Time", "Baggage", "minutes", "nonnegative", ["last bag time"]),
    (
        "Total Commercial Revenue",
        "Commercial",
        "currency",
        "signed",
        ["commercial revenue", "net commercial revenue"],
    ),
    ("Average Transaction Value", "Commercial", "currency", "signed", ["transaction value"]),
    ("Revenue per Passenger", "Commercial", "currency/passenger", "signed", ["commercial yield"]),
    (
        "Total Electricity Consumption",
        "Sustainability",
        "kWh",
        "nonnegative",
        ["electricity consumption", "electricity"],
    ),
    ("Total Water Consumption", "Sustainability", "m³", "nonnegative", ["water consumption"]),
    ("Total Waste Generated", "Sustainability", "tonnes", "nonnegative", ["waste generated"]),
    (
        "Total Estimated CO2e Emissions",
        "Sustainability",
        "tonnes CO2e",
        "nonnegative",
        ["carbon emissions", "co2 emissions"],
    ),
    ("Energy per Passenger", "Sustainability", "kWh/passenger", "nonnegative", ["electricity per passenger"]),
    ("Total Feedback", "Experience", "submissions", "nonnegative", ["passenger feedback", "feedback submissions"]),
]

# Accepted spelling of a dimension -> (dimension, column).
DIMENSION_SPELLINGS = {
    "dimairline": ("dim_airline", "airline_name"),
    "airline": ("dim_airline", "airline_name"),
    "airline_name": ("dim_airline", "airline_name"),
    "dimflight": ("dim_flight", "flight_id"),
    "flight": ("dim_flight", "flight_id"),
    "dimgate": ("dim_gate", "gate_id"),
    "gate": ("dim_gate", "gate_id"),
    "dimterminalzone": ("dim_terminal_zone", "terminal_zone"),
    "terminal": ("dim_terminal_zone", "terminal_zone"),
    "terminal zone": ("dim_terminal_zone", "terminal_zone"),
    "terminal_zone": ("dim_terminal_zone", "terminal_zone"),
}


@dataclass(frozen=True)
class Period:
    """A labelled period with both ends inclusive."""

    label: str
    start: date
    end: date


def registry_rows(spark: SparkSession) -> DataFrame:
    """The approved metrics as a table."""
    rows = [(name, page, unit, kind) for name, page, unit, kind, _ in KPI_REGISTRY]
    return spark.createDataFrame(rows, "metric string, page string, unit string, kind string")


def alias_rows(spark: SparkSession) -> DataFrame:
    """One row per accepted label of a metric, its own name included."""
    rows = [(label, name) for name, _, _, _, aliases in KPI_REGISTRY for label in (name, *aliases)]
    return spark.createDataFrame(rows, "label string, metric string").withColumn(
        "alias", normalize_text(F.col("label"))
    )


def lookup_column(key: Column, entries: dict[str, str]) -> Column:
    """The entry of a fixed dictionary; null for another key."""
    pairs = [F.lit(part) for pair in entries.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def validate_metric(name: Column) -> Column:
    """The approved spelling of a metric name, case-insensitive; null if it is not approved."""
    return lookup_column(F.lower(F.trim(name)), {row[0].lower(): row[0] for row in KPI_REGISTRY})


def resolve_dimension(name: Column) -> Column:
    """struct<dimension, column> of an accepted spelling; null otherwise."""
    key = F.lower(F.trim(name))
    table = lookup_column(key, {spelling: target[0] for spelling, target in DIMENSION_SPELLINGS.items()})
    column = lookup_column(key, {spelling: target[1] for spelling, target in DIMENSION_SPELLINGS.items()})
    return F.when(table.isNotNull(), F.struct(table.alias("dimension"), column.alias("column")))


def approved_metric(name: str) -> str:
    """validate_metric for a single request; an unknown metric is an error."""
    by_key = {row[0].lower(): row[0] for row in KPI_REGISTRY}
    key = name.strip().lower()
    if key not in by_key:
        raise ValueError(f"not an approved metric: {name!r}")
    return by_key[key]


def approved_dimension(name: str) -> tuple[str, str]:
    """resolve_dimension for a single request; an unknown dimension is an error."""
    key = name.strip().lower()
    if key not in DIMENSION_SPELLINGS:
        raise ValueError(f"not an approved dimension: {name!r}")
    return DIMENSION_SPELLINGS[key]


def period_filter(start: date, end: date) -> Filter:
    """Both ends inclusive."""
    return filter_date_between("dim_date", "date", start, end + timedelta(days=1))


def drop_blank_members(df: DataFrame, value: str = "value") -> DataFrame:
    """A breakdown omits the members without a value."""
    return df.filter(F.col(value).isNotNull())


def top_with_ties(df: DataFrame, value: str, n: int = 1, ascending: bool = False) -> DataFrame:
    """The ``n`` best rows and every row that ties with the last of them.

    The bound is a scalar from a top-n, so any number of ties is filtered where it lies instead
    of being ranked in one task.
    """
    column = F.col(value)
    best = df.filter(column.isNotNull()).select(value).orderBy(column.asc() if ascending else column.desc()).limit(n)
    bound = best.agg((F.max if ascending else F.min)(value)).scalar()
    return df.filter(column <= bound if ascending else column >= bound)


def kpi_lookup(model: Model, metric: str, period: Period | None = None) -> DataFrame:
    """One value over all dates or over one period."""
    metric = approved_metric(metric)
    filters = [period_filter(period.start, period.end)] if period else []
    result = evaluate(model, [metric], filters=filters)
    label = period.label if period else "all available dates"
    return result.select(
        F.lit(metric).alias("metric"), F.lit(label).alias("period"), F.col(f"`{metric}`").alias("value")
    )


PERIOD_COLUMNS = ["label", "start_date", "end_date"]


def _by_period(model: Model, periods: DataFrame) -> Model:
    """The model with its calendar joined to the days of the periods.

    A day of several periods appears once per period, so overlapping periods each get their rows.
    A period query needs no other dimension. The calendar serves every fact and the targets, so
    it is written once; its size is then known, and the joins to it can be broadcast.
    """
    days = periods.select(*PERIOD_COLUMNS).distinct().withColumn("date", F.explode(F.sequence("start_date", "end_date")))
    calendar = materialize(model.dimensions["dim_date"].join(days, "date"), "period_calendar")
    return replace(model, dimensions={"dim_date": calendar})


def kpi_by_period(model: Model, metrics: Sequence[str], periods: DataFrame, filters: Sequence[Filter] = ()) -> DataFrame:
    """Metrics per row of a table of periods (label, start_date, end_date), in long form.

    A period without facts keeps its row: blank, or 0 for a ratio with alternate 0. Each fact is
    reduced to its days once and the periods are rolled up from those; metrics that cannot be
    merged over days (targets) are evaluated on a calendar joined to the periods.
    """
    if daily.can_roll_up(model, metrics, MEASURES):
        states = daily.daily_states(model, metrics, MEASURES, filters)
        base = daily.by_period(states, model.dimensions[model.date_dimension], periods, PERIOD_COLUMNS)
    else:
        by = [("dim_date", column) for column in PERIOD_COLUMNS]
        base = evaluate_base(_by_period(model, periods), metrics, by=by, filters=filters)
    wide = derive(periods.join(base, PERIOD_COLUMNS, "left"), metrics)
    return long_form(wide, periods.columns, metrics).drop("text_value")


def period_rows(spark: SparkSession, periods: Sequence[Period]) -> DataFrame:
    rows = [(number, p.label, p.start, p.end) for number, p in enumerate(periods, start=1)]
    return spark.createDataFrame(rows, "period_no int, label string, start_date date, end_date date")


def kpi_compare(model: Model, metric: str, periods: Sequence[Period]) -> DataFrame:
    """One value per period; at least two periods."""
    if len(periods) < 2:
        raise ValueError("a comparison needs at least two periods")
    metric = approved_metric(metric)
    spark = model.dimensions["dim_date"].sparkSession
    # The span of all periods reaches the scan of the facts as bounds of the date key.
    span = period_filter(min(p.start for p in periods), max(p.end for p in periods))
    return kpi_by_period(model, [metric], period_rows(spark, periods), [span]).withColumnRenamed("measure", "metric")


def kpi_breakdown(model: Model, metric: str, dimension: str, period: Period | None = None) -> DataFrame:
    """The metric per member of a dimension; members without a value are left out."""
    metric = approved_metric(metric)
    table, column = approved_dimension(dimension)
    filters = [period_filter(period.start, period.end)] if period else []
    result = evaluate(model, [metric], by=[(table, column)], filters=filters)
    return drop_blank_members(result.select(F.col(column).alias("member"), F.col(f"`{metric}`").alias("value")))


def kpi_ranking(
    model: Model,
    metric: str,
    dimension: str,
    n: int = 1,
    ascending: bool = False,
    period: Period | None = None,
) -> DataFrame:
    """The ``n`` best members with ties; ``ascending`` ranks the lowest first."""
    return top_with_ties(kpi_breakdown(model, metric, dimension, period), "value", n, ascending)


def kpi_query(
    model: Model,
    intent: str,
    metric: str,
    dimension: str | None = None,
    periods: Sequence[Period] = (),
    ascending: bool = False,
) -> DataFrame:
    """Run a validated request: lookup, compare, breakdown or ranking.

    A lookup uses the first period only; breakdown and ranking use it as their filter.
    """
    first = periods[0] if periods else None
    if intent == "lookup":
        return kpi_lookup(model, metric, first)
    if intent == "compare":
        return kpi_compare(model, metric, periods)
    if intent not in ("breakdown", "ranking"):
        raise ValueError(f"unsupported intent: {intent!r}")
    if dimension is None:
        raise ValueError(f"a {intent} needs a dimension")
    if intent == "breakdown":
        return kpi_breakdown(model, metric, dimension, first)
    return kpi_ranking(model, metric, dimension, ascending=ascending, period=first)


def alias_conflicts(aliases: DataFrame, alias: str = "alias", metric: str = "metric") -> DataFrame:
    """Aliases that name more than one metric."""
    return (
        aliases.groupBy(alias, metric)
        .agg(F.lit(1).alias("__one"))
        .groupBy(alias)
        .agg(F.count(F.lit(1)).alias("metric_count"))
        .filter(F.col("metric_count") > 1)
    )


def metric_attributes(metric: Column) -> dict[str, Column]:
    """Page, unit and kind of an approved metric as lookup columns."""
    return {
        name: lookup_column(metric, {row[0]: row[position] for row in KPI_REGISTRY})
        for name, position in (("page", 1), ("unit", 2), ("kind", 3))
    }
