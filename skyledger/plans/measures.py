"""KPI measures: a registry, and their evaluation with one aggregation per fact."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numeric import blank_if_zero, div0, weighted_avg
from skyledger.plans.context import Filter, Model, propagate_filters, restrict, star_join
from skyledger.plans.targets import target_columns, target_status, target_variance

FLIGHTS = "fact_flight_operations"
FLOW = "fact_passenger_flow"
BAGGAGE = "fact_baggage_operations"
COMMERCIAL = "fact_commercial_transactions"
SUSTAINABILITY = "fact_sustainability_daily"
FEEDBACK = "fact_passenger_feedback"


@dataclass(frozen=True)
class Part:
    """A partial aggregate that can be kept per day and merged over days."""

    build: Callable[[], Column]
    merge: Callable[[str], Column] = F.sum


@dataclass(frozen=True)
class Aggregate:
    """An aggregate over one fact. ``columns`` are the fact columns it reads.

    With ``parts`` it is also ``finish`` of their merged values, so it can be rolled up from
    partial results instead of rows.
    """

    fact: str
    columns: tuple[str, ...]
    build: Callable[[], Column]
    parts: tuple[Part, ...] = ()
    finish: Callable[..., Column] = lambda value: value


@dataclass(frozen=True)
class GroupMean:
    """Mean over the groups of a fact of the sum of a column: a two-level aggregate."""

    fact: str
    group: tuple[str, ...]
    column: str


@dataclass(frozen=True)
class Derived:
    """Computed from other measures of the same result row, possibly of several facts.

    ``zero_on_blank`` marks a ratio with alternate 0: it has a value even where no fact row is.
    """

    inputs: tuple[str, ...]
    build: Callable[..., Column]
    zero_on_blank: bool = False


@dataclass(frozen=True)
class AsOfTarget:
    """The target in force on the latest date of the filter context."""

    kpi_code: str


Measure = Aggregate | GroupMean | Derived | AsOfTarget


def _rows(fact: str) -> Aggregate:
    part = Part(lambda: F.count(F.lit(1)))
    return Aggregate(fact, (), lambda: blank_if_zero(F.count(F.lit(1))), (part,), blank_if_zero)


def _sum(fact: str, column: str) -> Aggregate:
    return Aggregate(fact, (column,), lambda: F.sum(column), (Part(lambda: F.sum(column)),))


def _avg(fact: str, column: str) -> Aggregate:
    parts = (Part(lambda: F.sum(column)), Part(lambda: F.count(column)))
    return Aggregate(fact, (column,), lambda: F.avg(column), parts, F.try_divide)


def _max(fact: str, column: str) -> Aggregate:
    return Aggregate(fact, (column,), lambda: F.max(column), (Part(lambda: F.max(column), F.max),))


def _weighted(fact: str, value: str, weight: str) -> Aggregate:
    parts = (Part(lambda: F.sum(F.col(value) * F.col(weight))), Part(lambda: F.sum(weight)))
    return Aggregate(fact, (value, weight), lambda: weighted_avg(F.col(value), F.col(weight)), parts, F.try_divide)


def _sum_where(fact: str, column: str, condition: Callable[[Column], Column]) -> Aggregate:
    part = Part(lambda: F.sum(F.when(condition(F.col(column)), F.col(column))))
    return Aggregate(fact, (column,), part.build, (part,))


def _rows_where(fact: str, column: str, condition: Callable[[Column], Column]) -> Aggregate:
    part = Part(lambda: F.count_if(condition(F.col(column))))
    return Aggregate(fact, (column,), lambda: blank_if_zero(part.build()), (part,), blank_if_zero)


def _ratio0(numerator: str, denominator: str) -> Derived:
    return Derived((numerator, denominator), div0, zero_on_blank=True)


def _variance(actual: str, target: str) -> Derived:
    return Derived((actual, target), target_variance)


def _status(actual: str, target: str, direction: str) -> Derived:
    return Derived((actual, target), lambda a, t: target_status(a, t, direction))


MEASURES: dict[str, Measure] = {
    # flight operations
    "Total Flights": _rows(FLIGHTS),
    "Total Passengers": _sum(FLIGHTS, "passenger_count"),
    "Total Seat Capacity": _sum(FLIGHTS, "seat_capacity"),
    "Load Factor %": _ratio0("Total Passengers", "Total Seat Capacity"),
    "Delayed Flights": _rows_where(FLIGHTS, "status", lambda c: c == "Delayed"),
    "Cancelled Flights": _rows_where(FLIGHTS, "status", lambda c: c == "Cancelled"),
    "On-Time Flights": _rows_where(FLIGHTS, "status", lambda c: c == "On Time"),
    "On-Time Performance %": _ratio0("On-Time Flights", "Total Flights"),
    "Cancellation Rate %": _ratio0("Cancelled Flights", "Total Flights"),
    "Average Delay Minutes": _avg(FLIGHTS, "delay_minutes"),
    # passenger flow
    "Total Passengers Processed": _sum(FLOW, "passengers_processed"),
    "Average Security Wait Time": _weighted(FLOW, "avg_security_wait_min", "passengers_processed"),
    "Maximum Security Wait Time": _max(FLOW, "avg_security_wait_min"),
    "Average Passengers per Hour": GroupMean(FLOW, ("date_key", "hour"), "passengers_processed"),
    # baggage
    "Total Bags Processed": _sum(BAGGAGE, "bags_processed"),
    "Mishandled Bags": _sum(BAGGAGE, "mishandled_bags"),
    "Mishandled Baggage Rate %": _ratio0("Mishandled Bags", "Total Bags Processed"),
    "Average First Bag Time": _avg(BAGGAGE, "first_bag_min"),
    "Average Last Bag Time": _avg(BAGGAGE, "last_bag_min"),
    # commercial
    "Total Commercial Revenue": _sum(COMMERCIAL, "amount_cad"),
    "Total Transactions": _rows(COMMERCIAL),
    "Average Transaction Value": _avg(COMMERCIAL, "amount_cad"),
    "Refund Adjustment Amount": _sum_where(COMMERCIAL, "amount_cad", lambda c: c < 0),
    "Refund Adjustment Transactions": _rows_where(COMMERCIAL, "amount_cad", lambda c: c < 0),
    "Refund Adjustment Rate %": _ratio0("Refund Adjustment Transactions", "Total Transactions"),
    # sustainability
    "Total Electricity Consumption": _sum(SUSTAINABILITY, "electricity_kwh"),
    "Average Daily Electricity Consumption": _avg(SUSTAINABILITY, "electricity_kwh"),
    "Total Water Consumption": _sum(SUSTAINABILITY, "water_m3"),
    "Average Daily Water Consumption": _avg(SUSTAINABILITY, "water_m3"),
    "Total Waste Generated": _sum(SUSTAINABILITY, "waste_tonnes"),
    "Total Estimated CO2e Emissions": _sum(SUSTAINABILITY, "estimated_co2e_tonnes"),
    # passenger feedback
    "Total Feedback": _rows(FEEDBACK),
    "Undated Feedback": _rows_where(FEEDBACK, "date_key", lambda c: c.isNull()),
    "Feedback with Valid Date": _rows_where(FEEDBACK, "date_key", lambda c: c.isNotNull()),
    "Dated Feedback Rate %": _ratio0("Feedback with Valid Date", "Total Feedback"),
    # several facts
    "Revenue per Passenger": _ratio0("Total Commercial Revenue", "Total Passengers Processed"),
    "Energy per Passenger": _ratio0("Total Electricity Consumption", "Total Passengers Processed"),
    # targets
    "Average Delay Target": AsOfTarget("AVG_DELAY"),
    "On-Time Performance Target": AsOfTarget("ON_TIME_PERFORMANCE"),
    "Security Wait Time Target": AsOfTarget("SECURITY_WAIT_TIME"),
    "Average Last Bag Time Target": AsOfTarget("LAST_BAG_TIME"),
    "Revenue per Passenger Target": AsOfTarget("REVENUE_PER_PASSENGER"),
    "Energy per Passenger Target": AsOfTarget("ENERGY_PER_PASSENGER"),
    # actual against target
    "Average Delay Variance": _variance("Average Delay Minutes", "Average Delay Target"),
    "Average Delay Target Status": _status("Average Delay Minutes", "Average Delay Target", "<="),
    "On-Time Performance Variance": _variance("On-Time Performance %", "On-Time Performance Target"),
    "On-Time Performance Target Status": _status("On-Time Performance %", "On-Time Performance Target", ">="),
    "Security Wait Time Variance": _variance("Average Security Wait Time", "Security Wait Time Target"),
    "Security Wait Time Target Status": _status("Average Security Wait Time", "Security Wait Time Target", "<="),
    "Baggage Delivery Variance": _variance("Average Last Bag Time", "Average Last Bag Time Target"),
    "Baggage Delivery Target Status": _status("Average Last Bag Time", "Average Last Bag Time Target", "<="),
    "Revenue per Passenger Variance": _variance("Revenue per Passenger", "Revenue per Passenger Target"),
    "Revenue per Passenger Target Status": _status("Revenue per Passenger", "Revenue per Passenger Target", ">="),
    "Energy per Passenger Variance": _variance("Energy per Passenger", "Energy per Passenger Target"),
    "Energy per Passenger Target Status": _status("Energy per Passenger", "Energy per Passenger Target", "<="),
}

# Measures that make a target card: (actual, target, variance, status).
TARGET_CARDS = {
    "Average Delay Minutes": ("Average Delay Target", "Average Delay Variance", "Average Delay Target Status"),
    "On-Time Performance %": (
        "On-Time Performance Target",
        "On-Time Performance Variance",
        "On-Time Performance Target Status",
    ),
    "Average Security Wait Time": (
        "Security Wait Time Target",
        "Security Wait Time Variance",
        "Security Wait Time Target Status",
    ),
    "Average Last Bag Time": (
        "Average Last Bag Time Target",
        "Baggage Delivery Variance",
        "Baggage Delivery Target Status",
    ),
    "Revenue per Passenger": (
        "Revenue per Passenger Target",
        "Revenue per Passenger Variance",
        "Revenue per Passenger Target Status",
    ),
    "Energy per Passenger": (
        "Energy per Passenger Target",
        "Energy per Passenger Variance",
        "Energy per Passenger Target Status",
    ),
}


def with_inputs(names: Sequence[str], registry: dict[str, Measure]) -> list[str]:
    """The measures and everything they are derived from, inputs first."""
    ordered: dict[str, None] = {}

    def visit(name: str) -> None:
        measure = registry[name]
        if isinstance(measure, Derived):
            for source in measure.inputs:
                visit(source)
        ordered.setdefault(name)

    for name in names:
        visit(name)
    return list(ordered)


def drill_across(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Measures of several facts on shared keys.

    Each part is already aggregated to the keys, so it has one row per group. The parts are
    stacked and grouped once more: a full outer join on null-safe keys in a single shuffle.
    """
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    values = [name for name in stacked.columns if name not in keys]
    if not values:
        return stacked.distinct()
    return stacked.groupBy(*keys).agg(*[F.max(f"`{name}`").alias(name) for name in values])


def repeat_beside(groups: DataFrame, part: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The groups with the values of ``part``, which has one row per group of some of their keys.

    Null keys meet null keys, so the blank group keeps its values. Both sides are aggregated, and
    the join is on equal keys: no group meets another one's rows.
    """
    names = {key: f"__{i}_{key}" for i, key in enumerate(keys)}
    match = reduce(lambda a, b: a & b, [F.col(f"`{key}`").eqNullSafe(F.col(f"`{name}`")) for key, name in names.items()])
    return groups.join(part.withColumnsRenamed(names), match, "left").drop(*names.values())


def columns_of(fact: str, wanted: Mapping[str, Measure], by: Sequence[tuple[str, str]] = ()) -> set[str]:
    """The columns of a fact that its measures and its own attributes read."""
    columns = {column for table, column in by if table == fact}
    for measure in wanted.values():
        columns.update((*measure.group, measure.column) if isinstance(measure, GroupMean) else measure.columns)
    return columns


def _aggregate_fact(
    model: Model, fact: str, wanted: dict[str, Measure], by: Sequence[tuple[str, str]]
) -> list[DataFrame]:
    """The measures of one fact: all plain aggregates in one pass, two-level ones beside them."""
    keys = [column for _, column in by]
    parts = []
    plain = {name: m for name, m in wanted.items() if isinstance(m, Aggregate)}
    if plain:
        columns = {column for m in plain.values() for column in m.columns}
        # A count reads no column of its own; any key column serves to scan the rows.
        columns = columns or {model.facts[fact].columns[0]}
        joined = star_join(model, fact, by, sorted(columns))
        parts.append(joined.groupBy(*keys).agg(*[m.build().alias(name) for name, m in plain.items()]))
    for name, m in wanted.items():
        if isinstance(m, GroupMean):
            joined = star_join(model, fact, by, [*m.group, m.column])
            inner = [column for column in m.group if column not in keys]
            sums = joined.groupBy(*keys, *inner).agg(F.sum(m.column).alias("__sum"))
            parts.append(sums.groupBy(*keys).agg(F.avg("__sum").alias(name)))
    return parts


def _target_part(model: Model, targets: dict[str, str], by: Sequence[tuple[str, str]]) -> DataFrame:
    """Targets on the latest date of each group, or of the whole context without a date axis."""
    calendar = model.dimensions[model.date_dimension]
    axis = [column for table, column in by if table == model.date_dimension]
    latest = calendar.groupBy(*axis).agg(F.max("date").alias("__as_of"))
    columns = target_columns(latest, "__as_of", model.targets, targets)
    return latest.join(columns, "__as_of", "left").drop("__as_of")


def evaluate_base(
    model: Model,
    measures: Sequence[str],
    by: Sequence[tuple[str, str]] = (),
    filters: Sequence[Filter] = (),
    registry: dict[str, Measure] = MEASURES,
) -> DataFrame:
    """The aggregates and targets that the measures need, one row per group of ``by``.

    Measures are grouped by fact, so every fact is scanned once, aggregated to the groups, and
    only then brought together. A fact without a relationship to an attribute gives the same
    total to each member of it: one that is related to none of the attributes is a single row,
    one that is related to some is aggregated to those and repeated beside the groups of the
    other measures that agree on them (blank groups included). The groups themselves come from the
    measures related to every attribute, and there must be one. Where a ratio with alternate 0 is
    asked for, the members of the dimension without any fact row are groups too.
    """
    keys = [column for _, column in by]
    needed = with_inputs(measures, registry)
    base: dict[str, dict[str, Measure]] = {}
    for name in needed:
        measure = registry[name]
        if isinstance(measure, (Aggregate, GroupMean)):
            base.setdefault(measure.fact, {})[name] = measure
    targets = {m.kpi_code: name for name in needed if isinstance(m := registry[name], AsOfTarget)}
    by_tables = {table for table, _ in by}
    tables = {*base, *by_tables, *(item.table for item in filters)}
    if targets:
        tables.add(model.date_dimension)
    model = propagate_filters(restrict(model, tables), filters, {f: columns_of(f, m, by) for f, m in base.items()})

    related, totals, partial = [], [], []
    for fact, wanted in base.items():
        reachable = [
            (table, column) for table, column in by if table == fact or model.key_between(fact, table) is not None
        ]
        if len(reachable) == len(by):
            related += _aggregate_fact(model, fact, wanted, by)
        elif reachable:
            shared = [column for _, column in reachable]
            partial += [(part, shared) for part in _aggregate_fact(model, fact, wanted, reachable)]
        else:
            totals += _aggregate_fact(model, fact, wanted, [])

    date_axis = [column for table, column in by if table == model.date_dimension]
    if targets:
        target_part = _target_part(model, targets, by)
        if len(date_axis) == len(by):
            related.append(target_part)
        elif not date_axis:
            totals.append(target_part)
    zero_on_blank = any(isinstance(m := registry[name], Derived) and m.zero_on_blank for name in needed)
    if by and (not related or (zero_on_blank and by_tables <= set(model.dimensions))) and len(by_tables) == 1:
        (source,) = by_tables
        members = model.dimensions[source] if source in model.dimensions else model.facts[source]
        related.append(members.select(*keys).distinct())
    if not related:
        raise ValueError(f"no measure to evaluate by {by}")
    result = drill_across(related, keys)
    for part, shared in partial:
        result = repeat_beside(result, part, shared)
    for part in totals:
        # One scalar subquery per part; its fields are unpacked beside every group.
        row = part.select(F.struct(*[f"`{name}`" for name in part.columns])).scalar()
        result = result.select("*", row.alias("__total")).select(
            *[f"`{name}`" for name in result.columns], *[F.col(f"__total.`{name}`") for name in part.columns]
        )
    if targets and 0 < len(date_axis) < len(by):
        result = result.join(target_part, date_axis, "left")
    return result


def derive(base: DataFrame, measures: Sequence[str], registry: dict[str, Measure] = MEASURES) -> DataFrame:
    """Add the derived measures to a row of aggregates and targets."""
    for name in with_inputs(measures, registry):
        measure = registry[name]
        if isinstance(measure, Derived):
            base = base.withColumn(name, measure.build(*[F.col(f"`{source}`") for source in measure.inputs]))
    return base


def evaluate(
    model: Model,
    measures: Sequence[str],
    by: Sequence[tuple[str, str]] = (),
    filters: Sequence[Filter] = (),
    registry: dict[str, Measure] = MEASURES,
) -> DataFrame:
    """One row per group of the (table, column) attributes in ``by``, one column per measure.

    Groups in which every measure is blank are left out; without ``by`` there is always one row.
    """
    derived = derive(evaluate_base(model, measures, by, filters, registry), measures, registry)
    result = derived.select(*[column for _, column in by], *[f"`{name}`" for name in measures])
    return result.dropna(how="all", subset=list(measures)) if by else result


def long_form(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per group and measure; text measures (statuses) go to ``text_value``."""
    types = dict(df.dtypes)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("measure"),
                (F.lit(None) if types[name] == "string" else F.col(f"`{name}`")).cast("double").alias("value"),
                (F.col(f"`{name}`") if types[name] == "string" else F.lit(None)).cast("string").alias("text_value"),
            )
            for name in measures
        ]
    )
    return df.select(*keys, F.inline(rows))
