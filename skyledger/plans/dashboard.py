"""The dashboard queries: shapes of visuals, and every data visual of the seven pages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.text import words
from skyledger.plans.context import Filter, Model, propagate_filters, restrict, star_join
from skyledger.plans.measures import (
    COMMERCIAL,
    FEEDBACK,
    FLIGHTS,
    FLOW,
    TARGET_CARDS,
    evaluate,
)

DATE = ("dim_date", "date")
AIRLINE = ("dim_airline", "airline_name")
ZONE = ("dim_terminal_zone", "terminal_zone")


def card_single(model: Model, measures: Sequence[str], filters: Sequence[Filter] = ()) -> DataFrame:
    """One row with the measures over the whole context."""
    return evaluate(model, measures, filters=filters)


def card_kpi_target(model: Model, measure: str, filters: Sequence[Filter] = ()) -> DataFrame:
    """Actual, target, variance and status in one row."""
    names = [measure, *TARGET_CARDS[measure]]
    result = evaluate(model, names, filters=filters)
    return result.select(
        F.lit(measure).alias("measure"),
        *[F.col(f"`{name}`").alias(out) for name, out in zip(names, ["actual", "target", "variance", "status"])],
    )


def cards_kpi_target(model: Model, measures: Sequence[str], filters: Sequence[Filter] = ()) -> DataFrame:
    """The target cards of several measures, one row each, from one evaluation."""
    names = {measure: [measure, *TARGET_CARDS[measure]] for measure in measures}
    row = evaluate(model, [name for own in names.values() for name in own], filters=filters)
    cards = [
        F.struct(
            F.lit(measure).alias("measure"),
            *[F.col(f"`{name}`").cast("double").alias(out) for name, out in zip(own[:3], ["actual", "target", "variance"], strict=True)],
            F.col(f"`{own[3]}`").alias("status"),
        )
        for measure, own in names.items()
    ]
    return row.select(F.inline(F.array(*cards)))


def trend_by_date(model: Model, measures: Sequence[str], filters: Sequence[Filter] = ()) -> DataFrame:
    """Measures per date, ascending. Facts without a date form the blank group."""
    return evaluate(model, measures, by=[DATE], filters=filters).orderBy(F.asc_nulls_first("date"))


def trend_by_date_series(
    model: Model, measure: str, series: tuple[str, str], filters: Sequence[Filter] = ()
) -> DataFrame:
    """A measure per date and member of a series, in long form."""
    result = evaluate(model, [measure], by=[DATE, series], filters=filters)
    return result.orderBy(F.asc_nulls_first("date"), series[1])


def breakdown_by_attribute(
    model: Model, attribute: tuple[str, str], measures: Sequence[str], filters: Sequence[Filter] = ()
) -> DataFrame:
    """Measures per member of an attribute, the first measure descending."""
    result = evaluate(model, measures, by=[attribute], filters=filters)
    return result.orderBy(F.desc(f"`{measures[0]}`"), F.asc(attribute[1]))


def detail_table(
    model: Model, fact: str, columns: Sequence[str], attributes: Sequence[tuple[str, str]], filters: Sequence[Filter] = ()
) -> DataFrame:
    """Fact rows with dimension attributes, sorted by the fact columns.

    The first column of the fact, its key, ends the order: equal texts then still split over tasks.
    """
    tables = {fact, *(table for table, _ in attributes), *(item.table for item in filters)}
    model = propagate_filters(restrict(model, tables), filters)
    key = model.facts[fact].columns[0]
    joined = star_join(model, fact, attributes, [*columns, key]).orderBy(*columns, key)
    return joined.select(*[column for _, column in attributes], *columns)


def word_frequency(df: DataFrame, text: str) -> DataFrame:
    """How often each word occurs; counted per task before the shuffle, so a frequent word is no hot key."""
    found = df.select(F.explode(words(F.col(text))).alias("word")).filter(F.col("word") != "")
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))


def slicer_domain(model: Model, attribute: tuple[str, str], where: str | None = None) -> DataFrame:
    """The values a slicer offers, of the rows that its own filter leaves."""
    table, column = attribute
    source = model.dimensions[table] if table in model.dimensions else model.facts[table]
    return (source if where is None else source.filter(where)).select(column).distinct()


def slicer_range(model: Model, attribute: tuple[str, str] = DATE) -> DataFrame:
    """The bounds of a range slicer."""
    table, column = attribute
    return model.dimensions[table].agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


@dataclass(frozen=True)
class Visual:
    page: str
    name: str
    shape: str
    measures: tuple[str, ...] = ()
    by: tuple[str, str] | None = None
    # The visual's own filter: a condition on the rows of its table.
    where: str | None = None


# Every data visual: page, name, shape, measures, attribute.
VISUALS = [
    Visual("Overview", "revenue per passenger", "card_kpi_target", ("Revenue per Passenger",)),
    Visual("Overview", "energy per passenger", "card_kpi_target", ("Energy per Passenger",)),
    Visual("Overview", "on-time performance", "card_kpi_target", ("On-Time Performance %",)),
    Visual("Overview", "security wait", "card_kpi_target", ("Average Security Wait Time",)),
    Visual("Overview", "passengers by date", "trend_by_date", ("Total Passengers Processed",)),
    Visual(
        "Overview",
        "revenue by category",
        "breakdown_by_attribute",
        ("Total Commercial Revenue",),
        (COMMERCIAL, "revenue_category"),
    ),
    Visual("Overview", "date slicer", "slicer_range", by=DATE),
    Visual("Overview", "zone slicer", "slicer_domain", by=ZONE, where="terminal_zone IS NOT NULL"),
    Visual("Flights", "on-time performance", "card_kpi_target", ("On-Time Performance %",)),
    Visual("Flights", "delay", "card_kpi_target", ("Average Delay Minutes",)),
    Visual("Flights", "load factor", "card_single", ("Load Factor %",)),
    Visual("Flights", "cancellation", "card_single", ("Cancellation Rate %",)),
    Visual("Flights", "on-time by date", "trend_by_date", ("On-Time Performance %",)),
    Visual(
        "Flights",
        "on-time by airline",
        "breakdown_by_attribute",
        ("On-Time Performance %", "Average Delay Minutes", "Total Flights", "Cancellation Rate %"),
        AIRLINE,
    ),
    Visual(
        "Flights",
        "delays by reason",
        "breakdown_by_attribute",
        ("Delayed Flights", "Average Delay Minutes", "Total Flights"),
        (FLIGHTS, "delay_reason"),
    ),
    Visual("Flights", "date slicer", "slicer_range", by=DATE),
    Visual("Flights", "airline slicer", "slicer_domain", by=AIRLINE, where="airline_name IS NOT NULL"),
    Visual("Passenger", "security wait", "card_kpi_target", ("Average Security Wait Time",)),
    Visual("Passenger", "maximum wait", "card_single", ("Maximum Security Wait Time",)),
    Visual("Passenger", "passengers per hour", "card_single", ("Average Passengers per Hour",)),
    Visual("Passenger", "passengers", "card_single", ("Total Passengers Processed",)),
    Visual(
        "Passenger",
        "passengers by date and type",
        "trend_by_date_series",
        ("Total Passengers Processed",),
        (FLOW, "traffic_type"),
    ),
    Visual(
        "Passenger",
        "passengers by hour",
        "breakdown_by_attribute",
        ("Total Passengers Processed", "Average Security Wait Time"),
        (FLOW, "hour"),
    ),
    Visual(
        "Passenger",
        "wait by zone",
        "breakdown_by_attribute",
        ("Average Security Wait Time", "Total Passengers Processed", "Maximum Security Wait Time"),
        ZONE,
    ),
    Visual("Passenger", "date slicer", "slicer_range", by=DATE),
    Visual("Passenger", "traffic type slicer", "slicer_domain", by=(FLOW, "traffic_type")),
    Visual("Baggage", "bags", "card_single", ("Total Bags Processed",)),
    Visual("Baggage", "mishandled rate", "card_single", ("Mishandled Baggage Rate %",)),
    Visual("Baggage", "first bag", "card_single", ("Average First Bag Time",)),
    Visual("Baggage", "last bag", "card_single", ("Average Last Bag Time",)),
    Visual("Baggage", "bag times by date", "trend_by_date", ("Average First Bag Time", "Average Last Bag Time")),
    Visual("Baggage", "mishandled rate by date", "trend_by_date", ("Mishandled Baggage Rate %",)),
    Visual(
        "Baggage",
        "volume by date",
        "trend_by_date",
        ("Total Bags Processed", "Mishandled Bags", "Mishandled Baggage Rate %"),
    ),
    Visual("Baggage", "date slicer", "slicer_range", by=DATE),
    Visual("Commercial", "revenue per passenger", "card_kpi_target", ("Revenue per Passenger",)),
    Visual("Commercial", "transactions", "card_single", ("Total Transactions",)),
    Visual("Commercial", "transaction value", "card_single", ("Average Transaction Value",)),
    Visual("Commercial", "revenue", "card_single", ("Total Commercial Revenue",)),
    Visual(
        "Commercial",
        "revenue by date",
        "trend_by_date",
        ("Total Commercial Revenue", "Total Transactions", "Average Transaction Value"),
    ),
    Visual(
        "Commercial",
        "refunds by date",
        "trend_by_date",
        ("Refund Adjustment Amount", "Refund Adjustment Rate %", "Total Transactions"),
    ),
    Visual(
        "Commercial",
        "revenue by category",
        "breakdown_by_attribute",
        ("Total Commercial Revenue", "Total Transactions", "Average Transaction Value"),
        (COMMERCIAL, "revenue_category"),
    ),
    Visual("Commercial", "date slicer", "slicer_range", by=DATE),
    Visual("Commercial", "category slicer", "slicer_domain", by=(COMMERCIAL, "revenue_category")),
    Visual("Sustainability", "energy per passenger", "card_kpi_target", ("Energy per Passenger",)),
    Visual("Sustainability", "electricity", "card_single", ("Total Electricity Consumption",)),
    Visual("Sustainability", "emissions", "card_single", ("Total Estimated CO2e Emissions",)),
    Visual("Sustainability", "water", "card_single", ("Total Water Consumption",)),
    Visual(
        "Sustainability",
        "electricity by date",
        "trend_by_date",
        ("Total Electricity Consumption", "Energy per Passenger"),
    ),
    Visual("Sustainability", "water by date", "trend_by_date", ("Total Water Consumption",)),
    Visual(
        "Sustainability",
        "emissions by date",
        "trend_by_date",
        ("Total Estimated CO2e Emissions", "Total Waste Generated"),
    ),
    Visual("Sustainability", "date slicer", "slicer_range", by=DATE),
    Visual("Experience", "feedback", "card_single", ("Total Feedback",)),
    Visual("Experience", "feedback by date", "trend_by_date", ("Total Feedback", "Energy per Passenger")),
    Visual("Experience", "comments", "detail_table", by=(FEEDBACK, "feedback_text")),
    Visual(
        "Experience",
        "words",
        "word_frequency",
        by=(FEEDBACK, "feedback_text"),
        where="NOT (contains(lower(feedback_text), 'was') AND contains(lower(feedback_text), 'the'))",
    ),
    Visual("Experience", "date slicer", "slicer_range", by=DATE),
]

PAGES = list(dict.fromkeys(visual.page for visual in VISUALS))


def visual(page: str, name: str) -> Visual:
    for item in VISUALS:
        if (item.page, item.name) == (page, name):
            return item
    raise KeyError(f"{page}: {name}")


def run_visual(model: Model, item: Visual, filters: Sequence[Filter] = ()) -> DataFrame:
    """The result table of one visual under the slicers' filters."""
    if item.shape == "card_single":
        return card_single(model, item.measures, filters)
    if item.shape == "card_kpi_target":
        return card_kpi_target(model, item.measures[0], filters)
    if item.shape == "trend_by_date":
        return trend_by_date(model, item.measures, filters)
    if item.shape == "trend_by_date_series":
        return trend_by_date_series(model, item.measures[0], item.by, filters)
    if item.shape == "breakdown_by_attribute":
        return breakdown_by_attribute(model, item.by, item.measures, filters)
    if item.shape == "slicer_domain":
        return slicer_domain(model, item.by, item.where)
    if item.shape == "slicer_range":
        return slicer_range(model, item.by)
    fact, column = item.by
    if item.shape == "detail_table":
        return detail_table(model, fact, [column], [DATE], filters)
    if item.shape == "word_frequency":
        tables = {fact, *(item.table for item in filters)}
        rows = propagate_filters(restrict(model, tables), filters).facts[fact]
        return word_frequency(rows if item.where is None else rows.filter(item.where), column)
    raise ValueError(f"unknown shape: {item.shape}")
