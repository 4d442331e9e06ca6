"""Operators over a table of question texts: classes, pages, query shapes, periods, metric labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.dates import make_period
from skyledger.functions.text import collapse_whitespace, contains_any, normalize_text
from skyledger.operators.joins import keyed_join

# The lists below are fixed values; their order decides which class wins.
QUESTION_CLASSES = {
    "navigation": [
        "where can i",
        "where do i",
        "where should i",
        "which page",
        "what page",
        "which dashboard page",
        "navigate to",
        "take me to",
        "switch to",
        "go to",
        "open the",
        "open page",
        "show me the page",
        "show me the dashboard page",
    ],
    "simulation": [
        "what if",
        "hypothetically",
        "suppose",
        "assuming",
        "assume that",
        "scenario projection",
        "simulate",
        "simulation",
        "projected value",
        "projected volume",
        "projected revenue",
        "what would happen if",
        "what would be the impact if",
    ],
}

PAGE_KEYWORDS = {
    "Flights": [
        "otp",
        "on-time performance",
        "on time performance",
        "flight delay",
        "flight delays",
        "delayed flight",
        "cancellation",
        "cancelled flights",
        "load factor",
        "flight punctuality",
        "flight operations",
    ],
    "Passenger": [
        "passenger traffic",
        "passenger volume",
        "passenger flow",
        "passenger throughput",
        "security wait",
        "screening time",
        "security screening",
    ],
    "Baggage": ["baggage", "mishandled bags", "first bag", "last bag", "bag delivery"],
    "Commercial": [
        "commercial revenue",
        "revenue per passenger",
        "commercial transactions",
        "concessions",
        "retail revenue",
        "parking revenue",
    ],
    "Sustainability": [
        "sustainability",
        "electricity",
        "energy consumption",
        "energy per passenger",
        "water consumption",
        "co2",
        "co₂",
        "emissions",
        "waste",
    ],
    "Experience": [
        "passenger feedback",
        "passenger satisfaction",
        "customer feedback",
        "passenger comments",
    ],
    "Overview": ["overall performance", "airport overview", "airport performance summary"],
}

COMPARE_WORDS = ["compare", "versus", " vs "]
RANKING_WORDS = ["highest", "lowest", "top", "bottom"]

MONTH_NAMES = [
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
]
MONTH_ABBREVIATIONS = [name[:3] for name in MONTH_NAMES]

MONTH_YEAR_PATTERN = rf"({'|'.join(MONTH_NAMES)})\s+(\d{{4}})"
# Full names before their abbreviations, so that the longer form is taken.
MONTH_FIRST_PATTERN = rf"(?i)\b({'|'.join(MONTH_NAMES + MONTH_ABBREVIATIONS)})\s*,?\s*(20\d{{2}})\b"
YEAR_FIRST_PATTERN = r"\b(20\d{2})[/-](0?[1-9]|1[0-2])\b"


def classify_by_phrases(text: Column, classes: Mapping[str, Sequence[str]] = QUESTION_CLASSES) -> Column:
    """The first class of an ordered phrase list with a phrase in the text; null if none."""
    normalized = collapse_whitespace(text)
    result = F.lit(None).cast("string")
    for name, phrases in reversed(classes.items()):
        result = F.when(contains_any(normalized, list(phrases)), F.lit(name)).otherwise(result)
    return result


def route_page(text: Column) -> Column:
    """The first page one of whose keywords occurs in the text; null if none."""
    return classify_by_phrases(text, PAGE_KEYWORDS)


def classify_query_shape(text: Column, dimension: Column) -> Column:
    """compare, ranking, breakdown (a dimension is named) or lookup, in this order."""
    lowered = F.lower(text)
    return (
        F.when(contains_any(lowered, COMPARE_WORDS), F.lit("compare"))
        .when(contains_any(lowered, RANKING_WORDS), F.lit("ranking"))
        .when(dimension.isNotNull(), F.lit("breakdown"))
        .otherwise(F.lit("lookup"))
    )


def _position(names: Sequence[str], name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(n) for n in names]), name).cast("int")


def _months_and_kinds(lowered: Column) -> tuple[Column, Column]:
    """The distinct (month, year) pairs of a lower-case text, and the kinds of period that its words ask for."""
    months = F.array_distinct(
        F.arrays_zip(
            F.regexp_extract_all(lowered, F.lit(MONTH_YEAR_PATTERN), F.lit(1)).alias("month"),
            F.regexp_extract_all(lowered, F.lit(MONTH_YEAR_PATTERN), F.lit(2)).alias("year"),
        )
    )
    first, last, end = (lowered.contains(phrase) for phrase in ("first week", "last week", "end of"))
    kinds = F.array_compact(
        F.array(
            F.when(first, F.lit("first_week")),
            F.when(last, F.lit("last_week")),
            F.when(end & ~last, F.lit("end_of_month")),
            F.when(~(first | last | end), F.lit("month")),
        )
    )
    return months, kinds


def _period(month: Column, year: Column, kind: Column) -> Column:
    prefix = (
        F.when(kind == "first_week", F.lit("First week of "))
        .when(kind == "last_week", F.lit("Last week of "))
        .when(kind == "end_of_month", F.lit("End of "))
        .otherwise(F.lit(""))
    )
    label = F.concat(prefix, F.initcap(month), F.lit(" "), year)
    return make_period(label, kind, year.cast("int"), _position(MONTH_NAMES, month))


def extract_periods(df: DataFrame, text: str) -> DataFrame:
    """One row per period of a text: period_no, label, start_date, end_date. Texts without one give no row.

    Every 'month yyyy' of the text counts, once. The words "first week", "last week" and "end
    of" anywhere in the text apply to each of them and give a period each; without these words
    the period is the full month. "Last week" and "end of" are the same days, so the second is
    left out when both occur.
    """
    kept = [F.col(name) for name in df.columns]
    months, kinds = _months_and_kinds(F.col("__lowered"))
    # The patterns are costly: texts that cannot match leave first, and the text is lowered once.
    candidates = df.select("*", F.lower(F.col(text)).alias("__lowered")).filter(
        F.col("__lowered").rlike(MONTH_YEAR_PATTERN)
    )
    found = candidates.select(*kept, kinds.alias("__kinds"), F.posexplode(months).alias("__place", "__found"))
    found = found.select(*kept, "__place", "__found", "__kinds", F.posexplode("__kinds").alias("__order", "__kind"))
    period = _period(F.col("__found.month"), F.col("__found.year"), F.col("__kind"))
    number = F.col("__place") * F.size("__kinds") + F.col("__order") + 1
    return found.select(*kept, number.alias("period_no"), period.alias("__period")).select(
        *kept, "period_no", "__period.label", "__period.start_date", "__period.end_date"
    )


def only_period(text: Column) -> Column:
    """struct<label, start_date, end_date> of a text with exactly one period; null for none or several."""
    months, kinds = _months_and_kinds(F.lower(text))
    found = F.try_element_at(months, F.lit(1))
    period = _period(found["month"], found["year"], F.try_element_at(kinds, F.lit(1)))
    return F.when((F.size(months) == 1) & (F.size(kinds) == 1), period)


def extract_single_period(text: Column) -> Column:
    """'Month yyyy' from a month name or 3-letter form with a year, else from yyyy-mm or yyyy/mm; null if none."""
    named = F.lower(F.substring(F.regexp_extract(text, MONTH_FIRST_PATTERN, 1), 1, 3))
    named_year = F.regexp_extract(text, MONTH_FIRST_PATTERN, 2)
    numbered = F.regexp_extract(text, YEAR_FIRST_PATTERN, 2).try_cast("int")
    numbered_year = F.regexp_extract(text, YEAR_FIRST_PATTERN, 1)
    titles = F.array(*[F.lit(name.title()) for name in MONTH_NAMES])
    return F.when(
        named != "", F.concat_ws(" ", F.try_element_at(titles, _position(MONTH_ABBREVIATIONS, named)), named_year)
    ).when(numbered.isNotNull(), F.concat_ws(" ", F.try_element_at(titles, numbered), numbered_year))


def resolve_metric_alias(df: DataFrame, label: str, aliases: DataFrame) -> DataFrame:
    """Add the approved metric of a text label; null where the label is not approved.

    ``aliases`` has unique (alias, metric) rows with normalised aliases.
    """
    known = aliases.select(F.col("alias").alias("__alias"), "metric")
    return keyed_join(df.withColumn("__alias", normalize_text(F.col(label))), known, ["__alias"], "left").drop("__alias")


def rejected_labels(df: DataFrame, label: str, aliases: DataFrame) -> DataFrame:
    """Rows whose label is not approved."""
    known = aliases.select(F.col("alias").alias("__alias"))
    rejected = keyed_join(df.withColumn("__alias", normalize_text(F.col(label))), known, ["__alias"], "left_anti")
    return rejected.drop("__alias")
