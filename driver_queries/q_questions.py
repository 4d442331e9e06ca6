"""Text-table operators over questions built from the events, and over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import query, t, table
from skyledger.functions.text import collapse_whitespace, normalize_text
from skyledger.plans import questions as Q
from skyledger.plans.kpi import KPI_REGISTRY, alias_rows

# {month} is the name of a month, in the spelling of each engine.
QUESTION = """CASE event_id % 10
    WHEN 0 THEN 'What if ' || event_type || ' value increases by ' || CAST(user_id % 40 AS STRING) || '% in ' || {month} || ' ' || CAST(2020 + event_id % 7 AS STRING) || '?'
    WHEN 1 THEN 'Compare OTP between the first week and the end of ' || {month} || ' 2026.'
    WHEN 2 THEN 'Show average   delay by airline.'
    WHEN 3 THEN 'Which airline has the highest OTP?'
    WHEN 4 THEN 'Where can I see baggage in ' || upper({month}) || '  2025'
    WHEN 5 THEN 'What is the capital of ' || event_type || '? 2024-' || CAST(1 + event_id % 12 AS STRING)
    WHEN 6 THEN 'Total waste for the last week and end of MAY 2024 versus ' || {month} || ' 2023, and may 2024'
    WHEN 7 THEN 'Security wait in ' || substr({month}, 1, 3) || ', 2024 vs 2024/11'
    WHEN 8 THEN 'Suppose passenger feedback doubles: go to commercial revenue on 2023/0' || CAST(1 + event_id % 9 AS STRING)
    ELSE 'Lowest load factor by airline in ' || {month} || ' 1999 and ' || {month} || ' 2001' END"""
SPARK_QUESTION = QUESTION.format(month="date_format(make_date(2024, CAST(1 + event_id % 12 AS INT), 1), 'MMMM')")
QUESTIONS_SQL = (
    "(SELECT event_id, "
    + QUESTION.format(month="strftime(make_date(2024, CAST(1 + event_id % 12 AS INT), 1), '%B')")
    + " AS text FROM events)"
)


def questions(spark, sf):
    return table(spark, sf, "events").select("event_id", F.expr(SPARK_QUESTION).alias("text"))


COLLAPSED = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"


def _class_sql(classes) -> str:
    branches = []
    for name, phrases in classes.items():
        hits = " OR ".join(f"contains(s, '{phrase}')" for phrase in phrases)
        branches.append(f"WHEN {hits} THEN '{name}'")
    return "CASE " + " ".join(branches) + " END"


@query(
    "normalize_text",
    "SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS normalized FROM documents",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", normalize_text(F.col("text")).alias("normalized"))


@query(
    "collapse_whitespace",
    f"SELECT conv_id, turn, md5({COLLAPSED}) AS digest FROM conversations",
)
def _(spark, sf):
    rows = table(spark, sf, "conversations")
    return rows.select("conv_id", "turn", F.md5(collapse_whitespace(F.col("text"))).alias("digest"))


@query(
    "classify_by_phrases",
    f"SELECT event_id, {_class_sql(Q.QUESTION_CLASSES)} AS class FROM (SELECT event_id, {COLLAPSED} AS s FROM {QUESTIONS_SQL})",
)
def _(spark, sf):
    return questions(spark, sf).select("event_id", Q.classify_by_phrases(F.col("text")).alias("class"))


@query(
    "route_page",
    f"SELECT event_id, {_class_sql(Q.PAGE_KEYWORDS)} AS page FROM (SELECT event_id, {COLLAPSED} AS s FROM {QUESTIONS_SQL})",
)
def _(spark, sf):
    return questions(spark, sf).select("event_id", Q.route_page(F.col("text")).alias("page"))


@query(
    "route_page_documents",
    f"""SELECT page, count(*) AS documents FROM
        (SELECT {_class_sql(Q.PAGE_KEYWORDS)} AS page FROM (SELECT {COLLAPSED} AS s FROM documents)) GROUP BY ALL""",
)
def _(spark, sf):
    pages = table(spark, sf, "documents").select(Q.route_page(F.col("text")).alias("page"))
    return pages.groupBy("page").agg(F.count(F.lit(1)).alias("documents"))


@query(
    "classify_query_shape",
    f"""SELECT event_id, CASE
        WHEN contains(s, 'compare') OR contains(s, 'versus') OR contains(s, ' vs ') THEN 'compare'
        WHEN contains(s, 'highest') OR contains(s, 'lowest') OR contains(s, 'top') OR contains(s, 'bottom') THEN 'ranking'
        WHEN contains(s, 'airline') THEN 'breakdown' ELSE 'lookup' END AS intent
        FROM (SELECT event_id, lower(text) AS s FROM {QUESTIONS_SQL})""",
)
def _(spark, sf):
    dimension = F.when(F.lower("text").contains("airline"), F.lit("airline"))
    return questions(spark, sf).select("event_id", Q.classify_query_shape(F.col("text"), dimension).alias("intent"))


MONTHS_SQL = "[" + ", ".join(f"'{name}'" for name in Q.MONTH_NAMES) + "]"


def _found(group: int) -> str:
    return f"regexp_extract_all(s, '{Q.MONTH_YEAR_PATTERN}', {group})"



@query(
    "extract_periods",
    f"""WITH q AS (SELECT event_id, lower(text) AS s FROM {QUESTIONS_SQL}),
        m AS (SELECT event_id, s, unnest({_found(1)}) AS month_name, unnest({_found(2)}) AS year_text,
              generate_subscripts({_found(1)}, 1) AS place FROM q),
        d AS (SELECT event_id, s, month_name, year_text, min(place) AS place FROM m GROUP BY ALL),
        k AS (SELECT *, make_date(CAST(year_text AS INT), list_position({MONTHS_SQL}, month_name), 1) AS first FROM d
              JOIN (VALUES (1, 'First week of ', 'first week'), (2, 'Last week of ', 'last week'), (3, 'End of ', 'end of'),
                    (4, '', NULL)) AS v(kind, prefix, phrase)
              ON CASE kind WHEN 4 THEN NOT (contains(s, 'first week') OR contains(s, 'last week') OR contains(s, 'end of'))
                      WHEN 3 THEN contains(s, 'end of') AND NOT contains(s, 'last week') ELSE contains(s, phrase) END)
        SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY place, kind) AS period_no,
            prefix || upper(substr(month_name, 1, 1)) || substr(month_name, 2) || ' ' || year_text AS label,
            {t('CASE WHEN kind IN (2, 3) THEN last_day(first) - 6 ELSE first END')} AS start_date,
            {t('CASE WHEN kind = 1 THEN first + 6 ELSE last_day(first) END')} AS end_date FROM k""",
)
def _(spark, sf):
    return Q.extract_periods(questions(spark, sf), "text").drop("text")


ABBREVIATIONS_SQL = "[" + ", ".join(f"'{name}'" for name in Q.MONTH_ABBREVIATIONS) + "]"
TITLES_SQL = "[" + ", ".join(f"'{name.title()}'" for name in Q.MONTH_NAMES) + "]"


@query(
    "extract_single_period",
    f"""SELECT event_id, CASE WHEN named <> '' THEN {TITLES_SQL}[list_position({ABBREVIATIONS_SQL}, lower(substr(named, 1, 3)))]
            || ' ' || named_year
        WHEN numbered <> '' THEN {TITLES_SQL}[CAST(numbered AS INT)] || ' ' || numbered_year END AS period
        FROM (SELECT event_id, regexp_extract(text, '{Q.MONTH_FIRST_PATTERN}', 1) AS named,
            regexp_extract(text, '{Q.MONTH_FIRST_PATTERN}', 2) AS named_year,
            regexp_extract(text, '{Q.YEAR_FIRST_PATTERN}', 1) AS numbered_year,
            regexp_extract(text, '{Q.YEAR_FIRST_PATTERN}', 2) AS numbered FROM {QUESTIONS_SQL})""",
)
def _(spark, sf):
    return questions(spark, sf).select("event_id", Q.extract_single_period(F.col("text")).alias("period"))


LABEL = (
    "CASE event_id % 8 WHEN 0 THEN 'OTP' WHEN 1 THEN ' Passenger-Traffic!' WHEN 2 THEN event_type "
    "WHEN 3 THEN 'CO2  emissions' WHEN 4 THEN 'on-time performance %' WHEN 5 THEN 'Net commercial revenue' "
    "WHEN 6 THEN 'feedback submissions' ELSE 'nothing known' END"
)
ALIAS_SQL = (
    "(SELECT trim(regexp_replace(lower(label), '[^a-z0-9]+', ' ', 'g')) AS alias, metric FROM (VALUES "
    + ", ".join(
        f"('{label}', '{name}')" for name, _, _, _, aliases in KPI_REGISTRY for label in (name, *aliases)
    )
    + ") AS v(label, metric))"
)
UNIQUE_ALIAS_SQL = f"(SELECT DISTINCT alias, metric FROM {ALIAS_SQL})"
LABELS_SQL = f"(SELECT event_id, label, trim(regexp_replace(lower(label), '[^a-z0-9]+', ' ', 'g')) AS alias FROM (SELECT event_id, {LABEL} AS label FROM events))"


def _aliases(spark):
    return alias_rows(spark).select("alias", "metric").distinct()


def _labels(spark, sf):
    return table(spark, sf, "events").select("event_id", F.expr(LABEL).alias("label"))


@query(
    "resolve_metric_alias",
    f"SELECT event_id, label, metric FROM {LABELS_SQL} LEFT JOIN {UNIQUE_ALIAS_SQL} USING (alias)",
)
def _(spark, sf):
    return Q.resolve_metric_alias(_labels(spark, sf), "label", _aliases(spark))


@query(
    "resolve_metric_alias_rejected",
    f"SELECT event_id, label FROM {LABELS_SQL} WHERE alias NOT IN (SELECT alias FROM {ALIAS_SQL})",
)
def _(spark, sf):
    return Q.rejected_labels(_labels(spark, sf), "label", _aliases(spark))
