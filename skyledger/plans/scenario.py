"""What-if projections: a table of assumptions against a table of KPI baselines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.text import normalize_text
from skyledger.operators.joins import keyed_join
from skyledger.plans import daily
from skyledger.plans.context import Model
from skyledger.plans.kpi import KPI_REGISTRY, PERIOD_COLUMNS, kpi_by_period, lookup_column, metric_attributes
from skyledger.plans.measures import MEASURES, derive, evaluate, long_form
from skyledger.plans.questions import only_period
from skyledger.session import materialize

# The kinds of adjustment and the largest number of them in one request.
OPERATIONS = ("percentage_change", "absolute_change", "set_target", "percentage_point_change")
MAX_ASSUMPTIONS = 5

ALL_DATES = "all available dates"


def _is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def approved_label(label: Column) -> Column:
    """The approved metric of a text label by its normalised name or alias; null if unknown."""
    known = {}
    for name, _, _, _, aliases in KPI_REGISTRY:
        for text in (name, *aliases):
            known[re.sub("[^a-z0-9]+", " ", text.lower()).strip()] = name
    return lookup_column(normalize_text(label), known)


def validate_assumptions(assumptions: DataFrame) -> DataFrame:
    """Resolve the metrics and give the reason of each rejection.

    Input: request_id, label, operation, value and any other columns. ``reason`` is the fault of
    the row, ``request_reason`` that of its whole request: a request is taken or rejected as one.
    """
    rows = assumptions.withColumn("metric", approved_label(F.col("label")))
    rows = rows.withColumns(metric_attributes(F.col("metric")))
    rows = rows.withColumn(
        "reason",
        F.when(~F.coalesce(F.col("operation").isin(*OPERATIONS), F.lit(False)), F.lit("unsupported operation"))
        .when(~_is_finite(F.col("value")), F.lit("value is not finite"))
        .when(F.col("metric").isNull(), F.lit("unknown metric"))
        .when(
            (F.col("operation") == "percentage_point_change") & (F.col("kind") != "rate"),
            F.lit("percentage points apply to rates only"),
        )
        .when(
            (F.col("operation") == "absolute_change") & (F.col("kind") == "rate"),
            F.lit("a rate needs a percentage or percentage points"),
        ),
    )
    # Counted per metric first: at most one row per approved metric is left of a request of any size.
    per_metric = rows.groupBy("request_id", "metric").agg(
        F.count(F.lit(1)).alias("__rows"), F.count("reason").alias("__faults")
    )
    per_request = per_metric.groupBy("request_id").agg(
        F.sum("__rows").alias("__rows"),
        F.sum("__faults").alias("__faults"),
        F.max(F.when(F.col("metric").isNotNull(), F.col("__rows"))).alias("__same_metric"),
    )
    verdict = per_request.select(
        "request_id",
        F.when(F.col("__rows") > MAX_ASSUMPTIONS, F.lit("more than five assumptions"))
        .when(F.col("__faults") > 0, F.lit("invalid assumption"))
        .when(F.col("__same_metric") > 1, F.lit("several adjustments of one metric"))
        .alias("request_reason"),
    )
    return keyed_join(rows, verdict, ["request_id"], "left")


def split_requests(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) assumptions."""
    accepted = F.col("request_reason").isNull()
    return validated.filter(accepted), validated.filter(~accepted)


def request_period(df: DataFrame, time_expression: str) -> DataFrame:
    """Add the ``period`` label of a request and ``period_reason`` if its time cannot be used.

    No time expression means all available dates; any other must name exactly one period.
    """
    text = F.col(time_expression)
    unset = text.isNull() | (F.trim(text) == "")
    label = F.when(unset, F.lit(ALL_DATES)).otherwise(only_period(text)["label"])
    return df.withColumn("period", label).withColumn(
        "period_reason", F.when(F.col("period").isNull(), F.lit("one supported period is needed"))
    )


def scenario_baselines(model: Model, metrics: Sequence[str], periods: DataFrame) -> DataFrame:
    """The baselines (metric, period, value) of the metrics over a table of periods and over all dates.

    Each fact is scanned once: its written daily state serves the periods and the whole. The
    baselines are written before they are used: one small row per metric and period stands for whole
    facts, and its size decides how the assumptions are joined to it.
    """
    if daily.can_roll_up(model, metrics, MEASURES):
        states = [state.written() for state in daily.daily_states(model, metrics, MEASURES)]
        base = daily.by_period(states, model.dimensions[model.date_dimension], periods, PERIOD_COLUMNS)
        values = long_form(derive(periods.join(base, PERIOD_COLUMNS, "left"), metrics), periods.columns, metrics)
        overall = long_form(derive(daily.overall(states), metrics), [], metrics)
    else:
        values = kpi_by_period(model, metrics, periods)
        overall = long_form(evaluate(model, metrics), [], metrics)
    rows = values.select(F.col("measure").alias("metric"), F.col("label").alias("period"), "value")
    overall = overall.select(F.col("measure").alias("metric"), F.lit(ALL_DATES).alias("period"), "value")
    return materialize(rows.unionByName(overall), "baselines")


def baseline_join(accepted: DataFrame, baselines: DataFrame) -> DataFrame:
    """Add the baseline of (metric, period) and the reason if it cannot be used.

    ``baselines`` has one row per metric and period, both inputs name the period alike.
    """
    known = baselines.select("metric", "period", F.col("value").cast("double").alias("baseline"))
    joined = keyed_join(accepted, known, ["metric", "period"], "left")
    baseline = F.col("baseline")
    reason = (
        F.when(baseline.isNull(), F.lit("missing baseline"))
        .when(~_is_finite(baseline), F.lit("baseline is not finite"))
        .when((F.col("kind") == "rate") & ~baseline.between(0, 1), F.lit("baseline is not a rate between 0 and 1"))
    )
    return joined.withColumn("baseline_reason", reason)


def project_scenario(baseline: Column, operation: Column, value: Column, kind: Column) -> Column:
    """The projected value. Rates are fractions; targets and points of a rate are given in percent."""
    return (
        F.when(operation == "percentage_change", baseline * (1 + value / 100))
        .when(operation == "absolute_change", baseline + value)
        .when(operation == "set_target", F.when(kind == "rate", value / 100).otherwise(value))
        .when(operation == "percentage_point_change", baseline + value / 100)
    )


def validate_projection(projected: Column, kind: Column) -> Column:
    """Why a projection is rejected, null if it is fine. A signed metric may have any value."""
    return F.when((kind == "rate") & ~projected.between(0, 1), F.lit("projected rate is outside 0 to 1")).when(
        (kind == "nonnegative") & (projected < 0), F.lit("projected value is negative")
    )


def projection_deltas(df: DataFrame, baseline: str = "baseline", projected: str = "projected") -> DataFrame:
    """Absolute change and change in percent; the latter is null on a baseline of 0."""
    change = F.col(projected) - F.col(baseline)
    return df.withColumns(
        {"absolute_change": change, "relative_change_percent": F.try_divide(change, F.col(baseline)) * 100}
    )


def run_scenarios(accepted: DataFrame, baselines: DataFrame) -> DataFrame:
    """One projection per accepted assumption; ``reject_reason`` is null where it holds.

    Assumptions are independent: a derived metric is not recalculated from a changed one.
    """
    joined = baseline_join(accepted, baselines)
    projected = joined.withColumn(
        "projected",
        F.when(
            F.col("baseline_reason").isNull(),
            project_scenario(F.col("baseline"), F.col("operation"), F.col("value"), F.col("kind")),
        ),
    )
    reason = F.coalesce("baseline_reason", validate_projection(F.col("projected"), F.col("kind")))
    return projection_deltas(projected.withColumn("reject_reason", reason)).drop("baseline_reason")


def scenario_pages(projections: DataFrame) -> DataFrame:
    """The page of a request when all its projections share one, else null."""
    return projections.groupBy("request_id").agg(
        F.when(F.min("page") == F.max("page"), F.min("page")).alias("page"),
        F.count(F.lit(1)).alias("projection_count"),
    )
