"""A table of KPI requests answered in one plan.

All requests together decide what is computed: each fact that an asked metric needs is scanned
once and reduced to partial results per date and member, once without a dimension and once for each
asked dimension it is related to. Periods are covered by blocks of 2^k days; a day meets a period
through the one block that holds it, so dates and periods join on equal keys however many periods
overlap. Members are placed once per metric, dimension and period, and the requests look up the
values and places, however many ask for the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.plans.context import Model, restrict, star_join
from skyledger.plans.daily import finished, parts_of
from skyledger.plans.kpi import DIMENSION_SPELLINGS, KPI_REGISTRY, lookup_column, validate_metric
from skyledger.plans.measures import MEASURES, Aggregate, Derived, GroupMean, Measure, derive, drill_across, long_form, repeat_beside, with_inputs
from skyledger.plans.targets import COVER, blocks_of_day, day_number, join_on_blocks
from skyledger.session import materialize

INTENTS = ("lookup", "compare", "breakdown", "ranking")

# Names a dimension in the plan; requests without one have NO_AXIS.
NO_AXIS = ""
AXES = {f"{table}.{column}": (table, column) for table, column in DIMENSION_SPELLINGS.values()}
NEED = ["axis", "start_date", "end_date"]
ANSWER = ["request_id", "period_no", "metric", "member", "value", "reason"]


def validated(requests: DataFrame) -> DataFrame:
    """The requests with their approved ``metric``, ``axis`` and ``reason`` (null: can be answered).

    A lookup or comparison takes no dimension; without both dates a request is about all dates.
    """
    spelled = {spelling: f"{table}.{column}" for spelling, (table, column) in DIMENSION_SPELLINGS.items()}
    asked = lookup_column(F.lower(F.trim(F.col("dimension"))), spelled)
    by_member = F.col("intent").isin("breakdown", "ranking")
    reason = (
        F.when(~F.coalesce(F.col("intent").isin(*INTENTS), F.lit(False)), F.lit("unsupported intent"))
        .when(validate_metric(F.col("metric")).isNull(), F.lit("unknown metric"))
        .when(by_member & asked.isNull(), F.lit("unknown dimension"))
        .when(F.col("start_date").isNull() != F.col("end_date").isNull(), F.lit("half a period"))
        .when(F.col("start_date") > F.col("end_date"), F.lit("period ends before it starts"))
    )
    return requests.withColumns(
        {"metric": validate_metric(F.col("metric")), "axis": F.when(by_member, asked).otherwise(F.lit(NO_AXIS)), "reason": reason}
    )


def _is_related(model: Model, fact: str, axis: str) -> bool:
    return axis == NO_AXIS or model.key_between(fact, AXES[axis][0]) is not None


def _fact_values(model: Model, fact: str, wanted: Mapping[str, Measure], needs: DataFrame, axes: Sequence[str]) -> DataFrame:
    """The base measures of one fact per need and member: ``axis, start_date, end_date, member`` and measures.

    For an axis that the fact is not related to there is one row per period, with a null member.
    """
    key = model.key_between(fact, model.date_dimension)
    related = [axis for axis in axes if axis != NO_AXIS and _is_related(model, fact, axis)]
    columns, fine, merged, measures = parts_of(wanted, key)
    inner = sorted({c for m in wanted.values() if isinstance(m, GroupMean) for c in m.group if c != key})
    joined = star_join(model, fact, [AXES[axis] for axis in related], sorted({key, *columns, *inner}))
    members = [F.struct(F.lit(NO_AXIS).alias("own_axis"), F.lit(None).cast("string").alias("member"))]
    members += [F.struct(F.lit(a).alias("own_axis"), F.col(f"`{AXES[a][1]}`").cast("string").alias("member")) for a in related]
    # One pass over the fact: a row counts once without a dimension and once for each related one.
    spread = joined.select(key, *sorted({*columns, *inner} - {key}), F.inline(F.array(*members)))
    grain = [key, "own_axis", "member"]
    rows = spread.groupBy(*grain, *inner).agg(*[part.build().alias(at) for at, part in fine.items()])
    if inner:
        rows = rows.groupBy(*grain).agg(*[part.build().alias(at) for at, part in merged.items()])
    rows = materialize(rows, f"state-{fact}")

    own_axis = F.when(F.col("axis").isin(related), F.col("axis")).otherwise(F.lit(NO_AXIS))
    asked = needs.withColumn("own_axis", own_axis)
    sums = [part.merge(at).alias(at) for at, part in merged.items()]
    # All dates, undated rows included.
    whole = rows.groupBy("own_axis", "member").agg(*sums)
    whole = asked.filter("start_date IS NULL").join(whole, "own_axis").select(*NEED, "member", *merged)
    dated = rows.join(model.dimensions[model.date_dimension].select(key, "date"), key)
    of_day = dated.select("own_axis", "member", *merged, F.inline(blocks_of_day(day_number(F.col("date")))))
    spans = asked.filter("start_date IS NOT NULL").withColumns(
        {"__begin": day_number(F.col("start_date")), "__end": day_number(F.col("end_date"))}
    )
    covers = spans.select(*NEED, F.col("own_axis").alias("of_axis"), F.inline(F.expr(COVER)))
    met = join_on_blocks(of_day, covers, dated, spans).filter(F.col("own_axis") == F.col("of_axis"))
    periods = met.groupBy(*NEED, "member").agg(*sums)
    return whole.unionByName(periods.select(*NEED, "member", *merged)).select(*NEED, "member", *finished(measures))


def _values(model: Model, needs: DataFrame, metrics: Sequence[str], axes: Sequence[str]) -> DataFrame:
    """``axis, start_date, end_date, member, metric, value`` of every metric for every need."""
    base: dict[str, dict[str, Measure]] = {}
    for name in with_inputs(metrics, MEASURES):
        if isinstance(MEASURES[name], (Aggregate, GroupMean)):
            base.setdefault(MEASURES[name].fact, {})[name] = MEASURES[name]
    keys = [*NEED, "member"]
    parts, totals = [], []
    for fact, wanted in base.items():
        values = materialize(_fact_values(model, fact, wanted, needs, axes), f"values-{fact}")
        related = [axis for axis in axes if _is_related(model, fact, axis)]
        is_related = F.col("axis").isin(related)
        parts.append(values.filter(is_related).withColumn(f"in_{fact}", F.lit(1)))
        if len(related) < len(axes):
            totals.append((values.filter(~is_related).drop("member"), list(wanted)))
    # Members are groups of their own: a ratio is 0 for one without rows, an unrelated fact repeats its total.
    spark = needs.sparkSession
    members = [spark.range(1).select(F.lit(NO_AXIS).alias("axis"), F.lit(None).cast("string").alias("member"))]
    for axis in axes:
        if axis != NO_AXIS:
            table, column = AXES[axis]
            names = model.dimensions[table].select(F.col(f"`{column}`").cast("string").alias("member")).distinct()
            members.append(names.select(F.lit(axis).alias("axis"), "member"))
    # Written, so that the members of all dimensions meet the needs in one join whose size is known.
    every_member = materialize(reduce(DataFrame.unionByName, members), "members")
    is_member = needs.join(every_member, "axis").select(*keys, F.lit(1).alias("is_member"))
    wide = drill_across([is_member, *parts], keys)
    for total, wanted in totals:
        # A period without rows of the fact has no total, and nothing to add.
        named = {name: f"__total_{i}" for i, name in enumerate(wanted)}
        wide = repeat_beside(wide, total.withColumnsRenamed(named), NEED)
        wide = wide.withColumns({name: F.coalesce(f"`{name}`", at) for name, at in named.items()}).drop(*named.values())
    long = long_form(derive(wide, metrics), [*keys, "is_member", *[f"in_{fact}" for fact in base]], metrics)
    return long.filter(_exists(model, metrics, axes)).select(*keys, F.col("measure").alias("metric"), "value")


def _exists(model: Model, metrics: Sequence[str], axes: Sequence[str]) -> Column:
    """Whether a group is one of its metric's own: it has rows of a related fact, or is a member the metric has a value for."""
    condition = F.lit(False)
    for name in metrics:
        needed = with_inputs([name], MEASURES)
        facts = sorted({MEASURES[x].fact for x in needed if isinstance(MEASURES[x], (Aggregate, GroupMean))})
        zero = any(isinstance(MEASURES[x], Derived) and MEASURES[x].zero_on_blank for x in needed)
        for axis in axes:
            related = [f"in_{fact}" for fact in facts if _is_related(model, fact, axis)]
            has = F.coalesce(*related).isNotNull() if related else F.lit(False)
            if zero or not related or axis == NO_AXIS:
                has = has | F.col("is_member").isNotNull()
            condition = condition | ((F.col("measure") == name) & (F.col("axis") == axis) & has)
    return condition


def answer_requests(model: Model, requests: DataFrame) -> DataFrame:
    """One row per value: ``request_id, period_no, metric, member, value, reason``.

    ``requests`` has ``request_id, period_no, intent, metric, dimension, start_date, end_date, size, ascending``; both dates are
    inclusive, null dates mean all dates. A comparison is one row per period. A lookup always has a row; a
    breakdown leaves out members without a value; a ranking keeps the ``size`` best (null: 1) with all
    ties. A request that cannot be answered has one row with its ``reason``.
    """
    asked = materialize(validated(requests), "requests")
    taken = asked.filter("reason IS NULL")
    # One row of approved names, so the plan is of what is asked: no more of them than the registry has.
    named = taken.agg(F.collect_set("metric").alias("metrics"), F.collect_set("axis").alias("axes")).first()
    metrics = [row[0] for row in KPI_REGISTRY if row[0] in named["metrics"]]
    axes = [axis for axis in (NO_AXIS, *AXES) if axis == NO_AXIS or axis in named["axes"]]
    refused = asked.filter("reason IS NOT NULL").select(
        "request_id", "period_no", "metric", F.lit(None).cast("string").alias("member"), F.lit(None).cast("double").alias("value"), "reason"
    )
    if not metrics:
        return refused.select(*ANSWER)
    needs = materialize(taken.select(*NEED).distinct(), "needs")
    facts = {MEASURES[x].fact for x in with_inputs(metrics, MEASURES) if isinstance(MEASURES[x], (Aggregate, GroupMean))}
    model = restrict(model, {*facts, model.date_dimension, *(AXES[axis][0] for axis in axes if axis != NO_AXIS)})
    values = materialize(_placed(_values(model, needs, metrics, axes)), "answers")
    values = values.withColumnsRenamed({c: f"of_{c}" for c in (*NEED, "metric")})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in (*NEED, "metric")])
    rankings = taken.filter("intent = 'ranking'")
    own = Window.partitionBy("request_id", "period_no")
    rankings = rankings.withColumn("is_alone", F.count(F.lit(1)).over(own) == 1)
    kept = [taken.filter("intent <> 'ranking'").join(values, same)]
    # The places are those of the need, whatever the number of requests for it.
    place = F.when(F.col("ascending"), F.col("place_up")).otherwise(F.col("place_down"))
    kept.append(rankings.filter("is_alone").join(values, same).filter(place <= F.coalesce("size", F.lit(1))))
    # Rankings of one request and period compete for its places.
    order = F.when(F.col("ascending"), F.col("value")).otherwise(-F.col("value"))
    together = rankings.filter("NOT is_alone").join(values, same).withColumn("place", F.rank().over(own.orderBy(order)))
    kept.append(together.filter(F.col("place") <= F.coalesce("size", F.lit(1))))
    return reduce(DataFrame.unionByName, [rows.select(*ANSWER) for rows in [*kept, refused]])


def _placed(values: DataFrame) -> DataFrame:
    """The values of ``_values`` with their places among the members of a need, from below and from above; none without a value."""
    group = Window.partitionBy(*NEED, "metric")
    # A lookup has one value, blank or not.
    values = values.filter((F.col("axis") == NO_AXIS) | F.col("value").isNotNull())
    return values.withColumns(
        {"place_up": F.rank().over(group.orderBy("value")), "place_down": F.rank().over(group.orderBy(-F.col("value")))}
    )
