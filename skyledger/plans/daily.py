"""Measures rolled up from partial results per day.

A fact is scanned once and reduced to one row per date: sums, counts and maxima from which its
measures can be finished. Any number of periods, overlapping or not, is then answered from those
rows: they are merged into blocks of 2^k days, a period is covered by at most two blocks of each
length, and only these are merged for it. So a period costs the logarithm of its days, and no
fact row is repeated for the periods it lies in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.plans.context import Filter, Model, propagate_filters, restrict
from skyledger.plans.measures import Aggregate, AsOfTarget, Derived, GroupMean, Measure, Part, columns_of, drill_across, with_inputs
from skyledger.plans.targets import COVER, blocks_of_day, day_number, join_on_blocks
from skyledger.session import materialize


@dataclass(frozen=True)
class DailyState:
    """One row per value of the date key (null included), and how its columns become measures."""

    rows: DataFrame
    key: str
    columns: Mapping[str, Part]
    measures: Mapping[str, tuple[Measure, tuple[str, ...]]]

    def merged(self) -> list[Column]:
        return [part.merge(name).alias(name) for name, part in self.columns.items()]

    def finished(self) -> list[Column]:
        return finished(self.measures)

    def written(self) -> DailyState:
        """The same state read from the shared folder, for use in several plans."""
        return DailyState(materialize(self.rows, "daily"), self.key, self.columns, self.measures)


def can_roll_up(model: Model, measures: Sequence[str], registry: Mapping[str, Measure]) -> bool:
    """Whether all that the measures need can be merged over days."""
    for name in with_inputs(measures, registry):
        measure = registry[name]
        if isinstance(measure, Derived):
            continue
        if isinstance(measure, AsOfTarget):
            return False
        key = model.key_between(measure.fact, model.date_dimension)
        if key is None or (key not in measure.group if isinstance(measure, GroupMean) else not measure.parts):
            return False
    return True


def parts_of(
    wanted: Mapping[str, Measure], key: str
) -> tuple[set[str], dict[str, Part], dict[str, Part], dict[str, tuple[Measure, tuple[str, ...]]]]:
    """The columns read, the partial results of rows, those merged to a day, and which of them a measure is made of.

    A mean over groups of a day is summed per group first; merged, it is a sum and a number of groups.
    """
    read, fine, merged, measures = set(), {}, {}, {}
    for i, (name, measure) in enumerate(wanted.items()):
        if isinstance(measure, GroupMean):
            read.add(measure.column)
            fine[f"g{i}"] = Part(lambda column=measure.column: F.sum(column))
            merged |= {f"g{i}": Part(lambda at=f"g{i}": F.sum(at)), f"n{i}": Part(lambda at=f"g{i}": F.count(at))}
            measures[name] = (measure, (f"g{i}", f"n{i}"))
            continue
        read.update(measure.columns)
        own = {f"p{i}_{j}": part for j, part in enumerate(measure.parts)}
        fine |= own
        merged |= {at: Part(lambda at=at, part=part: part.merge(at), part.merge) for at, part in own.items()}
        measures[name] = (measure, tuple(own))
    return read, fine, merged, measures


def finished(measures: Mapping[str, tuple[Measure, tuple[str, ...]]]) -> list[Column]:
    """The measures from their merged partial results."""
    out = []
    for name, (measure, columns) in measures.items():
        finish = measure.finish if isinstance(measure, Aggregate) else F.try_divide
        out.append(finish(*[F.col(column) for column in columns]).alias(name))
    return out


def _state(model: Model, fact: str, wanted: Mapping[str, Measure]) -> DailyState:
    """The state of one fact from one scan; where means over groups are asked for, by way of the groups."""
    key = model.key_between(fact, model.date_dimension)
    inner = {tuple(c for c in m.group if c != key) for m in wanted.values() if isinstance(m, GroupMean)}
    if len(inner) > 1:
        raise ValueError(f"{fact} has means over groups of several kinds")
    grain = [key, *(inner.pop() if inner else ())]
    read, fine, columns, measures = parts_of(wanted, key)
    rows = model.facts[fact].select(*sorted({*read, *grain})).groupBy(*grain).agg(*[p.build().alias(at) for at, p in fine.items()])
    if len(grain) > 1:
        rows = rows.groupBy(key).agg(*[p.build().alias(at) for at, p in columns.items()])
    return DailyState(rows, key, columns, measures)


def daily_states(
    model: Model, measures: Sequence[str], registry: Mapping[str, Measure], filters: Sequence[Filter] = ()
) -> list[DailyState]:
    """One state per fact that the measures need, under the filters."""
    base: dict[str, dict[str, Measure]] = {}
    for name in with_inputs(measures, registry):
        if isinstance(registry[name], (Aggregate, GroupMean)):
            base.setdefault(registry[name].fact, {})[name] = registry[name]
    tables = {*base, model.date_dimension, *(item.table for item in filters)}
    model = propagate_filters(restrict(model, tables), filters, {f: columns_of(f, m) for f, m in base.items()})
    return [_state(model, fact, wanted) for fact, wanted in base.items()]


def overall(states: Sequence[DailyState]) -> DataFrame:
    """One row with the base measures over all rows, dated or not."""
    parts = [state.rows.agg(*state.merged()).select(*state.finished()) for state in states]
    return drill_across(parts, [])


def by_period(states: Sequence[DailyState], calendar: DataFrame, periods: DataFrame, names: Sequence[str]) -> DataFrame:
    """The base measures per period; ``names`` are its columns, the last two the first and last day.

    Only days of the calendar (``date`` and the date key) count. A period without any fact has no row.
    """
    *_, first, last = names
    asked = periods.select(*names).distinct()
    bounds = asked.withColumns({"__begin": day_number(F.col(first)), "__end": day_number(F.col(last))})
    covers = bounds.filter("__begin <= __end").select(*names, F.inline(F.expr(COVER)))
    parts = []
    for state in states:
        # Both sides have one row per date, so no key is hot.
        dated = state.rows.join(calendar.select(state.key, "date"), state.key)
        numbered = dated.select(*state.columns, F.inline(blocks_of_day(day_number(F.col("date")))))
        blocks = numbered.groupBy("level", "block").agg(*state.merged())
        merged = join_on_blocks(blocks, covers, dated, asked).groupBy(*names).agg(*state.merged())
        parts.append(merged.select(*names, *state.finished()))
    return drill_across(parts, list(names))
