"""Checks that the write job itself makes, so that no table is scanned again to be judged."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROWS = "rows"


class CheckFailed(ValueError):
    """More rows break a rule than allowed."""


def observed(
    df: DataFrame, rules: Mapping[str, Column], nulls_of: Sequence[str] = ()
) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` with counters on it, and a function that gives the counts once one action has run over it.

    Counts: ``rows``; per rule, under its name, the rows that break it (a null result does not); per column of
    ``nulls_of``, under ``<column> is null``, its nulls. The counters are aggregated where the rows
    pass by and cost no job, scan or shuffle of their own. Run one action only: a second one is not counted.
    """
    metrics = {ROWS: F.count(F.lit(1))}
    metrics |= {name: F.count_if(~rule) for name, rule in rules.items()}
    metrics |= {f"{column} is null": F.count_if(F.col(f"`{column}`").isNull()) for column in nulls_of}
    if len(metrics) != 1 + len(rules) + len(nulls_of):
        raise ValueError("two checks have one name")
    watch = Observation()
    counters = [count.alias(f"m{i}") for i, count in enumerate(metrics.values())]

    def counts() -> dict[str, int]:
        found = watch.get
        return {name: int(found[f"m{i}"]) for i, name in enumerate(metrics)}

    return df.observe(watch, *counters), counts


def write_checked(
    df: DataFrame,
    path: str,
    rules: Mapping[str, Column],
    nulls_of: Sequence[str] = (),
    fmt: str = "parquet",
) -> DataFrame:
    """Write the table at ``path`` anew and return ``check_name, row_count`` from the write job."""
    watched, counts = observed(df, rules, nulls_of)
    watched.write.format(fmt).mode("overwrite").save(path)
    return df.sparkSession.createDataFrame(list(counts().items()), "check_name string, row_count long")
