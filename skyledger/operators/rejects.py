"""Typed tables beside the records that could not be typed, each with a reason.

Casting turns bad text into null; here the same pass also notes what it could not use. The rows
are written once, typed and with their rejects, and the kept rows, the rejected rows and the list
of rejects are read from there: the source is scanned once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numeric import whole_number
from skyledger.session import materialize
from skyledger.sources.readers import MALFORMED

REJECTS = "__rejects"
REJECT = "array<struct<column_name:string,raw_value:string,reason:string>>"


@dataclass(frozen=True)
class Typed:
    """The written rows of a load, with the list of rejects of each."""

    rows: DataFrame
    keys: tuple[str, ...]

    @property
    def nulled(self) -> DataFrame:
        """All rows that are records at all; a bad value is null."""
        readable = ~F.exists(REJECTS, lambda r: r["column_name"].isNull())
        return self.rows.filter(readable).drop(REJECTS)

    @property
    def kept(self) -> DataFrame:
        """Rows without a reject."""
        return self.rows.filter(F.size(REJECTS) == 0).drop(REJECTS)

    @property
    def rejected(self) -> DataFrame:
        """Rows with at least one reject, typed as far as possible."""
        return self.rows.filter(F.size(REJECTS) > 0).drop(REJECTS)

    @property
    def rejects(self) -> DataFrame:
        """One row per value that was not used: keys, ``column_name, raw_value, reason``.

        A record that could not be read has no keys and no ``column_name``; its ``raw_value`` is the whole record.
        """
        return self.rows.select(*[f"`{key}`" for key in self.keys], F.inline(REJECTS))

    @property
    def summary(self) -> DataFrame:
        """Rejects per column and reason."""
        return self.rejects.groupBy("column_name", "reason").agg(F.count(F.lit(1)).alias("reject_count"))

    @property
    def balance(self) -> DataFrame:
        """One row: all rows, kept and rejected ones, and the rejects."""
        bad = F.size(REJECTS) > 0
        return self.rows.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(~bad).alias("kept_count"),
            F.count_if(bad).alias("rejected_count"),
            F.coalesce(F.sum(F.size(REJECTS)), F.lit(0)).cast("long").alias("reject_count"),
        )


def _cast(name: str, kind: str) -> Column:
    text = F.col(f"`{name}`")
    return whole_number(text) if kind == "int" else text.try_cast(kind)


def cast_with_rejects(
    raw: DataFrame,
    types: Mapping[str, str],
    keys: Sequence[str],
    required: Sequence[str] = (),
    domains: Mapping[str, Sequence] | None = None,
) -> Typed:
    """Type the text columns of ``raw`` and note every value that is lost by it.

    Reasons: ``not a <type>``; ``missing`` for a null or blank value of a ``required`` column; ``not in domain`` for a
    value that ``domains`` does not list; ``malformed record`` for a row whose MALFORMED column is set (see the
    checked scans), which then has no other reject. A null or blank value that is not required is
    no reject. ``keys`` are columns that name a row in the list of rejects; they keep their raw text there
    unless they are typed themselves. Columns without a type stay as they are.
    """
    checks: list[Column] = []
    nothing = F.lit(None).cast("struct<column_name:string,raw_value:string,reason:string>")

    def reject(condition: Column, column: str | None, value: Column, reason: str) -> Column:
        entry = F.struct(
            F.lit(column).cast("string").alias("column_name"), value.cast("string").alias("raw_value"), F.lit(reason).alias("reason")
        )
        return F.when(condition, entry).otherwise(nothing)

    def present(name: str) -> Column:
        text = F.col(f"`{name}`")
        return text.isNotNull() & (F.trim(text.cast("string")) != "")

    for name, kind in types.items():
        checks.append(reject(present(name) & _cast(name, kind).isNull(), name, F.col(f"`{name}`"), f"not a {kind}"))
    for name in required:
        checks.append(reject(~present(name), name, F.col(f"`{name}`"), "missing"))
    for name, values in (domains or {}).items():
        known = F.col(f"`{name}`").isin(list(values))
        checks.append(reject(present(name) & ~known, name, F.col(f"`{name}`"), "not in domain"))
    noted = F.array_compact(F.array(*checks)) if checks else F.array().cast(REJECT)
    if MALFORMED in raw.columns:
        record = F.col(MALFORMED)
        whole = F.array(reject(record.isNotNull(), None, record, "malformed record"))
        noted = F.when(record.isNotNull(), whole).otherwise(noted)
    typed = [
        (_cast(name, types[name]) if name in types else F.col(f"`{name}`")).alias(name) for name in raw.columns if name != MALFORMED
    ]
    return Typed(materialize(raw.select(*typed, noted.alias(REJECTS)), "typed"), tuple(keys))
