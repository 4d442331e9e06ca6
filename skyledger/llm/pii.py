"""Personal data in texts, with Spark's own functions only.

A pattern proposes spans, a validator (a range, Luhn, mod 97) confirms them, and words before a
span move its score: a span of a kind that is not sure by itself needs such a word.

Spark gives the matches of a pattern and the pieces between them, but no places; the running
sums of their lengths are the places, counted in code points. The patterns are written so that a
long run of one character class is read once (possessive runs, no start inside a run), which
changes no match.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lengths are summed up in blocks of this many, so a text with very many matches stays cheap.
SUM_BLOCK = 128

# Characters before a span that are searched for context words.
CONTEXT = 48

# Scores: what a kind starts with, what a validator and a context word add, and what is needed.
CONFIRMED = 0.3
IN_CONTEXT = 0.4
NEEDED = 0.7


@dataclass(frozen=True)
class Kind:
    """One kind of personal data. ``needs`` is a literal without which no match exists."""

    name: str
    pattern: str
    needs: str | None
    start_score: float
    words: str | None = None
    base: bool = False


# The four base kinds in their order; their patterns match what the documented ones match.
_MAIL = "[A-Za-z0-9._%+-]"
KINDS = [
    Kind("email", rf"(?:(?<!{_MAIL})|\G){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 1.0, base=True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 1.0, base=True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", None, 1.0, base=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 1.0, base=True),
    # Kinds of the method. An account number is sure by its check digits, the others need a word.
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", None, 0.4, "(iban|account|konto|compte|cuenta)"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.1, "(ssn|social security|tax id)"),
    Kind("local_phone", r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])", None, 0.1, "(phone|tel|call|mobile|fax)"),
]
BASE = [k.name for k in KINDS if k.base]


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def running_sums(numbers: Column) -> Column:
    """Sums of all numbers before each element of an array of ints, block by block."""
    empty = F.array().cast("array<int>")
    starts = F.when(F.size(numbers) > 0, F.sequence(F.lit(1), F.size(numbers), F.lit(SUM_BLOCK))).otherwise(empty)

    def within(block: Column, begin: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(begin.alias("sum"), empty.alias("all")),
            lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["all"], F.array(acc["sum"])).alias("all")),
        )

    blocks = F.transform(starts, lambda s: F.slice(numbers, s, F.lit(SUM_BLOCK)))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x))
    if_first = F.aggregate(
        totals,
        F.struct(F.lit(0).alias("sum"), empty.alias("all")),
        lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["all"], F.array(acc["sum"])).alias("all")),
    )["all"]
    return F.flatten(F.zip_with(blocks, if_first, lambda b, begin: within(b, begin)["all"]))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right counts double."""
    count = F.length(digits)

    def value(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        double = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when((count - i) % 2 == 1, double).otherwise(digit)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), count), value), F.lit(0), lambda acc, x: acc + x)
    return (count > 0) & (total % 10 == 0)


def mod_97(account: Column) -> Column:
    """Whether an account number without spaces leaves 1 when its first four signs stand last."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substring(account, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        sign = F.substring(turned, i, F.lit(1))
        value = F.when(sign.rlike("[0-9]"), sign.cast("int")).otherwise(F.ascii(sign) - 55)
        return (acc * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return mod_97(F.replace(match, F.lit(" "), F.lit("")))
    if kind == "ssn":
        return ~match.rlike("^(000|666|9..)") & ~match.rlike("^...-00") & ~match.rlike("0000$")
    return F.lit(True)


def kind_spans(text: str | Column, kind: Kind) -> Column:
    """Spans of one kind as an array of (kind, start, end, score), by start."""
    text = _column(text)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.split(text, kind.pattern, -1)
    # The piece before each match, and the match: together the length of a step.
    steps = F.zip_with(found, F.slice(pieces, F.lit(1), F.size(found)), lambda m, p: F.length(p) + F.length(m))
    ends = F.zip_with(running_sums(steps), steps, lambda before, step: before + step)
    spans = F.zip_with(
        found, ends, lambda m, end: F.struct(m.alias("match"), (end - F.length(m)).alias("start"), end.alias("end"))
    )
    spans = F.filter(spans, lambda s: _valid(kind.name, s["match"]))

    def scored(s: Column) -> Column:
        score = F.lit(min(1.0, kind.start_score + CONFIRMED))
        if kind.words is not None:
            before = F.greatest(s["start"] - CONTEXT, F.lit(0))
            near = F.lower(F.substring(text, before + 1, s["start"] - before))
            word = near.rlike(rf"(?<![a-z]){kind.words}(?![a-z])")
            score = F.least(F.lit(1.0), score + F.when(word, IN_CONTEXT).otherwise(0.0))
        return F.struct(F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score.alias("score"))

    spans = F.filter(F.transform(spans, scored), lambda s: s["score"] >= NEEDED)
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    if kind.needs is not None:
        return F.when(F.contains(text, F.lit(kind.needs)), spans).otherwise(none)
    return F.when(text.rlike("[0-9]"), spans).otherwise(none)


def joined(spans: Column) -> Column:
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def find_spans(docs: DataFrame, text: str = "text", name: str = "pii_spans") -> DataFrame:
    """``docs`` with an array of spans (kind, start, end, score) of each whole text.

    Kinds come in the order of KINDS, spans of a kind by start, in code points with an exclusive
    end. A null or empty text has none. Spans of different kinds may overlap. Other columns stay
    as they are; one called ``name`` is replaced.
    """
    source = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.withColumn(name, F.concat(*[kind_spans(source, k) for k in KINDS]))


def base_report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, digest of the base spans, and all spans as text."""
    rows = docs.select(F.col("doc_id"), F.col("text").alias("text"))
    source = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.select("doc_id", *[kind_spans(source, k).alias(k.name) for k in KINDS])
    base = joined(F.concat(*[F.col(n) for n in BASE]))
    return rows.select(
        "doc_id",
        *[F.size(n).cast("long").alias(f"n_{n}") for n in BASE],
        F.sha2(base, 256).alias("base_sha256"),
        joined(F.concat(*[F.col(k.name) for k in KINDS])).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one.

    The united span takes the kind that starts first (of equal starts, the first of KINDS). A
    null text stays null, a text without spans stays as it is, and all other columns too.
    """
    spans = "array<struct<start:int,end:int,kind:string>>"
    found = find_spans(docs, text, "__spans")
    ordered = F.array_sort(F.transform("__spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def unite(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        overlaps = (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > s["start"])
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        return F.when(overlaps, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown))).otherwise(
            F.concat(acc, F.array(s))
        )

    united = F.aggregate(ordered, F.array().cast(spans), unite)
    source = F.col(f"`{text}`")
    starts = F.transform("__united", lambda s: s["start"])
    ends = F.concat(F.array(F.lit(0)), F.transform("__united", lambda s: s["end"]))
    gaps = F.zip_with(ends, F.concat(starts, F.array(F.length(source))), lambda a, b: F.substring(source, a + 1, b - a))
    marks = F.concat(F.transform("__united", lambda s: F.concat(F.lit("["), s["kind"], F.lit("]"))), F.array(F.lit("")))
    clean = F.array_join(F.flatten(F.zip_with(gaps, marks, lambda g, m: F.array(g, m))), "")
    replaced = F.when(F.size("__united") > 0, clean).otherwise(source)
    return found.withColumn("__united", united).withColumn(text, replaced).drop("__spans", "__united")
