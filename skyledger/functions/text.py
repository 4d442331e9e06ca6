"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(text: Column) -> Column:
    """Lower case, every run of other characters than a-z and 0-9 becomes one blank, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def collapse_whitespace(text: Column) -> Column:
    """Lower case with every run of white space reduced to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def contains_any(text: Column, phrases: list[str] | tuple[str, ...]) -> Column:
    """True where any of the phrases occurs in the text."""
    found = F.lit(False)
    for phrase in phrases:
        found = found | text.contains(phrase)
    return found


def words(text: Column) -> Column:
    """The lower-case words of a text: letters, digits and inner apostrophes belong to a word.

    A text that starts or ends with another character gives an empty word there.
    """
    return F.split(F.lower(text), r"[^\p{L}\p{N}']+")
