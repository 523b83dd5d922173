"""Column expressions shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "[ \\x09-\\x0D]+"


def words(text: Column) -> Column:
    """Runs of characters other than space and U+0009-U+000D; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; lower() is the same thing on pure ASCII and faster."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike("[^\\x00-\\x7F]"), F.translate(t, UPPER, LOWER)).otherwise(F.lower(t))


def utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")
