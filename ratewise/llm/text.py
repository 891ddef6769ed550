"""Column expressions shared by the text operators (built-in functions only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that separates words: space and \\t \\n \\v \\f \\r.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for blank text."""
    return let(F.btrim(text, F.lit(SPACES)),
               lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN)))


def n_words(text: Column) -> Column:
    """Number of words of ``text`` as bigint, without building them."""
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def n_chars_of(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in ``chars``, as bigint."""
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("bigint")


def row_key(*columns: str) -> Column:
    """A digest that tells rows apart by the given columns, nulls included."""
    parts = [F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))
