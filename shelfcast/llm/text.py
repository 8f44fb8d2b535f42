"""Small helpers on texts shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what separates words (blank, tab, line feed, vertical tab, form feed, return).
GAP = r"[\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order, without empty ones."""
    return F.array_remove(F.split(whole(text), GAP), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.transform(F.array(value), body).getItem(0)


def identity(*columns: Column) -> Column:
    """A 64-bit key of some columns; a missing value is a value of its own."""
    marks = [F.concat(c.isNull().cast("string"), F.coalesce(c.cast("string"), F.lit(""))) for c in columns]
    return F.xxhash64(*marks)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
