"""Key, label and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_event(event: Column) -> Column:
    """Event text to a column name: letters and digits only, prefixed; missing is ``event_NA``."""
    bare = F.regexp_replace(F.coalesce(event, F.lit("NA")), "[^0-9A-Za-z]", "")
    return F.concat(F.lit("event_"), bare)


def series_key(*parts: Column | str, suffix: str | None = None) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    if suffix:
        cols.append(F.lit(suffix))
    return F.concat_ws("_", *cols)


def path_to_series_id(path: Column, part: int | None = None, extension: str = ".csv.out") -> Column:
    """Series id from a file path: its ``part``-th piece (default the last) without extension."""
    pieces = F.split(path, "/")
    piece = F.element_at(pieces, -1) if part is None else F.get(pieces, F.lit(part - 1))
    return F.replace(piece, F.lit(extension), F.lit(""))


def horizon_number(label: Column) -> Column:
    """``F12`` to 12."""
    return F.regexp_replace(label, "^F", "").cast("int")


def horizon_label(number: Column) -> Column:
    """12 to ``F12``."""
    return F.concat(F.lit("F"), number.cast("string"))


def day_label(number: Column) -> Column:
    """12 to ``d_12``."""
    return F.concat(F.lit("d_"), number.cast("string"))


def to_validation(series_id: Column) -> Column:
    return F.regexp_replace(series_id, "_evaluation$", "_validation")
