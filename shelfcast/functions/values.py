"""Value expressions and missing-value fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clip_nonnegative(value: Column) -> Column:
    """Negative to 0; a missing value stays missing."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def fill_missing(df: DataFrame, value: float | int | str, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace missing values in the named columns (default all of a matching type)."""
    return df.fillna(value, subset=list(columns) if columns is not None else None)


def scale_between(value: Column, low: Column, high: Column) -> Column:
    """Min-max scale; a flat range has no scale and gives NULL."""
    return F.try_divide((value - low).cast("double"), (high - low).cast("double"))
