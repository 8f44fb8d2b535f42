"""Row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import LABEL


def from_date(df: DataFrame, start: dt.date) -> DataFrame:
    return df.filter(F.col("date") >= F.lit(start))


def between_dates(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    return df.filter(F.col("date").between(F.lit(first), F.lit(last)))


def season_or_year(df: DataFrame, months: Sequence[int], year: int) -> DataFrame:
    """The named months of every year, and the whole of one year."""
    return df.filter(F.month("date").isin(list(months)) | (F.year("date") == year))


def train_rows(df: DataFrame, cutoff: dt.date) -> DataFrame:
    return df.filter(F.col("date") < F.lit(cutoff))


def eval_rows(df: DataFrame, cutoff: dt.date, label: str = LABEL) -> DataFrame:
    """Horizon rows without their label."""
    return df.filter(F.col("date") >= F.lit(cutoff)).drop(label)


def complete_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def ids_containing(df: DataFrame, text: str, column: str = "id") -> DataFrame:
    return df.filter(F.col(column).contains(text))


def first_days(calendar: DataFrame, start: dt.date, cutoff: dt.date) -> DataFrame:
    """Day labels used as training columns: the days from ``start`` up to the cutoff."""
    return train_rows(from_date(calendar, start), cutoff).select("d", "date")


def with_part(df: DataFrame, cutoff: dt.date, name: str = "part") -> DataFrame:
    """Training and horizon rows in one frame, told apart by ``name``."""
    return df.withColumn(name, F.when(F.col("date") < F.lit(cutoff), "train").otherwise("eval"))
