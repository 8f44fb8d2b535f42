"""Label encoding: 1-based codes of sorted distinct values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.columns import DICTIONARY_LIMIT, EVENT_COLS, HIERARCHY
from shelfcast.functions.dates import date_parts, week_of_month, week_of_year_simple
from shelfcast.session import fits, written


def _sort_key(df: DataFrame, column: str) -> list[Column]:
    """Numbers by value; text without regard to case first, then by case."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return [F.lower(column), F.col(column)]
    return [F.col(column)]


def number_values(values: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct values numbered by one task: for a dictionary known to be small."""
    return values.withColumn(code, F.row_number().over(Window.orderBy(*_sort_key(values, column))))


def number_values_by_range(values: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct values numbered without any task seeing all of them.

    The values are range partitioned, numbered inside each range and shifted by the
    sizes of the ranges before it.
    """
    order = _sort_key(values, column)
    # Written out: both uses below must see the same ranges.
    ranged = written(
        values.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), f"codes-{column}"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    # One offset per shuffle partition, hence the broadcast.
    return ranged.join(F.broadcast(offsets), "_range").select(
        column, (F.col("_before") + inside).cast("int").alias(code)
    )


def _encode_few_rows(df: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    codes = [
        F.when(F.col(c).isNotNull(), F.dense_rank().over(Window.orderBy(F.col(c).isNull(), *_sort_key(df, c)))).alias(n)
        for c, n in zip(columns, names)
    ]
    return df.select("*", *codes)


def label_encode(
    df: DataFrame, columns: Sequence[str], suffix: str = "", limit: int = DICTIONARY_LIMIT, days: bool = False
) -> DataFrame:
    """Replace (or, with ``suffix``, accompany) each column by its code; missing stays missing.

    A day table (``days``) is ranked in place. Of other frames dictionaries of at most
    ``limit`` values are numbered in one task and broadcast, and larger ones are numbered by
    range and joined by shuffle.
    """
    names = [f"{c}{suffix or '__code'}" for c in columns]
    if days:
        out = _encode_few_rows(df, columns, names)
    else:
        out = df
        for column, code in zip(columns, names):
            values = df.select(column).filter(F.col(column).isNotNull()).distinct()
            if fits(values, limit):
                codes = F.broadcast(number_values(values, column, code))
            else:
                codes = number_values_by_range(values, column, code)
            out = out.join(codes, column, "left")
    if suffix:
        return out.select(*df.columns, *names)
    code_of = dict(zip(columns, names))
    return out.select(*[F.col(code_of[c]).alias(c) if c in code_of else c for c in df.columns])


def encode_strings(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every text column to its codes."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in keep]
    return label_encode(df, text)


def encode_items(series: DataFrame) -> DataFrame:
    """Series table with each hierarchy column as its code."""
    return label_encode(series, HIERARCHY)


def encode_calendar(calendar: DataFrame) -> DataFrame:
    """Date parts of each day as codes: weekday (alphabetical), week and day of month, ..."""
    date = F.col("date")
    parts: Mapping[str, Column] = {
        "weekmonth": week_of_month(date),
        "monthday": date_parts(date)["monthday"],
        "month": F.col("month"),
        "year": F.col("year"),
        "quarter": date_parts(date)["quarter"],
        "week": week_of_year_simple(date),
    }
    days = calendar.select("date", "weekday", *[c.alias(n) for n, c in parts.items()])
    return label_encode(days, ["weekday", *parts], days=True)


def encode_events(calendar: DataFrame, events: Sequence[str] = EVENT_COLS, missing: str = "unknown") -> DataFrame:
    """Event columns of each day as codes; a missing event is a value of its own."""
    filled = calendar.select("date", *events).fillna(missing, subset=list(events))
    return label_encode(filled, events, days=True)
