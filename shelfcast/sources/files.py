"""Readers of the input files. Every read declares its schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.columns import FORECAST_COLS, LABEL, SERIES_COLS
from shelfcast.functions.dates import parse_us_date
from shelfcast.functions.text import path_to_series_id, series_key
from shelfcast.operators.filters import from_date

PRICE_SCHEMA = "store_id string, item_id string, wm_yr_wk int, sell_price double"
SALES_SCHEMA = f"id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d string, {LABEL} bigint"
NBA_SCHEMA = "date date, NBA_Finals int"
DATED_EVENT_SCHEMA = "event string, date string"


def calendar_schema(states: Sequence[str]) -> str:
    flags = "".join(f", snap_{s} int" for s in states)
    return (
        "date date, d string, wm_yr_wk int, weekday string, wday int, month int, year int,"
        " event_name_1 string, event_type_1 string, event_name_2 string, event_type_2 string" + flags
    )


def mlb_schema(states: Sequence[str]) -> str:
    return "date date" + "".join(f", MLB_{s} int" for s in states)


def wide_schema(days: Sequence[str]) -> str:
    return ", ".join([f"{c} string" for c in SERIES_COLS] + [f"{d} bigint" for d in days])


def submission_schema() -> str:
    return "id string" + "".join(f", {c} double" for c in FORECAST_COLS)


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True, **options: str) -> DataFrame:
    return spark.read.schema(schema).options(header=header, **options).csv(path)


def scan_calendar(spark: SparkSession, path: str, states: Sequence[str], start: dt.date | None = None) -> DataFrame:
    calendar = read_csv(spark, path, calendar_schema(states))
    return from_date(calendar, start) if start else calendar


def scan_prices(spark: SparkSession, path: str) -> DataFrame:
    prices = read_csv(spark, path, PRICE_SCHEMA)
    return prices.withColumn("store_item", series_key("item_id", "store_id"))


def scan_sales_wide(spark: SparkSession, path: str, all_days: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The wide sales matrix, only the id columns and the days to keep."""
    wide = read_csv(spark, path, wide_schema(all_days), maxColumns=str(len(all_days) + 100))
    return wide.select(*SERIES_COLS, *keep)


def scan_nba(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, NBA_SCHEMA)


def scan_mlb(spark: SparkSession, path: str, states: Sequence[str]) -> DataFrame:
    return read_csv(spark, path, mlb_schema(states))


def scan_us_open(spark: SparkSession, path: str) -> DataFrame:
    dates = read_csv(spark, path, DATED_EVENT_SCHEMA)
    return dates.select(parse_us_date(F.col("date")).alias("date"), F.lit(1).alias("USO_Sunday"))


def scan_races(spark: SparkSession, path: str) -> DataFrame:
    races = read_csv(spark, path, DATED_EVENT_SCHEMA)
    return races.select("event", parse_us_date(F.col("date")).alias("date"))


def scan_target_ids(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, submission_schema()).select("id")


def scan_prefix(spark: SparkSession, prefix: str, schema: str, header: bool = True) -> DataFrame:
    """All files below a prefix as one table."""
    return read_csv(spark, prefix, schema, header=header, recursiveFileLookup="true")


def scan_predictions(spark: SparkSession, prefix: str, extension: str = ".csv.out") -> DataFrame:
    """One header-less file per series: id from its path, horizon step from the line number.

    A file is read whole because only its own line order carries the step; it holds one
    number per horizon day.
    """
    files = spark.read.text(prefix, wholetext=True).select(
        path_to_series_id(F.url_decode("_metadata.file_path"), extension=extension).alias("id"),
        F.posexplode(F.split(F.rtrim(F.col("value"), F.lit("\n")), "\n")).alias("line", "number"),
    )
    return files.select("id", (F.col("line") + 1).alias("h"), F.expr("try_cast(number as double)").alias("pred"))
