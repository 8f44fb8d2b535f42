"""Encodings and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import LABEL
from shelfcast.functions import dates, text, values
from shelfcast.operators import encode, reshape, windows
from shelfcast.plans import tables
from shelfcast.queries import common
from shelfcast.queries.common import query
from shelfcast.sources.retail import Mart


@query
def label_encode_items(mart: Mart) -> DataFrame:
    return encode.encode_items(mart.series)


@query
def label_encode_calendar(mart: Mart) -> DataFrame:
    return common.with_total(mart, encode.encode_calendar(mart.calendar))


@query
def label_encode_events(mart: Mart) -> DataFrame:
    return common.with_total(mart, tables.event_codes(mart.calendar))


@query
def date_parts(mart: Mart) -> DataFrame:
    parts = dates.date_parts(F.col("date"))
    return mart.cells.select("id", "date", *[c.alias(n) for n, c in parts.items()])


@query
def week_of_month(mart: Mart) -> DataFrame:
    return mart.cells.select("id", "date", dates.week_of_month(F.col("date")).alias("weekmonth"))


@query
def week_of_year_simple(mart: Mart) -> DataFrame:
    return mart.cells.select("id", "date", dates.week_of_year_simple(F.col("date")).alias("week"))


@query
def event_name_clean(mart: Mart) -> DataFrame:
    events = reshape.unpivot_events(mart.calendar)
    return common.with_total(mart, events.withColumn("clean", text.clean_event(F.col("event"))))


@query
def series_key(mart: Mart) -> DataFrame:
    return mart.cells.select(
        "item_id", "store_id", "date",
        text.series_key("item_id", "store_id").alias("store_item"),
        text.series_key("item_id", "store_id", suffix="evaluation").alias("id"),
    )


@query
def path_to_series_id(mart: Mart) -> DataFrame:
    path = F.concat(F.lit("forecasts/eval_inference/"), F.col("id"), F.lit(".csv.out"))
    paths = mart.series.select(path.alias("path"))
    return paths.withColumn("id", text.path_to_series_id(F.col("path"), part=3))


@query
def football_flags(mart: Mart) -> DataFrame:
    flags = dates.football_flags(F.col("weekday"), F.col("month"))
    days = mart.calendar.select("date", "weekday", *[c.alias(n) for n, c in flags.items()])
    return common.with_total(mart, days)


@query
def null_fill_constant(mart: Mart) -> DataFrame:
    rows = windows.add_lags(common.spine(mart).select("id", "date", LABEL)).drop(LABEL)
    rows = values.fill_missing(rows, 0, ["lag_7", "lag_28"])
    return values.fill_missing(rows, 1, ["lag_60"])


@query
def parse_us_date(mart: Mart) -> DataFrame:
    written = mart.cells.select("id", F.date_format("date", "M/d/yyyy").alias("us_text"), F.col("date").cast("string").alias("iso_text"))
    return written.select(
        "*",
        dates.parse_us_date(F.col("us_text")).alias("us_date"),
        dates.parse_us_date(F.col("iso_text")).cast("string").alias("iso_date"),
    )


@query
def horizon_label_parse(mart: Mart) -> DataFrame:
    rows = common.forecast_long(mart).select("id", "key", text.horizon_number(F.col("key")).alias("h"))
    return rows.select(
        "*",
        text.horizon_label(F.col("h")).alias("label"),
        text.day_label(F.col("h") + mart.span.train_days).alias("d"),
    )


@query
def shift_date_to_horizon(mart: Mart) -> DataFrame:
    return mart.cells.select("id", "date", dates.shift_to_horizon(F.col("date")).alias("shifted"))


@query
def clip_nonnegative(mart: Mart) -> DataFrame:
    """Week-on-month change, negative or missing for many rows."""
    rows = windows.add_lags(common.spine(mart).select("id", "date", LABEL))
    raw = (F.col("lag_7") - F.col("lag_28")).cast("double")
    return rows.select("id", "date", raw.alias("raw"), values.clip_nonnegative(raw).alias("clipped"))
