"""Joins and assembled tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import LABEL
from shelfcast.functions.text import series_key
from shelfcast.operators import encode, filters, joins, rollup
from shelfcast.plans import tables
from shelfcast.queries import common
from shelfcast.queries.common import query, rounded
from shelfcast.sources import retail
from shelfcast.sources.retail import Mart


@query
def join_price_week_to_day(mart: Mart) -> DataFrame:
    return joins.price_weeks_to_days(mart.prices, mart.calendar, mart.small_days)


@query
def join_left_demand(mart: Mart) -> DataFrame:
    days = joins.price_weeks_to_days(mart.prices, mart.calendar, mart.small_days)
    return joins.attach_demand(days, mart.sales).select("store_id", "item_id", "d", "date", "sell_price", LABEL)


@query
def semi_join_price_weeks(mart: Mart) -> DataFrame:
    season = filters.season_or_year(mart.calendar, [3, 4, 5, 6], mart.span.last.year)
    return joins.prices_in_calendar(mart.prices, season)


@query
def semi_join_series(mart: Mart) -> DataFrame:
    """Horizon prices of the series that sold on the last known day."""
    last = F.lit(mart.cutoff - dt.timedelta(days=1))
    sold = mart.cells.filter(F.col("date") == last)
    priced = common.priced_days(mart)
    future = filters.from_date(mart.calendar.select("date"), mart.cutoff)
    return joins.rows_of(joins.rows_of(priced, future, "date"), sold, "id")


@query
def join_sales_calendar(mart: Mart) -> DataFrame:
    days = mart.calendar.select("d", "date", "wm_yr_wk", "weekday", "month")
    return joins.sales_with_calendar(mart.sales.select("id", "d", LABEL), days)


@query
def join_left_price(mart: Mart) -> DataFrame:
    days = mart.calendar.select("d", "date", "wm_yr_wk")
    keyed = mart.sales.select(series_key("item_id", "store_id").alias("store_item"), "d", LABEL)
    return joins.sales_with_price(joins.sales_with_calendar(keyed, days), mart.prices)


@query
def join_inner_price(mart: Mart) -> DataFrame:
    days = mart.calendar.select("d", "date", "wm_yr_wk")
    keyed = mart.sales.select(series_key("item_id", "store_id").alias("store_item"), "d", LABEL)
    return joins.sales_with_price(joins.sales_with_calendar(keyed, days), mart.prices, "inner")


@query
def sports_star_calendar_anchored(mart: Mart) -> DataFrame:
    star = common.sports(mart).on_days(joins.football_days(mart.calendar), retail.RACES)
    return common.with_total(mart, star)


@query
def sports_star_event_anchored(mart: Mart) -> DataFrame:
    return common.with_total(mart, common.sports(mart).on_anchor(mart.calendar))


@query
def join_calendar_features(mart: Mart) -> DataFrame:
    return common.with_total(mart, tables.label_day_table(mart.calendar, common.sports(mart)))


@query
def assemble_label_encoded_table(mart: Mart) -> DataFrame:
    days = common.label_days_table(mart)
    return tables.label_table(common.spine(mart), days, encode.encode_items(mart.series), mart.small_days)


STAT_COLS = [f"Roll_{s}_{n}_Shift" for s in ("Mean", "Sd", "Lm") for n in (28, 7, 14)]


@query
def assemble_series_model_table(mart: Mart) -> DataFrame:
    return rounded(common.training_table(mart, start=common.TRAIN_START), *STAT_COLS)


@query
def assemble_top_level_table(mart: Mart) -> DataFrame:
    days = common.aggregate_days_table(mart)
    total = rollup.sum_by(common.dated_sales(mart), [])
    return rounded(tables.aggregate_table(total, days, small=mart.small_days), "roll_sd_28", "roll_mean_28")


@query
def assemble_future_table(mart: Mart) -> DataFrame:
    return rounded(common.horizon_table(mart), *STAT_COLS)


@query
def assemble_future_table_sliced(mart: Mart) -> DataFrame:
    """The horizon table with leads and lags that end at the edges of the 28 days."""
    return rounded(common.sliced_horizon_table(mart), *STAT_COLS)


@query
def assemble_season_label_table(mart: Mart) -> DataFrame:
    """The label-encoded table over one season of every year and the whole last year."""
    return common.season_label_table(mart)


@query
def join_restrict_to_target_ids(mart: Mart) -> DataFrame:
    wide = joins.keep_target_ids(mart.template, common.forecast_wide(mart))
    return rounded(wide, *wide.columns[1:])


@query
def join_two_forecasts(mart: Mart) -> DataFrame:
    both = joins.join_forecasts(common.forecast_long(mart, "a"), common.forecast_long(mart, "b"))
    return rounded(both, "value_x", "value_y")


@query
def join_top_items(mart: Mart) -> DataFrame:
    return joins.top_rows(mart.sales.select("id", "d", LABEL), rollup.series_stats(mart.sales), 5)


@query
def join_bottom_up_to_top(mart: Mart) -> DataFrame:
    bottom = rollup.sum_by_horizon(common.forecast_long(mart))
    return rounded(bottom.join(common.top_forecast(mart), "key"), "bu", "fcast")
