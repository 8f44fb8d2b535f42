"""Joins between the fact, its dimensions and the day tables.

Day tables are broadcast when proven calendar-sized. Fact-to-fact joins carry no
hint: both sides are partitioned by series, and the partitioning is kept for the
windows that follow.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import DAY_LIMIT, LABEL
from shelfcast.functions.dates import football_flags
from shelfcast.functions.text import series_key
from shelfcast.operators.filters import from_date
from shelfcast.operators.rollup import top_series
from shelfcast.session import fits, small_side


def join_days(
    fact: DataFrame, days: DataFrame, on: str | Sequence[str] = "date", how: str = "inner", small: bool | None = None
) -> DataFrame:
    """Join a fact to a day table.

    ``small`` says that the day table is already known to hold at most ``DAY_LIMIT``
    rows; left open, its rows are counted up to that limit.
    """
    if small is None:
        small = fits(days, DAY_LIMIT)
    return fact.join(F.broadcast(days) if small else days, on, how)


# -- the row spine ----------------------------------------------------------
def price_weeks_to_days(prices: DataFrame, calendar: DataFrame, small: bool | None = None) -> DataFrame:
    """A weekly price to each day of its week; a day without a price has no row."""
    return join_days(prices, calendar.select("wm_yr_wk", "date", "d"), "wm_yr_wk", small=small)


def attach_demand(spine: DataFrame, demand: DataFrame) -> DataFrame:
    """Sales onto the spine by store, item and day; horizon rows keep a missing label."""
    return spine.join(demand.select("store_id", "item_id", "d", LABEL), ["store_id", "item_id", "d"], "left")


def make_spine(
    prices: DataFrame, calendar: DataFrame, demand: DataFrame, small: bool | None = None, since: dt.date | None = None
) -> DataFrame:
    """Priced days with their sales, keyed (id, date), partitioned and sorted by it.

    Both facts are partitioned by series and merged on (id, date), the order in which
    the windows that follow read them. The merge is asked for: compressed, a fact may
    look small enough to broadcast when it is not. With ``since`` only the days from
    then on: prices and sales are cut to them before they are shuffled.
    """
    key = series_key("item_id", "store_id", suffix="evaluation").alias("id")
    prices = prices.select(key, "*")
    if since:
        calendar = from_date(calendar, since)
        prices = join_days(prices, calendar.select("wm_yr_wk").distinct(), "wm_yr_wk", "left_semi", small)
    days = price_weeks_to_days(prices.repartition("id"), calendar, small)
    sold = join_days(demand.select("id", "d", LABEL), calendar.select("d", "date"), "d", small=small).drop("d")
    return days.join(sold.repartition("id").hint("merge"), ["id", "date"], "left")


def prices_in_calendar(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Prices whose week occurs in the calendar slice."""
    weeks = calendar.select("wm_yr_wk").distinct()
    return prices.join(small_side(weeks, DAY_LIMIT), "wm_yr_wk", "left_semi")


def rows_of(df: DataFrame, keys_of: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_of``."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys_of.select(*on), on, "left_semi")


def sales_with_calendar(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Long sales and calendar matched on differently named day labels."""
    renamed = sales.withColumnRenamed("d", "Date_label")
    days = small_side(calendar, DAY_LIMIT)
    return renamed.join(days, F.col("Date_label") == F.col("d")).drop("d")


def sales_with_price(sales: DataFrame, prices: DataFrame, how: str = "left") -> DataFrame:
    """Weekly price onto sales rows by (store_item, week)."""
    keyed = prices.select(series_key("item_id", "store_id").alias("store_item"), "wm_yr_wk", "sell_price")
    return sales.join(keyed, ["store_item", "wm_yr_wk"], how)


def top_rows(sales: DataFrame, stats: DataFrame, k: int, key: str = "id") -> DataFrame:
    """Sales of the ``k`` series with the highest mean; the list of k is broadcast."""
    return sales.join(F.broadcast(top_series(stats, k, key).select(key)), key)


# -- side calendars ---------------------------------------------------------
def sports_on_days(days: DataFrame, *sides: DataFrame, small: bool | None = None) -> DataFrame:
    """Every row of ``days`` with the flags of each side calendar, 0 where it has none.

    A side must be distinct by date: a repeated date repeats the day.
    """
    out = days
    for side in sides:
        out = join_days(out, side, "date", "left", small)
    return out.fillna(0)


def football_days(calendar: DataFrame) -> DataFrame:
    flags = football_flags(F.col("weekday"), F.col("month"))
    return calendar.select("date", *[c.alias(n) for n, c in flags.items()]).distinct()


def sports_on_anchor(
    calendar: DataFrame, anchor: DataFrame, *sides: DataFrame, small: bool | None = None
) -> DataFrame:
    """The same star hung on one sport's days: the other sports survive only there."""
    star = sports_on_days(anchor, *sides, small=small)
    return join_days(calendar.select("date"), star, "date", "left", small).fillna(0)


# -- forecasts --------------------------------------------------------------
def keep_target_ids(targets: DataFrame, forecast: DataFrame) -> DataFrame:
    """Forecast rows of the required ids."""
    return targets.select("id").join(forecast, "id")


def join_forecasts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two long forecasts side by side: (id, key, value_x, value_y)."""
    return a.withColumnRenamed("value", "value_x").join(b.withColumnRenamed("value", "value_y"), ["id", "key"])
