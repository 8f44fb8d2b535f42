"""Window and time-series features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import LABEL
from shelfcast.operators import filters, joins, per_series, pricing, reshape, rollup, windows
from shelfcast.plans import tables
from shelfcast.queries import common
from shelfcast.queries.common import query, rounded
from shelfcast.sources import retail
from shelfcast.sources.retail import Mart


def _rows(mart: Mart) -> DataFrame:
    return common.spine(mart).select("id", "date", LABEL)


def _known(mart: Mart) -> DataFrame:
    return common.train_spine(mart).select("id", "date", LABEL)


def _prices(mart: Mart) -> DataFrame:
    return common.priced_days(mart)


@query
def lag_multi(mart: Mart) -> DataFrame:
    return windows.add_lags(_rows(mart))


@query
def rolling_mean_of_lags(mart: Mart) -> DataFrame:
    out = windows.add_rolling_mean_of_lags(_rows(mart)).drop(LABEL)
    return rounded(out, *out.columns[2:])


def _rolling(mart: Mart, stat, name: str) -> DataFrame:
    columns = {f"Roll_{name}_{n}": stat(n) for n in windows.ROLL_WINDOWS}
    out = windows.with_running(_known(mart)).select("id", "date", *[c.alias(n) for n, c in columns.items()])
    return rounded(out, *columns)


@query
def rolling_mean_right(mart: Mart) -> DataFrame:
    return _rolling(mart, windows.rolling_mean, "Mean")


@query
def rolling_sd_right(mart: Mart) -> DataFrame:
    return _rolling(mart, windows.rolling_sd, "Sd")


@query
def rolling_slope_right(mart: Mart) -> DataFrame:
    return _rolling(mart, windows.rolling_slope, "Lm")


@query
def rolling_shifted(mart: Mart) -> DataFrame:
    out = windows.add_shifted_stats(_known(mart)).drop(LABEL)
    return rounded(out, *out.columns[2:])


@query
def rolling_shifted_consistent(mart: Mart) -> DataFrame:
    out = windows.add_shifted_stats(_known(mart), consistent=True).drop(LABEL)
    return rounded(out, *out.columns[2:])


@query
def rolling_centered_shifted(mart: Mart) -> DataFrame:
    total = rollup.sum_by(common.dated_sales(mart), [])
    return rounded(windows.add_centred_shifted(total), "roll_sd_28", "roll_mean_28")


@query
def rolling_centered_shifted_grouped(mart: Mart) -> DataFrame:
    keys = ["store_id", "dept_id"]
    groups = rollup.sum_by(common.dated_sales(mart), keys)
    return rounded(windows.add_centred_shifted(groups, keys), "roll_sd_28", "roll_mean_28")


@query
def future_rolling_shift(mart: Mart) -> DataFrame:
    out = windows.stats_for_horizon(_known(mart))
    return rounded(out, *out.columns[2:])


@query
def future_rolling_centered(mart: Mart) -> DataFrame:
    total = rollup.sum_by(common.dated_sales(mart), [])
    return rounded(windows.centred_for_horizon(total, mart.cutoff), "roll_sd_28", "roll_mean_28")


@query
def future_rolling_centered_grouped(mart: Mart) -> DataFrame:
    keys = ["store_id", "dept_id"]
    groups = rollup.sum_by(common.dated_sales(mart), keys)
    return rounded(windows.centred_for_horizon(groups, mart.cutoff, keys), "roll_sd_28", "roll_mean_28")


@query
def lead_features(mart: Mart) -> DataFrame:
    events = tables.holiday_features(mart.calendar, retail.EVENT_VOCABULARY)
    sports = tables.sports_features(mart.calendar, common.sports(mart), retail.RACES)
    both = joins.join_days(events, sports, small=mart.small_days)
    return common.with_total(mart, both.select("date", *reshape.columns_like(both, ["_Lead_"])))


@query
def lead_with_future_pad(mart: Mart) -> DataFrame:
    """Leads of the training rows, whose last two days look into the horizon."""
    star = common.sports(mart).on_days(joins.football_days(mart.calendar), retail.RACES)
    led = windows.lead_days(star, ["NFL_Sun", "NCAA_Sat", "NBA_Finals", "USO_Sunday"], (1, 2))
    days = led.select("date", *reshape.columns_like(led, ["_Lead_"]))
    return joins.join_days(_known(mart), days, small=mart.small_days)


@query
def holiday_lag_flags(mart: Mart) -> DataFrame:
    names = ["event_Thanksgiving", "event_Christmas"]
    days = common.wide_calendar(mart).select("date", *names)
    return common.with_total(mart, windows.lag_days(days, names))


@query
def dynamic_window_price_mean(mart: Mart) -> DataFrame:
    return pricing.add_price_mean(_prices(mart))


@query
def promo_hike_flags(mart: Mart) -> DataFrame:
    return pricing.add_promo_hike(pricing.add_price_mean(_prices(mart))).drop("roll_mean")


@query
def price_lag_diff_change(mart: Mart) -> DataFrame:
    return pricing.add_price_changes(_prices(mart))


@query
def horizon_index(mart: Mart) -> DataFrame:
    return windows.horizon_index(filters.from_date(_prices(mart), mart.cutoff).select("id", "date"))


@query
def locf_fill(mart: Mart) -> DataFrame:
    """The last positive sale carried over the days without one."""
    sold = _known(mart).withColumn("sold", F.when(F.col(LABEL) > 0, F.col(LABEL)))
    return sold.withColumn("filled", windows.locf("sold"))


@query
def tail_per_series(mart: Mart) -> DataFrame:
    return windows.tail_per_series(_known(mart), 60)


@query
def apply_per_series(mart: Mart) -> DataFrame:
    """A user function per series: days since the last sale, counted in the function."""

    def gaps(rows):
        sold = rows["date"].where(rows[LABEL] > 0).ffill()
        since = (rows["date"].astype("datetime64[ns]") - sold.astype("datetime64[ns]")).dt.days
        return rows[["id", "date"]].assign(days_since=since.astype("Int32"))

    return per_series.apply_per_series(_known(mart), gaps, "id string, date date, days_since int")
