"""The assembled feature tables.

All per-day features are gathered into one day table first, so the fact meets a single
broadcast join. Every window of a table runs on the spine's partitioning by id.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.columns import HIERARCHY, LABEL, SERIES_COLS
from shelfcast.functions.dates import date_parts, parse_us_date, week_of_month
from shelfcast.operators import encode, filters, joins, pricing, reshape, windows

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
TREND_LEADS = ("event_", "MLB_", "NFL_Sun", "NCAA_Sat", "NBA_Finals", "USO_Sunday")


@dataclass(frozen=True)
class Sports:
    """The four schedules with real dates."""

    nba: DataFrame
    us_open: DataFrame
    mlb: DataFrame
    races: DataFrame
    small: bool | None = None

    @classmethod
    def of(cls, mart) -> Sports:
        date = parse_us_date(F.col("date")).alias("date")
        return cls(
            mart.side("nba_finals"),
            mart.side("us_open").select(date).distinct().withColumn("USO_Sunday", F.lit(1)),
            mart.side("mlb_games"),
            mart.side("horse_racing").select("event", date),
            mart.small_days,
        )

    def race_days(self) -> DataFrame:
        return self.races.select("date").distinct().withColumn("Horse_Race", F.lit(1))

    def on_days(self, days: DataFrame, race_names: Sequence[str]) -> DataFrame:
        races = reshape.one_hot_races(self.races, race_names)
        return joins.sports_on_days(days, self.nba, self.us_open, self.mlb, races, small=self.small)

    def on_anchor(self, calendar: DataFrame) -> DataFrame:
        return joins.sports_on_anchor(
            calendar, self.nba, self.us_open, self.mlb, self.race_days(), small=self.small
        )


# -- day tables -------------------------------------------------------------
def event_codes(calendar: DataFrame, tail: int = 1) -> DataFrame:
    """Event codes with the next two days' codes; past the calendar's end the code is ``tail``."""
    codes = encode.encode_events(calendar)
    names = [c for c in codes.columns if c != "date"]
    return windows.lead_days(codes, names, (1, 2)).fillna(tail)


def sports_with_leads(sports: DataFrame, steps: Sequence[int] = (1,)) -> DataFrame:
    return windows.lead_days(sports, [c for c in sports.columns if c != "date"], steps)


def label_day_table(calendar: DataFrame, sports: Sports) -> DataFrame:
    """Calendar keys and SNAP flags ⋈ date codes ⋈ event codes ⟕ sports with leads."""
    snap = reshape.columns_like(calendar, ["snap"])
    days = calendar.select("date", "d", "wm_yr_wk", *snap)
    days = joins.join_days(days, encode.encode_calendar(calendar), small=sports.small)
    days = joins.join_days(days, event_codes(calendar), small=sports.small)
    return joins.join_days(days, sports_with_leads(sports.on_anchor(calendar)), how="left", small=sports.small)


def date_flag_columns(years: Sequence[int]) -> list:
    date = F.col("date")
    return [
        *reshape.one_hot("weekday", WEEKDAYS, "weekday"),
        *reshape.one_hot(week_of_month(date), range(1, 7), "weekmonth"),
        *reshape.one_hot(F.month(date), range(1, 13), "month"),
        *reshape.one_hot(F.year(date), years, "year"),
    ]


def calendar_wide(
    calendar: DataFrame, events: Sequence[str], years: Sequence[int], small: bool | None = None
) -> DataFrame:
    """Calendar without its event columns, with one-hot dates and events joined by date."""
    kept = reshape.columns_like(calendar, exclude=["event"])
    kept = [c for c in kept if c not in ("wday", "year")]
    days = calendar.select(*kept, *date_flag_columns(years))
    flags = reshape.one_hot_events(calendar, events)
    return joins.join_days(days, flags, how="left", small=small).fillna(0, subset=list(events))


def series_day_table(wide: DataFrame, football: DataFrame, sports: Sports, race_names: Sequence[str]) -> DataFrame:
    """Point, lead, lag and fixed indicators of each day that hold for every state.

    Leads and lags are taken on the whole calendar and so need no padding at the
    edges of the training or horizon slice.
    """
    unwanted = reshape.columns_like(wide, ["NBAFinalsEnd", "NBAFinalsStart", "snap"])
    days = joins.join_days(wide.drop(*unwanted), football, small=sports.small)
    star = sports.on_days(days, race_names)
    star = star.drop(*reshape.columns_like(star, ["MLB"]))
    leading = reshape.columns_like(star, TREND_LEADS) + list(race_names)
    out = windows.lead_days(star, leading, (1, 2))
    out = windows.lag_days(out, ["event_Thanksgiving", "event_Christmas"])
    return out.drop("d", "wm_yr_wk", "weekday", "month")


def state_day_table(calendar: DataFrame, mlb: DataFrame, small: bool | None = None) -> DataFrame:
    """(date, state_id) with the state's own SNAP and baseball flags and baseball leads."""
    snap = reshape.state_flags(calendar, "snap", "snap")
    flags = [c for c in mlb.columns if c != "date"]
    all_days = joins.join_days(calendar.select("date"), mlb, how="left", small=small).fillna(0, subset=flags)
    games = reshape.state_flags(all_days, "MLB", "MLB")
    w = Window.partitionBy("state_id").orderBy("date")
    games = games.select("*", *[F.lead("MLB", k).over(w).alias(f"MLB_Lead_{k}") for k in (1, 2)])
    return joins.join_days(snap, games, ["date", "state_id"], small=small)


# -- label-encoded table ----------------------------------------------------
def label_table(
    spine: DataFrame, day_table: DataFrame, item_codes: DataFrame, small: bool | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """Spine (with any ``extra`` columns) ⟕ day features ⟕ item codes, in the model's column order."""
    base = spine.select("id", "date", LABEL, "sell_price", *extra)
    days = day_table.drop("d", "wm_yr_wk")
    table = joins.join_days(base, days, how="left", small=small).join(item_codes, "id", "left")
    return table.select(*base.columns, *[c for c in days.columns if c != "date"], *HIERARCHY)


# -- per-series table -------------------------------------------------------
def price_features(spine: DataFrame) -> DataFrame:
    return pricing.add_promo_hike(pricing.add_price_mean(spine)).drop("roll_mean")


def series_table(
    spine: DataFrame, series: DataFrame, day_table: DataFrame, state_days: DataFrame, cutoff: dt.date,
    start: dt.date | None = None, slopes: bool = True, consistent: bool = False, small: bool | None = None,
) -> DataFrame:
    """Training table: sales, price flags, shifted statistics and day indicators.

    Only complete rows remain. Rows and days are checked for that before they meet, so
    the check does not run over the wide joined row.
    """
    known = filters.train_rows(spine, cutoff).select("id", "date", LABEL, "sell_price")
    # The price window sorts anew, so it comes after those that use the spine's order.
    known = windows.add_shifted_stats(known, slopes=slopes, consistent=consistent)
    known = filters.complete_rows(price_features(known))
    if start:
        known = filters.from_date(known, start)
    known = known.join(series.select(*SERIES_COLS), "id")
    table = joins.join_days(known, filters.complete_rows(day_table), small=small)
    return joins.join_days(table, filters.complete_rows(state_days), ["date", "state_id"], small=small)


def future_table(
    spine: DataFrame, series: DataFrame, day_table: DataFrame, state_days: DataFrame, cutoff: dt.date,
    slopes: bool = True, small: bool | None = None, slice_price_lag: bool = False,
) -> DataFrame:
    """Horizon table with the columns of ``series_table`` bar the label.

    The price window runs over history and future; the rolling statistics come from the
    last known days moved 28 days ahead; what is missing becomes 0. Yesterday's price of
    the first horizon day is the last known one, or missing with ``slice_price_lag``.
    """
    priced = price_features(spine.select("id", "date", LABEL, "sell_price"))
    if slice_price_lag:
        future = pricing.add_price_changes(filters.eval_rows(priced, cutoff))
    else:
        future = filters.eval_rows(pricing.add_price_changes(priced), cutoff)
    future = future.drop("sell_price_diff", "sell_price_change")
    stats = windows.stats_for_horizon(filters.train_rows(spine, cutoff), slopes=slopes)
    table = future.join(stats, ["id", "date"]).join(series.select(*SERIES_COLS), "id")
    table = joins.join_days(table, day_table, small=small)
    table = joins.join_days(table, state_days, ["date", "state_id"], small=small)
    return table.withColumn("Zero_Demand", F.lit(0)).fillna(0)


# -- aggregate tables -------------------------------------------------------
def holiday_features(calendar: DataFrame, events: Sequence[str]) -> DataFrame:
    """One-hot events of every day, ``event_NA`` included, with the next two days' flags."""
    names = sorted([*events, "event_NA"])
    flags = reshape.one_hot_events(calendar, names, drop_missing=False)
    return windows.lead_days(flags, names, (1, 2))


def sports_features(calendar: DataFrame, sports: Sports, race_names: Sequence[str]) -> DataFrame:
    return sports_with_leads(sports.on_days(joins.football_days(calendar), race_names))


def plain_date_parts(calendar: DataFrame) -> DataFrame:
    date = F.col("date")
    parts = date_parts(date)
    names = ["year", "month", "weekday", "monthday"]
    return calendar.select("date", *[parts[n].alias(n) for n in names], week_of_month(date).alias("weekmonth"))


def aggregate_day_table(calendar: DataFrame, sports: Sports, events: Sequence[str], race_names: Sequence[str]) -> DataFrame:
    """SNAP ⟕ holidays ⟕ sports ⟕ date parts, one row per day."""
    days = calendar.select("date", *reshape.columns_like(calendar, ["snap"]))
    parts = (
        holiday_features(calendar, events),
        sports_features(calendar, sports, race_names),
        plain_date_parts(calendar),
    )
    for part in parts:
        days = joins.join_days(days, part, how="left", small=sports.small)
    return days


def aggregate_table(
    rolled: DataFrame, day_table: DataFrame, keys: Sequence[str] = (), small: bool | None = None
) -> DataFrame:
    """Training table of an aggregate level."""
    stats = windows.add_centred_shifted(rolled, keys)
    return joins.join_days(stats, day_table, small=small).fillna(0)


def aggregate_future(
    rolled: DataFrame, day_table: DataFrame, cutoff: dt.date, keys: Sequence[str] = (), small: bool | None = None
) -> DataFrame:
    """Horizon table of an aggregate level."""
    stats = windows.centred_for_horizon(rolled, cutoff, keys).drop(LABEL)
    return joins.join_days(stats, day_table, small=small).fillna(0)
