"""Column choice, reshapes and filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import LABEL, SERIES_COLS
from shelfcast.operators import blend, encode, filters, joins, reshape, rollup, windows
from shelfcast.plans import tables
from shelfcast.queries import common
from shelfcast.queries.common import query, rounded
from shelfcast.sources import retail
from shelfcast.sources.retail import Mart


@query
def select_pattern(mart: Mart) -> DataFrame:
    """Fixed indicators: date patterns in, event columns and the raw text parts out."""
    wide = common.wide_calendar(mart)
    fixed = reshape.columns_like(wide, ["weekday", "month", "year", "snap"], exclude=["event"])
    fixed = [c for c in fixed if c not in ("weekday", "month")]
    events = reshape.columns_like(wide, ["event"], exclude=["NBAFinalsEnd", "NBAFinalsStart"])
    ordered = reshape.columns_shared(wide.select("date", *fixed, *events), wide)
    return common.with_total(mart, wide.select(*ordered))


@query
def label_first_projection(mart: Mart) -> DataFrame:
    table = common.facts(mart).select(*SERIES_COLS, "date", "d", "wm_yr_wk", "sell_price", LABEL)
    known = filters.train_rows(table, mart.cutoff)
    return reshape.label_first(known.select("id", "date", *reshape.columns_between(table, "item_id", "state_id"), "sell_price", LABEL))


@query
def unpivot_sales(mart: Mart) -> DataFrame:
    return reshape.unpivot_sales(mart.sales_wide, ["id", "item_id", "store_id"])


@query
def unpivot_events(mart: Mart) -> DataFrame:
    return common.with_total(mart, reshape.unpivot_events(mart.calendar))


@query
def unpivot_events_known(mart: Mart) -> DataFrame:
    return common.with_total(mart, reshape.unpivot_events(mart.calendar, drop_missing=True))


@query
def unpivot_forecast(mart: Mart) -> DataFrame:
    return rounded(reshape.unpivot_forecast(common.forecast_wide(mart)), "value")


@query
def pivot_forecast(mart: Mart) -> DataFrame:
    wide = common.forecast_wide(mart)
    return rounded(wide, *wide.columns[1:])


@query
def onehot_events_pivot(mart: Mart) -> DataFrame:
    names = [*retail.EVENT_VOCABULARY, "event_NA"]
    return common.with_total(mart, reshape.one_hot_events(mart.calendar, names, drop_missing=False))


@query
def onehot_events_pivot_known(mart: Mart) -> DataFrame:
    names = reshape.event_vocabulary(mart.calendar)
    return common.with_total(mart, reshape.one_hot_events(mart.calendar, names))


@query
def onehot_races_pivot(mart: Mart) -> DataFrame:
    return common.with_total(mart, reshape.one_hot_races(common.sports(mart).races, retail.RACES))


@query
def onehot_date_parts(mart: Mart) -> DataFrame:
    flags = tables.date_flag_columns(mart.span.years)
    return common.with_total(mart, mart.calendar.select("date", *flags))


@query
def calendar_wide_features(mart: Mart) -> DataFrame:
    return common.with_total(mart, common.wide_calendar(mart))


@query
def first_n_days(mart: Mart) -> DataFrame:
    days = filters.first_days(mart.calendar, common.TRAIN_START, mart.cutoff)
    return common.with_total(mart, days)


@query
def state_specific_flags(mart: Mart) -> DataFrame:
    rows = common.priced_days(mart).select("id", "date").join(mart.series.select("id", "state_id"), "id")
    flags = common.state_days(mart).select("date", "state_id", "snap", "MLB")
    return joins.join_days(rows, flags, ["date", "state_id"], small=mart.small_days)


@query
def encode_strings_all(mart: Mart) -> DataFrame:
    return encode.encode_strings(rollup.sum_by(common.dated_sales(mart), ["store_id", "dept_id"]))


# -- filters ----------------------------------------------------------------
@query
def filter_date_from(mart: Mart) -> DataFrame:
    return filters.from_date(mart.cells, common.TRAIN_START).select("id", "date", "qty")


@query
def filter_season_or_year(mart: Mart) -> DataFrame:
    return filters.season_or_year(mart.cells, [3, 4, 5, 6], mart.span.last.year).select("id", "date", "qty")


@query
def train_eval_split(mart: Mart) -> DataFrame:
    rows = common.spine(mart).select("id", "date", "sell_price", LABEL)
    return filters.with_part(rows, mart.cutoff)


@query
def drop_incomplete_rows(mart: Mart) -> DataFrame:
    rows = windows.add_lags(common.spine(mart).select("id", "date", LABEL))
    return filters.complete_rows(rows)


@query
def filter_id_match(mart: Mart) -> DataFrame:
    both = blend.both_id_forms(common.forecast_long(mart))
    return rounded(filters.ids_containing(both, "evaluation"), "value")


@query
def filter_date_range(mart: Mart) -> DataFrame:
    """The two days that pad the leads of the training tail."""
    second = mart.cutoff + dt.timedelta(days=1)
    return filters.between_dates(common.priced_days(mart), mart.cutoff, second)
