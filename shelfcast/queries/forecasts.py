"""Unions, blends, reconciliation and the flagship forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import blend, filters
from shelfcast.queries import common
from shelfcast.queries.common import query, rounded
from shelfcast.sources import retail
from shelfcast.sources.retail import Mart


def _wide(df: DataFrame) -> DataFrame:
    return rounded(df, *[c for c in df.columns if c != "id"])


@query
def union_validation_evaluation(mart: Mart) -> DataFrame:
    return _wide(blend.both_id_forms(common.forecast_wide(mart)))


@query
def union_segments(mart: Mart) -> DataFrame:
    """One frame per state, put back together."""
    rows = common.forecast_rows(mart).join(mart.series.select("id", "state_id"), "id")
    parts = [rows.filter(F.col("state_id") == state) for state in retail.STATES]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return rounded(out, "pred")


@query
def union_price_history_future(mart: Mart) -> DataFrame:
    priced = common.priced_days(mart)
    future = filters.from_date(priced, mart.cutoff)
    return future.unionByName(priced).distinct()


@query
def ensemble_mean(mart: Mart) -> DataFrame:
    return _wide(blend.ensemble_mean(common.forecast_long(mart, "a"), common.forecast_long(mart, "b")))


@query
def scale_forecast(mart: Mart) -> DataFrame:
    return rounded(blend.scale_forecast(common.forecast_long(mart)), "value")


@query
def multiplier_grid_search(mart: Mart) -> DataFrame:
    search = blend.multiplier_search(common.forecast_long(mart, "b"), common.top_forecast(mart))
    return rounded(search, "rmse")


@query
def multiplier_grid_search_items(mart: Mart) -> DataFrame:
    search = blend.multiplier_search_by_item(common.forecast_long(mart), common.top_forecast(mart))
    return rounded(search, "rmse")


@query
def topdown_disaggregate(mart: Mart) -> DataFrame:
    keys = ["store_id", "dept_id"]
    items = common.forecast_rows(mart, "b").join(mart.series.select("id", *keys), "id")
    rows = common.rolled_rows(mart, keys)
    names = rows.select("id", *keys).distinct()
    groups = common.forecast_rows(mart, "a", rows).join(names, "id")
    groups = groups.select(*keys, "h", F.col("pred").alias("group_pred"))
    return rounded(blend.top_down(items, groups, keys, common.few_groups(mart, keys)), "pred")


@query
def flagship_forecast(mart: Mart) -> DataFrame:
    """Prices, calendar and sales to the submission: both id forms, F1..F28."""
    return _wide(blend.final_submission(common.forecast_wide(mart), mart.template))
