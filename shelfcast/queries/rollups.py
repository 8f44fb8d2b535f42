"""Aggregates, distinct lists, top-k and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import LABEL
from shelfcast.operators import blend, joins, metrics, rollup
from shelfcast.queries import common
from shelfcast.queries.common import query, rounded
from shelfcast.sources.retail import Mart


@query
def agg_by_state(mart: Mart) -> DataFrame:
    return rollup.sum_by(common.dated_sales(mart), ["state_id"])


@query
def agg_by_store(mart: Mart) -> DataFrame:
    return rollup.sum_by(common.dated_sales(mart), ["store_id"])


@query
def agg_by_dept(mart: Mart) -> DataFrame:
    return rollup.sum_by(common.dated_sales(mart), ["dept_id"])


@query
def agg_by_cat(mart: Mart) -> DataFrame:
    return rollup.sum_by(common.dated_sales(mart), ["cat_id"])


@query
def agg_by_store_dept(mart: Mart) -> DataFrame:
    return rollup.sum_by(common.dated_sales(mart), ["store_id", "dept_id"])


@query
def agg_total(mart: Mart) -> DataFrame:
    return rollup.sum_by(common.dated_sales(mart), [])


@query
def agg_hierarchy_grouping_sets(mart: Mart) -> DataFrame:
    return rollup.sum_all_levels(common.dated_sales(mart))


@query
def item_stats(mart: Mart) -> DataFrame:
    return rounded(rollup.series_stats(mart.sales), "mean_v")


@query
def agg_forecast_by_horizon(mart: Mart) -> DataFrame:
    return rounded(rollup.sum_by_horizon(common.forecast_long(mart)), "bu")


@query
def distinct_rows(mart: Mart) -> DataFrame:
    """Selling days of each store, from the item rows."""
    return mart.cells.select("store_id", "date").distinct()


@query
def distinct_keys(mart: Mart) -> DataFrame:
    return rollup.distinct_values(mart.cells, "store_id")


@query
def data_range_report(mart: Mart) -> DataFrame:
    every, known = F.lit(True), F.col("date") < F.lit(mart.cutoff)
    spine = rollup.date_coverage(common.spine(mart), {"spine": every, "train": known, "future": ~known})
    return spine.unionByName(rollup.date_coverage(mart.cells, {"cells": every}))


# -- metrics ----------------------------------------------------------------
def _scored(mart: Mart) -> DataFrame:
    """Both forecasts beside what sold."""
    sold = joins.join_days(mart.actuals, mart.calendar.select("d", "date"), "d", small=mart.small_days)
    return common.two_forecasts(mart).join(sold.select("id", "date", LABEL), ["id", "date"])


@query
def metric_rmse(mart: Mart) -> DataFrame:
    long = _scored(mart).unpivot(["id", "h", LABEL], ["a", "b"], "model", "pred")
    return rounded(long.groupBy("model").agg(metrics.rmse(F.col(LABEL), F.col("pred")).alias("rmse")), "rmse")


@query
def metric_scaled_rmse(mart: Mart) -> DataFrame:
    return metrics.scaled_rmse(common.train_spine(mart), _scored(mart), estimate="a")


@query
def minmax_scale(mart: Mart) -> DataFrame:
    scaled = metrics.add_minmax(common.train_spine(mart), LABEL, ["store_id"], "scaled", common.few_groups(mart, ["store_id"]))
    return scaled.select("id", "date", LABEL, "scaled")


@query
def submission_contract_check(mart: Mart) -> DataFrame:
    wide = blend.final_submission(common.forecast_wide(mart), mart.template)
    return metrics.submission_check(wide, mart.template)


# -- top-k ------------------------------------------------------------------
@query
def topk_items(mart: Mart) -> DataFrame:
    return rounded(rollup.top_series(rollup.series_stats(mart.sales), 5), "mean_v")


@query
def best_multiplier(mart: Mart) -> DataFrame:
    search = blend.multiplier_search(common.forecast_long(mart, "b"), common.top_forecast(mart))
    return rounded(blend.best_multiplier(search), "rmse")
