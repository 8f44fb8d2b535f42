"""Combining, scaling, reconciling and submitting forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import DAY_LIMIT
from shelfcast.functions.text import horizon_number, to_validation
from shelfcast.operators.joins import join_forecasts, keep_target_ids
from shelfcast.operators.metrics import rmse
from shelfcast.operators.reshape import pivot_forecast
from shelfcast.session import fits

# Scaled variants and the search grid.
VARIANTS = [0.97, 0.99, 1.01, 1.03]
GRID = [m / 100 for m in range(96, 131)]


def ensemble_mean(a: DataFrame, b: DataFrame) -> DataFrame:
    """Mean of two long forecasts, wide."""
    both = join_forecasts(a, b)
    mean = (F.col("value_x") + F.col("value_y")) / 2
    return pivot_forecast(both.select("id", horizon_number(F.col("key")).alias("h"), mean.alias("pred")))


def scale_forecast(forecast: DataFrame, multipliers: Sequence[float] = VARIANTS) -> DataFrame:
    """Each (id, key, value) row once per multiplier, scaled."""
    each = F.explode(F.array(*[F.lit(float(m)) for m in multipliers])).alias("mult")
    return forecast.select("id", "key", "value", each).withColumn("value", F.col("value") * F.col("mult"))


def multiplier_search(bottom: DataFrame, top: DataFrame, grid: Sequence[float] = GRID) -> DataFrame:
    """RMSE between the scaled bottom-up total and the top forecast, per multiplier.

    ``bottom`` is (id, key, value), ``top`` is (key, fcast): the bottom is summed first,
    so the grid multiplies one row per horizon day.
    """
    each = F.explode(F.array(*[F.lit(float(m)) for m in grid])).alias("mult")
    total = bottom.groupBy("key").agg(F.sum("value").alias("bu")).join(top, "key")
    return total.select("bu", "fcast", each).groupBy("mult").agg(
        rmse(F.col("fcast"), F.col("bu") * F.col("mult")).alias("rmse")
    )


def multiplier_search_by_item(bottom: DataFrame, top: DataFrame, grid: Sequence[float] = GRID) -> DataFrame:
    """The search with every item's value against the scaled top forecast.

    Per horizon day the mean squared error is the items' variance and the squared distance
    of their mean from the scaled forecast, so one pass over the items gives it for the
    whole grid, and nothing cancels.
    """
    each = F.explode(F.array(*[F.lit(float(m)) for m in grid])).alias("mult")
    y = F.col("value")
    sums = bottom.groupBy("key").agg(F.count(y).alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("spread"))
    away = F.col("mean") - F.col("mult") * F.col("fcast")
    squared = F.col("n") * (F.col("spread") + away * away)
    return (
        sums.join(top, "key")
        .select("n", "mean", "spread", "fcast", each)
        .groupBy("mult")
        .agg(F.sqrt(F.sum(squared) / F.sum("n")).alias("rmse"))
    )


def best_multiplier(search: DataFrame) -> DataFrame:
    """The search's first row by error, ties to the smaller multiplier."""
    return search.orderBy("rmse", "mult").limit(1)


def top_down(
    items: DataFrame,
    groups: DataFrame,
    keys: Sequence[str] = ("store_id", "dept_id"),
    few_groups: bool | None = None,
) -> DataFrame:
    """Split group forecasts to items by each item's share of its group and horizon day.

    ``items`` is (id, keys, h, pred), ``groups`` is (keys, h, group_pred). The group sums
    are aggregated and joined back: a group may hold any number of items. ``few_groups``
    says that there are at most ``DAY_LIMIT`` group days, whose sums are broadcast; left
    open, they are counted.
    """
    on = [*keys, "h"]
    if few_groups is None:
        few_groups = fits(groups.select(*on).distinct(), DAY_LIMIT)
    sums = items.groupBy(*on).agg(F.sum("pred").alias("_sum")).join(groups, on)
    share = F.try_divide(F.col("pred"), F.col("_sum"))
    sums = F.broadcast(sums) if few_groups else sums
    return items.join(sums, on).select("id", "h", (share * F.col("group_pred")).alias("pred"))


def both_id_forms(forecast: DataFrame) -> DataFrame:
    """The forecast under its evaluation ids and again under the validation ids."""
    return forecast.withColumn("id", to_validation(F.col("id"))).unionByName(forecast)


def final_submission(wide: DataFrame, targets: DataFrame) -> DataFrame:
    """Both id forms, restricted to the required ids."""
    return keep_target_ids(targets, both_id_forms(wide))
