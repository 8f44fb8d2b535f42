"""Forecast scores and contract checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import DAY_LIMIT, LABEL
from shelfcast.functions.values import scale_between
from shelfcast.operators.windows import series_window
from shelfcast.session import fits


def rmse(truth: Column, estimate: Column) -> Column:
    return F.sqrt(F.avg((truth - estimate) * (truth - estimate)))


def naive_scale(history: DataFrame, value: str = LABEL) -> DataFrame:
    """Mean absolute day-to-day change of each series."""
    step = F.abs(F.col(value) - F.lag(value, 1).over(series_window()))
    return history.select("id", step.alias("_step")).groupBy("id").agg(F.avg("_step").alias("scale"))


def scaled_rmse(history: DataFrame, scored: DataFrame, truth: str = LABEL, estimate: str = "pred") -> DataFrame:
    """Per series: root mean squared error in units of the naive scale, 6 decimals.

    A flat history has no scale and gives NULL.
    """
    error = scored.groupBy("id").agg(rmse(F.col(truth), F.col(estimate)).alias("_rmse"))
    return error.join(naive_scale(history), "id", "left").select(
        "id", F.round(F.try_divide(F.col("_rmse"), F.col("scale")), 6).alias("scaled_rmse")
    )


def add_minmax(
    df: DataFrame, value: str, keys: Sequence[str], name: str, few_groups: bool | None = None
) -> DataFrame:
    """Value scaled to 0..1 inside its group.

    The bounds are aggregated per group and joined back, so a large group is never
    held by one task as a window would. ``few_groups`` says that there are at most
    ``DAY_LIMIT`` groups, whose bounds are broadcast; left open, they are counted.
    """
    if few_groups is None:
        few_groups = fits(df.select(*keys).distinct(), DAY_LIMIT)
    bounds = df.groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    scaled = scale_between(F.col(value), F.col("_low"), F.col("_high"))
    bounds = F.broadcast(bounds) if few_groups else bounds
    return df.join(bounds, list(keys)).withColumn(name, scaled).drop("_low", "_high")


def submission_check(submission: DataFrame, template: DataFrame) -> DataFrame:
    """One row: do the columns match, and how many ids are missing, extra or repeated."""
    have = submission.groupBy("id").agg(F.count(F.lit(1)).alias("_have"))
    want = template.groupBy("id").agg(F.count(F.lit(1)).alias("_want"))
    count = lambda hit, rows, name: F.coalesce(F.sum(F.when(hit, rows)), F.lit(0)).cast("bigint").alias(name)
    return have.join(want, "id", "full").agg(
        F.lit(submission.columns == template.columns).alias("columns_match"),
        count(F.col("_have").isNull(), F.col("_want"), "missing_ids"),
        count(F.col("_want").isNull(), F.col("_have"), "extra_ids"),
        count(F.col("_have") > 1, F.lit(1), "repeated_ids"),
    )
