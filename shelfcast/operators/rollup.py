"""Hierarchy roll-ups, series statistics and distinct lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import LABEL

# Levels of the hierarchy and the keys that name their series.
LEVELS: Mapping[str, Sequence[str]] = {
    "total": [],
    "state": ["state_id"],
    "store": ["store_id"],
    "cat": ["cat_id"],
    "dept": ["dept_id"],
    "store_dept": ["store_id", "dept_id"],
}


def sum_by(sales: DataFrame, keys: Sequence[str], value: str = LABEL) -> DataFrame:
    """Daily sum over the named keys; partial sums are taken before the shuffle."""
    return sales.groupBy("date", *keys).agg(F.sum(value).alias(value))


def sum_all_levels(sales: DataFrame, levels: Mapping[str, Sequence[str]] = LEVELS, value: str = LABEL) -> DataFrame:
    """All levels in one pass, tagged ``level``.

    The fact is first rolled up to the finest grain any level needs, so the grouping
    sets multiply that small result and not the fact.
    """
    keys = sorted({k for cols in levels.values() for k in cols})
    base = sum_by(sales, keys, value)
    sets = [[F.col("date"), *[F.col(k) for k in cols]] for cols in levels.values()]
    # A grouping id has one bit per absent column, the first column highest.
    ids = {
        name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in cols)
        for name, cols in levels.items()
    }
    level = F.lit(None).cast("string")
    for name, number in ids.items():
        level = F.when(F.col("_gid") == number, name).otherwise(level)
    rolled = base.groupingSets(sets, "date", *keys).agg(F.sum(value).alias(value), F.grouping_id().alias("_gid"))
    return rolled.select(level.alias("level"), "date", *keys, value)


def series_stats(sales: DataFrame, key: str = "id", value: str = LABEL) -> DataFrame:
    return sales.groupBy(key).agg(
        F.min(value).alias("min_v"), F.max(value).alias("max_v"), F.avg(value).alias("mean_v")
    )


def top_series(stats: DataFrame, k: int = 5, key: str = "id", by: str = "mean_v") -> DataFrame:
    """The ``k`` series with the highest mean, ties by key."""
    return stats.orderBy(F.col(by).desc(), F.col(key)).limit(k)


def sum_by_horizon(forecast: DataFrame) -> DataFrame:
    """Bottom-up total per horizon label from (id, key, value)."""
    return forecast.groupBy("key").agg(F.sum("value").alias("bu"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def date_coverage(df: DataFrame, parts: Mapping[str, Column]) -> DataFrame:
    """First and last date and row count of each part of a table, in one pass."""
    date = F.col("date")
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.min(F.when(inside, date)).alias("first_date"),
            F.max(F.when(inside, date)).alias("last_date"),
            F.count(F.when(inside, date)).alias("n_rows"),
        )
        for name, inside in parts.items()
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
