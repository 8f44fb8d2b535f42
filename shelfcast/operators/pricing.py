"""Price features of a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.windows import series_window

PRICE_SHARE = 0.12
PROMO_BOUND = 0.02


def add_price_mean(df: DataFrame, share: float = PRICE_SHARE, price: str = "sell_price", scale: int = 2) -> DataFrame:
    """``roll_mean``: mean price over the last ``ceil(rows * share)`` rows of the series,
    the price itself where that many rows do not exist yet.

    A frame's width must be a constant, so the sum over the last k rows is taken from
    running sums: today's less the one k rows back. Ordered by row / k, the row k back
    lies exactly 1 before, and a frame around that point holds it alone. Running sums
    are whole units of 10^-scale, so they are exact.
    """
    w = series_window()
    whole = Window.partitionBy("id")
    units = F.round(F.col(price) * 10**scale).cast("bigint")
    sums = df.select(
        "*",
        F.row_number().over(w).alias("_row"),
        F.sum(units).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_sum"),
        F.ceil(F.count(F.lit(1)).over(whole) * F.lit(share)).alias("_k"),
    )
    back = F.expr(
        "max(_sum) over (partition by id order by _row / _k"
        " range between 1.0000001D preceding and 0.9999999D preceding)"
    )
    total = F.col("_sum") - F.coalesce(F.col("_back"), F.lit(0))
    mean = total / F.lit(10**scale) / F.col("_k")
    return (
        sums.withColumn("_back", back)
        .withColumn("roll_mean", F.when(F.col("_row") >= F.col("_k"), mean).otherwise(F.col(price)))
        .drop("_row", "_sum", "_k", "_back")
    )


def _deviation(price: str) -> Column:
    return F.try_divide(F.col(price) - F.col("roll_mean"), F.col("roll_mean"))


def add_promo_hike(df: DataFrame, price: str = "sell_price", bound: float = PROMO_BOUND) -> DataFrame:
    """Flags a price 2 % or more below (promo) or above (hike) its rolling mean."""
    off = _deviation(price)

    def flag(hit: Column) -> Column:
        return F.when(off.isNull(), None).when(hit, 1).otherwise(0)

    return df.withColumn("promo", flag(off <= -bound)).withColumn("hike", flag(off >= bound))


def add_price_changes(df: DataFrame, price: str = "sell_price") -> DataFrame:
    """Yesterday's price, the difference and the relative change from it."""
    before = F.lag(price, 1).over(series_window())
    return df.select(
        "*",
        before.alias("sell_price_Lag_1"),
        (F.col(price) - before).alias("sell_price_diff"),
        F.try_divide(before - F.col(price), F.col(price)).alias("sell_price_change"),
    )
