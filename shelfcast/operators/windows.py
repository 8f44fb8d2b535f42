"""Lag, lead and rolling features of a series.

(id, date) is a key, so one window partition holds at most one row per day of the
calendar. All features of a call share one partitioning and one sort. A lag of a
rolling statistic is written as a frame further back, which gives the same rows
without a second window pass.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.columns import HORIZON, LABEL
from shelfcast.functions.dates import shift_to_horizon

LAGS = (7, 28, 60)
WINDOWS = (7, 28, 60)
ROLL_WINDOWS = (28, 7, 14)
# Days each slope is pushed back in the training table.
SLOPE_SHIFT = {28: 28, 14: 14, 7: 7}


def series_window(keys: Sequence[str] = ("id",), order: str = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def _complete(stat: Column, value: Column, frame: WindowSpec, n: int) -> Column:
    """A frame statistic, only where all ``n`` rows exist and have a value."""
    return F.when(F.count(value).over(frame) == n, stat.over(frame))


def with_running(df: DataFrame, value: str = LABEL, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Running count, sum, sum of squares and sum of value times row position.

    A statistic of the last n rows is a difference of two of these, whatever n is, where a
    sliding frame adds up n values for each row. Whole numbers stay exact; other values
    lose what a running double sum loses.
    """
    w = series_window(keys)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = isinstance(df.schema[value].dataType, T.IntegralType)
    v = F.col(value).cast("bigint" if whole else "double")
    total = lambda c, name: F.coalesce(F.sum(c).over(run), F.lit(0)).alias(name)
    return df.withColumn("_row", F.row_number().over(w)).select(
        "*", F.count(value).over(run).alias("_n"), total(v, "_s"), total(v * v, "_q"), total(v * F.col("_row"), "_x")
    )


RUNNING = ["_row", "_n", "_s", "_q", "_x"]


def _last(total: str, n: int, shift: int, keys: Sequence[str]) -> Column:
    """Sum over the ``n`` rows that end ``shift`` rows back, from its running total."""
    w = series_window(keys)
    return F.lag(total, shift, 0).over(w) - F.lag(total, shift + n, 0).over(w)


def lag_columns(value: str = LABEL, lags: Sequence[int] = LAGS) -> list[Column]:
    w = series_window()
    return [F.lag(value, k).over(w).alias(f"lag_{k}") for k in lags]


def rolling_mean_of_lag_columns(lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS) -> list[Column]:
    """``rmean_{lag}_{window}``: mean of the lagged values, missing ones ignored, from
    the ``window``-th row of the series on. Needs the running totals."""
    mean = lambda k, n: F.try_divide(_last("_s", n, k, ("id",)), _last("_n", n, k, ("id",)))
    return [F.when(F.col("_row") >= n, mean(k, n)).alias(f"rmean_{k}_{n}") for k in lags for n in windows]


def add_lags(df: DataFrame, value: str = LABEL, lags: Sequence[int] = LAGS) -> DataFrame:
    return df.select("*", *lag_columns(value, lags))


def add_rolling_mean_of_lags(
    df: DataFrame, value: str = LABEL, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    return with_running(df, value).select("*", *rolling_mean_of_lag_columns(lags, windows)).drop(*RUNNING)


def add_lag_features(df: DataFrame, value: str = LABEL) -> DataFrame:
    """Lags and rolling means of lags in one window pass."""
    return with_running(df, value).select("*", *lag_columns(value), *rolling_mean_of_lag_columns()).drop(*RUNNING)


def rolling_mean(n: int, shift: int = 0, keys: Sequence[str] = ("id",)) -> Column:
    """Mean of ``n`` complete rows. This and the two below need the running totals."""
    return F.when(_last("_n", n, shift, keys) == n, _last("_s", n, shift, keys) / n)


def rolling_sd(n: int, shift: int = 0, keys: Sequence[str] = ("id",)) -> Column:
    """Sample standard deviation; sums of whole numbers are compared as such while they fit."""
    squares, total = _last("_q", n, shift, keys), _last("_s", n, shift, keys)
    exact = F.try_subtract(F.try_multiply(F.lit(n), squares), F.try_multiply(total, total)).cast("double")
    spread = F.coalesce(exact, n * squares.cast("double") - total.cast("double") * total)
    return F.when(_last("_n", n, shift, keys) == n, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n * (n - 1))))


def rolling_slope(n: int, shift: int = 0, keys: Sequence[str] = ("id",)) -> Column:
    """Least-squares slope of the value on its row position."""
    middle = 2 * (F.col("_row") - shift) - (n - 1)
    tilt = 2 * _last("_x", n, shift, keys) - middle * _last("_s", n, shift, keys)
    return F.when(_last("_n", n, shift, keys) == n, 6 * tilt / (n * (n * n - 1)))


def add_rolling_stats(df: DataFrame, windows: Sequence[int] = ROLL_WINDOWS) -> DataFrame:
    """Right-aligned mean, sample sd and slope over complete windows."""
    columns = [rolling_mean(n).alias(f"Roll_Mean_{n}") for n in windows]
    columns += [rolling_sd(n).alias(f"Roll_Sd_{n}") for n in windows]
    columns += [rolling_slope(n).alias(f"Roll_Lm_{n}") for n in windows]
    return with_running(df).select("*", *columns).drop(*RUNNING)


def add_shifted_stats(
    df: DataFrame, windows: Sequence[int] = ROLL_WINDOWS, shift: int = HORIZON, consistent: bool = False, slopes: bool = True
) -> DataFrame:
    """Rolling statistics as known ``shift`` days earlier.

    Slopes are pushed back by ``SLOPE_SHIFT``; ``consistent`` pushes them back by
    ``shift`` like the rest, as serving needs.
    """
    columns = [rolling_mean(n, shift).alias(f"Roll_Mean_{n}_Shift") for n in windows]
    columns += [rolling_sd(n, shift).alias(f"Roll_Sd_{n}_Shift") for n in windows]
    if slopes:
        columns += [
            rolling_slope(n, shift if consistent else SLOPE_SHIFT.get(n, shift)).alias(f"Roll_Lm_{n}_Shift")
            for n in windows
        ]
    return with_running(df).select("*", *columns).drop(*RUNNING)


def _centred(n: int, shift: int, keys: Sequence[str], value: str) -> list[Column]:
    """Centred mean and sd; an even width reaches one row further ahead than back."""
    back = (n - 1) // 2
    w = Window.partitionBy(*keys).orderBy("date") if keys else Window.orderBy("date")
    frame = w.rowsBetween(-back - shift, n - 1 - back - shift)
    return [
        _complete(F.stddev_samp(value), F.col(value), frame, n).alias(f"roll_sd_{n}"),
        _complete(F.avg(value), F.col(value), frame, n).alias(f"roll_mean_{n}"),
    ]


def add_centred_shifted(
    df: DataFrame, keys: Sequence[str] = (), n: int = HORIZON, shift: int = HORIZON, value: str = LABEL
) -> DataFrame:
    """Centred mean and sd, then pushed back ``shift`` rows; incomplete rows are dropped."""
    return df.select("*", *_centred(n, shift, keys, value)).na.drop()


def centred_for_horizon(
    df: DataFrame, cutoff: dt.date, keys: Sequence[str] = (), n: int = HORIZON, value: str = LABEL
) -> DataFrame:
    """Serving form: centred statistics of the last days moved onto the horizon.

    Days whose centred window reaches past the data have none; they become 0.
    """
    recent = df.filter(F.col("date").between(F.date_sub(F.lit(cutoff), 59), F.date_sub(F.lit(cutoff), 1)))
    stats = recent.select(*keys, "date", value, *_centred(n, 0, keys, value))
    last = stats.filter(F.col("date") >= F.date_sub(F.lit(cutoff), HORIZON))
    return last.withColumn("date", shift_to_horizon(F.col("date"))).fillna(0)


def tail_per_series(df: DataFrame, n: int = 60, keys: Sequence[str] = ("id",)) -> DataFrame:
    """The last ``n`` rows of each series."""
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("date").desc()))
    return df.withColumn("_newest", newest).filter(F.col("_newest") <= n).drop("_newest")


def stats_for_horizon(history: DataFrame, n: int = 60, windows: Sequence[int] = ROLL_WINDOWS, slopes: bool = True) -> DataFrame:
    """Rolling statistics of the last ``n`` known rows, moved 28 days onto the horizon."""
    tail = with_running(tail_per_series(history.select("id", "date", LABEL), n))
    columns = [rolling_mean(k).alias(f"Roll_Mean_{k}_Shift") for k in windows]
    columns += [rolling_sd(k).alias(f"Roll_Sd_{k}_Shift") for k in windows]
    if slopes:
        columns += [rolling_slope(k).alias(f"Roll_Lm_{k}_Shift") for k in windows]
    stats = tail.select("id", "date", *columns).na.drop()
    return stats.withColumn("date", shift_to_horizon(F.col("date")))


def horizon_index(df: DataFrame, name: str = "h", keys: Sequence[str] = ("id",)) -> DataFrame:
    """Position 1, 2, ... of each row of a series, by date."""
    return df.withColumn(name, F.row_number().over(series_window(keys)))


def locf(value: str, keys: Sequence[str] = ("id",)) -> Column:
    """Last observation carried forward."""
    return F.last(value, ignorenulls=True).over(series_window(keys).rowsBetween(Window.unboundedPreceding, 0))


def lead_days(days: DataFrame, columns: Sequence[str], steps: Sequence[int]) -> DataFrame:
    """``<name>_Lead_<k>`` for each column: the value ``k`` rows ahead on the calendar.

    The frame is keyed by day, so the single window partition is calendar-sized.
    """
    w = Window.orderBy("date")
    return days.select("*", *[F.lead(c, k).over(w).alias(f"{c}_Lead_{k}") for k in steps for c in columns])


def lag_days(days: DataFrame, columns: Sequence[str], steps: Sequence[int] = (1,)) -> DataFrame:
    """``<name>_Lag_<k>`` for each column: the value ``k`` rows back on the calendar."""
    w = Window.orderBy("date")
    return days.select("*", *[F.lag(c, k).over(w).alias(f"{c}_Lag_{k}") for k in steps for c in columns])
