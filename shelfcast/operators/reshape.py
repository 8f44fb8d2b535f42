"""Column choice, wide-to-long, long-to-wide and one-hot reshapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import EVENT_COLS, HORIZON, LABEL
from shelfcast.functions.text import clean_event
from shelfcast.session import fits


# -- choosing columns -------------------------------------------------------
def columns_like(df: DataFrame, include: Sequence[str] = ("",), exclude: Sequence[str] = ()) -> list[str]:
    """Columns whose name contains any of ``include`` and none of ``exclude``, ignoring case."""

    def has(name: str, words: Sequence[str]) -> bool:
        return any(word.lower() in name.lower() for word in words)

    return [c for c in df.columns if has(c, include) and not has(c, exclude)]


def columns_between(df: DataFrame, first: str, last: str) -> list[str]:
    """Columns from ``first`` to ``last`` in table order, both included."""
    names = df.columns
    return names[names.index(first) : names.index(last) + 1]


def columns_shared(df: DataFrame, other: DataFrame) -> list[str]:
    """Columns of ``df`` that ``other`` has too, in the order of ``other``."""
    return [c for c in other.columns if c in df.columns]


def label_first(df: DataFrame, label: str = LABEL, drop: Sequence[str] = ("date", "id", "store_item")) -> DataFrame:
    """The trainer's layout: label in the first column, keys gone."""
    return df.select(label, *[c for c in df.columns if c != label and c not in drop])


# -- wide to long -----------------------------------------------------------
def unpivot_sales(wide: DataFrame, ids: Sequence[str], days: Sequence[str] | None = None) -> DataFrame:
    """Day columns to rows (ids, d, Value), missing values kept; pass only the days needed.

    A sales matrix has thousands of day columns. One array of them is exploded, where
    ``unpivot`` would plan one projection of the whole row per column.
    """
    days = list(days) if days is not None else [c for c in wide.columns if c.startswith("d_")]
    names = F.array(*[F.lit(c) for c in days])
    rows = wide.select(*ids, F.posexplode(F.array(*[F.col(c) for c in days])).alias("_at", LABEL))
    return rows.select(*ids, F.get(names, F.col("_at")).alias("d"), LABEL)


def unpivot_events(calendar: DataFrame, drop_missing: bool = False, events: Sequence[str] = EVENT_COLS) -> DataFrame:
    """Event columns to rows (date, key, event)."""
    long = calendar.unpivot(["date"], list(events), "key", "event")
    return long.na.drop(subset=["event"]) if drop_missing else long


def unpivot_forecast(wide: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """F1..Fn to rows (id, key, value)."""
    return wide.unpivot(["id"], [f"F{h}" for h in range(1, horizon + 1)], "key", "value")


# -- long to wide -----------------------------------------------------------
def pivot_days(long: DataFrame, ids: Sequence[str], days: Sequence[str]) -> DataFrame:
    """Day rows to one column per named day."""
    return long.groupBy(*ids).pivot("d", list(days)).agg(F.first(LABEL))


def pivot_forecast(long: DataFrame, h: str = "h", value: str = "pred", horizon: int = HORIZON) -> DataFrame:
    """(id, horizon number, value) to id, F1..Fn in numeric order."""
    steps = list(range(1, horizon + 1))
    wide = long.groupBy("id").pivot(h, steps).agg(F.first(value))
    return wide.select("id", *[F.col(str(s)).alias(f"F{s}") for s in steps])


def _flags(long: DataFrame, column: str, vocabulary: Sequence[str]) -> DataFrame:
    wide = long.groupBy("date").pivot(column, list(vocabulary)).agg(F.max(F.lit(1)))
    return wide.fillna(0, subset=list(vocabulary))


def event_vocabulary(calendar: DataFrame, drop_missing: bool = True, limit: int = 10_000) -> list[str]:
    """Cleaned event names of a calendar, sorted: the fixed list of one-hot columns."""
    names = unpivot_events(calendar, drop_missing).select(clean_event(F.col("event")).alias("event")).distinct()
    if not fits(names, limit):
        raise ValueError(f"more than {limit} event names cannot become columns")
    return sorted(row.event for row in names.collect())


def one_hot_events(calendar: DataFrame, vocabulary: Sequence[str], drop_missing: bool = True) -> DataFrame:
    """0/1 column per event of the vocabulary.

    With ``drop_missing`` only event days have a row; without, every day has one and
    the vocabulary may name ``event_NA``.
    """
    events = unpivot_events(calendar, drop_missing).select("date", clean_event(F.col("event")).alias("event"))
    return _flags(events.distinct(), "event", vocabulary)


def one_hot_races(races: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """0/1 column per race name from (event, date) rows; repeated rows count once."""
    return _flags(races.select("date", "event").distinct(), "event", vocabulary)


def one_hot(column: Column | str, vocabulary: Sequence, prefix: str) -> list[Column]:
    """One 0/1 column per value, no value left out."""
    col = F.col(column) if isinstance(column, str) else column
    return [F.when(col == v, 1).otherwise(0).alias(f"{prefix}_{v}") for v in vocabulary]


def state_flags(calendar: DataFrame, prefix: str, name: str) -> DataFrame:
    """State-suffixed flag columns to rows (date, state_id, flag)."""
    columns = [c for c in calendar.columns if c.startswith(prefix + "_")]
    long = calendar.unpivot(["date"], columns, "state_id", name)
    return long.withColumn("state_id", F.expr(f"substring(state_id, {len(prefix) + 2})"))
