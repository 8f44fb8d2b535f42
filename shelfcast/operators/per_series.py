"""A user's own function over each series."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame


def apply_per_series(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, key: str = "id") -> DataFrame:
    """Run ``fn`` on the rows of each series, at most one row per calendar day, in date order."""

    def ordered(rows: pd.DataFrame) -> pd.DataFrame:
        return fn(rows.sort_values("date"))

    return df.groupBy(key).applyInPandas(ordered, schema)
