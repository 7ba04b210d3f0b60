"""Min-max scaling per series, with the statistics of the training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "state"


def scaler_stats(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<column>_min`` and ``<column>_range`` per state; a constant column gets range 1."""
    lows = [F.min(c).cast("double").alias(f"{c}_min") for c in columns]
    spreads = []
    for c in columns:
        spread = (F.max(c) - F.min(c)).cast("double")
        spreads.append(F.when(spread == 0, 1.0).otherwise(spread).alias(f"{c}_range"))
    return train.groupBy(KEY).agg(*lows, *spreads)


def scaled(column: str) -> Column:
    """Value in units of the training range; rows outside that range are not clipped."""
    return (F.col(column) - F.col(f"{column}_min")) / F.col(f"{column}_range")


def unscaled(value: Column, column: str) -> Column:
    return value * F.col(f"{column}_range") + F.col(f"{column}_min")


def min_max_scale(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace the columns by their scaled values; states without statistics drop out."""
    statistics = [f"{c}_{part}" for c in columns for part in ("min", "range")]
    return df.join(stats, KEY).withColumns({c: scaled(c) for c in columns}).drop(*statistics)
