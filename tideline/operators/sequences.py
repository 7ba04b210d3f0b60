"""Look-back sequences and differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.config import LOOKBACK, SEASON
from tideline.operators.features import series_window

KEY = "state"


def lookback_sequences(df: DataFrame, steps: Column, length: int = LOOKBACK,
                       name: str = "sequence") -> DataFrame:
    """The ``length`` rows before each row as an array; rows with a shorter past drop out.

    ``steps`` is the per-row element: an amount, or an array of scaled features. The frame is
    bounded, so an array never holds more than ``length`` elements.
    """
    frame = series_window().rowsBetween(-length, -1)
    return df.withColumn(name, F.collect_list(steps).over(frame)).filter(F.size(name) == length)


def last_sequence(df: DataFrame, steps: Column, length: int = LOOKBACK,
                  name: str = "sequence") -> DataFrame:
    """One row per series: its final ``length`` elements (fewer if the series is shorter)."""
    window = series_window()
    return (
        df.withColumns(
            {
                name: F.collect_list(steps).over(window.rowsBetween(1 - length, 0)),
                "later_ds": F.lead("ds").over(window),
            }
        )
        .filter(F.col("later_ds").isNull())
        .select(KEY, F.col("ds").alias("last_ds"), name)
    )


def held_sequence(sequence: Column, step: Column, length: int = LOOKBACK) -> Column:
    """Input of forecast step ``step`` (1-based) when future rows repeat the last known row.

    A past shorter than ``length`` is extended on the left with copies of the last row.
    """
    last = F.element_at(sequence, -1)
    full = F.concat(F.array_repeat(last, length), sequence, F.array_repeat(last, length))
    known_end = F.size(sequence) + length
    shift = F.least(step - 1, F.lit(length))
    return F.slice(full, known_end - length + 1 + shift, F.lit(length))


def seasonal_difference(df: DataFrame, season: int = SEASON, name: str = "diff") -> DataFrame:
    """First difference of the seasonal difference; NULL on the first ``season + 1`` rows."""
    window = series_window()
    before = lambda k: F.lag("total", k).over(window)
    return df.withColumn(name, (F.col("total") - before(1)) - (before(season) - before(season + 1)))
