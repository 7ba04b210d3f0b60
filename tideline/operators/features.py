"""The 22 model features of a dense series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tideline.config import FEATURES, LAGS, ROLLING_WINDOWS
from tideline.functions.calendar import with_calendar
from tideline.operators.ordering import number_rows, over_chunks

KEY = "state"
LONGEST_LOOK_BACK = max(*LAGS, *ROLLING_WINDOWS)


def series_window(order: str | Column = "ds") -> WindowSpec:
    return Window.partitionBy(KEY).orderBy(order)


def lag_columns(window: WindowSpec, lags: Sequence[int] = LAGS) -> dict[str, Column]:
    """Amounts ``k`` rows earlier."""
    return {f"lag_{k}": F.lag("total", k).over(window) for k in lags}


def rolling_columns(window: WindowSpec, windows: Sequence[int] = ROLLING_WINDOWS,
                    include_current: bool = True) -> dict[str, Column]:
    """Mean, sample deviation, minimum and maximum of the last rows.

    The frame ends at the current row; with ``include_current=False`` it ends one row earlier,
    which keeps a row's own amount out of its features. NULL amounts are skipped; the deviation
    of fewer than two amounts is 0.
    """
    columns = {}
    for size in windows:
        frame = window.rowsBetween(1 - size, 0) if include_current else window.rowsBetween(-size, -1)
        columns[f"rolling_mean_{size}"] = F.avg("total").over(frame)
        columns[f"rolling_std_{size}"] = F.coalesce(
            F.stddev_samp("total").over(frame), F.lit(0.0)
        )
        columns[f"rolling_min_{size}"] = F.min("total").over(frame)
        columns[f"rolling_max_{size}"] = F.max("total").over(frame)
    return columns


def history_columns(window: WindowSpec, include_current: bool = True) -> dict[str, Column]:
    """All lags and rolling statistics: one partitioning, one order, hence one window pass."""
    return lag_columns(window) | rolling_columns(window, include_current=include_current)


def with_features(dense: DataFrame, include_current: bool = True) -> DataFrame:
    """Calendar, lag and rolling features of a table with one row per state and day."""
    columns = history_columns(series_window(), include_current)
    return with_calendar(dense.withColumns(columns)).select("ds", KEY, "total", "category", *FEATURES)


def with_features_keeping_rows(rows: DataFrame, include_current: bool = True) -> DataFrame:
    """The same features for tables with several rows per state and day, of any length."""
    numbered = number_rows(rows)
    featured = over_chunks(
        numbered, LONGEST_LOOK_BACK, lambda window: history_columns(window, include_current)
    )
    return with_calendar(featured).select(
        "ds", KEY, "total", "category", *FEATURES, "rn", "n_rows"
    )


def missing_features(df: DataFrame, features: Sequence[str] = FEATURES) -> list[str]:
    return [name for name in features if name not in df.columns]


def ensure_features(df: DataFrame) -> DataFrame:
    """``df`` itself when it has every feature, else with the features computed."""
    return with_features(df) if missing_features(df) else df


def complete_rows(features: DataFrame, with_total: bool = False) -> DataFrame:
    """Rows without a missing feature (the first 30 of each series have one)."""
    required = [*FEATURES, "total"] if with_total else list(FEATURES)
    return features.dropna(subset=required)


def fill_features(features: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Carry missing feature values forward within the series, 0 where nothing precedes."""
    window = series_window()
    return features.withColumns(
        {c: F.coalesce(F.last(c, ignorenulls=True).over(window), F.lit(0)) for c in columns}
    )
