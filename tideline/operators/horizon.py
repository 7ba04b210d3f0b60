"""Future dates and the feature rows that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.config import FEATURES, HORIZON_DAYS, LAGS, ROLLING_FEATURES
from tideline.functions.calendar import with_calendar
from tideline.operators.features import (
    LONGEST_LOOK_BACK,
    fill_features,
    history_columns,
    rolling_columns,
    series_window,
)

KEY = "state"


def future_days(last_ds: Column, days: Column | int = HORIZON_DAYS) -> Column:
    """Array of the ``days`` days after ``last_ds``."""
    n = days if isinstance(days, Column) else F.lit(days)
    return F.sequence(F.date_add(last_ds, 1), F.date_add(last_ds, n))


def future_dates(last_rows: DataFrame, days: Column | int = HORIZON_DAYS) -> DataFrame:
    """One row per state and future day, with its step number from 1.

    ``last_rows`` has one row per state with ``last_ds``; its other columns are repeated.
    """
    return last_rows.withColumn("ds", F.explode(future_days(F.col("last_ds"), days))).withColumn(
        "step", F.datediff("ds", "last_ds")
    )


def last_days(dense: DataFrame) -> DataFrame:
    """Last day of each series."""
    return dense.groupBy(KEY).agg(F.max("ds").alias("last_ds"))


def last_rows(dense: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of each series; ``from_end`` counts from 1 at the last row."""
    from_end = F.row_number().over(series_window(F.desc("ds")))
    return dense.withColumn("from_end", from_end).filter(F.col("from_end") <= n)


def last_known(dense: DataFrame) -> DataFrame:
    """One row per series: the lag and rolling values a future row starts from.

    ``lag_k`` is the k-th last amount, or the last amount where the series is shorter. All of it
    is read off the last row in a single window pass.
    """
    window = series_window()
    lags = {
        f"lag_{k}": F.coalesce(F.lag("total", k - 1).over(window), F.col("total")) for k in LAGS
    }
    columns = lags | rolling_columns(window) | {"later_ds": F.lead("ds").over(window)}
    return (
        dense.withColumns(columns)
        .filter(F.col("later_ds").isNull())
        .select(
            KEY,
            F.col("ds").alias("last_ds"),
            F.col("total").alias("last_total"),
            "category",
            *lags,
            *ROLLING_FEATURES,
        )
    )


def frozen_future(dense: DataFrame, days: Column | int = HORIZON_DAYS) -> DataFrame:
    """Future feature rows whose lags and rolling values stay at the last known ones."""
    future = with_calendar(future_dates(last_known(dense), days))
    return future.select("ds", KEY, "category", "step", *FEATURES)


def frozen_over(history: DataFrame, targets: DataFrame) -> DataFrame:
    """Feature rows of given later days whose lags and rolling values stay at the last known ones.

    Nothing of the targets but their days is used, so held-out days can be scored as a forecast.
    """
    known = last_known(history)
    return with_calendar(targets.select(KEY, "ds").join(known, KEY)).select("ds", KEY, "category", *FEATURES)


def future_rows(dense: DataFrame, days: Column | int = HORIZON_DAYS) -> DataFrame:
    """Future days without amounts, in the base columns, ready to be appended."""
    ends = dense.groupBy(KEY).agg(
        F.max("ds").alias("last_ds"), F.max_by("category", "ds").alias("category")
    )
    return future_dates(ends, days).select(
        KEY, "ds", F.lit(None).cast("double").alias("total"), "category"
    )


def appended_future(dense: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """Future feature rows computed on history plus empty future rows.

    A value that can no longer be computed keeps the last one that could, else 0. Instead of a
    union the last row of each series is unfolded into itself and its future days, which keeps
    partitioning and order; only the rows a future window can still see are carried along.
    """
    window = series_window()
    recent = dense.withColumns(
        {
            "later_ds": F.lead("ds").over(window),
            "far_ds": F.lead("ds", LONGEST_LOOK_BACK).over(window),
        }
    ).filter(F.col("far_ds").isNull())
    own_day = F.array("ds")
    all_days = F.concat(own_day, future_days(F.col("ds"), days))
    unfolded = recent.withColumn(
        "day", F.explode(F.when(F.col("later_ds").isNull(), all_days).otherwise(own_day))
    ).select(
        KEY,
        F.col("day").alias("ds"),
        F.when(F.col("day") == F.col("ds"), F.col("total")).alias("total"),
        "category",
        (F.col("day") > F.col("ds")).alias("is_future"),
    )
    history = history_columns(window)
    future = unfolded.withColumns(history).filter("is_future")
    return fill_features(with_calendar(future), list(history)).select(
        "ds", KEY, "category", *FEATURES
    )


def append_rows(history: DataFrame, future: DataFrame) -> DataFrame:
    """History followed by future rows; columns the future lacks become NULL."""
    return history.unionByName(future, allowMissingColumns=True)


def conform_to_base(df: DataFrame, history: DataFrame) -> DataFrame:
    """Give ``df`` the base columns, taking absent or empty ones from the series' history.

    An absent amount is NULL; an absent category is the first one of the series.
    """
    first = history.groupBy(KEY).agg(F.min_by("category", "ds").alias("first_category"))
    present = df
    for name, kind in (("total", "double"), ("category", "string")):
        if name not in df.columns:
            present = present.withColumn(name, F.lit(None).cast(kind))
    return present.join(first, KEY, "left").select(
        "ds", KEY, "total", F.coalesce("category", "first_category").alias("category")
    )
