"""Models whose fit is an aggregate and whose forecast is a formula.

A fit turns ``history(state, ds, total)`` into one row of coefficients per state; nothing but
that row leaves the grouping. A forecast joins those rows to ``targets(state, ds)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.config import ARIMA, TREND
from tideline.functions.scalars import clip_negative, finite
from tideline.operators.features import series_window
from tideline.operators.split import TEST, TRAIN

KEY = "state"


def as_predictions(df: DataFrame, model: str, yhat: Column) -> DataFrame:
    return df.select(KEY, F.lit(model).alias("model"), "ds", yhat.alias("yhat"))


# -- last value and constants ------------------------------------------------------------------


def fit_last_value(history: DataFrame) -> DataFrame:
    """Last day and amount of each series, the amount floored at 0."""
    return history.groupBy(KEY).agg(
        F.max("ds").alias("last_ds"),
        clip_negative(F.max_by("total", "ds")).alias("last_total"),
    )


def predict_last_value(fit: DataFrame, targets: DataFrame, model: str = "LastValue") -> DataFrame:
    return as_predictions(targets.join(fit, KEY), model, finite(F.col("last_total")))


def last_value_in_place(split: DataFrame) -> DataFrame:
    """The held-out rows of a labelled table with the last training amount as ``yhat``.

    Held-out rows follow the training rows of their series, so the forecast is a training amount
    carried forward: no join, and the rows stay where the split put them.
    """
    known = F.when(F.col("split") == TRAIN, F.col("total"))
    yhat = clip_negative(F.last(known, ignorenulls=True).over(series_window()))
    return split.withColumn("yhat", yhat).filter(F.col("split") == TEST)


def predict_constant(targets: DataFrame, model: str, value: float = 0.0) -> DataFrame:
    """The same value everywhere, 0 for a model that failed."""
    return as_predictions(targets, model, F.lit(value))


def first_available(*yhats: Column) -> Column:
    """Fallback chain: the first forecast that is a finite number."""
    return F.coalesce(*[finite(yhat) for yhat in yhats])


# -- first-order autoregression ----------------------------------------------------------------


def fit_ar1(history: DataFrame) -> DataFrame:
    """Least-squares line of each amount on the one before, plus where the forecast starts."""
    return with_previous(history).groupBy(KEY).agg(*_line_aggregates())


def with_previous(history: DataFrame) -> DataFrame:
    return history.withColumn("previous", F.lag("total").over(series_window()))


def _line_aggregates() -> list[Column]:
    return [
        F.regr_slope("total", "previous").alias("phi"),
        F.regr_intercept("total", "previous").alias("intercept"),
        F.max("ds").alias("last_ds"),
        F.max_by("total", "ds").alias("last_total"),
    ]


def ar1_forecast(step: Column) -> Column:
    """``step`` days ahead: the distance to the mean shrinks by ``phi`` per day.

    NULL where the line has no mean to return to (``phi`` not below 1 in size).
    """
    phi = F.col("phi")
    mean = F.col("intercept") / (1 - phi)
    path = mean + F.pow(phi, step) * (F.col("last_total") - mean)
    return F.when(F.abs(phi) < 1, path)


def predict_ar1(fit: DataFrame, targets: DataFrame, model: str = ARIMA) -> DataFrame:
    """Multi-step forecast; a series without a usable line repeats its last amount."""
    return as_predictions(targets.join(fit, KEY), model, line_yhat())


def line_yhat() -> Column:
    step = F.datediff("ds", "last_ds")
    return clip_negative(first_available(ar1_forecast(step), F.col("last_total")))


# -- linear trend with weekday and month indices -------------------------------------------------

WEEKDAYS = range(7)
MONTHS = range(1, 13)


def trend_value(ds: Column) -> Column:
    """Trend line at a day, floored at 0; a series without a slope uses its mean."""
    line = F.col("slope") * F.datediff(ds, "first_ds") + F.col("level")
    return clip_negative(F.coalesce(line, F.col("mean_total")))


def fit_trend_season(history: DataFrame) -> DataFrame:
    """Trend line times weekday index times month index, one row per state.

    The line is fitted on amounts floored at 0. The weekday index is the mean ratio of amount to
    trend, the month index the mean ratio of amount to trend and weekday index; a weekday or
    month that never occurs, or never has a positive base, gets index 1. Each step needs the one
    before at every row; windows over the state carry it there without joining the rows to their
    own aggregates.
    """
    return _with_indices(history).groupBy(KEY).agg(*_trend_aggregates())


def _with_indices(history: DataFrame) -> DataFrame:
    """History with the trend and the index of its weekday and month at every row."""
    state = Window.partitionBy(KEY)
    y = F.greatest(F.col("total"), F.lit(0.0))
    rows = history.select(
        KEY,
        "ds",
        "total",
        y.alias("y"),
        F.min("ds").over(state).alias("first_ds"),
        F.weekday("ds").alias("weekday"),
        F.month("ds").alias("month"),
    ).withColumn("t", F.datediff("ds", "first_ds"))
    lined = rows.withColumns(
        {
            "slope": F.regr_slope("y", "t").over(state),
            "level": F.regr_intercept("y", "t").over(state),
            "mean_total": F.avg("y").over(state),
        }
    ).withColumn("base", trend_value(F.col("ds")))
    weekly = lined.withColumn("weekday_ratio", _mean_ratio("weekday")).withColumn(
        "base", F.col("base") * F.col("weekday_ratio")
    )
    return weekly.withColumn("month_ratio", _mean_ratio("month"))


def _trend_aggregates() -> list[Column]:
    return [
        *[F.first(c).alias(c) for c in ("first_ds", "slope", "level", "mean_total")],
        _index_array("weekday", WEEKDAYS),
        _index_array("month", MONTHS),
    ]


def _mean_ratio(factor: str) -> Column:
    ratio = F.when(F.col("base") > 0, F.col("y") / F.col("base"))
    return F.coalesce(F.avg(ratio).over(Window.partitionBy(KEY, factor)), F.lit(1.0))


def _index_array(factor: str, values: range) -> Column:
    ratio = F.col(f"{factor}_ratio")
    return F.array(
        *[F.coalesce(F.max(F.when(F.col(factor) == v, ratio)), F.lit(1.0)) for v in values]
    ).alias(f"{factor}_index")


def predict_trend_season(fit: DataFrame, targets: DataFrame, model: str = TREND) -> DataFrame:
    return as_predictions(targets.join(fit, KEY), model, season_yhat())


def season_yhat() -> Column:
    ds = F.col("ds")
    weekday = F.get("weekday_index", F.weekday(ds))
    month = F.get("month_index", F.month(ds) - 1)
    return clip_negative(trend_value(ds) * weekday * month)


# -- all of them in one pass -----------------------------------------------------------------------

LAST_VALUE = "LastValue"


def fit_closed_forms(history: DataFrame) -> DataFrame:
    """Coefficients of all models of this module, one row per state, from one shuffle."""
    rows = with_previous(_with_indices(history))
    return rows.groupBy(KEY).agg(*_line_aggregates(), *_trend_aggregates())


def predict_closed_forms(fit: DataFrame, targets: DataFrame,
                         models: Sequence[str] = (ARIMA, TREND, LAST_VALUE)) -> DataFrame:
    """Forecasts of several models from one join; the amount of a target row goes along as ``actual``."""
    yhats = {
        ARIMA: line_yhat(),
        TREND: season_yhat(),
        LAST_VALUE: finite(clip_negative(F.col("last_total"))),
    }
    columns = [KEY, "ds", *(["total"] if "total" in targets.columns else [])]
    each = F.array(*[F.struct(F.lit(m).alias("model"), yhats[m].alias("yhat")) for m in models])
    rows = targets.select(columns).join(fit, KEY).withColumn("each", F.explode(each))
    actual = [F.col("total").alias("actual")] if "total" in targets.columns else []
    return rows.select(KEY, "each.model", "ds", "each.yhat", *actual)
