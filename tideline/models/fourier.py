"""Piecewise-linear trend with yearly and weekly Fourier terms (Taylor and Letham, 2018).

A ridge regression per state on 54 columns. The columns follow from the date alone, so tasks
build them in numpy and send only cross products on; these are summed by Spark and solved one
small system per state. ``multiplicative`` seasonality regresses ``amount / trend - 1``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.config import SEASONALITY_MODES, TREND, YEARLY_OPTIONS
from tideline.functions.linear import DOUBLE, DOUBLES, solve_subset, summed_grams, unpack
from tideline.functions.scalars import clip_negative
from tideline.models.closed_form import as_predictions, first_available, fit_last_value

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = "state"
# Published defaults of the decomposition: 25 possible bends in the first 80 % of the history,
# yearly order 10, weekly order 3.
BENDS = 25
BEND_SHARE = 0.8
YEARLY_ORDER = 10
WEEKLY_ORDER = 3
YEAR, WEEK = 365.25, 7.0
BEND_PENALTY = 1.0
SEASON_PENALTY = 0.01
BASE_PENALTY = 1e-6

N_TREND = 2 + BENDS
N_YEARLY = 2 * YEARLY_ORDER
N_WEEKLY = 2 * WEEKLY_ORDER
N_COLUMNS = N_TREND + N_YEARLY + N_WEEKLY
PENALTY = np.array(
    [BASE_PENALTY] * 2 + [BEND_PENALTY] * BENDS + [SEASON_PENALTY] * (N_YEARLY + N_WEEKLY)
)


def design(t: np.ndarray, day: np.ndarray) -> np.ndarray:
    """Regressors of rows at relative time ``t`` (0..1 within the history) and day number."""
    bends = np.linspace(0, BEND_SHARE, BENDS + 1)[1:]
    waves = []
    for period, order in ((YEAR, YEARLY_ORDER), (WEEK, WEEKLY_ORDER)):
        angle = 2 * np.pi * np.outer(day / period, np.arange(1, order + 1))
        waves += [np.sin(angle), np.cos(angle)]
    hinges = np.maximum(t[:, None] - bends[None, :], 0)
    return np.hstack([np.ones((len(t), 1)), t[:, None], hinges, *waves])


def kept_columns(yearly: bool, trend: bool = True) -> list[int]:
    yearly_columns = range(N_TREND, N_TREND + N_YEARLY)
    return [
        *(range(N_TREND) if trend else ()),
        *(yearly_columns if yearly else ()),
        *range(N_TREND + N_YEARLY, N_COLUMNS),
    ]


def with_clock(df: DataFrame) -> DataFrame:
    """Add the numeric inputs of ``design``; needs ``first_ds`` and ``last_ds``."""
    span = F.greatest(F.datediff("last_ds", "first_ds"), F.lit(1))
    return df.withColumns(
        {
            "t": F.datediff("ds", "first_ds") / span,
            "day": F.unix_date("ds").cast("double"),
        }
    )


def scaled_history(history: DataFrame) -> DataFrame:
    """History with its bounds, its amounts floored at 0 and divided by the largest one."""
    state = Window.partitionBy(KEY)
    y = F.greatest(F.col("total"), F.lit(0.0))
    unit = F.max(y).over(state)
    bounded = history.select(
        KEY,
        "ds",
        F.min("ds").over(state).alias("first_ds"),
        F.max("ds").over(state).alias("last_ds"),
        F.when(unit > 0, unit).otherwise(1.0).alias("unit"),
        y.alias("y"),
    )
    return with_clock(bounded).withColumn("y", F.col("y") / F.col("unit"))


def cross_products(rows: DataFrame, target: str = "y") -> DataFrame:
    """Cross products of design and target per state, as one array."""
    return summed_grams(rows, [KEY], ["t", "day", target], design_and(target), N_COLUMNS + 1)


def design_and(target: str) -> Callable[[pd.DataFrame], np.ndarray]:
    """Function from rows to their design columns and the target."""

    def build(batch: pd.DataFrame) -> np.ndarray:
        columns = design(batch["t"].to_numpy(), batch["day"].to_numpy())
        return np.column_stack([columns, batch[target].to_numpy()])

    return build


def solver(yearly: bool, trend: bool):
    """Pandas UDF: weights of all design columns, 0 for those left out."""
    keep = kept_columns(yearly, trend)

    @F.pandas_udf(DOUBLES)
    def solve(grams: pd.Series) -> pd.Series:
        weights = np.zeros((len(grams), N_COLUMNS))
        weights[:, keep] = solve_subset(unpack(grams, N_COLUMNS + 1), keep, PENALTY[keep])
        return pd.Series(list(weights))

    return solve


@F.pandas_udf(DOUBLE)
def trend_part(t: pd.Series, weights: pd.Series) -> pd.Series:
    columns = design(t.to_numpy(), np.zeros(len(t)))[:, :N_TREND]
    return pd.Series(np.einsum("nk,nk->n", columns, np.stack(weights)))


@F.pandas_udf(DOUBLE)
def season_part(day: pd.Series, weights: pd.Series) -> pd.Series:
    columns = design(np.zeros(len(day)), day.to_numpy())[:, N_TREND:]
    return pd.Series(np.einsum("nk,nk->n", columns, np.stack(weights)))


def fit_fourier(history: DataFrame, modes: Sequence[str] = ("multiplicative",),
                yearly_options: Sequence[bool] = (True,)) -> DataFrame:
    """Weights per state for every combination of mode and yearly seasonality.

    The yearly options share one pass over the data; the multiplicative mode adds one more, on
    the ratio of amount to fitted trend.
    """
    rows = scaled_history(history)
    bounds = rows.groupBy(KEY).agg(
        *[F.max(c).alias(c) for c in ("first_ds", "last_ds", "unit")],
        F.max_by("y", "ds").alias("last_y"),
    )
    sums = cross_products(rows)
    fits = None
    for yearly in yearly_options:
        solved = sums.select(KEY, solver(yearly, trend=True)("gram").alias("weights"))
        additive = solved.select(KEY, *weight_parts())
        for mode in modes:
            if mode == "additive":
                fit = additive
            else:
                trend = additive.select(KEY, "trend")
                base = rows.join(trend, KEY).withColumn("base", trend_part("t", "trend"))
                ratios = base.filter(F.col("base") > 0).withColumn(
                    "ratio", F.col("y") / F.col("base") - 1
                )
                seasonal = cross_products(ratios, "ratio").select(
                    KEY, solver(yearly, trend=False)("gram").alias("weights")
                )
                # Without a positive trend there is no ratio: a season of no numbers, no curve.
                none = F.array_repeat(F.lit(float("nan")), N_YEARLY + N_WEEKLY)
                fit = additive.drop("season").join(
                    seasonal.select(KEY, weight_parts()[1]), KEY, "left"
                ).withColumn("season", F.coalesce("season", none))
            fit = fit.withColumns({"mode": F.lit(mode), "yearly": F.lit(yearly)})
            fits = fit if fits is None else fits.unionByName(fit)
    return fits.join(bounds, KEY).join(fit_last_value(history).select(KEY, "last_total"), KEY)


def weight_parts() -> list[Column]:
    """Weights of the trend and of the seasonal columns, as two arrays."""
    return [
        F.slice("weights", 1, N_TREND).alias("trend"),
        F.slice("weights", N_TREND + 1, N_YEARLY + N_WEEKLY).alias("season"),
    ]


def fit_fourier_grid(history: DataFrame) -> DataFrame:
    return fit_fourier(history, SEASONALITY_MODES, YEARLY_OPTIONS)


def forecast_rows(fit: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets with ``yhat`` for every fitted configuration of their state."""
    return with_clock(targets.join(fit, KEY)).withColumn("yhat", curve())


def curve() -> Column:
    """Amount of a row with its clock, the weights of its configuration and its unit."""
    trend, season = trend_part("t", "trend"), season_part("day", "season")
    value = F.when(F.col("mode") == "additive", trend + season).otherwise(trend * (1 + season))
    return clip_negative(value * F.col("unit"))


def predict_fourier(fit: DataFrame, targets: DataFrame, model: str = TREND) -> DataFrame:
    """Forecast of one configuration per state; without a usable curve its last amount."""
    rows = forecast_rows(fit, targets.select(KEY, "ds"))
    return as_predictions(rows, model, first_available(F.col("yhat"), F.col("last_total")))
