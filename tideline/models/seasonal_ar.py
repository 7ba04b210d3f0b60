"""Seasonal ARIMA by conditional least squares.

The seasonal difference of a series is regressed on its own lags and on lagged residuals of a
long autoregression (Hannan and Rissanen, 1982). Both regressions are linear, so a series is
reduced to cross products by Spark aggregates, and one pass serves every order of the tuning
grid. The products of the multiplicative form (lag 1 times lag 7 and so on) enter as lags 8 and
9 with free weights. Only the h-step recursion runs in Python, on one tail row per series and
for a whole batch of series per step.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tideline.config import (
    ARIMA,
    ARIMA_D_GRID,
    ARIMA_ORDER,
    ARIMA_P_GRID,
    ARIMA_Q_GRID,
    SEASON,
)
from tideline.functions.linear import (
    DOUBLE,
    DOUBLES,
    gram_sums,
    solve_each,
    solve_subset,
    unpack,
)
from tideline.functions.scalars import clip_negative, finite
from tideline.models.closed_form import ar1_forecast, as_predictions, first_available, fit_ar1
from tideline.operators.features import series_window

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = "state"
LONG_LAGS = 2 * SEASON
SHORT_LAGS = (1, 2, SEASON, SEASON + 1, SEASON + 2)
N_REGRESSORS = 2 * len(SHORT_LAGS)
LONG_PENALTY = 1e-6
# Amounts needed to continue: the differences at the longest lag reach this far back.
TAIL_ROWS = max(SHORT_LAGS) + SEASON + 1
# A path that goes this many times beyond the largest known amount counts as diverged.
DIVERGED = 10.0

SOLUTION = T.StructType([T.StructField("coefficients", DOUBLES), T.StructField("aic", DOUBLE)])


def order_columns(p: int, q: int) -> list[int]:
    """Positions of the regressors that order (p, q) with one seasonal term uses."""
    ar = [i for i, lag in enumerate(SHORT_LAGS) if lag <= p or SEASON <= lag <= SEASON + p]
    ma = [i for i, lag in enumerate(SHORT_LAGS) if lag <= q or SEASON <= lag <= SEASON + q]
    return ar + [len(SHORT_LAGS) + i for i in ma]


def differences(history: DataFrame, d: int) -> DataFrame:
    """``w``: the series relative to its mean, seasonally and ``d`` times differenced.

    ``rn`` numbers the rows of a series from 1.
    """
    window = series_window()
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = F.col("total") - F.lag("total", SEASON).over(window)
    if d:
        w = w - (F.lag("total", 1).over(window) - F.lag("total", SEASON + 1).over(window))
    return history.select(
        KEY,
        "ds",
        "total",
        F.row_number().over(window).alias("rn"),
        F.greatest(F.avg(F.abs("total")).over(whole), F.lit(1e-9)).alias("unit"),
        w.alias("w"),
    ).withColumn("w", F.col("w") / F.col("unit"))


PAST = [f"l{k}" for k in range(1, LONG_LAGS + 1)]


def with_past(diffed: DataFrame) -> DataFrame:
    window = series_window()
    return diffed.withColumns({name: F.lag("w", k).over(window) for k, name in enumerate(PAST, 1)})


def autocovariances(diffed: DataFrame) -> DataFrame:
    """``acov`` per state: sums of ``w`` times itself and its lags up to the long ones."""
    return sum_products(with_past(diffed))


def sum_products(lagged: DataFrame) -> DataFrame:
    products = [F.sum(F.col("w") * F.col(name)) for name in ["w", *PAST]]
    return lagged.groupBy(KEY).agg(F.array(*products).alias("acov"))


def residuals(diffed: DataFrame) -> DataFrame:
    """Add ``e``: what a long autoregression leaves unexplained.

    The autoregression is fitted from autocovariances (Yule-Walker), 15 sums per state.
    """
    past = PAST
    lagged = with_past(diffed)
    fit = sum_products(lagged).select(KEY, solve_toeplitz("acov").alias("long"))
    explained = sum((F.col("long")[k] * F.col(name) for k, name in enumerate(past)), F.lit(0.0))
    return lagged.join(fit, KEY).select(
        KEY, "ds", "total", "rn", "unit", "w", (F.col("w") - explained).alias("e")
    )


@F.pandas_udf(DOUBLES)
def solve_toeplitz(acov: pd.Series) -> pd.Series:
    """Autoregressive weights from autocovariances at lags 0, 1, ...; 0 for a flat series."""
    # Sums over no rows are NULL: a series too short to have the lag, taken as uncorrelated.
    moments = np.stack([np.array([0.0 if x is None else x for x in a], dtype=float) for a in acov])
    return pd.Series(list(long_weights(moments)))


def long_weights(moments: np.ndarray) -> np.ndarray:
    """Weights of the long autoregression, one row per row of autocovariances."""
    apart = np.abs(np.subtract.outer(np.arange(LONG_LAGS), np.arange(LONG_LAGS)))
    floor = (LONG_PENALTY * moments[:, :1] + 1e-12)[:, :, None] * np.eye(LONG_LAGS)
    return solve_each(moments[:, apart] + floor, moments[:, 1:])


def first_row(d: int) -> int:
    """Number of the first row that has all regressors after ``d`` differences."""
    return SEASON + d + LONG_LAGS + max(SHORT_LAGS) + 1


def cross_products(with_residuals: DataFrame, largest_d: int) -> DataFrame:
    """One row per state: cross products of all candidate regressors, and the forecast tail.

    Rows count from the one where the most differenced series has all its regressors, so that AIC
    compares all orders on one row set.
    """
    window = series_window()
    reach = max(SHORT_LAGS)
    lagged = {
        f"{name}{k}": F.lag(name, k).over(window)
        for name, n in (("total", TAIL_ROWS), ("w", reach + 1), ("e", reach + 1))
        for k in range(1, n)
    }
    rows = with_residuals.withColumns(lagged | {"later_ds": F.lead("ds").over(window)})
    complete = rows.filter(F.col("rn") >= first_row(largest_d))
    regressors = [F.col(f"{name}{k}") for name in ("w", "e") for k in SHORT_LAGS]

    def tail(name: str, n: int) -> Column:
        past = [f"{name}{k}" for k in range(n - 1, 0, -1)] + [name]
        is_last = F.col("later_ds").isNull()
        return F.array(*[F.max(F.when(is_last, F.col(c))) for c in past])

    return complete.groupBy(KEY).agg(
        gram_sums([*regressors, F.col("w")]).alias("gram"),
        F.count("*").alias("n"),
        F.max("ds").alias("last_ds"),
        F.max("total").alias("peak"),
        F.max("unit").alias("unit"),
        tail("total", TAIL_ROWS).alias("tail_y"),
        tail("w", reach).alias("tail_w"),
        tail("e", reach).alias("tail_e"),
    )


def fit_grid(history: DataFrame, orders: Sequence[tuple[int, int, int]],
             largest_root: float | None = None) -> DataFrame:
    """Coefficients and AIC of every order for every state with enough rows.

    ``largest_root`` pulls explosive autoregressive parts inside that circle.
    """
    fits = None
    degrees = sorted({order[1] for order in orders})
    solve_order = order_solver(largest_root)
    for d in degrees:
        sums = cross_products(residuals(differences(history, d)), degrees[-1])
        grid = F.array(
            *[
                F.struct(
                    F.lit(i).alias("grid_id"),
                    F.lit(p).alias("p"),
                    F.lit(d).alias("d"),
                    F.lit(q).alias("q"),
                )
                for i, (p, order_d, q) in enumerate(orders)
                if order_d == d
            ]
        )
        solved = (
            sums.filter(F.col("n") > N_REGRESSORS + 1)
            .withColumn("order", F.explode(grid))
            .withColumn("fit", solve_order("gram", "n", "order.p", "order.q"))
            .select("*", "order.*", "fit.*")
            .drop("order", "fit", "gram")
        )
        fits = solved if fits is None else fits.unionByName(solved)
    return fits


def order_solver(largest_root: float | None):
    """Pandas UDF: each state's coefficients and AIC for its order; other regressors get 0.

    A system without a solution has NaN coefficients and an infinite AIC.
    """

    @F.pandas_udf(SOLUTION)
    def solve_order(gram: pd.Series, n: pd.Series, p: pd.Series, q: pd.Series) -> pd.DataFrame:
        full = unpack(gram, N_REGRESSORS + 1)
        coefficients = np.zeros((len(full), N_REGRESSORS))
        aic = np.full(len(full), np.inf)
        for order in set(zip(p, q)):
            rows = np.flatnonzero((p == order[0]) & (q == order[1]))
            keep = order_columns(*order)
            systems = full[rows]
            weights = solve_subset(systems, keep, np.full(len(keep), LONG_PENALTY))
            coefficients[np.ix_(rows, keep)] = weights
            cross = np.einsum("nk,nk->n", weights, systems[:, keep, -1])
            inner = np.einsum("nk,nkl,nl->n", weights, systems[:, keep][:, :, keep], weights)
            sse = np.maximum(systems[:, -1, -1] - 2 * cross + inner, 1e-300)
            count = n.to_numpy(dtype=float)[rows]
            found = count * np.log(sse / count) + 2 * len(keep)
            aic[rows] = np.where(np.isfinite(found), found, np.inf)
        if largest_root is not None:
            coefficients = stationary(coefficients, largest_root)
        return pd.DataFrame({"coefficients": list(coefficients), "aic": aic})

    return solve_order


def subset_solver(keep: Sequence[int]):
    """Pandas UDF: coefficients of the target on the regressors at these positions alone."""

    @F.pandas_udf(DOUBLES)
    def solve(gram: pd.Series) -> pd.Series:
        full = unpack(gram, N_REGRESSORS + 1)
        return pd.Series(list(solve_subset(full, keep, np.full(len(keep), LONG_PENALTY))))

    return solve


def stationary(coefficients: np.ndarray, largest_root: float) -> np.ndarray:
    """Pull explosive autoregressive parts inside the circle of radius ``largest_root``.

    Unrestricted least squares may leave a root outside it, and a long forecast would grow
    without bound. Scaling the weight at lag k by r**k moves every root by the factor r.
    """
    lags = np.asarray(SHORT_LAGS)
    reach = lags.max()
    companion = np.zeros((len(coefficients), reach, reach))
    companion[:, np.arange(1, reach), np.arange(reach - 1)] = 1
    companion[:, 0, lags - 1] = coefficients[:, : len(lags)]
    radius = np.full(len(coefficients), np.nan)
    good = np.isfinite(coefficients).all(axis=1)
    radius[good] = np.abs(np.linalg.eigvals(companion[good])).max(axis=1)
    shrink = np.minimum(1, largest_root / np.maximum(radius, largest_root))
    bounded = coefficients.copy()
    bounded[:, : len(lags)] *= shrink[:, None] ** lags
    return bounded


def fit_seasonal_ar(history: DataFrame, order: tuple[int, int, int] = ARIMA_ORDER,
                    largest_root: float | None = None, damping: float = 1.0) -> DataFrame:
    """One order for all states, with all that a forecast may need."""
    return with_fallback(fit_grid(history, [order], largest_root), history, damping)


def with_fallback(fits: DataFrame, history: DataFrame, damping: float = 1.0) -> DataFrame:
    """Every state of ``history`` with its first-order line, and its seasonal fit where it has one."""
    line = fit_ar1(history).withColumn("damping", F.lit(float(damping)))
    return line.join(fits.drop("last_ds"), KEY, "left")


def order_grid() -> list[tuple[int, int, int]]:
    return list(product(ARIMA_P_GRID, ARIMA_D_GRID, ARIMA_Q_GRID))


def select_order(fits: DataFrame) -> DataFrame:
    """The fit with the smallest AIC per state; ties go to the first grid point."""
    columns = [c for c in fits.columns if c != KEY]
    best = F.min_by(F.struct(*columns), F.struct("aic", "grid_id"))
    return fits.groupBy(KEY).agg(best.alias("best")).select(KEY, "best.*")


@F.pandas_udf(DOUBLES)
def continue_series(coefficients: pd.Series, tail_y: pd.Series, tail_w: pd.Series,
                    tail_e: pd.Series, unit: pd.Series, d: pd.Series,
                    steps: pd.Series, damping: pd.Series) -> pd.Series:
    """The next ``steps`` amounts of each series; future residuals are 0.

    A double difference carries the last week-on-week change on; with ``damping`` below 1 it
    fades (damped trend, Gardner and McKenzie, 1985).
    """
    reach = max(SHORT_LAGS)
    weights = np.stack(coefficients.to_numpy())
    scale = unit.to_numpy(dtype=float)[:, None]
    y = np.stack(tail_y.to_numpy()) / scale
    w = np.stack(tail_w.to_numpy())
    e = np.stack(tail_e.to_numpy())
    once, fading = d.to_numpy(dtype=float), damping.to_numpy(dtype=float)
    horizon = int(steps.max())
    known = y.shape[1]
    y = np.hstack([y, np.zeros((len(y), horizon))])
    w = np.hstack([w, np.zeros((len(w), horizon))])
    e = np.hstack([e, np.zeros((len(e), horizon))])
    lags = np.asarray(SHORT_LAGS)
    # An explosive path may overflow; it is told by its values afterwards.
    np.seterr(over="ignore", invalid="ignore")
    for h in range(horizon):
        at = reach + h
        regressors = np.hstack([w[:, at - lags], e[:, at - lags]])
        w[:, at] = np.einsum("nk,nk->n", regressors, weights)
        now = known + h
        step = y[:, now - 1] - y[:, now - 1 - SEASON]
        y[:, now] = w[:, at] + y[:, now - SEASON] + once * fading ** (h + 1) * step
    future = y[:, known:] * scale
    return pd.Series([row[:n] for row, n in zip(future, steps.astype(int))])


def seasonal_paths(fit: DataFrame, horizon: DataFrame, keys: Sequence[str] = (KEY,),
                   horizon_keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Forecast path per fitted state; ``horizon(state, steps)`` says how far each one goes.

    With several fits per state ``keys`` name one, and ``horizon_keys`` what decides its steps.

    A path counts as failed, and is NULL, if any of its days is no number or leaves the range of
    the data by an order of magnitude.
    """
    path = continue_series(
        "coefficients", "tail_y", "tail_w", "tail_e", "unit", F.col("d").cast("int"), "steps", "damping"
    )
    fitted = fit.filter(F.col("coefficients").isNotNull()).join(horizon, list(horizon_keys))
    lost = F.exists("path", lambda y: finite(y).isNull() | (F.abs(y) > DIVERGED * F.col("peak")))
    paths = fitted.select(*keys, "peak", path.alias("path"))
    return paths.select(*keys, F.when(~lost, F.col("path")).alias("path"))


def predict_seasonal_ar(fit: DataFrame, targets: DataFrame, model: str = ARIMA) -> DataFrame:
    """Forecast with the fallbacks of the fit: seasonal model, first-order line, last amount.

    The choice is made once per state, so no path mixes two models.
    """
    ahead = F.datediff("ds", "last_ds")
    line = fit.select(KEY, "last_ds", "phi", "intercept", "last_total")
    joined = targets.join(line, KEY)
    steps = joined.groupBy(KEY).agg(F.max(ahead).alias("steps"))
    joined = joined.join(seasonal_paths(fit, steps), KEY, "left")
    yhat = first_available(F.get("path", ahead - 1), ar1_forecast(ahead), F.col("last_total"))
    return as_predictions(joined, model, clip_negative(yhat))
