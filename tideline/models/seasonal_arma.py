"""Multiplicative seasonal ARMA by conditional least squares.

The differenced series w obeys (1 - phi(B))(1 - Phi B^7) w = (1 + theta(B))(1 + Theta B^7) e, so order
(p, d, q) has p + q + 2 parameters and the weights at lags 8 and 9 are products, where ``seasonal_ar``
leaves them free. The sum of squared residuals is no longer a quadratic form: it is minimised by
damped Gauss-Newton steps from the linear fit, for all series of a batch at once, one pass over time
per step. The result has the columns of ``seasonal_ar.fit_grid`` and is chosen and forecast by it.

A series travels to one task as an array of its daily differences, whose length the calendar bounds.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.config import ARIMA_ORDER, SEASON
from tideline.functions.linear import DOUBLE, DOUBLES, solve_each
from tideline.models import seasonal_ar as sa
from tideline.models.seasonal_ar import SHORT_LAGS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = "state"
REACH = max(SHORT_LAGS)
STEPS = 25
# Series that go through time together, and the largest size of a seasonal parameter.
BLOCK = 256
LARGEST_SEASONAL = 0.99
FIT = T.StructType([
    T.StructField("coefficients", DOUBLES), T.StructField("aic", DOUBLE), T.StructField("n", T.LongType()),
    T.StructField("tail_e", DOUBLES),
])


def lag_weights(beta: np.ndarray, p: int, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weights of past w and past e at lags 1 to 9, and their derivatives by each parameter.

    ``beta`` holds phi (p), Phi, theta (q), Theta in its columns.
    """
    n, k = beta.shape
    w, e = np.zeros((n, REACH)), np.zeros((n, REACH))
    dw, de = np.zeros((n, k, REACH)), np.zeros((n, k, REACH))
    for weights, slopes, size, first, sign in ((w, dw, p, 0, -1.0), (e, de, q, p + 1, 1.0)):
        seasonal = beta[:, first + size]
        weights[:, SEASON - 1] = seasonal
        slopes[:, first + size, SEASON - 1] = 1
        for i in range(size):
            weights[:, i] = beta[:, first + i]
            weights[:, SEASON + i] = sign * beta[:, first + i] * seasonal
            slopes[:, first + i, i] = 1
            slopes[:, first + i, SEASON + i] = sign * seasonal
            slopes[:, first + size, SEASON + i] = sign * beta[:, first + i]
    return w, e, dw, de


def residuals(beta: np.ndarray, w: np.ndarray, counted: np.ndarray, p: int, q: int,
              slopes: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Residuals of every series (0 where not counted), and their derivatives by the parameters."""
    n, length = w.shape
    on_w, on_e, by_w, by_e = lag_weights(beta, p, q)
    padded = np.hstack([np.zeros((n, REACH)), w])
    e = np.zeros((n, REACH + length))
    jac = np.zeros((n, REACH + length, beta.shape[1])) if slopes else None
    for t in range(length):
        past_w, past_e = padded[:, t : t + REACH][:, ::-1], e[:, t : t + REACH][:, ::-1]
        now = counted[:, t]
        found = w[:, t] - (on_w * past_w).sum(axis=1) - (on_e * past_e).sum(axis=1)
        e[:, t + REACH] = np.where(now, found, 0.0)
        if slopes:
            change = -np.einsum("nkl,nl->nk", by_w, past_w) - np.einsum("nkl,nl->nk", by_e, past_e)
            change -= np.einsum("nl,nlk->nk", on_e, jac[:, t : t + REACH][:, ::-1])
            jac[:, t + REACH] = np.where(now[:, None], change, 0.0)
    return e[:, REACH:], jac[:, REACH:] if slopes else None


def minimise(w: np.ndarray, counted: np.ndarray, start: np.ndarray, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Parameters with a small sum of squares, and the residuals they leave."""
    seasonal = [p, p + 1 + q]

    def bounded(beta: np.ndarray) -> np.ndarray:
        beta = beta.copy()
        beta[:, seasonal] = np.clip(beta[:, seasonal], -LARGEST_SEASONAL, LARGEST_SEASONAL)
        return beta

    beta = bounded(np.nan_to_num(start))
    with np.errstate(all="ignore"):
        e, jac = residuals(beta, w, counted, p, q)
        # A start that explodes is no start.
        lost = ~np.isfinite((e * e).sum(axis=1)) | ((e * e).sum(axis=1) > 4 * (w * w * counted).sum(axis=1))
        beta[lost] = 0.0
        e, jac = residuals(beta, w, counted, p, q)
        sse = (e * e).sum(axis=1)
        damping = np.full(len(w), 1e-3)
        for _ in range(STEPS):
            gram = np.einsum("ntk,ntl->nkl", jac, jac)
            scale = np.einsum("nkk->nk", gram).copy()
            gram = gram + (damping[:, None] * scale + 1e-12)[:, :, None] * np.eye(beta.shape[1])
            step = np.nan_to_num(solve_each(gram, -np.einsum("ntk,nt->nk", jac, e)))
            tried = bounded(beta + step)
            other, slopes = residuals(tried, w, counted, p, q)
            found = (other * other).sum(axis=1)
            better = np.isfinite(found) & (found < sse)
            gain = np.where(better, (sse - found) / np.maximum(sse, 1e-300), 0.0)
            beta[better], e[better], jac[better] = tried[better], other[better], slopes[better]
            sse = np.where(better, found, sse)
            damping = np.where(better, damping / 10, damping * 10)
            if not (gain > 1e-10).any() and (damping > 1e6).all() or not better.any() and (damping > 1e4).all():
                break
            if better.any() and gain.max() < 1e-12:
                break
    return beta, e


def fitter(p: int, q: int):
    """Pandas UDF: coefficients at the lags of ``seasonal_ar``, AIC, rows counted and last residuals."""

    @F.pandas_udf(FIT)
    def fit(w: pd.Series, skipped: pd.Series, coefficients: pd.Series) -> pd.DataFrame:
        out = []
        for i in range(0, len(w), BLOCK):
            series = [np.asarray(x, dtype=float) for x in w[i : i + BLOCK]]
            first = skipped[i : i + BLOCK].to_numpy()
            length = max(map(len, series))
            values, counted = np.zeros((len(series), length)), np.zeros((len(series), length), dtype=bool)
            for row, x in enumerate(series):
                good = np.isfinite(x).all()
                values[row, : len(x)] = x if good else 0.0
                counted[row, first[row] : len(x)] = good
            linear = np.stack([np.zeros(2 * len(SHORT_LAGS)) if c is None else np.asarray(c, dtype=float)
                               for c in coefficients[i : i + BLOCK]])
            half = len(SHORT_LAGS)
            start = np.column_stack([linear[:, :p], linear[:, 2], linear[:, half : half + q], linear[:, half + 2]])
            beta, e = minimise(values, counted, start, p, q)
            on_w, on_e, _, _ = lag_weights(beta, p, q)
            at = np.asarray(SHORT_LAGS) - 1
            n = counted.sum(axis=1)
            sse = np.maximum((e * e).sum(axis=1), 1e-300)
            with np.errstate(all="ignore"):
                aic = n * np.log(sse / n) + 2 * (p + q + 2)
            for row, x in enumerate(series):
                known = n[row] > 0 and np.isfinite(aic[row])
                out.append((
                    np.concatenate([on_w[row, at], on_e[row, at]]) if known else np.full(2 * half, np.nan),
                    float(aic[row]) if known else np.inf, int(n[row]), e[row, len(x) - REACH : len(x)],
                ))
        return pd.DataFrame(out, columns=["coefficients", "aic", "n", "tail_e"])

    return fit


def fit_grid(history: DataFrame, orders: Sequence[tuple[int, int, int]] = (ARIMA_ORDER,)) -> DataFrame:
    """Every order for every state that has a linear fit; columns as in ``seasonal_ar.fit_grid``."""
    linear = sa.fit_grid(history, orders).drop("aic", "n", "tail_e")
    most = max(d for _, d, _ in orders)
    # Rows count from the one where the most differenced series has all its lags, for all orders alike.
    first = SEASON + most + REACH + 1
    fits = None
    for d in sorted({order[1] for order in orders}):
        known = sa.differences(history, d).filter(F.col("rn") > SEASON + d)
        listed = F.array_sort(F.collect_list(F.struct("rn", "w")))
        series = known.groupBy(KEY).agg(F.transform(listed, lambda row: row["w"]).alias("series"))
        for i, (p, own, q) in enumerate(orders):
            if own != d:
                continue
            chosen = linear.filter(F.col("grid_id") == i).join(series, KEY)
            skipped = F.lit(first - 1 - SEASON - d)
            found = chosen.withColumn("fit", fitter(p, q)("series", skipped, "coefficients"))
            found = found.drop("series", "coefficients").select("*", "fit.*").drop("fit")
            fits = found if fits is None else fits.unionByName(found)
    return fits


def tune(train: DataFrame, orders: Sequence[tuple[int, int, int]] | None = None) -> DataFrame:
    """The order with the smallest AIC per state, with its fit."""
    return sa.select_order(fit_grid(train, sa.order_grid() if orders is None else orders))
