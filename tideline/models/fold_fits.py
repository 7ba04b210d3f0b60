"""Fits on expanding windows from cross products that are read once.

Each fit equals the one that the model's own module makes of the rows before its block.
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
from pyspark.sql.window import Window

from tideline.config import RIDGE_ALPHA
from tideline.functions.linear import DOUBLE, DOUBLES, solve_subset, summed_grams, unpack
from tideline.functions.scalars import clip_negative
from tideline.models import fourier as fr
from tideline.models import seasonal_ar as sa
from tideline.models.closed_form import line_yhat, with_previous
# By name: what a task runs must not bring the module along, whose own functions may be in use.
from tideline.models.seasonal_ar import LONG_LAGS, N_REGRESSORS, SHORT_LAGS, long_weights
from tideline.operators.features import series_window
from tideline.operators.folds import (
    FOLD,
    FOLDS,
    KEY,
    SEGMENT,
    before,
    fold_grams,
    fold_scores,
    judged,
    label_segments,
    segment_of,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# -- first-order autoregression --------------------------------------------------------------------


def ar1_folds(labelled: DataFrame) -> DataFrame:
    """Line of each amount on the one before, per state and fold, and where its forecast starts."""
    # Amounts relative to the mean of the series: sums of squares keep their digits.
    rows = with_previous(labelled).withColumn("center", F.avg("total").over(Window.partitionBy(KEY)))

    def build(batch: pd.DataFrame) -> np.ndarray:
        x = (batch["previous"] - batch["center"]).to_numpy(dtype=float)
        y = (batch["total"] - batch["center"]).to_numpy(dtype=float)
        known = ~(np.isnan(x) | np.isnan(y))
        return np.column_stack([known, np.where(known, x, 0.0), np.where(known, y, 0.0)])

    grams = fold_grams(rows, ["previous", "total", "center"], build, 3)
    ends = rows.groupBy(KEY, SEGMENT).agg(
        F.max("ds").alias("last_ds"), F.max_by("total", "ds").alias("last_total"), F.first("center").alias("center")
    )
    n, sx, sy, sxx, sxy = (F.col("gram")[i] for i in range(5))
    phi = (n * sxy - sx * sy) / F.nullif(n * sxx - sx * sx, F.lit(0.0))
    level = sy / n - F.col("phi") * sx / n + F.col("center") * (1 - F.col("phi"))
    fitted = grams.join(before(ends, last=["last_ds", "last_total", "center"]), [KEY, FOLD])
    return fitted.withColumn("phi", phi).select(
        KEY, FOLD, "phi", level.alias("intercept"), "last_ds", "last_total"
    )


def score_ar1_folds(history: DataFrame, folds: int = FOLDS) -> DataFrame:
    """RMSE of the first-order line per state and fold."""
    labelled = label_segments(history, folds)
    forecasts = judged(labelled, ar1_folds(labelled)).withColumn("yhat", line_yhat())
    return fold_scores(forecasts)


# -- seasonal autoregression -----------------------------------------------------------------------

REACH = max(sa.SHORT_LAGS)
# The differences a row's regressors are made of: its own and those so many rows before.
N_PAST = 1 + REACH + sa.LONG_LAGS
_PAST = ["w", *(f"w{k}" for k in range(1, N_PAST))]
N_LONG = sa.LONG_LAGS + 1
# Columns summed: complete rows, all rows, sizes of amounts, and counts of either kind of row.
_ABS, _ROW, _COMPLETE = N_PAST + N_LONG, N_PAST + N_LONG + 1, N_PAST + N_LONG + 2
N_SUMMED = _COMPLETE + 1

_REGRESSION = T.StructType([
    T.StructField("gram", DOUBLES), T.StructField("n", T.LongType()), T.StructField("unit", DOUBLE),
    T.StructField("tail_w", DOUBLES), T.StructField("tail_e", DOUBLES),
])


def from_past(long: np.ndarray) -> np.ndarray:
    """Matrices that turn past differences into regressors and target, one per series.

    A residual is a difference without what the long autoregression explains of it, so the cross
    products of residuals follow from those of differences.
    """
    n_short = len(SHORT_LAGS)
    out = np.zeros((len(long), N_REGRESSORS + 1, N_PAST))
    for i, lag in enumerate(SHORT_LAGS):
        out[:, i, lag] = 1
        out[:, n_short + i, lag] = 1
        out[:, n_short + i, lag + 1 : lag + 1 + LONG_LAGS] -= long
    out[:, -1, 0] = 1
    return out


@F.pandas_udf(_REGRESSION)
def fold_regression(gram: pd.Series, unit: pd.Series, tail: pd.Series) -> pd.DataFrame:
    """Regression of a fold in units of its own rows, from sums in units of the whole series."""
    full = unpack(gram, N_SUMMED)
    own = np.maximum(full[:, _ABS, _ROW] / full[:, _ROW, _ROW], 1e-9)
    ratio = unit.to_numpy(dtype=float) / own
    squared = (ratio * ratio)[:, None]
    long = long_weights(full[:, N_PAST, N_PAST : N_PAST + N_LONG] * squared)
    turn = from_past(long)
    short = turn @ (full[:, :N_PAST, :N_PAST] * squared[:, :, None]) @ turn.transpose(0, 2, 1)
    upper = np.triu_indices(N_REGRESSORS + 1)
    # A tail too short to hold all differences belongs to a fold without complete rows.
    past = np.stack([np.array([np.nan if x is None else x for x in t], dtype=float) for t in tail])
    past = past * ratio[:, None]
    explained = np.stack([
        np.einsum("nk,nk->n", long, past[:, i - LONG_LAGS : i][:, ::-1])
        for i in range(N_PAST - 1 - REACH, N_PAST - 1)
    ], axis=1)
    recent = past[:, -REACH:]
    return pd.DataFrame({
        "gram": list(short[:, upper[0], upper[1]]),
        "n": full[:, _COMPLETE, _COMPLETE].round().astype(np.int64),
        "unit": own, "tail_w": list(recent), "tail_e": list(recent - explained),
    })


def _past_rows(history: DataFrame, d: int, folds: int) -> DataFrame:
    """Differences with all that lie within reach before them, and the block of every row."""
    window = series_window()
    diffed = sa.differences(history, d)
    n = F.count("*").over(Window.partitionBy(KEY))
    columns = {f"w{k}": F.lag("w", k).over(window) for k in range(1, N_PAST)}
    columns |= {f"total{k}": F.lag("total", k).over(window) for k in range(1, sa.TAIL_ROWS)}
    labelled = diffed.withColumns(columns | {SEGMENT: segment_of(F.col("rn"), n, folds)})
    return labelled.withColumn("next", F.lead(SEGMENT).over(window))


def seasonal_folds(history: DataFrame, orders: Sequence[tuple[int, int, int]], folds: int = FOLDS,
                   largest_root: float | None = None) -> DataFrame:
    """Coefficients, AIC and forecast start of every order, per state and fold."""
    degrees = sorted({d for _, d, _ in orders})
    first_complete = sa.first_row(degrees[-1])
    solve_order = sa.order_solver(largest_root)
    fits = None

    def build(batch: pd.DataFrame) -> np.ndarray:
        past = np.nan_to_num(batch[_PAST].to_numpy(dtype=float), nan=0.0)
        complete = (batch["rn"] >= first_complete).to_numpy(dtype=float)[:, None]
        return np.hstack([past * complete, past[:, :N_LONG], batch[["total"]].abs().to_numpy(dtype=float),
                          np.ones_like(complete), complete])

    for d in degrees:
        rows = _past_rows(history, d, folds)
        grams = summed_grams(rows, [KEY, SEGMENT], ["rn", "total", *_PAST], build, N_SUMMED)
        ends = rows.filter(F.col("next").isNull() | (F.col("next") > F.col(SEGMENT))).select(
            KEY, SEGMENT, F.col("ds").alias("last_ds"), "unit",
            F.array(*[F.col(f"total{k}") for k in range(sa.TAIL_ROWS - 1, 0, -1)], F.col("total")).alias("tail_y"),
            F.array(*[F.col(f"w{k}") for k in range(N_PAST - 2, 0, -1)], F.col("w")).alias("tail"),
        )
        peaks = rows.groupBy(KEY, SEGMENT).agg(
            F.max(F.when(F.col("rn") >= first_complete, F.col("total"))).alias("peak")
        )
        known = before(
            grams.join(ends, [KEY, SEGMENT]).join(peaks, [KEY, SEGMENT]),
            sums=["gram"], largest=["peak"], last=["last_ds", "unit", "tail_y", "tail"],
        )
        solved = known.withColumn("own", fold_regression("gram", "unit", "tail")).select(
            KEY, FOLD, "last_ds", "peak", "tail_y", "own.*"
        )
        grid = F.array(*[
            F.struct(F.lit(i).alias("grid_id"), F.lit(p).alias("p"), F.lit(d).alias("d"), F.lit(q).alias("q"))
            for i, (p, own_d, q) in enumerate(orders) if own_d == d
        ])
        found = (
            solved.filter(F.col("n") > sa.N_REGRESSORS + 1)
            .withColumn("order", F.explode(grid))
            .withColumn("fit", solve_order("gram", "n", "order.p", "order.q"))
            .select("*", "order.*", "fit.*")
            .drop("order", "fit", "gram")
        )
        fits = found if fits is None else fits.unionByName(found)
    return fits


def score_seasonal_folds(history: DataFrame, orders: Sequence[tuple[int, int, int]] | None = None,
                         folds: int = FOLDS, largest_root: float | None = None,
                         damping: float = 1.0) -> DataFrame:
    """RMSE of every order per state and fold; a path that diverges scores infinity."""
    orders = sa.order_grid() if orders is None else orders
    keys = [KEY, FOLD, "grid_id"]
    fits = seasonal_folds(history, orders, folds, largest_root).withColumn("damping", F.lit(float(damping)))
    labelled = label_segments(history, folds)
    sizes = labelled.filter(F.col(SEGMENT) > 0).groupBy(KEY, F.col(SEGMENT).alias(FOLD)).agg(
        F.count("*").cast("int").alias("steps")
    )
    paths = sa.seasonal_paths(fits, sizes, keys, [KEY, FOLD]).join(
        fits.select(*keys, "p", "d", "q", "last_ds"), keys
    )
    ahead = F.datediff("ds", "last_ds")
    forecasts = judged(labelled, paths).withColumn("yhat", clip_negative(F.get("path", ahead - 1)))
    return fold_scores(forecasts, ["grid_id", "p", "d", "q"])


# -- trend and season ------------------------------------------------------------------------------


def trend_folds(history: DataFrame, modes: Sequence[str] = ("additive",),
                yearly_options: Sequence[bool] = (True,), folds: int = FOLDS) -> tuple[DataFrame, DataFrame]:
    """Labelled rows on the clock of the whole history, and weights per state, fold and configuration.

    Bends later than a fold's rows have no weight. The multiplicative mode divides by the trend of
    its own fold, so it reads the rows once more for every fold they belong to.
    """
    rows = label_segments(fr.scaled_history(history), folds)
    trends = fold_grams(rows, ["t", "day", "y"], fr.design_and("y"), fr.N_COLUMNS + 1)
    fits = None
    for yearly in yearly_options:
        solved = trends.select(KEY, FOLD, fr.solver(yearly, trend=True)("gram").alias("weights"))
        additive = solved.select(KEY, FOLD, *fr.weight_parts())
        for mode in modes:
            fit = additive
            if mode != "additive":
                trend = additive.select(KEY, FOLD, "trend")
                base = rows.join(trend, KEY).filter(F.col(SEGMENT) < F.col(FOLD))
                base = base.withColumn("base", fr.trend_part("t", "trend")).filter(F.col("base") > 0)
                ratios = base.withColumn("ratio", F.col("y") / F.col("base") - 1)
                grams = summed_grams(ratios, [KEY, FOLD], ["t", "day", "ratio"], fr.design_and("ratio"), fr.N_COLUMNS + 1)
                seasonal = grams.select(KEY, FOLD, fr.solver(yearly, trend=False)("gram").alias("weights"))
                fit = additive.drop("season").join(seasonal.select(KEY, FOLD, fr.weight_parts()[1]), [KEY, FOLD], "left")
            fit = fit.withColumns({"mode": F.lit(mode), "yearly": F.lit(yearly)})
            fits = fit if fits is None else fits.unionByName(fit)
    return rows, fits


def score_trend_folds(history: DataFrame, modes: Sequence[str] = fr.SEASONALITY_MODES,
                      yearly_options: Sequence[bool] = fr.YEARLY_OPTIONS, folds: int = FOLDS) -> DataFrame:
    """RMSE of every trend configuration per state and fold."""
    rows, fits = trend_folds(history, modes, yearly_options, folds)
    targets = rows.filter(F.col(SEGMENT) > 0).select(
        KEY, F.col(SEGMENT).alias(FOLD), "t", "day", "unit", (F.col("y") * F.col("unit")).alias("actual")
    )
    scored = targets.join(fits, [KEY, FOLD])
    forecasts = scored.withColumn("yhat", fr.curve())
    return fold_scores(forecasts, ["mode", "yearly"])


# -- ridge on base predictions ---------------------------------------------------------------------


def ridge_folds(labelled: DataFrame, columns: Sequence[str], alpha: float = RIDGE_ALPHA) -> DataFrame:
    """Ridge weights of ``total`` on ``columns`` with a free intercept, per state and fold."""
    state = Window.partitionBy(KEY)
    names = [*columns, "total"]
    rows = labelled.withColumns({f"mid_{name}": F.avg(name).over(state) for name in names})
    k = len(columns)

    def build(batch: pd.DataFrame) -> np.ndarray:
        values = batch[names].to_numpy(dtype=float) - batch[[f"mid_{x}" for x in names]].to_numpy(dtype=float)
        return np.column_stack([np.ones(len(batch)), values])

    @F.pandas_udf(DOUBLES)
    def solve(gram: pd.Series, middle: pd.Series) -> pd.Series:
        full, shift = unpack(gram, k + 2), np.stack(middle.to_numpy())
        n = full[:, 0, 0]
        means = full[:, 0, 1:] / n[:, None]
        centred = full[:, 1:, 1:] - n[:, None, None] * means[:, :, None] * means[:, None, :]
        weights = solve_subset(centred, range(k), np.full(k, alpha))
        means = means + shift
        level = means[:, k] - np.einsum("nk,nk->n", weights, means[:, :k])
        return pd.Series(list(np.column_stack([level, weights])))

    middles = [f"mid_{name}" for name in names]
    grams = fold_grams(rows, [*names, *middles], build, k + 2)
    middle = rows.groupBy(KEY).agg(F.array(*[F.first(m) for m in middles]).alias("middle"))
    solved = grams.join(middle, KEY).select(KEY, FOLD, solve("gram", "middle").alias("w"))
    return solved.select(KEY, FOLD, F.col("w")[0].alias("intercept"),
                         *[F.col("w")[i + 1].alias(name) for i, name in enumerate(columns)])
