"""Hyper-parameter grids, scored on the last fifth of the training rows.

A grid is a handful of literal points. Models with a linear fit score all of them in one plan;
the pooled learners are fitted once per point, several fits at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline import config as c
from tideline.functions.metrics import rmse
from tideline.models import fold_fits, fourier, pooled, seasonal_ar
from tideline.models.tree_arrays import numbers, staged_predictions, tree_arrays
from tideline.operators.features import complete_rows
from tideline.operators.folds import FOLDS, mean_over_folds
from tideline.operators.scoring import best_configuration
from tideline.operators.split import TEST, TRAIN, split_series, with_enough_rows
from tideline.session import materialize

KEY = "state"
PARALLEL_FITS = 8
TREE_PARAMETERS = ("depth", "step", "trees", "row_share")


def grid_rows(points: Sequence[dict]) -> Column:
    """The grid as an array of structs, numbered in order, ready to be exploded."""
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("grid_id"),
                *[F.lit(value).alias(name) for name, value in point.items()],
            )
            for i, point in enumerate(points)
        ]
    )


def with_grid(df: DataFrame, points: Sequence[dict]) -> DataFrame:
    """Every row once per grid point."""
    return df.withColumn("point", F.explode(grid_rows(points))).select("*", "point.*").drop("point")


def tree_grid() -> list[dict]:
    values = product(c.TREE_DEPTH_GRID, c.TREE_STEP_GRID, c.TREE_COUNT_GRID, c.TREE_ROW_SHARE_GRID)
    return [dict(zip(TREE_PARAMETERS, point)) for point in values]


def lookback_grid() -> list[dict]:
    return [{"length": length} for length in c.LOOKBACK_GRID]


def trend_grid() -> list[dict]:
    return [
        {"mode": mode, "yearly": yearly}
        for mode, yearly in product(c.SEASONALITY_MODES, c.YEARLY_OPTIONS)
    ]


def tune_seasonal_ar(train: DataFrame, largest_root: float | None = None) -> DataFrame:
    """Order with the smallest AIC per state, with its coefficients."""
    fits = seasonal_ar.fit_grid(train, seasonal_ar.order_grid(), largest_root)
    return seasonal_ar.select_order(fits)


def score_trend(train: DataFrame) -> DataFrame:
    """Hold-out error of every trend configuration per state."""
    held = split_series(train, column="holdout")
    history = held.filter(F.col("holdout") == TRAIN)
    targets = held.filter(F.col("holdout") == TEST).select(
        KEY, "ds", F.greatest(F.col("total"), F.lit(0.0)).alias("actual")
    )
    forecast = fourier.forecast_rows(fourier.fit_fourier_grid(history), targets)
    scores = forecast.groupBy(KEY, "mode", "yearly").agg(
        rmse(F.col("actual"), F.col("yhat")).alias("rmse")
    )
    return _numbered(scores, trend_grid())


def tune_trend(train: DataFrame) -> DataFrame:
    return best_configuration(score_trend(train), "rmse", ("mode", "yearly"))


def tune_seasonal_ar_folds(train: DataFrame, folds: int = FOLDS, orders: Sequence[tuple] | None = None,
                           largest_root: float | None = None) -> DataFrame:
    """Order with the smallest mean error over expanding windows, per state."""
    scores = fold_fits.score_seasonal_folds(train, orders, folds, largest_root)
    return best_configuration(mean_over_folds(scores, ["grid_id", "p", "d", "q"]), "rmse", ("p", "d", "q"))


def tune_trend_folds(train: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Trend configuration with the smallest mean error over expanding windows, per state."""
    scores = mean_over_folds(fold_fits.score_trend_folds(train, folds=folds), ["mode", "yearly"])
    return best_configuration(_numbered(scores, trend_grid()), "rmse", ("mode", "yearly"))


def _numbered(scores: DataFrame, points: Sequence[dict]) -> DataFrame:
    number = F
    for i, point in enumerate(points):
        same = [F.col(name) == F.lit(value) for name, value in point.items()]
        number = number.when(reduce(Column.__and__, same), F.lit(i))
    return scores.withColumn("grid_id", number)


def score_trees(train: DataFrame, points: Sequence[dict] | None = None) -> DataFrame:
    """Hold-out error of the trees per state and grid point.

    The hold-out is the last fifth of the complete rows of each series; series with fewer than
    100 such rows are left to the default configuration.
    """
    points = tree_grid() if points is None else points
    spark = train.sparkSession
    usable = with_enough_rows(complete_rows(train), c.MIN_TUNING_ROWS, F.lit(True))
    held = materialize(split_series(usable, column="holdout"))
    history = held.filter(F.col("holdout") == TRAIN)
    scale = materialize(pooled.amount_scale(history))
    # The fits overlap, so none of them is spread over all cores.
    inputs = pooled.kept_inputs(materialize(pooled.tree_inputs(history, scale)), spread=False)
    # Prepared once for the whole grid, with the amounts: scoring a point needs no join.
    targets = materialize(pooled.tree_targets(held.filter(F.col("holdout") == TEST), scale))

    def score(group: tuple[dict, list[int]]) -> DataFrame:
        fixed, stages = group
        model = pooled.fit_trees(inputs, **fixed, trees=stages[-1], kept=True)
        staged = staged_predictions(tree_arrays(model, spark), numbers(c.FEATURES), stages, spark)
        errors = targets.withColumn("staged", staged)
        found = [
            rmse(F.col("total"), pooled.back_to_amount(F.col("staged")[i])) for i in range(len(stages))
        ]
        per_state = errors.groupBy(KEY).agg(
            *[score.alias(f"rmse_{n}") for n, score in zip(stages, found)]
        )
        scores = F.array(*[F.struct(F.lit(n).alias("trees"), F.col(f"rmse_{n}").alias("rmse")) for n in stages])
        rows = materialize(per_state).select(KEY, F.explode(scores).alias("score")).select(KEY, "score.*")
        return rows.withColumns({name: F.lit(value) for name, value in fixed.items()})

    # The deepest take longest. A fit of one task is a chain of small jobs that leaves the cluster idle
    # in between, so all of them overlap; larger ones keep their rows in memory, a few at a time.
    groups = sorted(by_stages(points), key=lambda group: -group[0].get("depth", c.TREE_DEPTH))
    at_once = len(groups) if inputs.count() < 2 * pooled.TREE_TASK_ROWS else PARALLEL_FITS
    return _numbered(_in_parallel(score, groups, at_once), points)


def by_stages(points: Sequence[dict]) -> list[tuple[dict, list[int]]]:
    """Tree points that differ in the number of trees only, together: the first trees of a fit are
    those of a fit with fewer, so one fit with the most trees scores all of them.
    """
    groups: dict[tuple, list[int]] = {}
    for point in points:
        fixed = tuple((name, value) for name, value in point.items() if name != "trees")
        groups.setdefault(fixed, []).append(point["trees"])
    return [(dict(fixed), sorted(set(stages))) for fixed, stages in groups.items()]


def score_lookback(train: DataFrame, points: Sequence[dict] | None = None) -> DataFrame:
    """One-step hold-out error of the look-back regression per state and length."""
    points = lookback_grid() if points is None else points
    usable = with_enough_rows(train, c.MIN_TUNING_ROWS, F.lit(True))
    held = materialize(split_series(usable, column="holdout"))
    history = held.filter(F.col("holdout") == TRAIN)
    later = held.filter(F.col("holdout") == TEST)
    scale = materialize(pooled.lookback_scale(history))

    def score(point: dict) -> DataFrame:
        length = point["length"]
        model = pooled.fit_lookback(pooled.sequence_inputs(history, scale, length))
        scored = model.transform(pooled.sequence_inputs(later, scale, length)).join(scale, KEY)
        errors = scored.select(
            KEY,
            pooled.back_to_amount("prediction").alias("yhat"),
            pooled.unscaled(F.col("target"), "total").alias("actual"),
        )
        per_state = errors.groupBy(KEY).agg(rmse(F.col("actual"), F.col("yhat")).alias("rmse"))
        return per_state.withColumn("length", F.lit(length))

    return _numbered(_in_parallel(score, points), points)


def _in_parallel(score: Callable[..., DataFrame], points: Sequence, at_once: int = PARALLEL_FITS) -> DataFrame:
    """Scores of all points; the fits overlap so that small stages do not idle the cluster."""
    with ThreadPool(min(at_once, len(points))) as pool:
        scored = pool.map(score, points, chunksize=1)
    return reduce(DataFrame.unionByName, scored)


def pooled_choice(scores: DataFrame, parameters: Sequence[str]) -> DataFrame:
    """One row: the grid point with the smallest error summed over states.

    Each state's errors are taken relative to its best point, so large states do not decide
    alone.
    """
    best = scores.groupBy(KEY).agg(F.min("rmse").alias("least"))
    relative = F.col("rmse") / F.greatest(F.col("least"), F.lit(1e-9))
    totals = (
        scores.join(best, KEY)
        .groupBy("grid_id", *parameters)
        .agg(F.avg(relative).alias("score"))
    )
    return best_configuration(totals, "score", list(parameters), keys=())
