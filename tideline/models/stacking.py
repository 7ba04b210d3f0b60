"""Ridge regression on the predictions of base models, fitted per state from aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.config import BASE_MODELS, MIN_BASE_MODELS, MIN_META_ROWS, RIDGE_ALPHA, STACKED
from tideline.functions.linear import gram_columns, solve_gram
from tideline.functions.scalars import clip_negative
from tideline.operators.scoring import meta_matrix

KEY = "state"


def weight(model: str) -> str:
    return f"w_{model}"


def _flag(model: str) -> str:
    return f"has_{model}"


def fit_stack(predictions: DataFrame, actuals: DataFrame,
              models: Sequence[str] = BASE_MODELS, alpha: float = RIDGE_ALPHA) -> DataFrame:
    """Intercept and one weight per base model for every state.

    Needs the centred cross products of the meta columns only, so rows are reduced to one small
    matrix per state before anything is solved. A state uses the base models that predicted it,
    on the days all of them cover; states with fewer than two of them, or fewer than ten rows,
    get no ensemble.
    """
    state = Window.partitionBy(KEY)
    matrix = meta_matrix(predictions, models).join(
        actuals.select(KEY, "ds", "total"), [KEY, "ds"]
    )
    flagged = matrix.withColumns(
        {_flag(name): F.max(F.col(name).isNotNull()).over(state) for name in models}
    )
    aligned = flagged.filter(
        reduce(and_, [F.col(name).isNotNull() | ~F.col(_flag(name)) for name in models])
    )
    columns = [F.coalesce(F.col(name), F.lit(0.0)) for name in models] + [F.col("total")]
    sums = aligned.groupBy(KEY).agg(
        F.count("*").alias("n"),
        F.array(*[F.max(_flag(name)).cast("int") for name in models]).alias("present"),
        F.array(*[F.avg(c) for c in columns]).alias("means"),
        F.array(
            *[F.covar_samp(a, b) * (F.count("*") - 1) for a, b in gram_columns(columns)]
        ).alias("gram"),
    )
    ready = sums.filter(
        (F.col("n") >= MIN_META_ROWS)
        & (F.aggregate("present", F.lit(0), lambda a, b: a + b) >= MIN_BASE_MODELS)
    )
    solved = ready.withColumn("weights", solve_gram(len(models), [alpha] * len(models))("gram"))
    weights = [F.col("weights")[i] for i in range(len(models))]
    means = [F.col("means")[i] for i in range(len(models))]
    centre = sum((w * mean for w, mean in zip(weights, means)), F.lit(0.0))
    return solved.select(
        KEY,
        (F.col("means")[len(models)] - centre).alias("intercept"),
        *[
            F.when(F.col("present")[i] == 1, w).alias(weight(name))
            for i, (name, w) in enumerate(zip(models, weights))
        ],
    )


def predict_stack(fit: DataFrame, predictions: DataFrame,
                  models: Sequence[str] = BASE_MODELS) -> DataFrame:
    """Weighted sum of the base predictions, floored at 0.

    Days with fewer than two usable base predictions, and states without weights, get the plain
    mean of what there is, unfloored.
    """
    matrix = meta_matrix(predictions, models).join(fit, KEY, "left")
    count = sum((F.col(name).isNotNull().cast("int") for name in models), F.lit(0))
    total = sum((F.coalesce(F.col(name), F.lit(0.0)) for name in models), F.lit(0.0))
    blend: Column = F.col("intercept")
    for name in models:
        # A weight without a prediction makes the sum NULL, and the mean takes over.
        has_weight = F.col(weight(name)).isNotNull()
        blend = blend + F.when(has_weight, F.col(weight(name)) * F.col(name)).otherwise(0.0)
    stacked = F.when(count >= MIN_BASE_MODELS, clip_negative(blend))
    return matrix.select(
        KEY,
        F.lit(STACKED).alias("model"),
        "ds",
        F.coalesce(stacked, total / count).alias("yhat"),
    )


def average_predictions(predictions: DataFrame, model: str = STACKED) -> DataFrame:
    """Plain mean of all models per state and day."""
    return (
        predictions.groupBy(KEY, "ds")
        .agg(F.avg("yhat").alias("yhat"))
        .select(KEY, F.lit(model).alias("model"), "ds", "yhat")
    )
