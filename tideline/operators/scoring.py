"""Evaluation of predictions and choice of a model per series.

``predictions(state, model, ds, yhat)`` holds the output of every model in long form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.config import BASE_MODELS, MIN_BASE_MODELS, MODEL_ORDER
from tideline.functions import metrics as m
from tideline.functions.scalars import finite

KEY = "state"
METRICS = ("mae", "rmse", "mape")


def align(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Predictions next to the actual amount of the same state and day, unless they carry it."""
    if "actual" in predictions.columns:
        return predictions
    return predictions.join(
        actuals.select(KEY, "ds", F.col("total").alias("actual")), [KEY, "ds"]
    )


def metric_columns(actual: Column, yhat: Column) -> list[Column]:
    return [
        m.mae(actual, yhat).alias("mae"),
        m.rmse(actual, yhat).alias("rmse"),
        m.mape(actual, yhat).alias("mape"),
    ]


def evaluate(predictions: DataFrame, actuals: DataFrame | None = None,
             expected: DataFrame | None = None) -> DataFrame:
    """Errors per state and model; infinite where a day has no finite prediction.

    Predictions that carry their ``actual`` need no ``actuals``.

    With ``expected(state, model)`` every listed pair gets a row; a pair without predictions
    (a model that could not be fitted) scores infinity.
    """
    infinite = F.lit(float("inf"))
    whole = F.bool_and(finite(F.col("yhat")).isNotNull()).alias("whole")
    scores = (
        align(predictions, actuals)
        .groupBy(KEY, "model")
        .agg(*metric_columns(F.col("actual"), F.col("yhat")), whole)
        .select(KEY, "model", *[F.when(F.col("whole"), F.col(c)).otherwise(infinite).alias(c) for c in METRICS])
    )
    if expected is None:
        return scores
    return expected.join(scores, [KEY, "model"], "left").select(
        KEY, "model", *[F.coalesce(c, infinite).alias(c) for c in METRICS]
    )


def expected_pairs(states: DataFrame, models: Sequence[str] = MODEL_ORDER) -> DataFrame:
    """Every state with every model name."""
    names = F.array(*[F.lit(name) for name in models])
    return states.select(KEY).distinct().withColumn("model", F.explode(names))


def model_rank(model: Column) -> Column:
    """Position of a model in the fixed order that breaks ties."""
    return F.array_position(F.array(*[F.lit(name) for name in MODEL_ORDER]), model)


def select_best(scores: DataFrame, by: str = "rmse") -> DataFrame:
    """The model with the smallest error per state; ties go to the earlier model name."""
    row = F.struct("model", *METRICS)
    best = F.min_by(row, F.struct(F.col(by), model_rank(F.col("model"))))
    return scores.groupBy(KEY).agg(best.alias("best")).select(
        KEY, F.col("best.model").alias("best_model"), *[f"best.{c}" for c in METRICS]
    )


def leaderboard(scores: DataFrame, by: str = "mape") -> DataFrame:
    """Models of each state ranked by error, sorted for a report."""
    window = Window.partitionBy(KEY).orderBy(by, model_rank(F.col("model")))
    return scores.withColumn("rank", F.row_number().over(window)).orderBy(KEY, "rank")


def best_configuration(scores: DataFrame, score: str, config: Sequence[str],
                       keys: Sequence[str] = (KEY,), order: str = "grid_id") -> DataFrame:
    """The grid point with the smallest score per key; ties go to the first grid point."""
    best = F.min_by(F.struct(order, *config, score), F.struct(F.col(score), F.col(order)))
    return (
        scores.filter(F.col(score).isNotNull())
        .groupBy(*keys)
        .agg(best.alias("best"))
        .select(*keys, *[f"best.{c}" for c in (order, *config, score)])
    )


def run_summary(best: DataFrame) -> DataFrame:
    """How many states each model won."""
    return best.groupBy("best_model").agg(F.count("*").alias("n_states"))


def base_model_counts(predictions: DataFrame) -> DataFrame:
    """Number of usable base models per state."""
    return (
        predictions.filter(F.col("model").isin(list(BASE_MODELS)))
        .groupBy(KEY)
        .agg(F.countDistinct("model").alias("n_models"))
    )


def stackable_states(predictions: DataFrame, minimum: int = MIN_BASE_MODELS) -> DataFrame:
    """States with enough base models for an ensemble."""
    return base_model_counts(predictions).filter(F.col("n_models") >= minimum).select(KEY)


def meta_matrix(predictions: DataFrame, models: Sequence[str] = BASE_MODELS) -> DataFrame:
    """One column per base model, in the fixed order, for every state and day."""
    return predictions.groupBy(KEY, "ds").pivot("model", list(models)).agg(F.first("yhat"))
