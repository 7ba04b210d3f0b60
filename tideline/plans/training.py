"""Resumable training runs, and what can be done with the models they saved."""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline import config as c
from tideline.functions.scalars import finite
from tideline.operators.scoring import evaluate, leaderboard
from tideline.plans.compare import (
    Fits,
    Settings,
    compare_prepared,
    forecast_best,
    refit_stack,
    stacked_predictions,
)
from tideline.plans.prepare import prepare
from tideline.session import materialize, scratch
from tideline.sources.documents import forecast_documents, result_documents, write_documents
from tideline.sources.registry import (
    FAILED,
    OK,
    SKIPPED,
    ModelRegistry,
    Progress,
    unsettled_sales,
)
from tideline.sources.stages import Stages, content_of, fingerprint

KEY = "state"
FORECAST_SCHEMA = "state string, model_used string, ds date, yhat double, last_ds date"
POOLED_KINDS = {c.TREES: GBTRegressionModel, c.LOOKBACK_MODEL: LinearRegressionModel}


def save_fits(registry: ModelRegistry, fits: Fits) -> None:
    for model, table in fits.tables.items():
        registry.save_coefficients(model, table)
    for model, (fitted, scale) in fits.pooled.items():
        registry.save_pooled(model, fitted, scale)


def load_fits(registry: ModelRegistry) -> Fits:
    """All base models found in a registry; a pooled model knows its own look-back length."""
    saved = registry.models()
    pooled = {
        model: registry.load_pooled(model, kind)
        for model, kind in POOLED_KINDS.items()
        if model in saved
    }
    tables = {
        model: registry.load_coefficients(model)
        for model in c.BASE_MODELS
        if model in saved and model not in POOLED_KINDS
    }
    return Fits(tables, pooled)


def train(spark: SparkSession, sales: DataFrame, folder: str, settings: Settings | None = None,
          days: int = c.HORIZON_DAYS) -> DataFrame:
    """Compare, choose, save and forecast for every state not yet settled.

    Returns the forecasts of this run. All remaining states go through one plan. They are
    recorded last, and a batch is named after the number of records before it, so a run that
    was interrupted writes over its own leftovers. A state too short to be trained is recorded as
    ``skipped`` and tried again when it has grown, one that no model could be scored or forecast
    for as ``failed`` and tried again by the next run; when nothing is left to train, no forecast
    comes back. Intermediate tables are removed at the end.

    Preparation, every fit, weights, predictions, scores and forecasts are committed one by one:
    the same call after an interruption goes on behind the last of them. A record removes them.
    """
    with scratch(spark):
        return _train(spark, sales, folder, settings or Settings(), days)


def _train(spark: SparkSession, sales: DataFrame, folder: str, settings: Settings,
           days: int) -> DataFrame:
    progress = Progress(spark, folder)
    done = progress.completed()
    batch = f"batch={done.count():06d}"
    todo = materialize(unsettled_sales(sales, done))
    sizes = todo.groupBy(KEY).agg(F.count("*").alias("n_rows"))
    stages = Stages(spark, folder, fingerprint(content_of(todo), settings, days, batch))
    prepared = stages.table("prepared", lambda: prepare(todo))
    if prepared.isEmpty():
        progress.record(sizes.select(KEY, F.lit(SKIPPED).alias("status"), "n_rows"))
        stages.clear()
        return spark.createDataFrame([], FORECAST_SCHEMA)
    run = compare_prepared(prepared, settings, stages)
    forecasts = stages.table("forecasts", lambda: forecast_best(run, days, stages))
    forecasts = materialize(forecasts, outlive=True)
    registry = ModelRegistry(spark, f"{folder}/models/{batch}")
    save_fits(registry, run.train_fits)
    registry.save_coefficients(c.STACKED, run.weights)
    save_fits(ModelRegistry(spark, f"{folder}/base_models/{batch}"), run.base_fits)
    results = result_documents(run.scores, run.best, run.sizes)
    write_documents(results, f"{folder}/results/{batch}")
    write_documents(forecast_documents(forecasts), f"{folder}/forecasts/{batch}")
    trained = state_status(run.scores, forecasts)
    status = F.coalesce("status", F.lit(SKIPPED)).alias("status")
    progress.record(sizes.join(trained, KEY, "left").select(KEY, status, "n_rows"))
    stages.clear()
    return forecasts


def state_status(scores: DataFrame, forecasts: DataFrame) -> DataFrame:
    """``ok`` for states with a finite score and a whole forecast, else ``failed``."""
    scored = scores.groupBy(KEY).agg(F.min("rmse").alias("least"))
    whole = forecasts.groupBy(KEY).agg(F.bool_and(finite(F.col("yhat")).isNotNull()).alias("whole"))
    good = (F.col("least") < float("inf")) & F.coalesce("whole", F.lit(False))
    return scored.join(whole, KEY, "left").select(
        KEY, F.when(good, OK).otherwise(FAILED).alias("status")
    )


def rescore(registry: ModelRegistry, train_rows: DataFrame, test_rows: DataFrame,
            by: str = "mape") -> DataFrame:
    """Leaderboard of all saved models, the ensemble included, on the held-out rows."""
    fits = load_fits(registry)
    weights = registry.load_coefficients(c.STACKED)
    predictions = stacked_predictions(fits, weights, train_rows, test_rows)
    return leaderboard(evaluate(predictions, test_rows), by)


def refit_ensemble(base_registry: ModelRegistry, base_rows: DataFrame,
                   meta_rows: DataFrame) -> DataFrame:
    """New ensemble weights on top of saved base models."""
    return refit_stack(load_fits(base_registry), base_rows, meta_rows)


def overview(progress: DataFrame) -> DataFrame:
    """Number of states per status."""
    return progress.groupBy("status").agg(F.countDistinct(KEY).alias("n_states"))
