"""Fit all models on all series, stack them, score them, choose, and forecast."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline import config as c
from tideline.models import fourier, pooled, seasonal_ar, seasonal_arma, stacking
from tideline.models.closed_form import predict_constant
from tideline.models.tree_arrays import recursive_forecast, tree_arrays
from tideline.operators.horizon import (
    appended_future,
    frozen_future,
    frozen_over,
    future_dates,
    last_days,
)
from tideline.operators.scoring import evaluate, expected_pairs, select_best, stackable_states
from tideline.operators.split import TEST, TRAIN, split_sizes
from tideline.plans import tuning
from tideline.plans.prepare import prepare
from tideline.session import materialize
from tideline.sources.stages import Unkept

KEY = "state"


@dataclass(frozen=True)
class Settings:
    """Hyper-parameters of one run; ``tune`` replaces them by the winners of the grids.

    Trees are scored one step ahead with ``tree_scores="true_lags"``; with ``"frozen"`` or
    ``"recursive"`` they forecast from the end of training like all other models. ``tree_ahead``
    says how they forecast beyond the data: ``"frozen"`` keeps lags and rolling values at the last
    known ones (inside an ensemble: carries them on), ``"recursive"`` feeds predictions back.
    """

    arima_order: tuple[int, int, int] = c.ARIMA_ORDER
    arima_largest_root: float | None = None
    arima_damping: float = 1.0
    arima_multiplicative: bool = False
    mode: str = "multiplicative"
    yearly: bool = True
    lookback: int = c.LOOKBACK
    trees: dict = field(default_factory=lambda: {"trees": c.TREE_COUNT})
    tune: bool = False
    tree_scores: str = "true_lags"
    tree_ahead: str = "frozen"
    models: tuple[str, ...] = c.BASE_MODELS
    select_by: str = "rmse"


@dataclass(frozen=True)
class Fits:
    """Fitted base models by name: a coefficient table, or a pooled model with its scale table."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    pooled: dict[str, tuple] = field(default_factory=dict)


@dataclass(frozen=True)
class Comparison:
    """One run: fits, predictions of the held-out rows, scores and winners per state."""

    prepared: DataFrame
    settings: Settings
    base_fits: Fits
    train_fits: Fits
    weights: DataFrame
    predictions: DataFrame
    scores: DataFrame
    best: DataFrame
    sizes: DataFrame


def tuned(settings: Settings, train: DataFrame, stages: Unkept) -> Settings:
    """Settings of the pooled models after their grids; two single rows reach the driver.

    The seasonal and trend models are tuned per state inside ``fit_bases``.
    """
    changes: dict = {}
    if c.TREES in settings.models:
        scores = stages.table("tree_scores", lambda: tuning.score_trees(train))
        row = tuning.pooled_choice(scores, tuning.TREE_PARAMETERS).first()
        if row:
            changes["trees"] = {name: row[name] for name in tuning.TREE_PARAMETERS}
    if c.LOOKBACK_MODEL in settings.models:
        scores = stages.table("lookback_scores", lambda: tuning.score_lookback(train))
        row = tuning.pooled_choice(scores, ("length",)).first()
        if row:
            changes["lookback"] = row["length"]
    return replace(settings, **changes)


def seasonal_fit(history: DataFrame, settings: Settings) -> DataFrame:
    if settings.arima_multiplicative:
        orders = seasonal_ar.order_grid() if settings.tune else [settings.arima_order]
        return seasonal_ar.with_fallback(seasonal_arma.tune(history, orders), history, settings.arima_damping)
    if settings.tune:
        chosen = tuning.tune_seasonal_ar(history, settings.arima_largest_root)
        return seasonal_ar.with_fallback(chosen, history, settings.arima_damping)
    return seasonal_ar.fit_seasonal_ar(
        history, settings.arima_order, settings.arima_largest_root, settings.arima_damping
    )


def trend_fit(history: DataFrame, settings: Settings) -> DataFrame:
    if not settings.tune:
        return fourier.fit_fourier(history, [settings.mode], [settings.yearly])
    chosen = tuning.tune_trend(history).select(KEY, "mode", "yearly")
    return fourier.fit_fourier_grid(history).join(chosen, [KEY, "mode", "yearly"])


def fit_bases(history: DataFrame, settings: Settings, stages: Unkept | None = None,
              name: str = "fit") -> Fits:
    """Fit the base models of ``settings`` on all series of ``history`` at once.

    Every model is a stage of its own, called ``name`` and the model's.
    """
    stages = stages or Unkept()
    tables, fitted = {}, {}
    if c.TREES in settings.models:
        scale = stages.table(f"{name}_{c.TREES}_scale", lambda: pooled.amount_scale(history))
        fitted[c.TREES] = (
            stages.pooled(
                f"{name}_{c.TREES}", GBTRegressionModel,
                lambda: pooled.fit_trees(pooled.tree_inputs(history, scale), **settings.trees),
            ),
            scale,
        )
    if c.TREND in settings.models:
        tables[c.TREND] = stages.table(f"{name}_{c.TREND}", lambda: trend_fit(history, settings))
    if c.ARIMA in settings.models:
        tables[c.ARIMA] = stages.table(f"{name}_{c.ARIMA}", lambda: seasonal_fit(history, settings))
    if c.LOOKBACK_MODEL in settings.models:
        ranges = stages.table(f"{name}_{c.LOOKBACK_MODEL}_scale", lambda: pooled.lookback_scale(history))
        fitted[c.LOOKBACK_MODEL] = (
            stages.pooled(
                f"{name}_{c.LOOKBACK_MODEL}", LinearRegressionModel,
                lambda: pooled.fit_lookback(pooled.sequence_inputs(history, ranges, settings.lookback)),
            ),
            ranges,
        )
    return Fits(tables, fitted)


def predict_bases(fits: Fits, history: DataFrame, targets: DataFrame,
                  tree_rows: DataFrame | None = None, recursive: bool = False) -> DataFrame:
    """Predictions of every fitted base model for ``targets(state, ds)``.

    Forecasts start after the last row of ``history``. ``tree_rows`` are the feature rows the
    trees score; by default the targets themselves. ``recursive`` trees need no feature rows.
    """
    days = targets.select(KEY, "ds")
    parts = []
    if c.TREES in fits.pooled:
        model, scale = fits.pooled[c.TREES]
        if recursive:
            arrays = tree_arrays(model, history.sparkSession)
            parts.append(recursive_forecast(arrays, scale, history, days))
        else:
            rows = targets if tree_rows is None else tree_rows
            parts.append(pooled.predict_trees(model, scale, rows))
    if c.TREND in fits.tables:
        parts.append(fourier.predict_fourier(fits.tables[c.TREND], days))
    if c.ARIMA in fits.tables:
        parts.append(seasonal_ar.predict_seasonal_ar(fits.tables[c.ARIMA], days))
    if c.LOOKBACK_MODEL in fits.pooled:
        model, scale = fits.pooled[c.LOOKBACK_MODEL]
        parts.append(pooled.predict_lookback(model, scale, history, days))
    return reduce(DataFrame.unionByName, parts)


def rows_of(prepared: DataFrame, label: str) -> DataFrame:
    """Rows of one side of the split (train, test) or one part of it (base, meta)."""
    column = "split" if label in (TRAIN, TEST) else "part"
    return prepared.filter(F.col(column) == label)


def compare_models(sales: DataFrame, settings: Settings | None = None) -> Comparison:
    """Score all models on the last fifth of every series and pick a winner per state."""
    return compare_prepared(materialize(prepare(sales)), settings or Settings())


def compare_prepared(prepared: DataFrame, settings: Settings, stages: Unkept | None = None) -> Comparison:
    """The comparison on an already prepared and kept table with at least one series.

    The stacking weights come from base models that have not seen the rows they are fitted on:
    those are trained on the first part of the training rows and predict the rest of it. What
    ``stages`` has committed is not computed again.
    """
    stages = stages or Unkept()
    train, test = rows_of(prepared, TRAIN), rows_of(prepared, TEST)
    base, meta = rows_of(prepared, "base"), rows_of(prepared, "meta")
    if settings.tune:
        settings = tuned(settings, train, stages)
    # Neither waits for the other, and a boosted fit is a long chain of small jobs.
    with ThreadPool(2) as pool:
        base_fits, train_fits = pool.map(
            lambda part: fit_bases(part[0], settings, stages, part[1]), ((base, "base"), (train, "train"))
        )
    weights = stages.table("weights", lambda: refit_stack(base_fits, base, meta))
    frozen = settings.tree_scores == "frozen"
    tree_rows = frozen_over(train.select(KEY, "ds", "total", "category"), test) if frozen else None
    recursive = settings.tree_scores == "recursive"
    predictions = stages.table(
        "predictions", lambda: stacked_predictions(train_fits, weights, train, test, tree_rows, recursive)
    )
    models = [m for m in c.MODEL_ORDER if m in (*settings.models, c.STACKED)]
    scores = stages.table("scores", lambda: evaluate(predictions, test, expected_pairs(prepared, models)))
    best = select_best(scores, settings.select_by)
    return Comparison(
        prepared, settings, base_fits, train_fits, weights, predictions, scores, best,
        split_sizes(prepared),
    )


def refit_stack(fits: Fits, base: DataFrame, meta: DataFrame) -> DataFrame:
    """Ensemble weights from fitted base models; states with fewer than two are skipped."""
    on_meta = materialize(predict_bases(fits, base, meta))
    usable = on_meta.join(stackable_states(on_meta), KEY, "left_semi")
    return stacking.fit_stack(usable, meta)


def stacked_predictions(fits: Fits, weights: DataFrame, history: DataFrame, targets: DataFrame,
                        tree_rows: DataFrame | None = None, recursive: bool = False) -> DataFrame:
    """Base predictions plus those of the ensemble, the latter where it could be fitted."""
    on_targets = materialize(predict_bases(fits, history, targets, tree_rows, recursive))
    stacked = stacking.predict_stack(weights, on_targets)
    return on_targets.unionByName(stacked.join(weights.select(KEY), KEY, "left_semi"))


def forecast_best(run: Comparison, days: int | DataFrame = c.HORIZON_DAYS,
                  stages: Unkept | None = None) -> DataFrame:
    """The next days of every state from its winner, refitted on all rows.

    ``days`` is one number for all states, or a table ``(state, days)`` with a horizon for each;
    states it does not list get no forecast. Unless they are to be recursive, trees score frozen
    features where they win alone, and appended ones inside an ensemble. Only the base models some
    state needs are refitted.
    """
    dense = run.prepared.select(KEY, "ds", "total", "category")
    ends = last_days(dense)
    if isinstance(days, DataFrame):
        dense = dense.join(days.select(KEY), KEY, "left_semi")
        reach = days.agg(F.max("days")).first()[0] or 0
        own = ends.join(days.select(KEY, "days"), KEY)
        targets = future_dates(own, F.col("days")).select(KEY, "ds")
    else:
        reach = days
        targets = future_dates(ends, days).select(KEY, "ds")
    winners = {row.best_model for row in run.best.select("best_model").distinct().collect()}
    needed = [m for m in run.settings.models if m in winners or c.STACKED in winners]
    settings = replace(run.settings, models=tuple(needed))

    def won_by(df: DataFrame, model: str) -> DataFrame:
        states = run.best.filter(F.col("best_model") == model).select(KEY)
        return df.join(states, KEY, "left_semi")

    tree_rows = won_by(frozen_future(dense, reach).drop("step"), c.TREES).unionByName(
        won_by(appended_future(dense, reach), c.STACKED)
    ).join(targets, [KEY, "ds"], "left_semi")
    fits = fit_bases(run.prepared, settings, stages, "whole")
    recursive = settings.tree_ahead == "recursive"
    base = materialize(predict_bases(fits, run.prepared, targets, tree_rows, recursive))
    stacked = stacking.predict_stack(run.weights, won_by(base, c.STACKED))
    return pick_winner(base.unionByName(stacked), run.best).join(ends, KEY)


def forecast_requests(run: Comparison, requests: DataFrame) -> DataFrame:
    """Forecasts as far as the longest valid request of each state goes."""
    weeks = F.coalesce("weeks", F.lit(c.HORIZON_WEEKS))
    days = requests.groupBy(KEY).agg(F.max(weeks * c.DAYS_PER_WEEK).alias("days"))
    return forecast_best(run, materialize(days.filter("days > 0")))


def pick_winner(predictions: DataFrame, best: DataFrame) -> DataFrame:
    """Each state's forecast by its best model."""
    chosen = best.select(KEY, F.col("best_model").alias("model"))
    return predictions.join(chosen, [KEY, "model"]).withColumnRenamed("model", "model_used")


def failed_predictions(targets: DataFrame, model: str) -> DataFrame:
    """What a model that could not be fitted predicts: 0 everywhere."""
    return predict_constant(targets, model, 0.0)
