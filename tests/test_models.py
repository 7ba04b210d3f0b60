"""Invariants of fits and forecasts, scoring rules, requests, documents and the registry."""

import json
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline import config as c
from tideline.models import closed_form as cf
from tideline.models import fourier, pooled, seasonal_ar, stacking
from tideline.operators import horizon as hz
from tideline.operators import scoring as so
from tideline.plans import compare, requests, training, tuning
from tideline.plans.prepare import daily_series, prepare
from tideline.session import materialize
from tideline.sources import documents as doc
from tideline.sources import registry as reg
from tideline.sources.sales import read_sales, resolve_input

KEY = "state"


@pytest.fixture
def prepared(seasonal):
    return materialize(prepare(seasonal()))


def sides(prepared):
    return compare.rows_of(prepared, "train"), compare.rows_of(prepared, "test")


def rmse_by_state(predictions, test):
    return {r.state: r.rmse for r in so.evaluate(predictions, test).collect()}


def check_forecast(predictions, test):
    assert predictions.count() == test.count()
    assert predictions.filter(F.col("yhat").isNull() | (F.col("yhat") < 0)).count() == 0


def test_trend_models_beat_the_last_value(prepared):
    train, test = sides(prepared)
    days = test.select(KEY, "ds")
    last = rmse_by_state(cf.predict_last_value(cf.fit_last_value(train), days), test)
    for predictions in (
        cf.predict_trend_season(cf.fit_trend_season(train), days),
        fourier.predict_fourier(fourier.fit_fourier(train, yearly_options=[False]), days),
    ):
        check_forecast(predictions, test)
        scores = rmse_by_state(predictions, test)
        assert all(scores[s] < last[s] for s in last)


def test_seasonal_ar_follows_the_week(prepared):
    train, test = sides(prepared)
    days = test.select(KEY, "ds")
    # A few hundred days leave the free fit explosive; bounded, it is better than its fallback.
    fit = seasonal_ar.fit_seasonal_ar(train, largest_root=0.98, damping=0.9)
    predictions = seasonal_ar.predict_seasonal_ar(fit, days)
    check_forecast(predictions, test)
    flat = rmse_by_state(cf.predict_ar1(cf.fit_ar1(train), days), test)
    scores = rmse_by_state(predictions, test)
    assert all(scores[s] < flat[s] for s in flat)


def test_seasonal_ar_falls_back_on_short_series(sales_of):
    dense = daily_series(sales_of([("A", i, float(i % 3)) for i in range(12)]))
    targets = hz.future_dates(hz.last_days(dense), 5).select(KEY, "ds")
    fit = seasonal_ar.fit_seasonal_ar(dense)
    assert fit.filter("coefficients is not null").count() == 0
    assert seasonal_ar.predict_seasonal_ar(fit, targets).filter("yhat is not null").count() == 5


def test_order_grid_and_ties(prepared):
    train, _ = sides(prepared)
    fits = seasonal_ar.fit_grid(train, seasonal_ar.order_grid())
    assert fits.groupBy(KEY).count().filter("count = 18").count() == 3
    best = {r.state: r.aic for r in seasonal_ar.select_order(fits).collect()}
    least = {r.state: r.aic for r in fits.groupBy(KEY).agg(F.min("aic").alias("aic")).collect()}
    assert best == least


def test_cross_products_equal_direct_least_squares(spark):
    """The seasonal fit solves the same system as a plain regression on one series."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=200) / 10
    rows = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    from tideline.functions.linear import gram_sums, solve_gram

    gram = rows.agg(gram_sums([F.col(n) for n in ("a", "b", "c", "y")]).alias("g"))
    found = gram.select(solve_gram(3, [1.0] * 3)("g").alias("w")).first().w
    expected = np.linalg.solve(x.T @ x + np.eye(3), x.T @ y)
    np.testing.assert_allclose(found, expected, rtol=1e-8)


def test_stack_equals_ridge_with_free_intercept(spark, sales_of):
    rng = np.random.default_rng(2)
    base = rng.normal(100, 20, size=(40, 2))
    y = 5 + base @ [0.6, 0.3] + rng.normal(size=40)
    actual = sales_of([("A", i, float(v)) for i, v in enumerate(y)])
    days = [r.ds for r in actual.orderBy("ds").collect()]
    rows = [("A", m, d, float(base[i, j])) for j, m in enumerate((c.TREND, c.ARIMA)) for i, d in enumerate(days)]
    predictions = spark.createDataFrame(rows, "state string, model string, ds date, yhat double")
    fit = stacking.fit_stack(predictions, actual).first()
    centred = base - base.mean(axis=0)
    w = np.linalg.solve(centred.T @ centred + np.eye(2), centred.T @ (y - y.mean()))
    np.testing.assert_allclose([fit.w_Prophet, fit.w_ARIMA], w, rtol=1e-8)
    assert fit.intercept == pytest.approx(y.mean() - base.mean(axis=0) @ w)
    assert fit.w_XGBoost is None and fit.w_LSTM is None
    out = stacking.predict_stack(stacking.fit_stack(predictions, actual), predictions)
    first = out.filter(F.col("ds") == days[0]).first().yhat
    assert first == pytest.approx(max(fit.intercept + base[0] @ w, 0))


def test_single_base_model_is_averaged(spark, sales_of):
    rows = [("A", c.TREND, date(2023, 1, 1), -4.0)]
    predictions = spark.createDataFrame(rows, "state string, model string, ds date, yhat double")
    none = stacking.fit_stack(predictions, sales_of([("A", 0, 1.0)]))
    assert none.count() == 0
    assert stacking.predict_stack(none, predictions).first().yhat == -4.0


def test_trees_beat_the_last_value_on_known_lags(prepared):
    train, test = sides(prepared)
    scale = materialize(pooled.amount_scale(train))
    model = pooled.fit_trees(pooled.tree_inputs(train, scale), trees=5, depth=4, step=0.3)
    predictions = pooled.predict_trees(model, scale, test)
    check_forecast(predictions, test)


def test_lookback_forecast_settles_after_its_window(prepared):
    train, test = sides(prepared)
    scale = materialize(pooled.lookback_scale(train))
    model = pooled.fit_lookback(pooled.sequence_inputs(train, scale, 21))
    predictions = pooled.predict_lookback(model, scale, train, test)
    check_forecast(predictions, test)
    rows = predictions.filter("state = 'A'").orderBy("ds").collect()
    assert len({round(r.yhat, 6) for r in rows[22:]}) == 1


def test_amount_recursion_equals_a_loop(prepared):
    train, test = sides(prepared)
    scale = materialize(pooled.amount_scale(train))
    model = pooled.fit_lookback(pooled.amount_sequences(train, scale, 7))
    predictions = pooled.predict_amounts(model, scale, train, test)
    check_forecast(predictions, test)
    found = [r.yhat for r in predictions.filter("state = 'B'").orderBy("ds").collect()]
    y = [r.total for r in train.filter("state = 'B'").orderBy("ds").collect()]
    low, width = min(y), max(y) - min(y)
    path = [(v - low) / width for v in y]
    for _ in found:
        path.append(float(np.dot(model.coefficients.toArray(), path[-7:])) + model.intercept)
    expected = [max(v * width + low, 0) for v in path[len(y):]]
    np.testing.assert_allclose(found, expected, rtol=1e-9)


def test_metrics_with_zero_actuals(spark, sales_of):
    actual = sales_of([("A", 0, 0.0), ("A", 1, 0.0), ("B", 0, 0.0), ("B", 1, 4.0)])
    predictions = actual.select(KEY, F.lit("ARIMA").alias("model"), "ds", F.lit(3.0).alias("yhat"))
    found = {r.state: r for r in so.evaluate(predictions, actual).collect()}
    assert found["A"].mape == float("inf") and found["B"].mape == 25.0
    assert found["B"].mae == 2.0 and found["B"].rmse == pytest.approx(5**0.5)


SCORES = "state string, model string, mae double, rmse double, mape double"


def test_ties_and_failed_models(spark):
    inf = float("inf")
    scores = spark.createDataFrame(
        [("A", "Prophet", 1.0, 2.0, 3.0), ("A", "ARIMA", 1.0, 2.0, 4.0), ("A", "LSTM", inf, inf, inf)],
        SCORES,
    )
    assert so.select_best(scores).first().best_model == "ARIMA"
    assert so.select_best(scores, "mape").first().best_model == "Prophet"
    assert [r.model for r in so.leaderboard(scores).collect()] == ["Prophet", "ARIMA", "LSTM"]


def test_winner_depends_on_the_metric(spark):
    # Published scores of one state.
    scores = spark.createDataFrame(
        [("Georgia", "XGBoost", 0.0, 3793132.0, 0.59), ("Georgia", "StackedEnsemble", 0.0, 3864541.0, 0.58)],
        SCORES,
    )
    assert so.select_best(scores, "rmse").first().best_model == "XGBoost"
    assert so.select_best(scores, "mape").first().best_model == "StackedEnsemble"


def test_missing_models_score_infinity(spark, sales_of):
    actual = sales_of([("A", 0, 1.0)])
    predictions = actual.select(KEY, F.lit("ARIMA").alias("model"), "ds", F.lit(1.0).alias("yhat"))
    found = so.evaluate(predictions, actual, so.expected_pairs(actual)).collect()
    assert {r.model: r.rmse for r in found if r.rmse == 0} == {"ARIMA": 0.0}
    assert sum(r.rmse == float("inf") for r in found) == 4


def test_grid_ties_go_to_the_first_point(spark):
    scores = spark.createDataFrame(
        [("A", 2, 7, 1.0), ("A", 1, 8, 1.0), ("A", 0, 9, None)],
        "state string, grid_id int, size int, score double",
    )
    assert so.best_configuration(scores, "score", ["size"]).first()["size"] == 8


def test_requests(spark, sales_of):
    sales = sales_of([("A", 0, 1.0), ("B", 0, 1.0)])
    forecasts = hz.future_dates(hz.last_days(sales.filter("state = 'A'")), 56).select(
        KEY, "ds", F.lit(2.0).alias("yhat"), F.lit("ARIMA").alias("model_used")
    )
    asked = spark.createDataFrame([("A", 1), ("A", None), ("B", 2), ("X", 2)], "state string, weeks int")
    out = requests.answer_requests(asked, forecasts, sales).collect()
    found = {(r.state, r.forecast_horizon_weeks): (r.status, len(r.forecasts)) for r in out}
    assert found == {
        ("A", 1): ("ok", 7), ("A", 8): ("ok", 56), ("B", 2): ("no_model", 0), ("X", 2): ("no_data", 0)
    }
    first = next(r for r in out if r.status == "ok").forecasts[0]
    assert (first.date, first.predicted_sales) == ("2023-01-02T00:00:00", 2.0)


def test_documents_round_trip(spark, tmp_path):
    scores = spark.createDataFrame(
        [("New York", "ARIMA", 1.0, 2.0, float("inf")), ("New York", "LSTM", 3.0, 4.0, 5.0)], SCORES
    )
    sizes = spark.createDataFrame([("New York", 8, 2)], "state string, train_size long, test_size long")
    documents = doc.result_documents(scores, so.select_best(scores), sizes)
    doc.write_documents(documents, str(tmp_path / "results"))
    back = doc.flatten_results(doc.read_documents(spark, str(tmp_path / "results")))
    found = {(r.model, r.rmse, r.mape) for r in back.collect()}
    assert found == {("ARIMA", 2.0, None), ("LSTM", 4.0, 5.0)}


def test_nested_document(spark, tmp_path):
    text = {"Ohio": {"best_model": "ARIMA", "metrics": {"ARIMA": {"mae": 1.0, "rmse": 2.0, "mape": 3.0}}}}
    (tmp_path / "r.json").write_text(json.dumps(text, indent=2))
    rows = doc.fill_sizes(doc.read_nested_document(spark, str(tmp_path / "r.json"))).first()
    assert (rows.state, rows.train_size, rows.test_size) == ("Ohio", 1429, 358)


def test_forecast_documents_keep_date_order(spark, sales_of):
    rows = sales_of([("A", i, float(i)) for i in (2, 0, 1)]).select(
        KEY, "ds", F.col("total").alias("yhat"), F.lit("ARIMA").alias("model_used"),
        F.lit(date(2022, 12, 31)).alias("last_ds"),
    )
    document = doc.forecast_documents(rows).first()
    assert document.predictions == [0.0, 1.0, 2.0]
    assert document.dates[0] == "2023-01-01 00:00:00"
    assert document.last_training_date == "2022-12-31T00:00:00"
    assert doc.unfold_forecasts(doc.forecast_documents(rows)).count() == 3


def test_read_sales_formats_and_input_choice(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "sales.csv").write_text("State,Date,Total,Category\nA,2023-01-01,5,x\nA,2023-01-02,bad,x\n")
    (tmp_path / "in" / "~$sales.csv").write_text("lock")
    folder = str(tmp_path / "in")
    path = resolve_input(spark, folder, "absent.csv", "*.csv")
    assert path.endswith("/sales.csv")
    rows = read_sales(spark, path, "csv").orderBy("ds").collect()
    assert [(r.total, r.category) for r in rows] == [(5.0, "x"), (None, "x")]
    (tmp_path / "in" / "other.csv").write_text("x")
    with pytest.raises(FileNotFoundError):
        resolve_input(spark, folder, "absent.csv", "*.csv")
    assert resolve_input(spark, folder, "other.csv", "*.csv").endswith("/other.csv")


def test_training_run_resumes(spark, tmp_path, seasonal):
    sales = seasonal((("A", 300, 10.0), ("B", 300, 20.0), ("tiny", 20, 1.0)))
    settings = compare.Settings(models=(c.TREND, c.ARIMA))
    folder = str(tmp_path)
    first = training.train(spark, sales.filter("state <> 'B'"), folder, settings)
    assert {r.state for r in first.collect()} == {"A"} and first.count() == 56
    progress = reg.Progress(spark, folder)
    status = {r.state: r.status for r in progress.completed().collect()}
    assert status == {"A": "ok", "tiny": "skipped"}
    counts = {r.status: r.n_states for r in training.overview(progress.completed()).collect()}
    assert counts == {"ok": 1, "skipped": 1}
    second = training.train(spark, sales, folder, settings)
    assert {r.state for r in second.collect()} == {"B"}
    assert training.train(spark, sales, folder, settings).isEmpty()
    results = doc.read_documents(spark, f"{folder}/results")
    assert {r.state for r in results.collect()} == {"A", "B"}
    saved = reg.ModelRegistry(spark, f"{folder}/models/batch=000002")
    assert saved.models() == {c.TREND, c.ARIMA, c.STACKED}
    assert [r.state for r in reg.available_states(saved.entries(), c.ARIMA).collect()] == ["B"]


def test_saved_models_score_like_fresh_ones(spark, tmp_path, seasonal):
    run = compare.compare_models(seasonal(), compare.Settings(models=(c.TREND, c.ARIMA)))
    registry = reg.ModelRegistry(spark, str(tmp_path))
    training.save_fits(registry, run.train_fits)
    registry.save_coefficients(c.STACKED, run.weights)
    train, test = sides(run.prepared)
    board = training.rescore(registry, train, test)
    fresh = {(r.state, r.model): r.rmse for r in run.scores.collect()}
    for r in board.collect():
        assert r.rmse == pytest.approx(fresh[r.state, r.model])


def test_all_models_end_to_end(spark, seasonal):
    settings = compare.Settings(trees={"trees": 3, "depth": 3}, lookback=21)
    run = compare.compare_models(seasonal(), settings)
    assert run.scores.count() == 3 * 5
    assert run.scores.filter(F.col("rmse") == float("inf")).count() == 0
    forecasts = compare.forecast_best(run, 14)
    counts = {r.state: r["count"] for r in forecasts.groupBy(KEY).count().collect()}
    assert counts == {"A": 14, "B": 14, "C": 14}
    assert forecasts.filter("ds <= last_ds or yhat < 0").count() == 0


def test_tuning(prepared):
    train, _ = sides(prepared)
    trend = tuning.tune_trend(train).collect()
    assert len(trend) == 3 and {r.grid_id for r in trend} <= {0, 1, 2, 3}
    points = [{"depth": 2, "step": 0.3, "trees": 2, "row_share": 0.8}, {"depth": 3, "step": 0.3, "trees": 4, "row_share": 0.8}]
    scores = materialize(tuning.score_trees(train, points))
    assert scores.count() == 6
    assert tuning.pooled_choice(scores, tuning.TREE_PARAMETERS).count() == 1
    lengths = tuning.score_lookback(train)
    assert {r.length for r in lengths.collect()} == {21, 30}


def test_tuned_run(seasonal):
    settings = compare.Settings(models=(c.TREND, c.ARIMA), tune=True)
    run = compare.compare_models(seasonal(), settings)
    assert run.best.count() == 3
