"""Bad series, failed states, saved models, and requests that cannot be answered in full."""

import pytest
from pyspark.sql import functions as F

from tideline import config as c
from tideline.models import fourier, seasonal_ar
from tideline.operators import horizon as hz
from tideline.operators import scoring as so
from tideline.plans import compare, requests, training
from tideline.plans.prepare import daily_series
from tideline.session import checkpoint_dir, materialize, scratch
from tideline.sources import registry as reg
from tideline.sources.sales import to_number

KEY = "state"


def paths(predictions):
    out = {}
    for r in predictions.orderBy(KEY, "ds").collect():
        out.setdefault(r.state, []).append(r.yhat)
    return out


@pytest.mark.parametrize("bad", [float("inf"), float("nan")])
def test_one_bad_amount_leaves_the_other_series_alone(seasonal, bad):
    good = materialize(daily_series(seasonal()))
    spoilt = (F.col(KEY) == "B") & (F.col("ds") == F.lit("2023-03-01").cast("date"))
    rows = materialize(good.withColumn("total", F.when(spoilt, bad).otherwise(F.col("total"))))
    targets = hz.future_dates(hz.last_days(good), 14).select(KEY, "ds")
    for fit, predict in (
        (seasonal_ar.fit_seasonal_ar, seasonal_ar.predict_seasonal_ar),
        (fourier.fit_fourier, fourier.predict_fourier),
    ):
        expected = paths(predict(fit(good), targets))
        found = paths(predict(fit(rows), targets))
        assert found["A"] == pytest.approx(expected["A"]) and found["C"] == pytest.approx(expected["C"])
        assert all(y is not None for y in found["B"])


def test_amounts_that_are_no_numbers_are_unknown(spark, sales_of):
    texts = spark.createDataFrame([(x,) for x in ("1.5", "Infinity", "1e400", "NaN", "x", None)], "t string")
    assert [r[0] for r in texts.select(to_number(F.col("t"))).collect()] == [1.5, None, None, None, None, None]
    dense = daily_series(sales_of([("A", 0, 1.0), ("A", 1, float("inf")), ("A", 2, 3.0)]))
    assert [r.total for r in dense.orderBy("ds").collect()] == [1.0, 2.0, 3.0]


def test_diverging_path_fails_as_a_whole(seasonal):
    dense = materialize(daily_series(seasonal((("A", 400, 10.0),))))
    fit = seasonal_ar.fit_seasonal_ar(dense, largest_root=0.9, damping=0.8)
    wild = F.transform("coefficients", lambda x, i: F.when(i == 0, 3.0).otherwise(x))
    steps = hz.last_days(dense).select(KEY, F.lit(60).alias("steps"))
    assert len(seasonal_ar.seasonal_paths(fit, steps).first().path) == 60
    lost = fit.withColumn("coefficients", wild)
    assert seasonal_ar.seasonal_paths(lost, steps).first().path is None
    targets = hz.future_dates(hz.last_days(dense), 60).select(KEY, "ds")
    assert seasonal_ar.predict_seasonal_ar(lost, targets).filter("yhat is null").count() == 0


def test_root_bound_is_optional(seasonal):
    dense = materialize(daily_series(seasonal()))
    free = {r.state: r.coefficients for r in seasonal_ar.fit_seasonal_ar(dense).collect()}
    bound = {r.state: r.coefficients for r in seasonal_ar.fit_seasonal_ar(dense, largest_root=0.5).collect()}
    assert free.keys() == bound.keys() and free != bound


def test_requests_are_never_cut(spark, seasonal):
    sales = seasonal()
    run = compare.compare_models(sales, compare.Settings(models=(c.TREND, c.ARIMA)))
    asked = spark.createDataFrame(
        [("A", 12), ("A", 1), ("B", 2), ("C", -3), ("X", 5)], "state string, weeks int"
    )
    ahead = materialize(compare.forecast_requests(run, asked))
    assert {r.state: r["count"] for r in ahead.groupBy(KEY).count().collect()} == {"A": 84, "B": 14}
    out = requests.answer_requests(asked, ahead, run.sizes).collect()
    found = {(r.state, r.forecast_horizon_weeks): (r.status, len(r.forecasts)) for r in out}
    assert found == {
        ("A", 12): ("ok", 84), ("A", 1): ("ok", 7), ("B", 2): ("ok", 14),
        ("C", -3): ("bad_request", 0), ("X", 5): ("no_data", 0),
    }
    longer = spark.createDataFrame([("B", 3), ("B", 0)], "state string, weeks int")
    found = {r.forecast_horizon_weeks: (r.status, len(r.forecasts))
             for r in requests.answer_requests(longer, ahead, run.sizes).collect()}
    assert found == {3: ("beyond_horizon", 0), 0: ("ok", 0)}


def test_grown_and_failed_states_are_tried_again(spark, tmp_path, seasonal):
    settings = compare.Settings(models=(c.TREND, c.ARIMA))
    folder = str(tmp_path)
    progress = reg.Progress(spark, folder)
    training.train(spark, seasonal((("A", 300, 10.0), ("B", 30, 5.0))), folder, settings)
    assert {r.state: r.status for r in progress.completed().collect()} == {"A": "ok", "B": "skipped"}
    again = training.train(spark, seasonal((("A", 300, 10.0), ("B", 30, 5.0))), folder, settings)
    assert again.isEmpty() and progress.completed().count() == 2
    grown = seasonal((("A", 300, 10.0), ("B", 200, 5.0)))
    assert {r.state for r in training.train(spark, grown, folder, settings).collect()} == {"B"}
    progress.record(spark.createDataFrame([("Z", "failed", 9)], reg.PROGRESS_SCHEMA))
    sales = seasonal((("A", 300, 10.0), ("Z", 9, 5.0)))
    assert {r.state for r in reg.unsettled_sales(sales, progress.completed()).collect()} == {"Z"}


def test_state_without_a_finite_forecast_has_failed(spark):
    scores = spark.createDataFrame(
        [("A", "m", 1.0), ("B", "m", float("inf")), ("C", "m", 1.0), ("D", "m", 1.0)], "state string, model string, rmse double"
    )
    ahead = spark.createDataFrame(
        [("A", 1.0), ("B", 1.0), ("C", None), ("C", 1.0)], "state string, yhat double"
    )
    found = {r.state: r.status for r in training.state_status(scores, ahead).collect()}
    assert found == {"A": "ok", "B": "failed", "C": "failed", "D": "failed"}


def test_all_saved_models_score_like_fresh_ones(spark, tmp_path, seasonal):
    settings = compare.Settings(trees={"trees": 3, "depth": 3}, lookback=21)
    run = compare.compare_models(seasonal(), settings)
    registry = reg.ModelRegistry(spark, str(tmp_path))
    training.save_fits(registry, run.train_fits)
    registry.save_coefficients(c.STACKED, run.weights)
    train, test = (compare.rows_of(run.prepared, x) for x in ("train", "test"))
    fresh = {(r.state, r.model): r.rmse for r in run.scores.collect()}
    board = training.rescore(registry, train, test).collect()
    assert {(r.state, r.model) for r in board} == set(fresh)
    assert all(r.rmse == pytest.approx(fresh[r.state, r.model]) for r in board)
    assert reg.available_count(registry.entries()).first().n_states == 3
    base, meta = (compare.rows_of(run.prepared, x) for x in ("base", "meta"))
    saved = reg.ModelRegistry(spark, f"{tmp_path}/base")
    training.save_fits(saved, run.base_fits)
    again = {r.state: r.asDict() for r in training.refit_ensemble(saved, base, meta).collect()}
    for r in run.weights.collect():
        for name, value in r.asDict().items():
            assert again[r.state][name] == (value if name == KEY else pytest.approx(value))


def test_incomplete_predictions_score_infinity(spark):
    actual = spark.createDataFrame([("A", "2023-01-01", 1.0), ("A", "2023-01-02", 2.0)], "state string, ds string, total double")
    guess = spark.createDataFrame(
        [("A", "half", "2023-01-01", 1.0), ("A", "half", "2023-01-02", None), ("A", "nan", "2023-01-01", float("nan")),
         ("A", "nan", "2023-01-02", 1.0), ("A", "whole", "2023-01-01", 1.0), ("A", "whole", "2023-01-02", 1.0)],
        "state string, model string, ds string, yhat double",
    )
    found = {r.model: r.mae for r in so.evaluate(guess, actual).collect()}
    assert found == {"half": float("inf"), "nan": float("inf"), "whole": 0.5}


def test_scratch_tables_are_removed(spark):
    fs = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark)).getFileSystem(spark._jsc.hadoopConfiguration())
    with scratch(spark) as folder:
        inner = materialize(spark.range(3))
        kept = materialize(inner.filter("id > 0"), outlive=True)
        assert inner.count() == 3 and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(folder))
    assert kept.count() == 2 and not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(folder))


def test_frozen_scores_use_no_held_out_amount(seasonal):
    rows = materialize(compare.prepare(seasonal()))
    changed = materialize(rows.withColumn(
        "total", F.when(F.col("split") == "test", F.col("total") * 7 + 1).otherwise(F.col("total"))
    ))
    settings = compare.Settings(
        models=(c.TREES, c.TREND), trees={"trees": 3, "depth": 3}, tree_scores="frozen"
    )
    found = [paths(compare.compare_prepared(x, settings).predictions.filter(F.col("model") == c.TREES))
             for x in (rows, changed)]
    assert found[0] == found[1] and found[0]
