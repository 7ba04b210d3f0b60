"""Expanding windows: every fold's fit equals a fit of the rows before its block alone."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.models import closed_form as cf
from tideline.models import fold_fits as ff
from tideline.models import fourier, seasonal_ar
from tideline.operators import folds as fo
from tideline.plans import tuning
from tideline.plans.prepare import daily_series
from tideline.session import materialize

KEY = "state"
ORDERS = [(2, 1, 2), (1, 0, 1), (0, 0, 0)]


@pytest.fixture(scope="module")
def history(spark):
    from datetime import date, timedelta

    rows = []
    for state, n, unit in (("A", 403, 100.0), ("B", 300, 5000.0), ("C", 20, 1.0), ("D", 2, 1.0)):
        for t in range(n):
            weekly = 1.4 if t % 7 == 6 else 1.0 - 0.02 * (t % 7)
            wobble = ((t * 7919 + t * t) % 101 - 50) / 400
            rows.append((state, date(2023, 1, 1) + timedelta(days=t), unit * (1 + t / 500) * weekly * (1 + wobble), "c"))
    return materialize(daily_series(spark.createDataFrame(rows, "state string, ds date, total double, category string")))


@pytest.fixture(scope="module")
def labelled(history):
    return materialize(fo.label_segments(history))


def test_blocks_end_the_series(labelled):
    sizes = {}
    for r in labelled.groupBy(KEY, "segment").agg(F.count("*").alias("n"), F.min("ds"), F.max("ds")).collect():
        sizes.setdefault(r.state, {})[r.segment] = r.n
    assert sizes == {"A": {0: 103, 1: 100, 2: 100, 3: 100}, "B": {i: 75 for i in range(4)},
                     "C": {i: 5 for i in range(4)}, "D": {0: 2}}


def alone(labelled, fold):
    return labelled.filter(F.col("segment") < fold).select(KEY, "ds", "total", "category")


@pytest.mark.parametrize("fold", [1, 2, 3])
def test_line_of_a_fold(labelled, fold):
    found = {r.state: r for r in ff.ar1_folds(labelled).filter(F.col("fold") == fold).collect()}
    expected = {r.state: r for r in cf.fit_ar1(alone(labelled, fold)).collect()}
    assert found.keys() == expected.keys() - {"D"}
    for s, r in found.items():
        e = expected[s]
        assert (r.last_ds, r.last_total) == (e.last_ds, e.last_total)
        assert (r.phi, r.intercept) == (pytest.approx(e.phi, rel=1e-9), pytest.approx(e.intercept, rel=1e-9))


@pytest.mark.parametrize("fold", [1, 3])
def test_seasonal_fit_of_a_fold(labelled, history, fold):
    found = {(r.state, r.p, r.d, r.q): r for r in ff.seasonal_folds(history, ORDERS).filter(F.col("fold") == fold).collect()}
    expected = {(r.state, r.p, r.d, r.q): r for r in seasonal_ar.fit_grid(alone(labelled, fold), ORDERS).collect()}
    assert found.keys() == expected.keys() and len(found) == 6
    for k, r in found.items():
        e = expected[k]
        assert (r.last_ds, r.n, r.peak, r.grid_id) == (e.last_ds, e.n, e.peak, e.grid_id)
        assert r.aic == pytest.approx(e.aic, rel=1e-7)
        assert r.unit == pytest.approx(e.unit)
        for name in ("coefficients", "tail_w", "tail_e", "tail_y"):
            assert np.array(r[name]) == pytest.approx(np.array(e[name]), rel=1e-6, abs=1e-9), (k, name)


def test_seasonal_scores_are_those_of_forecasts_from_each_fold(labelled, history):
    order = (1, 0, 1)
    scores = {(r.state, r.fold): r.rmse for r in ff.score_seasonal_folds(history, [order]).collect()}
    assert scores.keys() == {(s, f) for s in "AB" for f in (1, 2, 3)}
    for fold in (1, 2, 3):
        block = labelled.filter(F.col("segment") == fold)
        fit = seasonal_ar.fit_seasonal_ar(alone(labelled, fold), order)
        steps = block.groupBy(KEY).agg(F.count("*").alias("steps"))
        paths = {r.state: r.path for r in seasonal_ar.seasonal_paths(fit, steps).collect()}
        for state in "AB":
            actual = [r.total for r in block.filter(F.col(KEY) == state).orderBy("ds").collect()]
            if paths[state] is None:
                assert scores[state, fold] == float("inf")
                continue
            error = np.maximum(paths[state], 0) - np.array(actual)
            assert scores[state, fold] == pytest.approx(np.sqrt((error**2).mean()), rel=1e-6)


@pytest.mark.parametrize("mode", fourier.SEASONALITY_MODES)
def test_trend_of_a_fold(labelled, history, mode):
    rows, fits = ff.trend_folds(history.filter("state in ('A', 'B')"), [mode], [False])
    found = {(r.state, r.fold): r for r in fits.collect()}
    assert len(found) == 6
    frame = rows.toPandas().sort_values(["state", "ds"])
    keep_all = fourier.kept_columns(False)
    for (state, fold), r in found.items():
        own = frame[(frame["state"] == state) & (frame["segment"] < fold)]
        x = fourier.design(own["t"].to_numpy(), own["day"].to_numpy())

        def ridge(target, keep):
            a = x[:, keep]
            left = a.T @ a + np.diag(fourier.PENALTY[keep])
            out = np.zeros(fourier.N_COLUMNS)
            out[keep] = np.linalg.lstsq(left, a.T @ target, rcond=None)[0]
            return out

        weights = ridge(own["y"].to_numpy(), keep_all)
        trend = x[:, : fourier.N_TREND] @ weights[: fourier.N_TREND]
        if mode != "additive":
            weights = ridge(own["y"].to_numpy() / trend - 1, fourier.kept_columns(False, trend=False))
        assert np.array(r.season) == pytest.approx(weights[fourier.N_TREND :], rel=1e-5, abs=1e-8)
        fitted = x[:, : fourier.N_TREND] @ np.array(r.trend)
        assert fitted == pytest.approx(trend, rel=1e-6)


def test_ridge_of_a_fold(labelled):
    rows = labelled.withColumns({"a": F.lag("total", 1, 1.0).over(fo.Window.partitionBy(KEY).orderBy("ds")),
                                 "b": F.sin(F.unix_date("ds").cast("double"))}).filter("state <> 'D'")
    found = ff.ridge_folds(rows, ["a", "b"]).collect()
    frame = rows.toPandas()
    assert len(found) == 9
    for r in found:
        own = frame[(frame["state"] == r.state) & (frame["segment"] < r.fold)]
        x, y = own[["a", "b"]].to_numpy(), own["total"].to_numpy()
        xc, yc = x - x.mean(axis=0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + np.eye(2), xc.T @ yc)
        assert (r.a, r.b) == (pytest.approx(w[0], rel=1e-7), pytest.approx(w[1], rel=1e-7))
        assert r.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ w, rel=1e-6)


def test_folds_choose_orders_and_trends(history):
    long = history.filter("state in ('A', 'B')")
    best = {r.state: r for r in tuning.tune_seasonal_ar_folds(long, orders=ORDERS).collect()}
    scores = {}
    for r in ff.score_seasonal_folds(long, ORDERS).collect():
        scores.setdefault((r.state, r.grid_id), []).append(r.rmse)
    for state in "AB":
        means = [np.mean(scores[state, i]) for i in range(3)]
        assert best[state].grid_id == int(np.argmin(means))
    trends = tuning.tune_trend_folds(long).collect()
    assert {r.state for r in trends} == {"A", "B"} and all(np.isfinite(r.rmse) for r in trends)


def test_no_rows(history):
    empty = history.limit(0)
    assert ff.score_ar1_folds(empty).count() == 0
    assert ff.score_seasonal_folds(empty, [(1, 0, 0)]).count() == 0
