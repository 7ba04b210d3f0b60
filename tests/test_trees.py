"""Tree ensembles as arrays: equal to the library's scoring, in stages, and fed back day by day."""

from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tideline import config as c
from tideline.models import pooled
from tideline.models import tree_arrays as ta
from tideline.operators import horizon as hz
from tideline.plans import compare, tuning
from tideline.plans.prepare import daily_series, prepare
from tideline.session import materialize

KEY = "state"


@pytest.fixture(scope="module")
def fitted(spark):
    from datetime import date

    rows = []
    for state, n, unit in (("A", 400, 100.0), ("B", 300, 5000.0), ("C", 45, 1.0)):
        for t in range(n):
            weekly = 1.4 if t % 7 == 6 else 1.0 - 0.02 * (t % 7)
            rows.append((state, date(2023, 1, 1) + timedelta(days=t), unit * (1 + t / 500) * weekly
                         * (1 + ((t * 7919) % 101 - 50) / 1000), "c"))
    sales = spark.createDataFrame(rows, "state string, ds date, total double, category string")
    dense = materialize(daily_series(sales))
    featured = materialize(pooled.ensure_features(dense))
    scale = materialize(pooled.amount_scale(featured))
    inputs = materialize(pooled.tree_inputs(featured, scale))
    model = pooled.fit_trees(inputs, trees=12, depth=4)
    return dense, scale, inputs, model


def test_arrays_predict_like_the_library(spark, fitted):
    _, _, inputs, model = fitted
    arrays = ta.tree_arrays(model, spark)
    rows = model.transform(inputs).select(vector_to_array("inputs").alias("x"), "prediction").toPandas()
    found = arrays.predict(np.stack(rows["x"]))
    assert found == pytest.approx(rows["prediction"].to_numpy(), rel=1e-12)
    assert arrays.depth <= 4 and len(arrays.root) == 12


def test_first_trees_of_a_fit_are_a_smaller_fit(spark, fitted):
    _, _, inputs, model = fitted
    small = ta.tree_arrays(pooled.fit_trees(inputs, trees=5, depth=4), spark)
    rows = inputs.select(vector_to_array("inputs").alias("x")).toPandas()
    x = np.stack(rows["x"])
    staged = ta.tree_arrays(model, spark).staged(x, [5, 12])
    assert staged[:, 0] == pytest.approx(small.predict(x), rel=1e-12)
    assert not np.allclose(staged[:, 0], staged[:, 1])
    column = ta.staged_predictions(ta.tree_arrays(model, spark), F.col("x"), [5, 12], spark)
    out = inputs.select(vector_to_array("inputs").alias("x")).select("x", column.alias("s")).toPandas()
    again = ta.tree_arrays(model, spark).staged(np.stack(out["x"]), [5, 12])
    assert np.stack(out["s"]) == pytest.approx(again)


def test_staged_scores_equal_separate_fits(seasonal):
    train = compare.rows_of(materialize(prepare(seasonal())), "train")
    points = [{"depth": 3, "step": 0.2, "trees": n, "row_share": 0.8} for n in (2, 6)]
    both = {(r.state, r.trees): (r.rmse, r.grid_id) for r in tuning.score_trees(train, points).collect()}
    for i, point in enumerate(points):
        alone = {r.state: r.rmse for r in tuning.score_trees(train, [point]).collect()}
        assert {s: both[s, point["trees"]] for s in alone} == {
            s: (pytest.approx(x, rel=1e-9), i) for s, x in alone.items()
        }
    groups = tuning.by_stages(tuning.tree_grid())
    assert len(groups) == 18 and all(stages == [100, 200] for _, stages in groups)


def test_small_fits_all_overlap_and_the_deepest_start_first(seasonal, monkeypatch):
    train = compare.rows_of(materialize(prepare(seasonal())), "train")
    seen = []

    def recorded(score, groups, at_once=tuning.PARALLEL_FITS):
        seen.append(([fixed["depth"] for fixed, _ in groups], at_once))
        return score(groups[-1])

    monkeypatch.setattr(tuning, "_in_parallel", recorded)
    points = [{"depth": d, "step": s, "trees": 1, "row_share": 0.8} for d in (1, 2, 3) for s in (0.1, 0.2, 0.3)]
    tuning.score_trees(train, points)
    monkeypatch.setattr(pooled, "TREE_TASK_ROWS", 1)
    tuning.score_trees(train, points)
    deepest_first = [3] * 3 + [2] * 3 + [1] * 3
    assert seen == [(deepest_first, 9), (deepest_first, tuning.PARALLEL_FITS)]


def test_recursion_equals_a_loop_over_library_predictions(spark, fitted):
    dense, scale, _, model = fitted
    days = 9
    arrays = ta.tree_arrays(model, spark)
    found = {(r.state, r.ds): r.yhat for r in ta.recursive_future(arrays, scale, dense, days).collect()}
    rows = dense.select(KEY, "ds", "total", "category")
    for _ in range(days):
        rows = materialize(rows)
        step = pooled.predict_trees(model, scale, hz.appended_future(rows, 1))
        step = step.select(KEY, "ds", F.col("yhat").alias("total"), F.lit("c").alias("category"))
        rows = rows.unionByName(step)
    last = dense.groupBy(KEY).agg(F.max("ds").alias("last_ds"))
    expected = {(r.state, r.ds): r.total for r in rows.join(last, KEY).filter("ds > last_ds").collect()}
    assert len(expected) == 3 * days and found.keys() == expected.keys()
    assert found == {k: pytest.approx(v, rel=1e-9) for k, v in expected.items()}


def test_targets_are_forecast_from_the_end_of_their_history(spark, fitted):
    dense, scale, _, model = fitted
    arrays = ta.tree_arrays(model, spark)
    whole = {(r.state, r.ds): r.yhat for r in ta.recursive_future(arrays, scale, dense, 6).collect()}
    later = dense.groupBy(KEY).agg(F.max("ds").alias("d")).filter("state <> 'B'")
    targets = later.select(KEY, F.explode(F.array(F.date_add("d", 2), F.date_add("d", 6), F.col("d"))).alias("ds"))
    unknown = spark.createDataFrame([("X",)], "state string").select(KEY, F.lit("2030-01-01").cast("date").alias("ds"))
    found = ta.recursive_forecast(arrays, scale, dense, targets.unionByName(unknown)).collect()
    assert len(found) == 4 and all(r.yhat == pytest.approx(whole[r.state, r.ds]) for r in found)


def test_short_and_infinite_series(spark, sales_of):
    stump = ta.grown_from(pd.DataFrame({
        "tree": [0, 0, 0], "id": [0, 1, 2], "value": [0.0, 0.25, 0.75], "left": [1, -1, -1],
        "right": [2, -1, -1], "feature": [c.FEATURES.index("lag_1"), -1, -1], "threshold": [0.5, None, None],
    }), [1.0])
    rows = sales_of([("A", 0, 1.0), ("A", 1, 5.0), ("B", 0, 3.0), ("C", 0, 1.0), ("C", 1, float("inf")), ("C", 2, 2.0)])
    scale = pooled.amount_scale(rows)
    out = {}
    for r in ta.recursive_future(stump, scale, rows, 3).orderBy(KEY, "ds").collect():
        out.setdefault(r.state, []).append(r.yhat)
    # A: from 5 (scaled 1) to 0.75 of the range, which stays above the split.
    assert out["A"] == [4.0, 4.0, 4.0] and out["B"] == [3.25, 3.25, 3.25]
    assert len(out["C"]) == 3
    empty = rows.limit(0)
    assert ta.recursive_future(stump, pooled.amount_scale(empty), empty, 3).count() == 0


def test_recursive_runs_use_no_held_out_amount(seasonal):
    rows = materialize(prepare(seasonal()))
    changed = materialize(rows.withColumn(
        "total", F.when(F.col("split") == "test", F.col("total") * 7 + 1).otherwise(F.col("total"))
    ))
    settings = compare.Settings(models=(c.TREES, c.TREND), trees={"trees": 3, "depth": 3},
                                tree_scores="recursive", tree_ahead="recursive")
    found = []
    for x in (rows, changed):
        run = compare.compare_prepared(x, settings)
        trees = run.predictions.filter(F.col("model") == c.TREES).orderBy(KEY, "ds").collect()
        found.append([(r.state, r.ds, pytest.approx(r.yhat)) for r in trees])
    assert [(s, d, y.expected) for s, d, y in found[0]] == found[1] and found[0]
    ahead = compare.forecast_best(run, days=4)
    assert ahead.filter("yhat is not null").count() == 12
