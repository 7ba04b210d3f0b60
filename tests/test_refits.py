"""Stored sums and the new days give what a fit of the whole series gives."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.models import closed_form as cf
from tideline.models import refits, seasonal_ar
from tideline.session import materialize

KEY = "state"
ORDERS = [(2, 1, 2), (1, 0, 1)]


def series(spark, lengths):
    rows = []
    for state, n, unit in lengths:
        for t in range(n):
            weekly = 1.4 if t % 7 == 6 else 1.0 - 0.02 * (t % 7)
            rows.append((state, date(2023, 1, 1) + timedelta(days=t),
                         unit * (1 + t / 500) * weekly * (1 + ((t * 7919 + t * t) % 101 - 50) / 400)))
    return spark.createDataFrame(rows, "state string, ds date, total double")


@pytest.fixture(scope="module")
def known_and_whole(spark):
    whole = materialize(series(spark, (("A", 400, 100.0), ("B", 300, 5000.0), ("C", 90, 1.0), ("D", 5, 2.0), ("E", 120, 7.0))))
    # Cuts of different age; C is known by a few days only, D and E have not grown or are new.
    cut = F.when(F.col(KEY) == "A", "2023-12-01").when(F.col(KEY) == "B", "2023-03-01").when(
        F.col(KEY) == "C", "2023-01-12").when(F.col(KEY) == "D", "2024-01-01").otherwise("2020-01-01").cast("date")
    stored = materialize(refits.statistics(whole.filter(F.col("ds") <= cut)))
    assert {r.state for r in stored.collect()} == set("ABCD")
    return stored, whole


def test_grown_sums_fit_like_the_whole(known_and_whole):
    stored, whole = known_and_whole
    now = materialize(refits.grown(stored, whole))
    sizes = {r.state: r.n for r in whole.groupBy(KEY).agg(F.count("*").alias("n")).collect()}
    assert {r.state: r.n for r in now.collect()} == sizes
    expected = {r.state: r for r in cf.fit_ar1(whole).collect()}
    for r in refits.line_fit(now).collect():
        e = expected[r.state]
        assert (r.last_ds, r.last_total) == (e.last_ds, e.last_total)
        assert (r.phi, r.intercept) == (pytest.approx(e.phi, rel=1e-9), pytest.approx(e.intercept, rel=1e-9))
    expected = {(r.state, r.p, r.d, r.q): r for r in seasonal_ar.fit_grid(whole, ORDERS).collect()}
    found = {(r.state, r.p, r.d, r.q): r for r in refits.seasonal_fits(now, ORDERS).collect()}
    assert found.keys() == expected.keys() and len(found) == 8
    for k, r in found.items():
        e = expected[k]
        assert (r.n, r.last_ds, r.peak) == (e.n, e.last_ds, e.peak)
        assert r.unit == pytest.approx(e.unit, rel=1e-9) and r.aic == pytest.approx(e.aic, rel=1e-7)
        for name in ("tail_y", "tail_w", "tail_e", "coefficients"):
            assert np.array(r[name]) == pytest.approx(np.array(e[name]), rel=1e-6, abs=1e-9), (k, name)


def test_growing_twice_is_growing_once(known_and_whole):
    stored, whole = known_and_whole
    half = materialize(refits.grown(stored, whole.filter("ds <= date'2023-12-15'")))
    twice = {r.state: r for r in refits.line_fit(refits.grown(half, whole)).collect()}
    once = {r.state: r for r in refits.line_fit(refits.grown(stored, whole)).collect()}
    assert {s: r.phi for s, r in twice.items()} == {s: pytest.approx(r.phi, rel=1e-9) for s, r in once.items()}


def test_only_new_days_are_read(spark, tmp_path, known_and_whole):
    _, whole = known_and_whole
    long = whole.filter("state in ('A', 'B')")
    path = f"{tmp_path}/daily"
    long.withColumn("month", F.date_format("ds", "yyyy-MM")).write.partitionBy("month").parquet(path)
    stored = materialize(refits.statistics(long.filter("ds <= date'2023-10-01'")))
    daily = spark.read.parquet(path)
    later = daily.filter(F.col("ds") > F.lit(date(2023, 10, 1)))
    plan = refits.statistics(later.join(stored, KEY, "left_semi"), stored)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ds), GreaterThan(ds,2023-10-01)" in plan
    months = daily.filter("month >= '2023-10'")
    assert {r.state: r.phi for r in refits.line_fit(refits.grown(stored, months)).collect()} == {
        r.state: pytest.approx(r.phi, rel=1e-9) for r in cf.fit_ar1(long).collect()
    }
