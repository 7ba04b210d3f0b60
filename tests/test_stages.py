"""An interrupted training run goes on where it stopped."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tideline import config as c
from tideline.models import fourier, pooled
from tideline.plans import compare, training
from tideline.sources import registry as reg
from tideline.sources import stages as st

SETTINGS = compare.Settings(models=(c.TREES, c.TREND, c.ARIMA), trees={"trees": 3, "depth": 3})
SERIES = (("A", 300, 10.0), ("B", 200, 5.0), ("C", 20, 1.0))


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def rows(df):
    return sorted((r.state, r.ds, r.model_used, round(r.yhat, 6)) for r in df.collect())


class Stop(Exception):
    pass


def test_only_later_stages_run_again(spark, tmp_path, seasonal, monkeypatch):
    sales = seasonal(SERIES)
    whole, parted = str(tmp_path / "whole"), str(tmp_path / "parted")
    before = jobs(spark)
    expected = rows(training.train(spark, sales, whole, SETTINGS))
    all_jobs = jobs(spark) - before

    def stop(*_):
        raise Stop

    with monkeypatch.context() as m:
        m.setattr(compare, "refit_stack", stop)
        before = jobs(spark)
        with pytest.raises(Stop):
            training.train(spark, sales, parted, SETTINGS)
        first_jobs = jobs(spark) - before
    assert reg.Progress(spark, parted).completed().isEmpty()
    home = next((tmp_path / "parted" / "stages").iterdir())
    names = {p.name for p in (home / "committed").iterdir() if p.name.endswith(".json")}
    fitted = {f"{part}_{m}.json" for part in ("base", "train") for m in (c.TREES, c.TREND, c.ARIMA)}
    assert fitted < names and "weights.json" not in names

    fits = []
    for module, name in ((pooled, "fit_trees"), (fourier, "fit_fourier")):
        own = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, own=own, name=name, **k: fits.append(name) or own(*a, **k))
    before = jobs(spark)
    found = rows(training.train(spark, sales, parted, SETTINGS))
    later_jobs = jobs(spark) - before
    # What was fitted is read; only the winners are fitted anew, on all rows.
    assert found == expected and len(fits) <= 2
    assert later_jobs < all_jobs - 0.7 * first_jobs
    assert not os.path.exists(tmp_path / "parted" / "stages")
    states = {r.state: r.status for r in reg.Progress(spark, parted).completed().collect()}
    assert states == {"A": "ok", "B": "ok", "C": "skipped"}


def test_stop_before_the_record_costs_only_the_record(spark, tmp_path, seasonal, monkeypatch):
    sales = seasonal(SERIES)
    settings = compare.Settings(models=(c.TREND, c.ARIMA))
    with monkeypatch.context() as m:
        m.setattr(reg.Progress, "record", lambda *_: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            training.train(spark, sales, str(tmp_path), settings)
    for name in ("trend_fit", "seasonal_fit", "refit_stack", "stacked_predictions"):
        monkeypatch.setattr(compare, name, lambda *_: pytest.fail("computed again"))
    assert training.train(spark, sales, str(tmp_path), settings).count() == 112


def test_other_rows_or_settings_start_afresh(spark, tmp_path, seasonal):
    sales = seasonal(SERIES)
    one, other = (compare.Settings(models=m) for m in ((c.TREND,), (c.ARIMA,)))
    content = st.content_of(sales)
    assert content == st.content_of(sales.repartition(7).select(*reversed(sales.columns)))
    changed = sales.withColumn("total", F.when(F.col("ds") == "2023-01-05", 1.0).otherwise(F.col("total")))
    # A repeated row must count too, though it cancels in an exclusive or.
    twice = sales.unionByName(sales.limit(1)).unionByName(sales.limit(1))
    prints = {st.fingerprint(x, s, 7) for x in (content, st.content_of(changed), st.content_of(twice)) for s in (one, other)}
    assert len(prints) == 6


def test_a_stage_without_its_file_never_happened(spark, tmp_path):
    made = []

    def build(n):
        made.append(n)
        return spark.range(n)

    first = st.Stages(spark, str(tmp_path), "x")
    assert first.table("t", lambda: build(3)).count() == 3
    assert st.Stages(spark, str(tmp_path), "x").table("t", lambda: build(9)).count() == 3
    assert st.Stages(spark, str(tmp_path), "y").table("t", lambda: build(4)).count() == 4
    assert made == [3, 4]
    with pytest.raises(Stop):
        first.table("broken", lambda: (_ for _ in ()).throw(Stop()))
    assert first.names() == ["t"]
    assert first.table("broken", lambda: build(2)).count() == 2
    assert first.value("v", lambda: {"a": 1}) == first.value("v", lambda: {"a": 2}) == {"a": 1}
    committed = json.loads((tmp_path / "stages" / "x" / "committed" / "v.json").read_text())
    assert committed == {"a": 1}
    # The first commit of a name counts.
    first._commit("v", {"a": 3})
    assert first.value("v", dict) == {"a": 1}
    empty = first.table("empty", lambda: spark.createDataFrame([], "a int, b array<string>"))
    assert empty.isEmpty() and empty.columns == ["a", "b"]
    first.clear()
    assert first.names() == []
