"""Shape of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from checks import spark_queries
from tests.conftest import TABLES
from tideline.operators import densify as d
from tideline.operators import features as ft
from tideline.operators import horizon as hz
from tideline.plans import requests
from tideline.plans.prepare import prepare
from tideline.sources.sales import star_sales


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def state_shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning\(state#\d+, \d+\)", plan))


@pytest.fixture
def raw(spark, tmp_path, seasonal):
    seasonal().write.parquet(str(tmp_path / "sales"))
    return spark.read.parquet(str(tmp_path / "sales"))


def test_prepare_shuffles_once_by_state(raw):
    assert state_shuffles(plan_of(prepare(raw))) == 1


def test_appended_future_shuffles_once_by_state(raw):
    assert state_shuffles(plan_of(hz.appended_future(d.densify(raw)))) == 1


def test_lags_and_rolling_values_share_a_window(raw):
    plan = plan_of(ft.with_features(raw))
    assert plan.count("Window [") == 1


def test_raw_rows_meet_a_hash_aggregate_first(raw):
    plan = plan_of(d.roll_up(raw))
    below_first_shuffle = plan[plan.rindex("Exchange"):]
    assert "HashAggregate" in below_first_shuffle
    assert "Sort " not in below_first_shuffle and "SortAggregate" not in below_first_shuffle


def test_published_forecasts_are_not_shuffled(spark, tmp_path, sales_of):
    asked = spark.createDataFrame([("A", 1), ("A", 2), ("B", None), ("X", 1), (None, 1), ("A", -1)], "state string, weeks int")
    states = sales_of([("A", 0, 1.0), ("B", 0, 1.0), ("C", 0, 1.0)])
    rows = [(s, i) for s in "AB" for i in range(56 if s == "A" else 7)]
    ahead = spark.createDataFrame(rows, "state string, i int").select(
        "state", F.lit("m").alias("model_used"), F.date_add(F.lit("2024-01-01"), F.col("i")).alias("ds"),
        F.col("i").cast("double").alias("yhat"),
    )
    expected = {(r.state, r.forecast_horizon_weeks): (r.status, r.forecasts, r.model_used)
                for r in requests.answer_requests(asked, ahead, states).collect()}
    assert {k: v[0] for k, v in expected.items()} == {
        ("A", 1): "ok", ("A", 2): "ok", ("B", 8): "beyond_horizon", ("X", 1): "no_data", (None, 1): "no_data", ("A", -1): "bad_request"}
    try:
        for _ in range(2):  # publishing again replaces
            requests.publish(ahead, states, "published", str(tmp_path), buckets=4)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        answers = requests.answer_published(asked, "published")
        found = {(r.state, r.forecast_horizon_weeks): (r.status, r.forecasts, r.model_used) for r in answers.collect()}
        plan = plan_of(answers)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS published")
    assert found == expected
    scan = plan[: plan.index("FileScan parquet")]
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # The one shuffle is that of the requests.
    assert plan.split("== Initial Plan ==")[0].count("Exchange") == 1 and scan


def test_filters_and_columns_reach_the_scan(raw):
    plan = plan_of(raw.filter(F.col("state").isin("A", "B")).groupBy("ds").agg(F.sum("total")))
    assert "In(state, [A,B])" in plan
    assert "ReadSchema: struct<state:string,ds:date,total:double>" in plan


def test_star_scan_reads_three_order_columns(spark):
    plan = plan_of(star_sales(spark, TABLES))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize(
    "name", ["all_features", "future_frozen", "best_forecast", "batch_requests", "grid_points"]
)
def test_no_cross_joins(spark, name):
    plan = plan_of(getattr(spark_queries, name)(spark, TABLES))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(("name", "most"), [("best_forecast", 8), ("stack_predict", 6)])
def test_exchanges_of_combined_plans(spark, name, most):
    plan = plan_of(getattr(spark_queries, name)(spark, TABLES))
    assert len(re.findall(r"Exchange ", plan)) <= most


def test_unsummed_rows_are_read_from_their_source_once(spark, tmp_path, seasonal):
    seasonal().write.parquet(str(tmp_path / "rows"))
    raw = spark.read.parquet(str(tmp_path / "rows"))
    filled = d.densify_keeping_rows(raw)
    assert all(str(tmp_path / "rows") not in name for name in filled.inputFiles())
    assert filled.count() > raw.count() - 1
