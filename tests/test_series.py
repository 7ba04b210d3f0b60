"""Edge cases of the dense series, features, splits, scaling and sequences."""

from datetime import date, datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.config import FEATURES, LAGS, ROLLING_WINDOWS
from tideline.functions.calendar import is_holiday, with_calendar
from tideline.functions.scalars import clip_negative, fit_length, pad_left
from tideline.operators import densify as d
from tideline.operators import features as ft
from tideline.operators import horizon as hz
from tideline.operators import ordering, scale, sequences, split
from tideline.plans.prepare import daily_series, prepare_keeping_rows
from tideline.sources.sales import to_sales

DAY = date(2023, 1, 1)


def totals(df):
    return [r.total for r in df.orderBy("state", "ds").collect()]


def test_interpolation_between_and_beyond_known_amounts(sales_of):
    sales = sales_of([("A", 0, None), ("A", 1, 1.0), ("A", 2, None), ("A", 4, 3.0), ("A", 5, None)])
    assert totals(daily_series(sales)) == pytest.approx([0, 1, 5 / 3, 7 / 3, 3, 3])


def test_series_without_any_amount_is_zero(sales_of):
    assert totals(daily_series(sales_of([("A", 0, None), ("A", 3, None)]))) == [0, 0, 0, 0]


def test_category_is_carried_forward(sales_of):
    sales = sales_of([("A", 0, 1.0, "x"), ("A", 2, 3.0, None), ("A", 4, 5.0, "y")])
    found = [r.category for r in daily_series(sales).orderBy("ds").collect()]
    assert found == ["x", "x", "x", "x", "y"]


def test_single_row_series(sales_of):
    row = ft.with_features(daily_series(sales_of([("A", 0, 7.0)]))).first()
    assert (row.total, row.rolling_std_7, row.rolling_mean_30, row.lag_1) == (7.0, 0.0, 7.0, None)


def test_rows_of_one_day_are_summed_or_kept(sales_of):
    sales = sales_of([("A", 0, 1.0), ("A", 0, 2.0), ("A", 2, 6.0)])
    assert totals(daily_series(sales)) == [3.0, 4.5, 6.0]
    kept = d.densify_keeping_rows(sales)
    assert sorted(totals(kept)) == [1.0, 2.0, 4.0, 6.0]


def test_time_of_day_is_cut_off(spark):
    rows = [("A", datetime(2023, 1, 1, 6), "1", "c"), ("A", datetime(2023, 1, 2), "2", "c")]
    raw = spark.createDataFrame(rows, "State string, Date timestamp, Total string, Category string")
    assert [r.ds for r in to_sales(raw).orderBy("ds").collect()] == [DAY, date(2023, 1, 2)]


def test_text_amounts_become_null(spark):
    rows = [("A", "2023-01-01", "12.5", "c"), ("A", "2023-01-02", "n/a", "c"), ("A", "x", "1", "c")]
    raw = spark.createDataFrame(rows, "State string, Date string, Total string, Category string")
    found = {(r.ds, r.total) for r in to_sales(raw).collect()}
    assert found == {(DAY, 12.5), (date(2023, 1, 2), None), (None, 1.0)}


def test_rolling_windows_skip_unknown_amounts(sales_of):
    rows = sales_of([("A", i, v) for i, v in enumerate([1.0, None, None, 4.0, 9.0])])
    columns = ft.rolling_columns(ft.series_window(), [2])
    out = rows.withColumns(columns).orderBy("ds").collect()
    assert [r.rolling_mean_2 for r in out] == [1.0, 1.0, None, 4.0, 6.5]
    assert [r.rolling_std_2 for r in out] == pytest.approx([0, 0, 0, 0, 3.5355339])


def test_features_equal_pandas(spark, sales_of):
    rng = np.random.default_rng(3)
    days = np.flatnonzero(rng.random(300) < 0.4)
    rows = [("A", int(i), None if rng.random() < 0.1 else float(rng.integers(1, 900))) for i in days]
    found = ft.with_features(daily_series(sales_of(rows))).orderBy("ds").toPandas()

    frame = pd.DataFrame([(DAY + pd.Timedelta(days=r[1]), r[2]) for r in rows], columns=["d", "y"])
    y = frame.assign(d=pd.to_datetime(frame.d)).set_index("d").y.astype(float).asfreq("D")
    y = y.interpolate(method="time").fillna(0)
    np.testing.assert_allclose(found.total, y, atol=1e-9)
    for k in LAGS:
        np.testing.assert_allclose(found[f"lag_{k}"], y.shift(k), atol=1e-9)
    for k in ROLLING_WINDOWS:
        roll = y.rolling(k, min_periods=1)
        np.testing.assert_allclose(found[f"rolling_mean_{k}"], roll.mean(), atol=1e-7)
        np.testing.assert_allclose(found[f"rolling_std_{k}"], roll.std().fillna(0), atol=1e-6)
        np.testing.assert_allclose(found[f"rolling_max_{k}"], roll.max(), atol=1e-9)
    assert list(found.day_of_week) == list(y.index.dayofweek)
    assert list(found.week_of_year) == list(y.index.isocalendar().week)


def test_calendar_edges(spark):
    days = [date(2021, 1, 1), date(2023, 12, 3), date(1999, 12, 31), date(2022, 6, 20)]
    rows = spark.createDataFrame([(x,) for x in days], "ds date")
    found = {r.ds: r for r in with_calendar(rows).collect()}
    assert found[days[0]].week_of_year == 53
    assert (found[days[1]].day_of_week, found[days[1]].is_weekend) == (6, 1)
    assert [found[x].is_holiday for x in days] == [1, 0, 1, 1]


def test_holidays_of_a_year(spark):
    days = spark.sql("select explode(sequence(date'2023-01-01', date'2023-12-31')) as ds")
    found = [r.ds.strftime("%m-%d") for r in days.filter(is_holiday(F.col("ds"))).orderBy("ds").collect()]
    assert found == [
        "01-01", "01-02", "01-16", "02-20", "05-29", "06-19", "07-04", "09-04", "10-09",
        "11-10", "11-11", "11-23", "12-25",
    ]


def test_chunked_windows_equal_whole_windows(spark, seasonal):
    dense = daily_series(seasonal())
    whole = ft.with_features(dense).select("state", "ds", *FEATURES)
    numbered = ordering.number_rows(dense)
    chunked = with_calendar(
        ordering.over_chunks(numbered, ft.LONGEST_LOOK_BACK, ft.history_columns, chunk_rows=37)
    ).select("state", "ds", *FEATURES)
    assert chunked.count() == whole.count()
    assert whole.exceptAll(chunked).count() == 0


def test_row_numbers_are_complete_under_skew(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("state"),
        F.lit(DAY).alias("ds"),
        (F.col("id") % 11).cast("double").alias("total"),
        F.lit("c").alias("category"),
    )
    out = ordering.number_rows(rows).groupBy("state", "n_rows").agg(
        F.countDistinct("rn").alias("n"), F.max("rn").alias("top")
    )
    for r in out.collect():
        assert r.n == r.top == r.n_rows


def test_kept_rows_count_rows_not_days(sales_of):
    rows = [("A", t // 2, float(t)) for t in range(60)]
    out = prepare_keeping_rows(sales_of(rows)).orderBy("rn").collect()
    assert len(out) == 60 and out[10].lag_7 == 3.0 and out[10].n_rows == 60
    assert [r.split for r in out].count("train") == 48


@pytest.mark.parametrize(
    "n, train", [(1, 0), (4, 3), (5, 4), (49, 39), (50, 40), (63, 50), (1787, 1429)]
)
def test_split_sizes(spark, n, train):
    rows = spark.range(n).select(
        F.lit("A").alias("state"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("ds")
    )
    labelled = split.split_series(rows)
    sizes = split.split_sizes(labelled).first()
    assert (sizes.train_size, sizes.test_size) == (train, n - train)
    assert (split.with_enough_rows(labelled).count() > 0) == (train >= 50)


def test_split_is_chronological_and_nested(seasonal):
    rows = split.nested_split(daily_series(seasonal())).groupBy("state", "part").agg(
        F.min("ds").alias("lo"), F.max("ds").alias("hi")
    )
    for state in "ABC":
        bounds = {r.part: r for r in rows.filter(F.col("state") == state).collect()}
        assert bounds["base"].hi < bounds["meta"].lo <= bounds["meta"].hi < bounds["test"].lo


def test_constant_column_scales_to_zero(sales_of):
    rows = sales_of([("A", i, 5.0) for i in range(4)])
    scaled = scale.min_max_scale(rows, scale.scaler_stats(rows, ["total"]), ["total"])
    assert totals(scaled) == [0.0] * 4


def test_scaling_uses_training_rows_only(sales_of):
    rows = sales_of([("A", i, float(i)) for i in range(5)])
    stats = scale.scaler_stats(rows.filter("total <= 2"), ["total"])
    assert totals(scale.min_max_scale(rows, stats, ["total"])) == [0, 0.5, 1, 1.5, 2]


def test_sequences(sales_of):
    rows = sales_of([("A", i, float(i)) for i in range(6)])
    out = sequences.lookback_sequences(rows, F.col("total"), 3).orderBy("ds").collect()
    assert [(r.total, r.sequence) for r in out] == [
        (3.0, [0, 1, 2]), (4.0, [1, 2, 3]), (5.0, [2, 3, 4])
    ]
    tail = sequences.last_sequence(rows, F.col("total"), 3)
    held = [
        tail.select(sequences.held_sequence(F.col("sequence"), F.lit(k), 3)).first()[0]
        for k in (1, 2, 4, 9)
    ]
    assert held == [[3, 4, 5], [4, 5, 5], [5, 5, 5], [5, 5, 5]]


def test_array_helpers(spark):
    rows = spark.createDataFrame([([7.0],), ([1.0, 2.0],), ([1.0, 2.0, 3.0, 4.0],), ([],)], "a array<double>")
    fitted = [r[0] for r in rows.select(fit_length(F.col("a"), 3)).collect()]
    assert fitted == [[7, 7, 7], [1, 2, 2], [1, 2, 3], [0, 0, 0]]
    padded = [r[0] for r in rows.select(pad_left(F.col("a"), 3)).collect()]
    assert padded == [[7, 7, 7], [1, 1, 2], [2, 3, 4], None]


def test_clip_keeps_null(spark):
    rows = spark.createDataFrame([(-1.0,), (None,), (2.0,)], "y double")
    assert [r[0] for r in rows.select(clip_negative(F.col("y"))).collect()] == [0.0, None, 2.0]


def test_seasonal_difference(sales_of):
    y = [float((i * i) % 17) for i in range(12)]
    rows = sales_of([("A", i, v) for i, v in enumerate(y)])
    out = [r.diff for r in sequences.seasonal_difference(rows).orderBy("ds").collect()]
    assert out[:8] == [None] * 8
    assert out[8:] == [(y[i] - y[i - 1]) - (y[i - 7] - y[i - 8]) for i in range(8, 12)]


def test_frozen_future_of_a_short_series(sales_of):
    dense = daily_series(sales_of([("A", i, float(i + 1)) for i in range(10)]))
    out = hz.frozen_future(dense, 7).orderBy("step").collect()
    assert len(out) == 7 and {(r.lag_1, r.lag_7, r.lag_30) for r in out} == {(10.0, 4.0, 10.0)}
    assert out[0].ds == date(2023, 1, 11) and out[0].rolling_mean_7 == 7.0


def test_appended_future_carries_what_runs_out(sales_of):
    dense = daily_series(sales_of([("A", i, float(i + 1)) for i in range(40)]))
    out = hz.appended_future(dense, 10).orderBy("ds").collect()
    assert [r.lag_1 for r in out] == [40.0] * 10
    assert [r.lag_7 for r in out] == [34, 35, 36, 37, 38, 39, 40, 40, 40, 40]
    assert [r.rolling_std_7 for r in out][5:] == [0.0] * 5
    assert [r.rolling_mean_7 for r in out][6:] == [40.0] * 4


def test_appended_future_equals_full_recomputation(seasonal):
    dense = daily_series(seasonal())
    future = hz.future_rows(dense, 56)
    combined = ft.with_features(dense.unionByName(future))
    full = ft.fill_features(combined.filter(F.col("total").isNull()))
    short = hz.appended_future(dense, 56)
    keep = ["state", "ds", *FEATURES]
    left = full.select(keep).orderBy("state", "ds").toPandas()
    right = short.select(keep).orderBy("state", "ds").toPandas()
    pd.testing.assert_frame_equal(left, right, check_dtype=False)


def test_input_order_does_not_matter(spark, seasonal):
    sales = seasonal()
    shuffled = sales.repartition(7).orderBy(F.rand(1))
    left = ft.with_features(daily_series(sales))
    right = ft.with_features(daily_series(shuffled))
    assert left.exceptAll(right).count() == 0
