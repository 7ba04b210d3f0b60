"""The queries that are checked against SQL, and those that are only counted.

Each takes a session and a table folder. Amounts that come out of long floating-point sums are
snapped to a binary grid before comparison: two engines may add in a different order, and a
decimal grid would have ties exactly where linear interpolation of cents puts its values.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline import config as c
from tideline.functions.calendar import calendar_columns, iso_timestamp, spaced_timestamp
from tideline.functions.scalars import clip_negative, fit_length, model_key, pad_left
from tideline.models import closed_form as cf
from tideline.models import fold_fits, fourier, pooled, refits, seasonal_ar, seasonal_arma, stacking, tree_arrays
from tideline.operators import densify as d
from tideline.operators import features as ft
from tideline.operators import folds as fo
from tideline.operators import horizon as hz
from tideline.operators import profile as pr
from tideline.operators import scale as sc
from tideline.operators import scoring as so
from tideline.operators import sequences as sq
from tideline.operators import split as sp
from tideline.plans import compare, requests, training, tuning
from tideline.plans.prepare import prepare
from tideline.session import checkpoint_dir, materialize
from tideline.sources import documents as doc
from tideline.sources import registry as reg
from tideline.sources.sales import read_sales, resolve_input, star_sales, to_day, to_number

KEY = "state"
FINE, COARSE = 1024, 8


def snap(value: Column | str, per_unit: int = FINE) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value * per_unit) / per_unit


def snapped(df: DataFrame, columns: list[str], per_unit: int = FINE) -> DataFrame:
    return df.withColumns({name: snap(name, per_unit) for name in columns})


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def dense(spark: SparkSession, sf: str) -> DataFrame:
    return d.densify(star_sales(spark, sf))


def with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Sales whose amount is unknown on every 13th of a month."""
    total = F.when(F.dayofmonth("ds") != 13, F.col("total"))
    return star_sales(spark, sf).withColumn("total", total)


def features(spark: SparkSession, sf: str) -> DataFrame:
    return ft.with_features(dense(spark, sf))


def parts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Dense rows labelled once and kept, because base and final fits read them repeatedly."""
    rows = materialize(sp.nested_split(dense(spark, sf)).select(KEY, "ds", "total", "split", "part"))
    return {
        "all": rows,
        "base": rows.filter("part = 'base'"),
        "meta": rows.filter("part = 'meta'"),
        "train": rows.filter("split = 'train'"),
        "test": rows.filter("split = 'test'"),
    }


def two_models(history: DataFrame, targets: DataFrame) -> DataFrame:
    return cf.predict_closed_forms(cf.fit_closed_forms(history), targets, (c.ARIMA, c.TREND))


def three_models(history: DataFrame, targets: DataFrame) -> DataFrame:
    return cf.predict_closed_forms(cf.fit_closed_forms(history), targets)


def test_scores(p: dict[str, DataFrame]) -> DataFrame:
    return so.evaluate(three_models(p["train"], p["test"]))


def rounded_scores(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"mae": snap("mae", COARSE), "rmse": snap("rmse", COARSE), "mape": F.round("mape", 4)}
    )


# -- sources, selections, summaries ----------------------------------------------------------------


def sales_daily(spark, sf):
    return star_sales(spark, sf)


def profile(spark, sf):
    return pr.profile(star_sales(spark, sf))


def state_list(spark, sf):
    return pr.states_of(star_sales(spark, sf))


def first_states(spark, sf):
    return pr.first_states(star_sales(spark, sf))


def date_bounds(spark, sf):
    return pr.date_bounds(star_sales(spark, sf))


def filter_states(spark, sf):
    return pr.filter_states(star_sales(spark, sf), ["NATION_2", "NATION_7", "NATION_20"])


def sorted_series(spark, sf):
    return pr.sort_series(star_sales(spark, sf))


def parsed_dates(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", to_day(ts).alias("ds"), to_day(ts.cast("string")).alias("ds_of_text")
    )


def coerced_numbers(spark, sf):
    price_or_word = F.when(
        F.col("o_orderstatus") == "F", F.col("o_orderpriority")
    ).otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        to_number(price_or_word).alias("price"),
        to_number(F.substring("o_orderpriority", 1, 1)).alias("code"),
    )


def conformed_future(spark, sf):
    history = dense(spark, sf)
    future = hz.future_dates(hz.last_days(history)).select(KEY, "ds")
    return hz.conform_to_base(future, history)


def known_states(spark, sf):
    return pr.known_states(places(spark, sf), star_sales(spark, sf))


def unknown_states(spark, sf):
    return pr.unknown_states(places(spark, sf), star_sales(spark, sf))


def places(spark, sf):
    """Names that may be asked for: nations, which are states of the data, and regions."""
    nations = table(spark, sf, "nation").select(F.col("n_name").alias(KEY))
    return nations.unionByName(table(spark, sf, "region").select(F.col("r_name").alias(KEY)))


# -- dense series and features ---------------------------------------------------------------------


def densify(spark, sf):
    return dense(spark, sf)


def densify_nulls(spark, sf):
    return d.densify(with_gaps(spark, sf))


def densify_kept_rows(spark, sf):
    """Every order its own row, several per day, with unknown amounts on every 13th."""
    return d.densify_keeping_rows(order_rows(spark, sf))


def order_rows(spark, sf):
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias(KEY))
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf, "orders")
    day = F.to_date("o_orderdate")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            KEY,
            day.alias("ds"),
            F.when(F.dayofmonth(day) != 13, F.col("o_totalprice")).alias("total"),
            F.col("o_orderpriority").alias("category"),
        )
    )


def features_kept_rows(spark, sf):
    """Features over unsummed rows; rows that tie in day, category and amount are equal."""
    rows = ft.with_features_keeping_rows(d.densify_keeping_rows(order_rows(spark, sf)))
    summed = [n for n in c.FEATURES if n.startswith(("rolling_mean", "rolling_std"))]
    waves = {name: F.round(name, 8) for name in c.CALENDAR_FEATURES[-4:]}
    picked = rows.select(KEY, "ds", "category", "total", "rn", "n_rows", *c.FEATURES)
    return snapped(picked, summed).withColumns(waves)


def spine_gaps(spark, sf):
    return d.spine_join(star_sales(spark, sf))


def forward_fill(spark, sf):
    return d.forward_fill(d.spine_join(star_sales(spark, sf)), ["total", "category"])


def calendar_features(spark, sf):
    rows = dense(spark, sf).select(KEY, "ds", *calendar_named())
    return rows.withColumns({n: F.round(n, 8) for n in c.CALENDAR_FEATURES[-4:]})


def calendar_named() -> list[Column]:
    return [column.alias(name) for name, column in calendar_columns(F.col("ds")).items()]


def holiday_flag(spark, sf):
    flag = calendar_columns(F.col("ds"))["is_holiday"]
    return dense(spark, sf).select("ds").distinct().withColumn("is_holiday", flag)


def lag_features(spark, sf):
    return dense(spark, sf).select(KEY, "ds", *named(ft.lag_columns(ft.series_window())))


def named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


SUMMED = ["rolling_mean_7", "rolling_std_7", "rolling_mean_30", "rolling_std_30"]


def rolling_features(spark, sf):
    rows = dense(spark, sf).select(KEY, "ds", *named(ft.rolling_columns(ft.series_window())))
    return snapped(rows, SUMMED)


def rolling_before(spark, sf):
    columns = ft.rolling_columns(ft.series_window(), include_current=False)
    return snapped(dense(spark, sf).select(KEY, "ds", *named(columns)), SUMMED)


def comparable(df: DataFrame) -> DataFrame:
    """Feature rows with floating-point columns cut to what two engines agree on."""
    waves = {name: F.round(name, 8) for name in c.CALENDAR_FEATURES[-4:]}
    return snapped(df, SUMMED).withColumns(waves)


def all_features(spark, sf):
    return comparable(features(spark, sf))


def training_rows(spark, sf):
    return comparable(ft.complete_rows(features(spark, sf)))


def training_rows_with_target(spark, sf):
    known = F.when(F.dayofmonth("ds") != 13, F.col("total"))
    rows = features(spark, sf).withColumn("total", known)
    return comparable(ft.complete_rows(rows, with_total=True))


def filled_features(spark, sf):
    """Lags of gappy sales, carried forward and then 0."""
    lags = d.spine_join(star_sales(spark, sf)).select(
        KEY, "ds", *named(ft.lag_columns(ft.series_window()))
    )
    return ft.fill_features(lags, c.LAG_FEATURES)


# -- splits, guards, scaling, sequences ------------------------------------------------------------


def split_sizes(spark, sf):
    return sp.split_sizes(sp.split_series(dense(spark, sf)))


def nested_split(spark, sf):
    return sp.nested_split(dense(spark, sf)).select(KEY, "ds", "split", "part")


def cut_short(spark, sf) -> DataFrame:
    """Sales in which the states of two regions end early: too soon to train, or just to tune."""
    day = F.col("ds")
    early = F.when(F.col("category") == "ASIA", day < F.lit("1995-02-25").cast("date")).when(
        F.col("category") == "AMERICA", day < F.lit("1995-05-10").cast("date")
    )
    return star_sales(spark, sf).filter(F.coalesce(early, F.lit(True)))


def min_history(spark, sf):
    """Observed days of the states that have enough of them before the cut."""
    return sp.with_enough_rows(sp.split_series(cut_short(spark, sf)))


def tuning_guard(spark, sf):
    """States with enough complete rows for a hold-out, by look-back length."""
    rows = ft.with_features(d.densify(cut_short(spark, sf)))
    rows = ft.complete_rows(rows).groupBy(KEY).agg(F.count("*").alias("n"))
    lengths = tuning.with_grid(rows, tuning.lookback_grid())
    return lengths.select(
        KEY,
        "length",
        "n",
        (F.col("n") >= c.MIN_TUNING_ROWS).alias("can_tune"),
        (F.col("n") >= F.col("length") + c.LOOKBACK_MARGIN).alias("can_fit"),
    )


SCALED = ["total", "lag_1", "lag_30", "day_of_month"]


def train_features(spark, sf):
    rows = sp.split_series(features(spark, sf))
    return rows, rows.filter(F.col("split") == sp.TRAIN)


def minmax_stats(spark, sf):
    return sc.scaler_stats(train_features(spark, sf)[1], SCALED)


def minmax_scaled(spark, sf):
    rows, train = train_features(spark, sf)
    scaled = sc.min_max_scale(rows, sc.scaler_stats(train, SCALED), SCALED)
    return scaled.select(KEY, "ds", *[F.round(n, 9).alias(n) for n in SCALED])


def minmax_round_trip(spark, sf):
    rows, train = train_features(spark, sf)
    joined = rows.join(sc.scaler_stats(train, ["total"]), KEY)
    back = sc.unscaled(sc.scaled("total"), "total")
    return joined.select(KEY, "ds", snap(back).alias("total"))


def lookback_sequences(spark, sf):
    rows = sq.lookback_sequences(dense(spark, sf), F.col("total"))
    return rows.select(
        KEY,
        "ds",
        F.size("sequence").alias("steps"),
        F.element_at("sequence", 1).alias("oldest"),
        F.element_at("sequence", -1).alias("newest"),
        snap(F.aggregate("sequence", F.lit(0.0), lambda a, b: a + b)).alias("step_sum"),
    )


def padded_sequences(spark, sf):
    """Looking back from every observed day, short pasts filled with their first amount."""
    frame = ft.series_window().rowsBetween(-c.LOOKBACK, -1)
    rows = star_sales(spark, sf).withColumn("past", F.collect_list("total").over(frame))
    padded = rows.withColumn("padded", pad_left(F.col("past"), c.LOOKBACK))
    return padded.select(
        KEY,
        "ds",
        F.size("past").alias("known"),
        F.element_at("padded", 1).alias("oldest"),
        F.element_at("padded", -1).alias("newest"),
        snap(F.aggregate("padded", F.lit(0.0), lambda a, b: a + b)).alias("step_sum"),
    )


def held_sequences(spark, sf):
    """Inputs of the first 40 forecast steps when the last amount is repeated."""
    tails = sq.last_sequence(dense(spark, sf), F.col("total"))
    steps = tails.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(40))))
    held = steps.withColumn("held", sq.held_sequence(F.col("sequence"), F.col("step")))
    return held.select(
        KEY,
        "step",
        F.element_at("held", 1).alias("oldest"),
        F.element_at("held", -1).alias("newest"),
        snap(F.aggregate("held", F.lit(0.0), lambda a, b: a + b)).alias("step_sum"),
    )


def seasonal_diff(spark, sf):
    return sq.seasonal_difference(dense(spark, sf)).select(KEY, "ds", "diff")


# -- scoring ---------------------------------------------------------------------------------------


def last_value_metrics(spark, sf):
    """Per state: how well the last training amount predicts the held-out days."""
    rows = cf.last_value_in_place(sp.split_series(dense(spark, sf)))
    return last_value_scores(rows, F.col("total"))


def mape_zero_mask(spark, sf):
    """Errors against actuals that are 0 on every 13th, and always 0 in one state."""
    rows = cf.last_value_in_place(sp.split_series(dense(spark, sf)))
    zero = (F.dayofmonth("ds") == 13) | (F.col(KEY) == "NATION_4")
    return last_value_scores(rows, F.when(zero, 0.0).otherwise(F.col("total")))


def last_value_scores(rows: DataFrame, actual: Column) -> DataFrame:
    scores = rows.groupBy(KEY).agg(*so.metric_columns(actual, F.col("yhat")))
    return rounded_scores(scores).withColumn("model", F.lit("LastValue"))


def evaluate_models(spark, sf):
    return rounded_scores(test_scores(parts(spark, sf)))


def evaluate_missing(spark, sf):
    """A model without predictions scores infinity."""
    p = parts(spark, sf)
    expected = so.expected_pairs(p["all"], [c.ARIMA, c.LOOKBACK_MODEL])
    predictions = cf.predict_ar1(cf.fit_ar1(p["train"]), p["test"].select(KEY, "ds"))
    return rounded_scores(so.evaluate(predictions, p["test"], expected))


def best_by_rmse(spark, sf):
    return rounded_scores(so.select_best(test_scores(parts(spark, sf)), "rmse"))


def best_by_mape(spark, sf):
    return rounded_scores(so.select_best(test_scores(parts(spark, sf)), "mape"))


def leaderboard(spark, sf):
    return rounded_scores(so.leaderboard(test_scores(parts(spark, sf))))


def run_summary(spark, sf):
    return so.run_summary(so.select_best(test_scores(parts(spark, sf))))


def model_counts(spark, sf):
    p = parts(spark, sf)
    return so.base_model_counts(three_models(p["train"], p["test"]))


def predictions_aligned(spark, sf):
    p = parts(spark, sf)
    rows = so.align(two_models(p["train"], p["test"]), p["test"])
    return snapped(rows, ["yhat"], COARSE)


# -- closed-form models ----------------------------------------------------------------------------


def last_value_forecast(spark, sf):
    history = dense(spark, sf)
    targets = hz.future_dates(hz.last_days(history)).select(KEY, "ds")
    return cf.predict_last_value(cf.fit_last_value(history), targets)


def zero_forecast(spark, sf):
    targets = hz.future_dates(hz.last_days(dense(spark, sf)))
    return compare.failed_predictions(targets, c.TREES)


def ar1_fit(spark, sf):
    fit = cf.fit_ar1(parts(spark, sf)["train"])
    return fit.select(
        KEY, F.round("phi", 9).alias("phi"), snap("intercept", COARSE).alias("intercept"),
        "last_ds", "last_total",
    )


def ar1_forecast(spark, sf):
    p = parts(spark, sf)
    rows = cf.predict_ar1(cf.fit_ar1(p["train"]), p["test"].select(KEY, "ds"))
    return snapped(rows, ["yhat"], COARSE)


def trend_season_fit(spark, sf):
    fit = cf.fit_trend_season(parts(spark, sf)["train"])
    return fit.select(
        KEY,
        "first_ds",
        F.round("slope", 6).alias("slope"),
        snap("level", COARSE).alias("level"),
        *[F.round(F.get("weekday_index", F.lit(i)), 8).alias(f"weekday_{i}") for i in range(7)],
        *[F.round(F.get("month_index", F.lit(i)), 8).alias(f"month_{i + 1}") for i in range(12)],
    )


def trend_season_negative(spark, sf):
    """The same fit when amounts on every fifth of a month are negative: they count as 0."""
    sign = F.when(F.dayofmonth("ds") == 5, -1).otherwise(1)
    train = parts(spark, sf)["train"].withColumn("total", F.col("total") * sign)
    fit = cf.fit_trend_season(train)
    return fit.select(KEY, F.round("slope", 6).alias("slope"), snap("level", COARSE).alias("level"))


def stackable_states(spark, sf):
    """States with two base models, when the seasonal one is missing in one region."""
    rows = parts_with_category(spark, sf)
    train, test = (rows.filter(F.col("split") == side) for side in (sp.TRAIN, sp.TEST))
    predictions = two_models(train, test)
    asia = rows.filter("category = 'ASIA'").select(KEY).distinct()
    missing = asia.withColumn("model", F.lit(c.ARIMA))
    return so.stackable_states(predictions.join(missing, [KEY, "model"], "left_anti"))


def fallback_chain_engine(spark, sf):
    """The engine's own chain for states without a seasonal fit: line, or last amount.

    The line is spoilt for one region, so both steps of the chain are taken.
    """
    rows = parts_with_category(spark, sf)
    train, test = (rows.filter(F.col("split") == side) for side in (sp.TRAIN, sp.TEST))
    fit = seasonal_ar.fit_seasonal_ar(train)
    lost = F.lit(None).cast("array<double>")
    europe = rows.filter("category = 'EUROPE'").select(KEY).distinct().withColumn("spoilt", F.lit(True))
    fit = fit.withColumn("coefficients", lost).join(europe, KEY, "left").withColumn(
        "phi", F.when(F.col("spoilt"), 1.5).otherwise(F.col("phi"))
    )
    found = seasonal_ar.predict_seasonal_ar(fit.drop("spoilt"), test.select(KEY, "ds"))
    return snapped(found, ["yhat"], COARSE)


def forecast_coverage(spark, sf):
    """Days forecast per state and iterative or learned model, and those without a usable value."""
    p = parts(spark, sf)
    days = p["test"].select(KEY, "ds")
    scale = materialize(pooled.amount_scale(p["train"]))
    model = pooled.fit_lookback(pooled.amount_sequences(p["train"], scale, c.LOOKBACK))
    rows = (
        seasonal_ar.predict_seasonal_ar(seasonal_ar.fit_seasonal_ar(p["train"]), days)
        .unionByName(fourier.predict_fourier(fourier.fit_fourier(p["train"]), days))
        .unionByName(pooled.predict_amounts(model, scale, p["train"], days))
    )
    bad = (F.col("yhat").isNull() | F.isnan("yhat") | (F.col("yhat") < 0)).cast("long")
    return rows.groupBy(KEY, "model").agg(
        F.count("*").alias("n"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
        F.sum(bad).alias("n_bad"),
    )


def progress_latest(spark, sf):
    """Progress written in two batches and read back: states settled, and rows each had."""
    sales = star_sales(spark, sf)
    sizes = sales.groupBy(KEY, "category").agg(F.count("*").alias("n_rows"))
    progress = reg.Progress(spark, new_folder(spark))
    asia = F.col("category") == "ASIA"
    for rows, status in ((sizes.filter(asia), reg.SKIPPED), (sizes.filter(~asia), reg.OK)):
        progress.record(rows.select(KEY, F.lit(status).alias("status"), "n_rows"))
    return progress.completed()


def unsettled_states(spark, sf):
    """States to take up again: skipped ones of two nations have grown since, all failed ones."""
    sales = star_sales(spark, sf)
    sizes = sales.groupBy(KEY, "category").agg(F.count("*").alias("n_rows"))
    grown = F.col(KEY).isin("NATION_2", "NATION_12")
    status = F.when(F.col("category") == "ASIA", reg.SKIPPED).when(
        F.col("category") == "AFRICA", reg.FAILED
    ).otherwise(reg.OK)
    progress = sizes.select(
        KEY, status.alias("status"), F.when(grown, F.col("n_rows") - 1).otherwise(F.col("n_rows")).alias("n_rows")
    )
    return reg.unsettled_sales(sales, progress).groupBy(KEY).agg(F.count("*").alias("n"))


def regenerated_features(spark, sf):
    """Rows that lack feature columns get all of them computed; complete ones stay as they are."""
    rows = ft.ensure_features(dense(spark, sf).withColumn("lag_1", F.lit(-1.0)))
    return comparable(ft.ensure_features(rows))


def found_input(spark, sf):
    """Days in the file that a pattern finds when the configured one is absent."""
    folder = new_folder(spark)
    star_sales(spark, sf).select("state", "ds", "total", "category").toDF(
        "State", "Date", "Total", "Category"
    ).coalesce(1).write.option("header", True).csv(folder)
    path = resolve_input(spark, folder, "absent.csv", "*.csv")
    return read_sales(spark, path, "csv").groupBy(KEY).agg(
        F.count("*").alias("n"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds")
    )


def trend_season_forecast(spark, sf):
    p = parts(spark, sf)
    rows = cf.predict_trend_season(cf.fit_trend_season(p["train"]), p["test"].select(KEY, "ds"))
    return snapped(rows, ["yhat"], COARSE)


def fallback_chain(spark, sf):
    """First-order forecast where it has a mean to return to, else the last amount."""
    history = parts(spark, sf)["train"]
    fit = cf.fit_ar1(history)
    steps = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(c.HORIZON_DAYS))))
    full = F.when(F.abs(F.col("phi")) < 0.83, cf.ar1_forecast(F.col("step")))
    return steps.select(
        KEY, "step", snap(cf.first_available(full, F.col("last_total")), COARSE).alias("yhat")
    )


STACKED_PAIR = (c.TREND, c.ARIMA)


def meta_matrix(spark, sf):
    p = parts(spark, sf)
    rows = so.meta_matrix(two_models(p["base"], p["meta"]))
    return snapped(rows, list(STACKED_PAIR), COARSE)


def stack_weights(p: dict[str, DataFrame]) -> DataFrame:
    return stacking.fit_stack(two_models(p["base"], p["meta"]), p["meta"], STACKED_PAIR)


def stack_fit(spark, sf):
    fit = stack_weights(parts(spark, sf))
    # Base predictions may be nearly collinear, so weights agree to a share of their size only.
    names = ["intercept", *[stacking.weight(m) for m in STACKED_PAIR]]
    return fit.select(KEY, *[significant(F.col(name)).alias(name) for name in names])


def significant(value: Column, bits: int = 20) -> Column:
    """``value`` to so many significant bits."""
    unit = F.pow(F.lit(2.0), F.floor(F.log2(F.abs(value))) - bits)
    return F.when(value == 0, 0.0).otherwise(F.round(value / unit) * unit)


def stack_predict(spark, sf):
    p = parts(spark, sf)
    rows = stacking.predict_stack(stack_weights(p), two_models(p["train"], p["test"]), STACKED_PAIR)
    # Extrapolated sums differ by magnitudes between states: compared by ratio, hence the log.
    return rows.select(KEY, "model", "ds", F.round(F.ln(1 + F.col("yhat")), 6).alias("log_yhat"))


def avg_ensemble(spark, sf):
    p = parts(spark, sf)
    rows = stacking.average_predictions(two_models(p["train"], p["test"]))
    return snapped(rows, ["yhat"], COARSE)


def clipped(spark, sf):
    """Day-on-day changes floored at 0; the unknown first change of a series stays unknown."""
    change = F.col("total") - F.lag("total").over(ft.series_window())
    return dense(spark, sf).select(KEY, "ds", clip_negative(change).alias("rise"))


# -- horizon, requests, documents ------------------------------------------------------------------


def horizon_dates(spark, sf):
    future = hz.future_dates(hz.last_days(dense(spark, sf)))
    return future.select(
        KEY,
        "ds",
        "step",
        iso_timestamp(F.col("ds")).alias("iso"),
        spaced_timestamp(F.col("ds")).alias("text"),
    )


def last_known(spark, sf):
    return snapped(hz.last_known(dense(spark, sf)), SUMMED)


def last_30_rows(spark, sf):
    return hz.last_rows(dense(spark, sf), 30).select(KEY, "ds", "total", "from_end")


def future_frozen(spark, sf):
    return comparable(hz.frozen_future(dense(spark, sf)))


def future_frozen_test(spark, sf):
    """Feature rows of the held-out days as seen from the end of training."""
    p = parts_with_category(spark, sf)
    train, test = (p.filter(F.col("split") == side) for side in (sp.TRAIN, sp.TEST))
    return comparable(hz.frozen_over(train.drop("split"), test))


def parts_with_category(spark, sf) -> DataFrame:
    return materialize(sp.split_series(dense(spark, sf)))


def future_appended(spark, sf):
    return comparable(hz.appended_future(dense(spark, sf)))


def appended_rows(spark, sf):
    history = dense(spark, sf)
    return hz.append_rows(history, hz.future_rows(history).drop("total"))


def winners(spark, sf, days=c.HORIZON_DAYS):
    p = parts(spark, sf)
    best = so.select_best(so.evaluate(two_models(p["train"], p["test"])))
    ends = hz.last_days(p["all"])
    targets = hz.future_dates(ends, days).select(KEY, "ds")
    chosen = compare.pick_winner(two_models(p["all"], targets), best)
    return chosen.join(ends, KEY)


def best_forecast(spark, sf):
    return snapped(winners(spark, sf), ["yhat"], COARSE)


def forecast_arrays(spark, sf):
    documents = doc.forecast_documents(winners(spark, sf))
    money = F.transform("predictions", lambda y: F.round(y).cast("long").cast("string"))
    return documents.select(
        KEY,
        F.concat_ws(",", "dates").alias("dates"),
        F.concat_ws(",", money).alias("predictions"),
        "model_used",
        "last_training_date",
    )


def forecasts_unfolded(spark, sf):
    rows = doc.unfold_forecasts(doc.forecast_documents(winners(spark, sf)))
    return snapped(rows, ["yhat"], COARSE)


def result_docs(spark, sf) -> DataFrame:
    p = parts(spark, sf)
    scores = rounded_scores(test_scores(p))
    return doc.result_documents(scores, so.select_best(scores), sp.split_sizes(p["all"]))


def results_document(spark, sf):
    rows = result_docs(spark, sf)
    return rows.select(
        KEY,
        "best_model",
        F.concat_ws(",", F.map_keys("metrics")).alias("models"),
        F.size("metrics").alias("n_models"),
        F.col("metrics")[c.ARIMA]["rmse"].alias("arima_rmse"),
        "train_size",
        "test_size",
    )


def results_flatten(spark, sf):
    """Documents written as JSON text, read back and unfolded to one row per model."""
    text = result_docs(spark, sf).select(
        F.to_json(F.map_from_arrays(F.array(KEY), F.array(F.struct(
            "best_model", "metrics", "train_size", "test_size"
        )))).alias("value")
    )
    return doc.flatten_results(doc.parse_nested(text, F.col("value")))


def size_backfill(spark, sf):
    """Sizes of long series only, the rest filled with the defaults."""
    sizes = sp.split_sizes(sp.split_series(dense(spark, sf)))
    known = F.when(F.col("train_size") > 1910, F.col("train_size"))
    return doc.fill_sizes(sizes.select(KEY, known.alias("train_size")))


def batch_requests(spark, sf):
    """Requests for every nation and region: 1 to 8 weeks, 12, 20, -1, or unspecified.

    Forecasts reach 12 weeks, so longer requests are refused, not cut. Regions are no states of
    the data; states won by the seasonal model stand for those whose model was never saved.
    """
    number = F.col("n_nationkey")
    weeks = (
        F.when(number % 6 == 1, 12).when(number % 11 == 3, 20).when(number % 12 == 5, -1)
        .when(number % 9 > 0, number % 9)
    )
    asked = table(spark, sf, "nation").select(F.col("n_name").alias(KEY), weeks.alias("weeks"))
    regions = table(spark, sf, "region").select(F.col("r_name").alias(KEY), F.lit(2).alias("weeks"))
    ahead = materialize(winners(spark, sf, 12 * c.DAYS_PER_WEEK))
    forecasts = ahead.filter(F.col("model_used") == c.TREND)
    answers = requests.answer_requests(asked.unionByName(regions), forecasts, ahead.select(KEY))
    return snapped(requests.response_rows(answers), ["predicted_sales"], COARSE)


def remaining_states(spark, sf):
    sales = star_sales(spark, sf)
    return reg.remaining_states(sales, done_states(sales))


def done_states(sales: DataFrame) -> DataFrame:
    """Stand-in for a progress record: the states of two regions."""
    return sales.filter(F.col("category").isin("ASIA", "EUROPE")).select(KEY).distinct()


def remaining_sales(spark, sf):
    sales = star_sales(spark, sf)
    return reg.remaining_sales(sales, done_states(sales))


def completed_states(spark, sf):
    sales = star_sales(spark, sf)
    batch = sales.filter(F.col("category").isin("ASIA", "AFRICA"))
    return reg.all_completed(done_states(sales), batch)


def available_states(spark, sf):
    """Registry entries of all base models, reduced to the states with trees."""
    return reg.available_states(listed_models(spark, sf))


def available_count(spark, sf):
    return reg.available_count(listed_models(spark, sf))


def listed_models(spark, sf) -> DataFrame:
    """Stand-in for a registry listing: trees exist for the states of four regions only."""
    sales = star_sales(spark, sf).select(KEY, "category").distinct()
    pairs = sales.withColumn("model", F.explode(F.array(*[F.lit(m) for m in c.BASE_MODELS])))
    saved = pairs.filter((F.col("model") != c.TREES) | (F.col("category") != "ASIA"))
    return saved.select(KEY, "model", model_key(F.col(KEY), F.col("model")).alias("key"))


def grid_points(spark, sf):
    """Every state with every point of the tree grid."""
    states = star_sales(spark, sf).select(KEY).distinct()
    return tuning.with_grid(states, tuning.tree_grid())


def best_configuration(spark, sf):
    """Forecast discount with the smallest error on the held-out rows, per state."""
    p = parts(spark, sf)
    last = cf.predict_last_value(cf.fit_last_value(p["train"]), p["test"].select(KEY, "ds"))
    points = [{"share": share} for share in (0.5, 0.75, 1.0, 1.25)]
    grid = tuning.with_grid(so.align(last, p["test"]), points)
    error = F.col("yhat") * F.col("share") - F.col("actual")
    scores = grid.groupBy(KEY, "grid_id", "share").agg(F.avg(F.abs(error)).alias("score"))
    best = so.best_configuration(scores, "score", ["share"])
    return snapped(best, ["score"], COARSE)


def fitted_length(spark, sf):
    """Past amounts of every observed day brought to length 10."""
    frame = ft.series_window().rowsBetween(-14, -1)
    rows = star_sales(spark, sf).withColumn("past", F.collect_list("total").over(frame))
    fitted = rows.withColumn("fitted", fit_length(F.col("past"), 10))
    return fitted.select(
        KEY,
        "ds",
        F.size("fitted").alias("n"),
        F.element_at("fitted", 1).alias("head"),
        F.element_at("fitted", -1).alias("tail"),
        snap(F.aggregate("fitted", F.lit(0.0), lambda a, b: a + b)).alias("step_sum"),
    )


BAD_STATE = "NATION_3"


def evaluate_with_bad_series(spark, sf):
    """Scores when one state's last training amount is infinite: only that state's are."""
    p = parts(spark, sf)
    last = F.max("ds").over(Window.partitionBy(KEY))
    spoilt = (F.col(KEY) == BAD_STATE) & (F.col("ds") == last)
    bad = F.when(spoilt, float("inf")).otherwise(F.col("total"))
    train = p["train"].withColumn("total", bad)
    days = p["test"].select(KEY, "ds")
    last_values = cf.predict_last_value(cf.fit_last_value(train), days)
    scores = so.evaluate(two_models(train, days).unionByName(last_values), p["test"])
    return rounded_scores(scores)


def seasonal_row_counts(spark, sf):
    """Rows that enter the seasonal regression, per state and degree of differencing."""
    train = parts(spark, sf)["train"]
    counts = [
        seasonal_ar.differences(train, d).filter(F.col("rn") >= seasonal_ar.first_row(1))
        .groupBy(KEY).agg(F.count("w").alias("n"), F.min("ds").alias("first_ds"))
        .withColumn("d", F.lit(d))
        for d in (0, 1)
    ]
    return counts[0].unionByName(counts[1])


def seasonal_autocovariances(spark, sf):
    """Sums of the differenced series times its lags, relative to lag 0, per state and degree."""
    train = parts(spark, sf)["train"]
    found = None
    for d in (0, 1):
        sums = seasonal_ar.autocovariances(seasonal_ar.differences(train, d))
        share = F.col("acov")[F.col("lag")] / F.col("acov")[0]
        lags = sums.withColumn("lag", F.explode(F.sequence(F.lit(1), F.lit(seasonal_ar.LONG_LAGS))))
        rows = lags.select(KEY, F.lit(d).alias("d"), "lag", F.round(share, 6).alias("share"))
        found = rows if found is None else found.unionByName(rows)
    return found


def seasonal_fixed_order(spark, sf):
    """Weights of lags 1, 7 and 8 of the seasonally differenced series, solved on their own."""
    train = parts(spark, sf)["train"]
    sums = seasonal_ar.cross_products(
        seasonal_ar.residuals(seasonal_ar.differences(train, 0)), 0
    )
    keep = [seasonal_ar.SHORT_LAGS.index(lag) for lag in (1, 7, 8)]
    solved = sums.withColumn("b", seasonal_ar.subset_solver(keep)("gram"))
    weights = {f"lag_{lag}": F.round(F.col("b")[i], 5) for i, lag in enumerate((1, 7, 8))}
    return solved.withColumns(weights).select(KEY, "n", *weights)


# -- fitted models without an SQL equivalent -------------------------------------------------------


def prepared(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = materialize(prepare(star_sales(spark, sf)))
    return rows.filter(F.col("split") == sp.TRAIN), rows.filter(F.col("split") == sp.TEST)


def arima_forecast(spark, sf):
    p = parts(spark, sf)
    fit = seasonal_ar.fit_seasonal_ar(p["train"])
    return seasonal_ar.predict_seasonal_ar(fit, p["test"].select(KEY, "ds"))


def arima_tuned(spark, sf):
    best = tuning.tune_seasonal_ar(parts(spark, sf)["train"])
    return best.select(KEY, "p", "d", "q", "aic")


def fourier_forecast(spark, sf):
    p = parts(spark, sf)
    fit = fourier.fit_fourier(p["train"])
    return fourier.predict_fourier(fit, p["test"].select(KEY, "ds"))


def fourier_tuned(spark, sf):
    return tuning.tune_trend(parts(spark, sf)["train"])


def lookback_forecast(spark, sf):
    train, test = prepared(spark, sf)
    scale = materialize(pooled.lookback_scale(train))
    model = pooled.fit_lookback(pooled.sequence_inputs(train, scale, c.LOOKBACK))
    return pooled.predict_lookback(model, scale, train, test)


def lookback_amounts(spark, sf):
    p = parts(spark, sf)
    scale = materialize(pooled.amount_scale(p["train"]))
    model = pooled.fit_lookback(pooled.amount_sequences(p["train"], scale, c.LOOKBACK))
    return pooled.predict_amounts(model, scale, p["train"], p["test"])


def lookback_tuned(spark, sf):
    scores = tuning.score_lookback(prepared(spark, sf)[0])
    return so.best_configuration(scores, "rmse", ["length"])


def gbt_forecast(spark, sf):
    train, test = prepared(spark, sf)
    scale = materialize(pooled.amount_scale(train))
    model = pooled.fit_trees(pooled.tree_inputs(train, scale))
    return pooled.predict_trees(model, scale, test)


def gbt_tuned(spark, sf):
    scores = tuning.score_trees(prepared(spark, sf)[0])
    return so.best_configuration(scores, "rmse", tuning.TREE_PARAMETERS)


# A fixed ensemble: weight, feature, threshold, value up to it, value beyond it.
STUMPS = (
    (1.0, "lag_7", 0.4137, 0.3, 0.55),
    (0.5, "rolling_mean_7", 0.5171, -0.1, 0.15),
    (0.5, "day_of_week", 4.0, 0.05, -0.2),
    (0.25, "lag_1", 0.3919, 0.2, -0.15),
    (0.25, "rolling_std_30", 0.1573, 0.1, -0.1),
    (0.25, "rolling_min_7", 0.2113, -0.05, 0.1),
    (0.125, "rolling_max_30", 0.8219, 0.3, -0.2),
    (0.125, "lag_30", 0.4493, -0.25, 0.35),
)


def stumps() -> tree_arrays.TreeArrays:
    rows = []
    for tree, (_, feature, threshold, low, high) in enumerate(STUMPS):
        rows += [(tree, 0, 0.0, 1, 2, c.FEATURES.index(feature), threshold),
                 (tree, 1, low, -1, -1, -1, None), (tree, 2, high, -1, -1, -1, None)]
    names = ["tree", "id", "value", "left", "right", "feature", "threshold"]
    return tree_arrays.grown_from(pd.DataFrame(rows, columns=names), [s[0] for s in STUMPS])


def recursive_forecast(spark, sf):
    """Eight weeks ahead by a fixed ensemble, every prediction an input of the days after it."""
    rows = materialize(dense(spark, sf))
    ahead = tree_arrays.recursive_future(stumps(), pooled.amount_scale(rows), rows)
    return snapped(ahead, ["yhat"], COARSE)


def ar1_folds(spark, sf):
    """First-order lines on three expanding windows."""
    labelled = materialize(fo.label_segments(dense(spark, sf)))
    fits = fold_fits.ar1_folds(labelled)
    return fits.select(KEY, "fold", "last_ds", F.round("phi", 6).alias("phi"), snap("intercept", COARSE).alias("intercept"))


def ar1_fold_scores(spark, sf):
    scores = fold_fits.score_ar1_folds(materialize(dense(spark, sf)))
    return snapped(scores, ["rmse"], COARSE)


def ar1_refit(spark, sf):
    """First-order lines from sums up to the turn of 2000 and the days after it."""
    rows = materialize(dense(spark, sf))
    stored = materialize(refits.statistics(rows.filter("ds < date'2000-01-01'")))
    fits = refits.line_fit(refits.grown(stored, rows))
    return fits.select(KEY, "last_ds", F.round("phi", 6).alias("phi"), snap("intercept", COARSE).alias("intercept"))


def arima_multiplicative(spark, sf):
    """The product form of the default order, from the end of training."""
    train, test = prepared(spark, sf)
    fit = seasonal_ar.with_fallback(seasonal_arma.fit_grid(train), train)
    return seasonal_ar.predict_seasonal_ar(fit, test.select(KEY, "ds"))


def arima_folds(spark, sf):
    return tuning.tune_seasonal_ar_folds(prepared(spark, sf)[0])


def fourier_folds(spark, sf):
    return tuning.tune_trend_folds(prepared(spark, sf)[0])


def gbt_recursive(spark, sf):
    """Held-out days by fitted trees from the end of training."""
    train, test = prepared(spark, sf)
    scale = materialize(pooled.amount_scale(train))
    model = pooled.fit_trees(pooled.tree_inputs(train, scale))
    return tree_arrays.recursive_forecast(tree_arrays.tree_arrays(model, spark), scale, train, test)


def compare_models(spark, sf):
    run = compare.compare_models(star_sales(spark, sf))
    return doc.result_documents(run.scores, run.best, run.sizes)


def train_forecast(spark, sf):
    """A training run into an empty folder: models saved, winners forecast."""
    return training.train(spark, star_sales(spark, sf), new_folder(spark))


def new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/runs/{uuid.uuid4().hex}"


def saved_run(spark, sf, fits: str) -> tuple[reg.ModelRegistry, compare.Comparison]:
    """A comparison of all base models, its fits saved and reopened."""
    run = compare.compare_models(star_sales(spark, sf))
    registry = reg.ModelRegistry(spark, new_folder(spark))
    training.save_fits(registry, getattr(run, fits))
    registry.save_coefficients(c.STACKED, run.weights)
    return registry, run


def rescore_saved(spark, sf):
    registry, run = saved_run(spark, sf, "train_fits")
    rows = run.prepared
    return training.rescore(
        registry, compare.rows_of(rows, sp.TRAIN), compare.rows_of(rows, sp.TEST)
    )


def refit_ensemble(spark, sf):
    registry, run = saved_run(spark, sf, "base_fits")
    rows = run.prepared
    return training.refit_ensemble(
        registry, compare.rows_of(rows, "base"), compare.rows_of(rows, "meta")
    )


def registry_entries(spark, sf):
    return saved_run(spark, sf, "train_fits")[0].entries()
