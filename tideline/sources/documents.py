"""Result, forecast and checkpoint documents.

Written as JSON lines, one document per state, so that no task has to hold all states; the
single nested document of earlier runs can be read as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.config import DEFAULT_TEST_SIZE, DEFAULT_TRAIN_SIZE
from tideline.functions.calendar import iso_timestamp, spaced_timestamp
from tideline.functions.scalars import finite
from tideline.operators.scoring import METRICS

KEY = "state"
METRIC_TYPE = "struct<mae double, rmse double, mape double>"
RESULT_FIELDS = (
    f"best_model string, metrics map<string, {METRIC_TYPE}>, train_size bigint, test_size bigint"
)
FORECAST_FIELDS = (
    "dates array<string>, predictions array<double>, model_used string, last_training_date string"
)


def result_documents(scores: DataFrame, best: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per state: winner, map of model to metrics, and split sizes.

    JSON has no infinity, so the score of a model that failed becomes NULL here.
    """
    metrics = F.struct(*[finite(F.col(c)).alias(c) for c in METRICS])
    maps = scores.groupBy(KEY).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("model", metrics)))).alias(
            "metrics"
        )
    )
    return (
        maps.join(best.select(KEY, "best_model"), KEY)
        .join(sizes, KEY)
        .select(KEY, "best_model", "metrics", "train_size", "test_size")
    )


def forecast_documents(forecasts: DataFrame) -> DataFrame:
    """One row per state: parallel arrays of dates and predictions in date order."""
    rows = forecasts.groupBy(KEY).agg(
        F.sort_array(F.collect_list(F.struct("ds", "yhat"))).alias("path"),
        F.max("model_used").alias("model_used"),
        iso_timestamp(F.max("last_ds")).alias("last_training_date"),
    )
    return rows.select(
        KEY,
        F.transform("path", lambda day: spaced_timestamp(day["ds"])).alias("dates"),
        F.col("path.yhat").alias("predictions"),
        "model_used",
        "last_training_date",
    )


def unfold_forecasts(documents: DataFrame) -> DataFrame:
    """Forecast documents back to one row per state and day."""
    pairs = F.explode(F.arrays_zip("dates", "predictions"))
    return documents.select(KEY, "model_used", pairs.alias("pair")).select(
        KEY,
        "model_used",
        F.to_date(F.substring("pair.dates", 1, 10)).alias("ds"),
        F.col("pair.predictions").alias("yhat"),
    )


def write_documents(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").json(path)


def read_documents(spark: SparkSession, path: str, fields: str = RESULT_FIELDS) -> DataFrame:
    """Documents written by ``write_documents``, read with a fixed schema."""
    return spark.read.schema(f"{KEY} string, {fields}").json(path)


def read_nested_document(spark: SparkSession, path: str, fields: str = RESULT_FIELDS) -> DataFrame:
    """A document ``{state: {...}, ...}`` in one file, as one row per state.

    The file is one JSON value and cannot be split; it is as small as a report.
    """
    text = spark.read.text(path, wholetext=True)
    return parse_nested(text, F.col("value"), fields)


def parse_nested(df: DataFrame, text: Column, fields: str = RESULT_FIELDS) -> DataFrame:
    parsed = F.from_json(text, f"map<string, struct<{fields}>>")
    return df.select(F.explode(parsed).alias(KEY, "document")).select(KEY, "document.*")


def flatten_results(documents: DataFrame) -> DataFrame:
    """Result documents as one row per state and model."""
    return documents.select(
        KEY, "best_model", F.explode("metrics").alias("model", "scores")
    ).select(KEY, "best_model", "model", "scores.*")


def fill_sizes(results: DataFrame, train: int = DEFAULT_TRAIN_SIZE,
               test: int = DEFAULT_TEST_SIZE) -> DataFrame:
    """Add split sizes where they are absent."""
    for name, default in (("train_size", train), ("test_size", test)):
        known = F.col(name) if name in results.columns else F.lit(None).cast("long")
        results = results.withColumn(name, F.coalesce(known, F.lit(default).cast("long")))
    return results
