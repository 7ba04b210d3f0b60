"""Many forecast requests answered in one job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.config import DAYS_PER_WEEK, HORIZON_WEEKS
from tideline.functions.calendar import iso_timestamp

KEY = "state"
# Buckets of a published table: as many tasks answer a batch.
BUCKETS = 64


def forecast_paths(forecasts: DataFrame) -> DataFrame:
    """One row per state: its forecast as an ordered array, and the model behind it."""
    entry = F.struct("ds", "yhat")
    return forecasts.groupBy(KEY).agg(
        F.sort_array(F.collect_list(entry)).alias("path"),
        F.max("model_used").alias("model_used"),
    )


def answer_requests(requests: DataFrame, forecasts: DataFrame, states: DataFrame) -> DataFrame:
    """``requests(state, weeks)`` with the first ``7 * weeks`` forecast days of their state.

    ``states`` lists the states that have data, on any number of rows; the smallest table that
    does is best. A request joins one row per state, so a popular state multiplies nothing.
    ``status`` is ``ok`` only for complete answers; all others get an empty list:
    ``bad_request`` (negative weeks), ``no_data``, ``no_model``, or ``beyond_horizon`` where the
    forecasts at hand end before the request does (``compare.forecast_requests`` makes them as
    long as the requests).
    """
    return answer_from(requests, served(forecasts, states))


def served(forecasts: DataFrame, states: DataFrame) -> DataFrame:
    """What answers are made of, one row per state: has_data, path, model_used."""
    known = states.select(KEY).distinct().withColumn("has_data", F.lit(True))
    return known.join(forecast_paths(forecasts), KEY, "full")


def publish(forecasts: DataFrame, states: DataFrame, table: str, path: str,
            buckets: int = BUCKETS) -> None:
    """Write what answers are made of as ``table`` at ``path``, bucketed and sorted by state.

    Batches of requests then meet it bucket by bucket: only the requests are shuffled, however many
    states there are. Publishing again replaces the table.
    """
    spark = forecasts.sparkSession
    rows = served(forecasts, states).repartition(buckets, KEY).sortWithinPartitions(KEY)
    # Data of a table that was published before stay until the new ones are written.
    home = f"{path}/{uuid.uuid4().hex}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows.write.bucketBy(buckets, KEY).sortBy(KEY).option("path", home).saveAsTable(table)


def answer_published(requests: DataFrame, table: str) -> DataFrame:
    """Answers to ``requests(state, weeks)`` from a published table."""
    return answer_from(requests, requests.sparkSession.table(table))


def answer_from(requests: DataFrame, rows: DataFrame) -> DataFrame:
    """Answers to ``requests(state, weeks)`` from rows as ``served`` makes them."""
    weeks = F.coalesce("weeks", F.lit(HORIZON_WEEKS))
    joined = requests.withColumn("weeks", weeks).join(rows, KEY, "left")
    n_days = F.col("weeks") * DAYS_PER_WEEK
    status = (
        F.when(F.col("weeks") < 0, "bad_request")
        .when(F.col("has_data").isNull(), "no_data")
        .when(F.col("path").isNull(), "no_model")
        .when(F.size("path") < n_days, "beyond_horizon")
        .otherwise("ok")
    )
    days = F.slice("path", 1, F.greatest(n_days, F.lit(0)))
    items = F.transform(
        days,
        lambda day: F.struct(
            iso_timestamp(day["ds"]).alias("date"), day["yhat"].alias("predicted_sales")
        ),
    )
    return joined.withColumn("status", status).select(
        KEY,
        F.when(F.col("status") == "ok", items).otherwise(F.array()).alias("forecasts"),
        F.when(F.col("status") == "ok", F.col("model_used")).alias("model_used"),
        F.col("weeks").alias("forecast_horizon_weeks"),
        "status",
    )


def response_rows(responses: DataFrame) -> DataFrame:
    """One row per request and forecast day; a request without forecast keeps one row."""
    return responses.select(
        KEY,
        "forecast_horizon_weeks",
        "model_used",
        "status",
        F.explode_outer("forecasts").alias("item"),
    ).select(KEY, "forecast_horizon_weeks", "model_used", "status", "item.*")
