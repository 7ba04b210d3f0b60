"""Summaries and selections on the raw sales table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_states(sales: DataFrame, states: Sequence[str]) -> DataFrame:
    """Rows of the named states; the predicate reaches the scan."""
    return sales.filter(F.col("state").isin(list(states)))


def states_of(sales: DataFrame) -> DataFrame:
    """Distinct states, sorted."""
    return sales.select("state").distinct().orderBy("state")


def first_states(sales: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` states by name (a top-n report)."""
    return states_of(sales).limit(n)


def profile(sales: DataFrame) -> DataFrame:
    """One row: size and date range of the table.

    States are counted after a grouped pre-aggregation, so the distinct count does not have to
    shuffle raw rows.
    """
    per_state = sales.groupBy("state").agg(
        F.count("*").alias("n"), F.min("ds").alias("lo"), F.max("ds").alias("hi")
    )
    return per_state.agg(
        F.sum("n").alias("n_rows"),
        F.count("state").alias("n_states"),
        F.min("lo").alias("first_ds"),
        F.max("hi").alias("last_ds"),
    ).withColumn("n_columns", F.lit(len(sales.columns)))


def date_bounds(sales: DataFrame) -> DataFrame:
    """First and last day of every series."""
    return sales.groupBy("state").agg(
        F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds")
    )


def sort_series(sales: DataFrame) -> DataFrame:
    """Total order by state and day; category and amount break ties."""
    return sales.orderBy("state", "ds", "category", "total")


def known_states(requested: DataFrame, sales: DataFrame) -> DataFrame:
    """Requested rows whose state occurs in the data."""
    return requested.join(sales.select("state").distinct(), "state", "left_semi")


def unknown_states(requested: DataFrame, sales: DataFrame) -> DataFrame:
    """Requested rows whose state does not occur in the data."""
    return requested.join(sales.select("state").distinct(), "state", "left_anti")
