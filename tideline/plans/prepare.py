"""From raw sales to the prepared table all models share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tideline.config import MIN_TRAIN_ROWS
from tideline.operators.densify import densify, densify_keeping_rows, roll_up
from tideline.operators.features import with_features, with_features_keeping_rows
from tideline.operators.split import nested_split, split_numbered, with_enough_rows


def daily_series(sales: DataFrame) -> DataFrame:
    """One row per state and calendar day."""
    return densify(roll_up(sales))


def prepare(sales: DataFrame, minimum: int = MIN_TRAIN_ROWS) -> DataFrame:
    """Features with ``split`` and ``part`` labels of every series that is long enough.

    Rolling up, gap filling, features, labels and the length guard all need the rows of a state
    together and in date order: one shuffle by state serves them all.
    """
    labelled = nested_split(with_features(daily_series(sales)))
    return with_enough_rows(labelled, minimum)


def prepare_keeping_rows(sales: DataFrame) -> DataFrame:
    """The same table when several rows of one day have to stay apart."""
    return split_numbered(with_features_keeping_rows(densify_keeping_rows(sales)))
