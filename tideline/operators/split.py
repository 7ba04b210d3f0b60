"""Chronological splits and row-count guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.config import META_SHARE, MIN_TRAIN_ROWS, TEST_SHARE

KEY = "state"
TRAIN, TEST = "train", "test"


def train_rows(n: Column, test_share: float) -> Column:
    """Rows before the cut: the whole part of ``n * (1 - test_share)`` in double arithmetic."""
    return F.floor(n * F.lit(1 - test_share)).cast("long")


def split_series(df: DataFrame, test_share: float = TEST_SHARE,
                 column: str = "split") -> DataFrame:
    """Label the earliest rows of each series ``train`` and the rest ``test``."""
    per_state = Window.partitionBy(KEY)
    rn = F.row_number().over(per_state.orderBy("ds"))
    n = F.count("*").over(per_state)
    label = F.when(rn <= train_rows(n, test_share), TRAIN).otherwise(TEST)
    return df.withColumn(column, label)


def split_numbered(df: DataFrame, test_share: float = TEST_SHARE,
                   column: str = "split") -> DataFrame:
    """The same labels for rows that already carry ``rn`` and ``n_rows``."""
    label = F.when(F.col("rn") <= train_rows(F.col("n_rows"), test_share), TRAIN).otherwise(TEST)
    return df.withColumn(column, label)


def nested_split(df: DataFrame, meta_share: float = META_SHARE) -> DataFrame:
    """Add ``split`` (train/test) and ``part`` (base/meta within train, else test).

    Both cuts follow from one row number and one count, so they cost a single window.
    """
    per_state = Window.partitionBy(KEY)
    numbered = df.withColumns(
        {
            "rn": F.row_number().over(per_state.orderBy("ds")),
            "n_train": train_rows(F.count("*").over(per_state), TEST_SHARE),
        }
    )
    in_train = F.col("rn") <= F.col("n_train")
    in_base = F.col("rn") <= train_rows(F.col("n_train"), meta_share)
    return numbered.withColumns(
        {
            "split": F.when(in_train, TRAIN).otherwise(TEST),
            "part": F.when(in_base, "base").when(in_train, "meta").otherwise("test"),
        }
    ).drop("rn", "n_train")


def split_sizes(split: DataFrame) -> DataFrame:
    """Rows on either side of the cut, per state."""
    return split.groupBy(KEY).agg(
        F.count_if(F.col("split") == TRAIN).alias("train_size"),
        F.count_if(F.col("split") == TEST).alias("test_size"),
    )


def with_enough_rows(split: DataFrame, minimum: int = MIN_TRAIN_ROWS,
                     counted: Column | None = None) -> DataFrame:
    """Rows of the states that have at least ``minimum`` rows satisfying ``counted``.

    Counted by a window over the state, like the split itself, so the rows are not shuffled
    again. The default counts training rows.
    """
    condition = F.col("split") == TRAIN if counted is None else counted
    return (
        df_with_count(split, condition)
        .filter(F.col("n_counted") >= minimum)
        .drop("n_counted")
    )


def df_with_count(df: DataFrame, condition: Column) -> DataFrame:
    return df.withColumn("n_counted", F.count_if(condition).over(Window.partitionBy(KEY)))
