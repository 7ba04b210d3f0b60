"""Expanding validation windows: every fold is fitted on all rows before its block.

A series of n rows ends in k blocks of n // (k + 1) rows each. Fold j (from 1) learns from all rows
before block j and is judged on block j. Fits that need only cross products read each row once: a
task adds up one matrix per series and block, and what fold j needs is the sum of the matrices of
the blocks before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.functions.linear import summed_grams
from tideline.functions.metrics import rmse
from tideline.functions.scalars import finite

KEY, SEGMENT, FOLD = "state", "segment", "fold"
FOLDS = 3


def segment_of(rn: Column, n: Column, folds: int = FOLDS) -> Column:
    """Block of the row numbered ``rn`` of ``n``: 0 before all blocks, then 1 to ``folds``.

    A series with no row to spare for every block has none.
    """
    block = F.floor(n / (folds + 1))
    first = n - block * folds
    return F.when((rn <= first) | (block == 0), 0).otherwise(F.ceil((rn - first) / block)).cast("int")


def label_segments(df: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Add ``segment`` to the rows of each series, in the order of their days."""
    state = Window.partitionBy(KEY)
    rn = F.row_number().over(state.orderBy("ds"))
    return df.withColumn(SEGMENT, segment_of(rn, F.count("*").over(state), folds))


def before(segments: DataFrame, sums: Sequence[str] = (), largest: Sequence[str] = (),
           last: Sequence[str] = ()) -> DataFrame:
    """One row per fold from one row per block: what is known from the blocks before it.

    ``sums`` are arrays added up entry by entry, ``largest`` columns of which the largest counts,
    ``last`` columns taken from the block just before.
    """
    order = Window.partitionBy(KEY).orderBy(SEGMENT)
    past = order.rowsBetween(Window.unboundedPreceding, -1)

    def total(name: str) -> Column:
        listed = F.collect_list(name).over(past)
        rest = F.slice(listed, 2, F.size(listed) - 1)
        return F.aggregate(rest, listed[0], lambda a, b: F.zip_with(a, b, lambda x, y: x + y))

    columns = {f"{name}_": F.when(F.col(SEGMENT) > 0, total(name)) for name in sums}
    columns |= {f"{name}_": F.max(name).over(past) for name in largest}
    columns |= {f"{name}_": F.lag(name).over(order) for name in last}
    known = segments.withColumns(columns).filter(F.col(SEGMENT) > 0)
    return known.select(KEY, F.col(SEGMENT).alias(FOLD), *[F.col(f"{n}_").alias(n) for n in (*sums, *largest, *last)])


def fold_grams(rows: DataFrame, columns: Sequence[str],
               build: Callable[[pd.DataFrame], np.ndarray], width: int) -> DataFrame:
    """``gram`` per state and fold: cross products of what ``build`` makes of the rows before it."""
    return before(summed_grams(rows, [KEY, SEGMENT], columns, build, width), sums=["gram"])


def judged(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """The rows of every block with the fits of the fold that is judged on it."""
    targets = rows.filter(F.col(SEGMENT) > 0).select(KEY, "ds", F.col(SEGMENT).alias(FOLD), F.col("total").alias("actual"))
    return targets.join(fits, [KEY, FOLD])


def fold_scores(forecasts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """RMSE per state and fold; infinite where a day has no finite forecast."""
    whole = F.bool_and(finite(F.col("yhat")).isNotNull())
    score = F.when(whole, rmse(F.col("actual"), F.col("yhat"))).otherwise(float("inf"))
    return forecasts.groupBy(KEY, *keys, FOLD).agg(score.alias("rmse"))


def mean_over_folds(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean RMSE over the folds of every state (and configuration)."""
    return scores.groupBy(KEY, *keys).agg(F.avg("rmse").alias("rmse"), F.count("*").alias("n_folds"))
