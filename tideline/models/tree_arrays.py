"""Boosted trees as flat arrays: scored in stages, and day by day into the future.

A fitted ensemble has at most trees x 2^(depth + 1) nodes, whatever the data, so it travels to the
tasks as a few arrays. There a whole batch of rows goes down all trees at once. Two things follow
that the library's own scoring cannot do: the first k trees of one fit are scored along with all of
them, and a prediction can become an input of the next day, for all series of a batch together.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.config import FEATURES, HORIZON_DAYS, LAGS, ROLLING_WINDOWS, TREES
from tideline.functions.calendar import calendar_columns
from tideline.functions.linear import DOUBLES
from tideline.functions.scalars import finite
from tideline.models.closed_form import as_predictions
from tideline.operators.features import LONGEST_LOOK_BACK
from tideline.operators.horizon import last_rows
from tideline.session import exists, new_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = "state"
# Rows that go down all trees at once.
BLOCK_ROWS = 2_048
N_CALENDAR = len(FEATURES) - len(LAGS) - 4 * len(ROLLING_WINDOWS)


@dataclass(frozen=True)
class TreeArrays:
    """Nodes of all trees in one numbering; a leaf is its own child on both sides."""

    root: np.ndarray
    weight: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def staged(self, inputs: np.ndarray, stages: Sequence[int]) -> np.ndarray:
        """Prediction of the first ``stages[j]`` trees for every row, as column ``j``."""
        out = np.empty((len(inputs), len(stages)))
        for i in range(0, len(inputs), BLOCK_ROWS):
            rows = inputs[i : i + BLOCK_ROWS]
            at = np.broadcast_to(self.root, (len(rows), len(self.root)))
            own = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                at = np.where(rows[own, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            parts = self.value[at] * self.weight
            for j, n in enumerate(stages):
                out[i : i + BLOCK_ROWS, j] = parts[:, :n].sum(axis=1)
        return out

    def predict(self, inputs: np.ndarray) -> np.ndarray:
        return self.staged(inputs, [len(self.root)])[:, 0]


def grown_from(nodes: pd.DataFrame, weights: Sequence[float]) -> TreeArrays:
    """Arrays from ``nodes(tree, id, value, left, right, feature, threshold)``; leaves have left -1."""
    nodes = nodes.sort_values(["tree", "id"], ignore_index=True)
    tree = nodes["tree"].to_numpy()
    first = np.searchsorted(tree, np.arange(len(weights)))
    if not np.array_equal(nodes["id"].to_numpy(), np.arange(len(nodes)) - first[tree]):
        raise ValueError("the nodes of every tree must be numbered from 0")
    leaf = nodes["left"].to_numpy() < 0
    own = np.arange(len(nodes))
    left = np.where(leaf, own, nodes["left"].to_numpy() + first[tree])
    right = np.where(leaf, own, nodes["right"].to_numpy() + first[tree])
    depth, level = 0, first
    while not leaf[level].all():
        inner = level[~leaf[level]]
        level = np.concatenate([left[inner], right[inner]])
        depth += 1
    return TreeArrays(
        first, np.asarray(weights, dtype=float), np.where(leaf, 0, nodes["feature"].to_numpy()),
        nodes["threshold"].fillna(0.0).to_numpy(dtype=float), left, right,
        nodes["value"].to_numpy(dtype=float), depth,
    )


def tree_arrays(model: GBTRegressionModel, spark) -> TreeArrays:
    """The nodes of a fitted ensemble, read back from its saved form, which grown ones already have."""
    path = getattr(model, "saved_at", None)
    if path is None or not exists(path, spark):
        path = new_path(spark)
        model.write().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["prediction"].alias("value"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        split["featureIndex"].alias("feature"),
        F.get(split["leftCategoriesOrThreshold"], 0).alias("threshold"),
        split["numCategories"].alias("categories"),
    ).toArrow().to_pandas()
    if (nodes["categories"] >= 0).any():
        raise ValueError("only splits on numbers are supported")
    return grown_from(nodes, list(model.treeWeights))


def numbers(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(name).cast("double") for name in columns])


def staged_predictions(arrays: TreeArrays, inputs: Column, stages: Sequence[int], spark) -> Column:
    """Array column: the prediction of the first n trees for each n of ``stages``."""
    # Only the arrays are broadcast: their class travels with the function, the workers need no module.
    held, stages = spark.sparkContext.broadcast(vars(arrays)), list(stages)

    @F.pandas_udf(DOUBLES)
    def staged(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return rows
        return pd.Series(list(TreeArrays(**held.value).staged(np.stack(rows.to_numpy()), stages)))

    return staged(inputs)


# -- recursive forecasts ---------------------------------------------------------------------------


def window_features(amounts: np.ndarray, at: int) -> np.ndarray:
    """Lags and rolling statistics of the rows at position ``at`` of every series.

    Their own amounts are not known yet, so a rolling window holds the rows before them only. What
    cannot be computed (NaN amounts: a series shorter than the window) is 0.
    """
    columns = [amounts[:, at - k] for k in LAGS]
    for size in ROLLING_WINDOWS:
        past = amounts[:, at - size + 1 : at]
        known = ~np.isnan(past)
        n = known.sum(axis=1)
        filled = np.where(known, past, 0.0)
        mean = filled.sum(axis=1) / np.maximum(n, 1)
        spread = np.where(known, past - mean[:, None], 0.0)
        std = np.sqrt((spread * spread).sum(axis=1) / np.maximum(n - 1, 1))
        low = np.where(known, past, np.inf).min(axis=1)
        high = np.where(known, past, -np.inf).max(axis=1)
        some = n > 0
        columns += [np.where(some, x, 0.0) for x in (mean, np.where(n > 1, std, 0.0), low, high)]
    return np.nan_to_num(np.column_stack(columns), nan=0.0)


def in_range(features: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Amount features in units of their series: deviations are only divided."""
    shift = np.repeat(low[:, None], features.shape[1], axis=1)
    for i in range(len(ROLLING_WINDOWS)):
        shift[:, len(LAGS) + 4 * i + 1] = 0.0
    return (features - shift) / width[:, None]


def paths_ahead(predict: Callable[[np.ndarray], np.ndarray], tails: Sequence, calendars: Sequence,
                low: np.ndarray, width: np.ndarray) -> list[np.ndarray]:
    """Amounts of the days to come, each an input of the days after it; all series step together."""
    steps = np.array([len(c) // N_CALENDAR for c in calendars])
    most = int(steps.max(initial=0))
    amounts = np.full((len(tails), LONGEST_LOOK_BACK + most), np.nan)
    days = np.zeros((len(tails), most, N_CALENDAR))
    for i, (tail, calendar) in enumerate(zip(tails, calendars)):
        amounts[i, LONGEST_LOOK_BACK - len(tail) : LONGEST_LOOK_BACK] = tail
        days[i, : steps[i]] = np.reshape(calendar, (-1, N_CALENDAR))
    for step in range(most):
        at = LONGEST_LOOK_BACK + step
        scaled = in_range(window_features(amounts, at), low, width)
        yhat = predict(np.hstack([days[:, step], scaled]))
        amounts[:, at] = np.maximum(yhat * width + low, 0.0)
    return [row[LONGEST_LOOK_BACK : LONGEST_LOOK_BACK + n] for row, n in zip(amounts, steps)]


def recursive_paths(arrays: TreeArrays, starts: DataFrame) -> DataFrame:
    """``starts(state, last_ds, tail, days, total_min, total_range)`` with the ``path`` of the days ahead."""
    held = starts.sparkSession.sparkContext.broadcast(arrays)

    @F.pandas_udf(DOUBLES)
    def ahead(tail: pd.Series, calendar: pd.Series, low: pd.Series, width: pd.Series) -> pd.Series:
        # An infinite amount makes paths of no numbers; they are told by their values afterwards.
        with np.errstate(all="ignore"):
            return pd.Series(paths_ahead(held.value.predict, tail, calendar, low.to_numpy(), width.to_numpy()))

    def day_inputs(ds: Column) -> Column:
        return F.array(*[x.cast("double") for x in calendar_columns(ds).values()])

    dates = F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", F.col("days")))
    calendar = F.flatten(F.transform(dates, day_inputs))
    return starts.withColumn("path", ahead("tail", calendar, "total_min", "total_range"))


def recursive_forecast(arrays: TreeArrays, scale: DataFrame, history: DataFrame, targets: DataFrame,
                       name: str = TREES) -> DataFrame:
    """Forecast in which every predicted amount enters the lags and windows of the days after it.

    Only the last 30 amounts of a series and the number of days wanted leave its rows; a series
    without a scale, or a target that is not after its history, has no prediction.
    """
    tails = last_rows(history, LONGEST_LOOK_BACK).groupBy(KEY).agg(
        F.max("ds").alias("last_ds"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("ds", F.col("total").cast("double").alias("total")))),
            lambda row: row["total"],
        ).alias("tail"),
    )
    starts = tails.join(scale, KEY)
    ahead = F.datediff("ds", "last_ds")
    days = targets.select(KEY, "ds").join(tails.select(KEY, "last_ds"), KEY).groupBy(KEY).agg(
        F.max(ahead).alias("days")
    )
    paths = recursive_paths(arrays, starts.join(days.filter("days > 0"), KEY))
    joined = targets.select(KEY, "ds").join(paths.select(KEY, "last_ds", "path"), KEY).filter(ahead > 0)
    return as_predictions(joined, name, finite(F.get("path", ahead - 1)))


def recursive_future(arrays: TreeArrays, scale: DataFrame, dense: DataFrame,
                     days: int = HORIZON_DAYS, name: str = TREES) -> DataFrame:
    """The next ``days`` days of every series."""
    ends = dense.groupBy(KEY).agg(F.max("ds").alias("last_ds"))
    dates = F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", days))
    return recursive_forecast(arrays, scale, dense, ends.select(KEY, F.explode(dates).alias("ds")), name)
