"""Learned models that are fitted once for all series together.

Totals of different states differ by orders of magnitude, so every amount-like column is put in
units of its own series' training range. After that a row no longer needs to name its state, and
one distributed fit serves any number of series; no label index of the states is collected.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline import config as c
from tideline.functions.scalars import clip_negative, finite, pad_left
from tideline.models.closed_form import as_predictions
from tideline.models.tree_growth import DEEPEST, grown_model
from tideline.operators.features import complete_rows, ensure_features, fill_features
from tideline.operators.scale import min_max_scale, scaler_stats, unscaled
from tideline.operators.sequences import held_sequence, last_sequence, lookback_sequences
from tideline.operators.split import with_enough_rows
from tideline.session import checkpoint_dir, materialize

KEY = "state"
AMOUNT_FEATURES = c.LAG_FEATURES + c.ROLLING_FEATURES
# Rows that make a task of tree building worth its start.
TREE_TASK_ROWS = 25_000
# Rows up to which one task grows all trees of a fit: a job for every level would cost more.
TREE_FIT_ROWS = 200_000
# Ridge term of the look-back regression: neighbouring lags are almost collinear.
LOOKBACK_RIDGE = 0.01


def amount_scale(train: DataFrame) -> DataFrame:
    """Smallest amount and range of each series; a constant series gets range 1."""
    return scaler_stats(train, ["total"])


def in_units(features: DataFrame, scale: DataFrame) -> DataFrame:
    """Features and amount relative to the training range of their series."""
    low, width = F.col("total_min"), F.col("total_range")
    columns = {}
    for name in AMOUNT_FEATURES:
        shifted = F.col(name) if name.startswith("rolling_std") else F.col(name) - low
        columns[name] = shifted / width
    joined = features.join(scale, KEY).withColumns(columns)
    if "total" in features.columns:
        joined = joined.withColumn("target", (F.col("total") - low) / width)
    return joined


def only_finite(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose columns are all numbers: an infinite amount must not stop a pooled fit."""
    return df.filter(F.forall(
        F.array(*[F.col(name).cast("double") for name in columns]), lambda x: finite(x).isNotNull()
    ))


def assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(c.FEATURES), outputCol="inputs").transform(df)


def back_to_amount(prediction: str | Column = "prediction") -> Column:
    value = F.col(prediction) if isinstance(prediction, str) else prediction
    return clip_negative(unscaled(value, "total"))


# -- boosted trees -------------------------------------------------------------------------------


def tree_inputs(train: DataFrame, scale: DataFrame) -> DataFrame:
    """Training rows of the trees: complete features, scaled and assembled."""
    rows = only_finite(in_units(complete_rows(train), scale), [*c.FEATURES, "target"])
    return assembled(rows).select(KEY, "ds", "inputs", "target")


def kept_inputs(inputs: DataFrame, spread: bool = True) -> DataFrame:
    """Inputs of the trees, kept once in partitions of some size.

    They are on at least as many partitions as there are cores, unless several fits overlap, but on
    fewer where a task would have too little to do.
    """
    cores = inputs.sparkSession.sparkContext.defaultParallelism
    inputs = materialize(inputs)
    now = inputs.rdd.getNumPartitions()
    enough = max(inputs.count() // TREE_TASK_ROWS, 1)
    if enough < now:
        return inputs.coalesce(enough)
    if spread and now < min(cores, enough):
        return inputs.repartition(min(cores, enough))
    return inputs


def fit_trees(inputs: DataFrame, trees: int = c.TREE_COUNT, depth: int = c.TREE_DEPTH,
              step: float = c.TREE_STEP, row_share: float = c.TREE_ROW_SHARE,
              spread: bool = True, kept: bool = False) -> GBTRegressionModel:
    """Boosted trees over the rows of all series.

    Fits that overlap share inputs that are ``kept``; the library's model is read from the nodes of
    such a fit only if something asks for it.

    Spark draws the column subset anew for every node. Up to ``TREE_FIT_ROWS`` rows, one task grows
    the trees of the library from them. Beyond, tree building repeats passes over the rows, several
    small jobs a tree; their lineage is cut in the checkpoint folder every ten trees.
    """
    checkpoint_dir(inputs.sparkSession)
    if not kept:
        inputs = kept_inputs(inputs, spread)
    regressor = GBTRegressor(
        featuresCol="inputs",
        labelCol="target",
        maxIter=trees,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=row_share,
        featureSubsetStrategy=str(c.TREE_COLUMN_SHARE),
        seed=c.TREE_SEED,
        checkpointInterval=10,
    )
    if 0 < inputs.count() <= TREE_FIT_ROWS and depth <= DEEPEST:
        model = grown_model(regressor, inputs, len(c.FEATURES))
        return model if kept else model.library()
    return regressor.fit(inputs)


def predict_trees(model: GBTRegressionModel, scale: DataFrame, features: DataFrame,
                  name: str = c.TREES) -> DataFrame:
    """One prediction per row; gaps in the features are carried forward, then 0.

    Rows that lack a feature column altogether get all of them computed first.
    """
    rows = tree_targets(features, scale)
    return as_predictions(model.transform(rows), name, back_to_amount())


def tree_targets(features: DataFrame, scale: DataFrame) -> DataFrame:
    """Rows to be scored by trees, whole and assembled, with the scale of their series."""
    return assembled(in_units(fill_features(ensure_features(features)), scale))


# -- look-back regression ------------------------------------------------------------------------


SCALED = [*c.FEATURES, "total"]


def lookback_scale(train: DataFrame) -> DataFrame:
    """Training range of every feature and of the amount, per series."""
    return scaler_stats(complete_rows(train, with_total=True), SCALED)


def feature_steps() -> Column:
    return F.array(*[F.col(name).cast("double") for name in c.FEATURES])


def sequence_inputs(train: DataFrame, scale: DataFrame, length: int) -> DataFrame:
    """Flattened look-back sequences of all scaled features, for series with enough rows.

    The wide vector exists only inside a task: the regression reads each row once and keeps sums.
    """
    complete = complete_rows(train, with_total=True)
    long_enough = with_enough_rows(complete, length + c.LOOKBACK_MARGIN, F.lit(True))
    rows = min_max_scale(long_enough, scale, SCALED)
    rows = only_finite(rows, SCALED)
    return lookback_sequences(rows, feature_steps(), length).select(
        KEY,
        "ds",
        F.col("total").alias("target"),
        array_to_vector(F.flatten("sequence")).alias("inputs"),
    )


def fit_lookback(inputs: DataFrame) -> LinearRegressionModel:
    """Ridge regression on the flattened sequences: one pass, one normal-equation solve."""
    regression = LinearRegression(
        featuresCol="inputs", labelCol="target", regParam=LOOKBACK_RIDGE, solver="normal"
    )
    return regression.fit(inputs)


def predict_lookback(model: LinearRegressionModel, scale: DataFrame, history: DataFrame,
                     targets: DataFrame, name: str = c.LOOKBACK_MODEL) -> DataFrame:
    """Multi-step forecast in which the last known feature row is repeated.

    No step needs the prediction of the step before, so all steps are scored at once. Beyond the
    look-back of the model the input no longer changes; such days share the last distinct one.
    """
    length = model.numFeatures // len(c.FEATURES)
    amount = scale.select(KEY, "total_min", "total_range")
    others = scale.drop("total_min", "total_range")
    rows = min_max_scale(fill_features(history), others, list(c.FEATURES))
    tails = last_sequence(rows, feature_steps(), length).join(amount, KEY)
    positions = F.explode(F.sequence(F.lit(1), F.lit(length + 1)))
    inputs = tails.withColumn("position", positions).select(
        KEY,
        "last_ds",
        "position",
        "total_min",
        "total_range",
        array_to_vector(
            F.flatten(held_sequence(F.col("sequence"), F.col("position"), length))
        ).alias("inputs"),
    )
    scored = model.transform(inputs).select(
        KEY, "last_ds", "position", back_to_amount().alias("yhat")
    )
    paths = scored.groupBy(KEY).agg(
        F.max("last_ds").alias("last_ds"),
        F.sort_array(F.collect_list(F.struct("position", "yhat"))).alias("path"),
    )
    ahead = F.least(F.datediff("ds", "last_ds"), F.lit(length + 1))
    joined = targets.select(KEY, "ds").join(paths, KEY)
    return as_predictions(joined, name, F.get("path.yhat", ahead - 1))


# -- look-back regression on the amounts alone ---------------------------------------------------


def amount_sequences(history: DataFrame, scale: DataFrame, length: int) -> DataFrame:
    """The ``length`` scaled amounts before each row, and the row's own as target."""
    rows = min_max_scale(history.select(KEY, "ds", "total"), scale, ["total"])
    return lookback_sequences(rows, F.col("total"), length).select(
        KEY, "ds", F.col("total").alias("target"), array_to_vector("sequence").alias("inputs")
    )


def predict_amounts(model: LinearRegressionModel, scale: DataFrame, history: DataFrame,
                    targets: DataFrame, name: str = c.LOOKBACK_MODEL) -> DataFrame:
    """Multi-step forecast in which every prediction becomes an input of the next step.

    The recursion runs on one array per series, from its last amounts; a series shorter than the
    look-back is extended on the left with its first amount.
    """
    weights = [float(w) for w in model.coefficients]
    length = len(weights)
    rows = min_max_scale(history.select(KEY, "ds", "total"), scale, ["total"])
    tails = last_sequence(rows, F.col("total"), length).withColumn(
        "tail", pad_left(F.col("sequence"), length)
    )
    steps = targets.join(tails.select(KEY, "last_ds"), KEY).groupBy(KEY).agg(
        F.max(F.datediff("ds", "last_ds")).alias("steps")
    )

    def extend(path: Column, _: Column) -> Column:
        products = F.zip_with(
            F.slice(path, -length, length), F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w
        )
        following = F.aggregate(products, F.lit(float(model.intercept)), lambda a, x: a + x)
        return F.concat(path, F.array(following))

    paths = tails.join(steps, KEY).select(
        KEY, "last_ds", F.aggregate(F.sequence(F.lit(1), F.col("steps")), "tail", extend).alias("path")
    )
    joined = targets.select(KEY, "ds").join(paths, KEY).join(scale, KEY)
    scaled_yhat = F.get("path", length - 1 + F.datediff("ds", "last_ds"))
    return as_predictions(joined, name, clip_negative(unscaled(scaled_yhat, "total")))
