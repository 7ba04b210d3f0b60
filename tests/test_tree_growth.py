"""Trees grown inside one task: the library's nodes, by a few jobs, whatever the grid."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tideline import config as c
from tideline.models import pooled
from tideline.models import tree_arrays as ta
from tideline.models import tree_growth as tg
from tideline.session import materialize, new_path


def inputs_of(spark, n, columns=6):
    """Rows with smooth, coarse, sparse and constant columns, some of which split alike."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, columns))
    x[:, 1] = np.arange(n) % 7
    x[:, 2] = (x[:, 1] >= 5) * 1.0
    x[:, 3] = np.where(rng.random(n) < 0.7, 0.0, x[:, 3])
    x[:, 4] = 3.0
    y = np.sin(x[:, 0]) + x[:, 2] - 0.2 * x[:, 3] + rng.normal(scale=0.3, size=n)
    rows = spark.createDataFrame(
        [(i, *map(float, row)) for i, row in enumerate(np.column_stack([y, x]))],
        ", ".join(["n int", "target double", *[f"x{i} double" for i in range(columns)]]),
    ).withColumn("x", F.array(*[f"x{i}" for i in range(columns)]))
    return rows.select(array_to_vector("x").alias("inputs"), "target", "n")


def nodes_of(model, spark):
    path = new_path(spark)
    model.write().save(path)
    return [tuple(r) for r in spark.read.parquet(f"{path}/data").orderBy("treeID", "nodeData.id").collect()]


def regressor(trees, depth, share=0.8):
    return GBTRegressor(
        featuresCol="inputs", labelCol="target", maxIter=trees, maxDepth=depth, stepSize=0.3,
        subsamplingRate=share, featureSubsetStrategy="0.7", seed=42,
    )


@pytest.mark.parametrize(("n", "trees", "depth", "share"), [
    (1, 2, 2, 0.8), (3, 3, 2, 0.5), (40, 4, 4, 0.8), (300, 5, 8, 0.9), (300, 3, 0, 0.8), (12_000, 3, 4, 1.0),
    (30_000, 3, 5, 0.8),
])
def test_nodes_are_those_of_the_library(spark, n, trees, depth, share):
    inputs = materialize(inputs_of(spark, n).orderBy("n").coalesce(1))
    by = regressor(trees, depth, share)
    grown = tg.grown_model(by, inputs, 6)
    library = by.fit(inputs)
    assert nodes_of(grown, spark) == nodes_of(library, spark)
    assert list(grown.treeWeights) == list(library.treeWeights)
    assert (grown.uid, grown.getNumTrees, grown.numFeatures) == (library.uid, library.getNumTrees, library.numFeatures)
    assert grown.getMaxDepth() == library.getMaxDepth()
    assert grown.featureImportances.toArray() == pytest.approx(library.featureImportances.toArray())


def test_every_partition_keeps_its_own_draws(spark):
    inputs = materialize(inputs_of(spark, 900).repartitionByRange(3, "n").sortWithinPartitions("n"))
    assert inputs.rdd.getNumPartitions() == 3
    by = regressor(4, 4)
    found = tg.grown_model(by, inputs, 6).transform(inputs).orderBy("n").toPandas()["prediction"]
    expected = by.fit(inputs).transform(inputs).orderBy("n").toPandas()["prediction"]
    assert found.to_numpy() == pytest.approx(expected.to_numpy(), rel=1e-9)


def test_equal_leaves_are_their_parents(spark):
    """A second tree over a target that the first one met has nothing left to part."""
    rows = spark.createDataFrame([([float(i % 2)], float(i % 2)) for i in range(40)], "x array<double>, target double")
    inputs = materialize(rows.select(array_to_vector("x").alias("inputs"), "target").coalesce(1))
    by = GBTRegressor(featuresCol="inputs", labelCol="target", maxIter=3, maxDepth=3, featureSubsetStrategy="0.8", seed=42)
    assert nodes_of(tg.grown_model(by, inputs, 1), spark) == nodes_of(by.fit(inputs), spark)


def test_a_fit_is_a_few_jobs_and_large_ones_stay_with_the_library(spark, seasonal, monkeypatch):
    from tideline.plans.prepare import daily_series

    featured = materialize(pooled.ensure_features(materialize(daily_series(seasonal()))))
    inputs = materialize(pooled.tree_inputs(featured, materialize(pooled.amount_scale(featured))))
    context = spark.sparkContext
    found = []
    for group, most in (("grown", pooled.TREE_FIT_ROWS), ("library", inputs.count() - 1)):
        monkeypatch.setattr(pooled, "TREE_FIT_ROWS", most)
        context.setJobGroup(group, group)
        try:
            model = pooled.fit_trees(inputs, trees=15, depth=4)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        arrays = ta.tree_arrays(model, spark)
        rows = pd.DataFrame(inputs.select(F.col("inputs")).toPandas())
        jobs = len(context.statusTracker().getJobIdsForGroup(group))
        found.append((arrays.predict(np.stack([v.toArray() for v in rows["inputs"]])), jobs))
    (grown, few), (library, many) = found
    assert few < 20 < 15 * 4 < many
    assert grown == pytest.approx(library, rel=1e-9)
    assert len(inputs.first()["inputs"]) == len(c.FEATURES)
