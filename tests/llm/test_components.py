"""Connected components of links."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tideline.llm.near_duplicates import components

R = random.Random(4)
SHAPES = {
    "none": [],
    "loops": [(3, 3)],
    "chain": [(i, i + 1) for i in range(60)],
    "tangled chain": (lambda order: list(zip(order, order[1:])))(R.sample(range(80), 80)),
    "star": [(50, i) for i in range(50)] + [(i, 50) for i in range(50)],
    "random": [(R.randrange(200), R.randrange(200)) for _ in range(150)],
    "negative": [(-5, 7), (7, 2**62), (2**62, -(2**63)), (1, 2)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_components(spark, shape):
    links = SHAPES[shape]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert len(found) == len(nodes)
    assert {r.node: r.component for r in found} == brute.lowest(nodes, links)


def test_columns_of_no_links(spark):
    found = components(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b")))
    assert found.columns == ["node", "component"] and found.count() == 0
