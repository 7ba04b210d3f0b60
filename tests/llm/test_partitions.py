"""The learned partitions: what they find, and how little they read for it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tideline.llm import neighbours


def vectors(kind, n, d, seed=5):
    r = np.random.default_rng(seed)
    if kind == "clustered":
        centres = r.normal(size=(60, d))
        return centres[r.integers(0, 60, n)] + 0.2 * r.normal(size=(n, d))
    return r.normal(size=(n, d))


@pytest.mark.parametrize(("kind", "leaf_rows", "most_read"), [
    ("clustered", 20_000, 1 / 3), ("unclustered", 20_000, 0.85), ("unclustered", 100, 0.85),
])
def test_recall_and_reading(spark, kind, leaf_rows, most_read):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.float32(vectors(kind, 3000, 12)))]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    asks = F.col("vec_id") % 100 == 0
    expected = brute.nearest([(i, np.float32(v)) for i, v in rows], set(range(0, 3000, 100)))
    found = {}
    for r in neighbours.nearest(table, asks, leaf_rows=leaf_rows).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert all(len(set(x)) == 10 for x in found.values()) and len(found) == 30
    hits = sum(len(set(found[q]) & {i for i, _ in best}) for q, best in expected.items())
    assert hits >= 0.87 * 300  # 30 queries; the share of all rows is tuned to 0.93
    read = neighbours.reading(table, asks, leaf_rows=leaf_rows)
    assert read["compared"] <= most_read
    assert read["leaves"] >= (40 if leaf_rows < 20_000 else 20)


def test_setting_reads_least():
    top = neighbours.Router(np.zeros(1), np.ones(1), np.array([[1.0, -1.0]]), np.zeros(2), np.eye(2), np.zeros(2))
    index = neighbours.Index(top, {})
    queries = np.array([[1.0], [2.0], [-1.0], [-2.0]])
    # Every neighbour is at home with its query but one, whose second copy is.
    homes = [np.array([[0, 1, -1]] * 4), np.array([[0, 1, -1]] * 3 + [[1, 0, -1]]), np.array([[1, -1, -1]] * 4),
             np.array([[1, -1, -1]] * 4)]
    held = np.array([[50, 50], [10, 10], [0, 0]])
    assert neighbours.choose_setting(index, queries, homes, held, 0.9) == (1, 0.0)
    copies, share = neighbours.choose_setting(index, queries, homes, held, 1.0)
    assert (copies, share) == (2, 0.0)


def test_leaves_of_a_large_part():
    d = 1
    split = neighbours.Router(np.zeros(d), np.ones(d), np.array([[1.0, -1.0]]), np.zeros(2), np.eye(2), np.zeros(2))
    index = neighbours.Index(split, {1: split})
    assert index.n_leaves == 3 and index.first.tolist() == [0, 1, 3]
    p = index.probabilities(np.array([[3.0], [-3.0]]))
    assert p.sum(axis=1) == pytest.approx([1, 1])
    assert index.homes(np.array([[3.0], [-3.0]]), 3)[:, 0].tolist() == [0, 2]
    assert index.homes(np.array([[-3.0]]), 1).tolist() == [[2]]
    order, before = index.order(np.array([[-3.0]]))
    assert order[0].tolist() == [2, 0, 1] or order[0, 0] == 2
    assert before[0, 0] == 0 and (np.diff(before[0]) >= 0).all()
