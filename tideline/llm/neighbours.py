"""Approximate nearest neighbours by learned partitions of a neighbour graph.

1. A bounded sample's exact neighbour graph is cut into balanced parts by label propagation under a
   size limit, and a small softmax classifier learns from a vector the share of its neighbours in
   each part.
2. A part that holds more than ``LEAF_ROWS`` rows is cut again in the same way, from a sample of its
   own, one task a part; so there are more leaves the more rows there are, up to 64 x 64.
3. Every row is placed in its most probable leaf, or in its two or three most probable ones. A query
   probes leaves, most probable first, until they hold a given share of the probability. Copies and
   share are chosen together: for a few hundred rows the exact neighbours among all rows are found,
   and of the settings that would find ``TARGET_RECALL`` of them the one that reads least is taken.
4. A query whose leaves hold too few rows goes on to its next ones. Candidates of the probed leaves
   are reranked by exact distance, in blocks: a leaf's rows and the queries that probe it are dealt
   into blocks of bounded size, and every pair of blocks is one task that keeps the best of a query.

Defined results: vectors that are null, empty, zero, of another dimension than the sample's most
common one, or hold null or non-finite components take no part, as row or query; equal distances go
to the smaller id; rows that repeat an id are candidates of their own; a query's own id is never its
neighbour; with fewer candidates than asked for, all are returned; an empty table gives none.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.session import materialize

# Bounds of the sample that a cut is fitted on, and of the rows whose exact neighbours are found.
SAMPLE_ROWS = 6_000
TUNING_QUERIES = 500
GRAPH_NEIGHBOURS = 10
# Sampled rows in a part, parts of one cut, and rows in a part from which it is cut again.
ROWS_PER_PART = 95
MOST_PARTS = 64
LEAF_ROWS = 20_000
MOST_COPIES = 3
# Share of the exact neighbours that the tuning rows are to find; the error of 500 rows is below 0.01.
TARGET_RECALL = 0.93
BLOCK_ROWS = 20_000
BLOCK_QUERIES = 2_000
TRAINING_STEPS = 300


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components and not only zeros."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _nearest(rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of each row's ``k`` nearest other rows, in blocks."""
    squares = (rows**2).sum(axis=1)
    out = np.empty((len(rows), k), dtype=np.int64)
    for i in range(0, len(rows), 500):
        d = squares[None, :] - 2 * rows[i : i + 500] @ rows.T
        d[np.arange(len(d)), i + np.arange(len(d))] = np.inf
        best = np.argpartition(d, k - 1, axis=1)[:, :k]
        order = np.argsort(np.take_along_axis(d, best, axis=1), axis=1)
        out[i : i + 500] = np.take_along_axis(best, order, axis=1)
    return out


def balanced_parts(near: np.ndarray, rows: np.ndarray, n_parts: int, rng) -> np.ndarray:
    """Parts of nearly equal size that cut few neighbour links.

    Starts from slices along random splits of the vectors, then rows move to the part most of their
    neighbours are in, as long as it has room.
    """
    n = len(near)
    part = np.zeros(n, dtype=np.int64)
    groups = [np.arange(n)]
    while len(groups) < n_parts:
        groups.sort(key=len)
        widest = groups.pop()
        centred = rows[widest] - rows[widest].mean(axis=0)
        direction = rng.normal(size=rows.shape[1])
        for _ in range(8):  # towards the direction of the largest variance
            direction = centred.T @ (centred @ direction)
            direction /= np.linalg.norm(direction) + 1e-12
        order = np.argsort(centred @ direction, kind="stable")
        groups += [widest[order[: len(order) // 2]], widest[order[len(order) // 2 :]]]
    for i, members in enumerate(groups):
        part[members] = i
    limit = int(np.ceil(1.15 * n / n_parts))
    sizes = np.bincount(part, minlength=n_parts)
    for _ in range(8):
        votes = np.zeros((n, n_parts))
        np.add.at(votes, (np.repeat(np.arange(n), near.shape[1]), part[near].ravel()), 1)
        np.add.at(votes, (near.ravel(), np.repeat(part, near.shape[1])), 1)
        wanted = votes.argmax(axis=1)
        gain = votes.max(axis=1) - votes[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            to = wanted[i]
            if gain[i] > 0 and sizes[to] < limit:
                sizes[part[i]] -= 1
                sizes[to] += 1
                part[i] = to
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """Softmax classifier over parts."""

    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    weight: np.ndarray
    bias: np.ndarray

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        z = (vectors - self.mean) / self.scale
        logits = np.maximum(z @ self.hidden + self.hidden_bias, 0) @ self.weight + self.bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


@dataclass
class Index:
    """Leaves: the parts of a router, and in place of a large part the parts of its own router."""

    top: Router
    below: dict[int, Router]
    copies: int = 1
    share: float = 1.0  # of the probability that a query probes

    def __post_init__(self):
        sizes = [len(self.below[i].bias) if i in self.below else 1 for i in range(len(self.top.bias))]
        self.first = np.concatenate(([0], np.cumsum(sizes)))

    @property
    def n_leaves(self) -> int:
        return int(self.first[-1])

    def probabilities(self, vectors: np.ndarray, only: np.ndarray | None = None) -> np.ndarray:
        """Probability of every leaf; with ``only`` (rows by parts) 0 outside the parts chosen."""
        top = self.top.probabilities(vectors)
        out = np.zeros((len(vectors), self.n_leaves))
        for part, probability in enumerate(top.T):
            rows = slice(None) if only is None else np.flatnonzero(only[:, part])
            a, b = self.first[part], self.first[part + 1]
            inside = self.below[part].probabilities(vectors[rows]) if part in self.below else 1.0
            out[rows, a:b] = probability[rows, None] * inside
        return out

    def homes(self, vectors: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` most probable leaves of each row within its ``n`` most probable parts; -1 for none."""
        top = self.top.probabilities(vectors)
        chosen = np.zeros(top.shape, dtype=bool)
        np.put_along_axis(chosen, np.argsort(-top, axis=1, kind="stable")[:, :n], True, axis=1)
        leaves = self.probabilities(vectors, chosen)
        order = np.argsort(-leaves, axis=1, kind="stable")[:, :n]
        found = np.where(np.take_along_axis(leaves, order, axis=1) > 0, order, -1)
        found[:, 0] = order[:, 0]
        return np.pad(found, ((0, 0), (0, n - found.shape[1])), constant_values=-1)

    def order(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves of each query, most probable first, and the probability of those before each."""
        leaves = self.probabilities(vectors)
        order = np.argsort(-leaves, axis=1, kind="stable")
        sums = np.cumsum(np.take_along_axis(leaves, order, axis=1), axis=1)
        return order, np.hstack([np.zeros((len(order), 1)), sums[:, :-1]])


def _train_router(rows: np.ndarray, shares: np.ndarray, rng, width: int = 128) -> Router:
    """One hidden layer, fitted by Adam to the shares of each row's neighbours per part."""
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    z = (rows - mean) / scale
    n, d = z.shape
    p = [rng.normal(size=(d, width)) * np.sqrt(2 / d), np.zeros(width),
         rng.normal(size=(width, shares.shape[1])) * np.sqrt(1 / width), np.zeros(shares.shape[1])]
    m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for step in range(1, TRAINING_STEPS + 1):
        pick = rng.integers(0, n, min(n, 512))
        x, y = z[pick], shares[pick]
        h = np.maximum(x @ p[0] + p[1], 0)
        logits = h @ p[2] + p[3]
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        g = (e / e.sum(axis=1, keepdims=True) - y) / len(pick)
        gh = (g @ p[2].T) * (h > 0)
        grads = [x.T @ gh + 1e-4 * p[0], gh.sum(axis=0), h.T @ g + 1e-4 * p[2], g.sum(axis=0)]
        for i, grad in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad**2
            p[i] = p[i] - 0.01 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Router(mean, scale, *p)


def single_part(dimension: int) -> Router:
    d = dimension
    return Router(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))


def fit_router(rows: np.ndarray, n_parts: int | None = None, seed: int = 7) -> Router:
    """Cut the neighbour graph of a sample, and fit a classifier to it."""
    rng = np.random.default_rng(seed)
    wanted = n_parts or len(rows) // ROWS_PER_PART
    n_parts = int(np.clip(min(wanted, len(rows) // 8), 1, MOST_PARTS))
    if n_parts == 1:
        return single_part(rows.shape[1])
    near = _nearest(rows, min(GRAPH_NEIGHBOURS, len(rows) - 1))
    part = balanced_parts(near, rows, n_parts, rng)
    shares = np.zeros((len(rows), n_parts))
    np.add.at(shares, (np.repeat(np.arange(len(rows)), near.shape[1]), part[near].ravel()), 1)
    np.add.at(shares, (np.arange(len(rows)), part), 1)
    return _train_router(rows, shares / shares.sum(axis=1, keepdims=True), rng)


def choose_setting(index: Index, queries: np.ndarray, neighbours: list[np.ndarray],
                   held: np.ndarray, target: float = TARGET_RECALL) -> tuple[int, float]:
    """Copies and share that find ``target`` of the neighbours and make queries read least.

    ``neighbours`` are the most probable leaves of each query's exact neighbours; ``held[c, leaf]``
    the rows that have the leaf as their copy number ``c``.
    """
    order, before = index.order(queries)
    place = np.argsort(order, axis=1)
    best = None
    for copies in range(1, MOST_COPIES + 1):
        # Probability passed before the first leaf that holds the neighbour; it is found if that much is probed.
        passed = [
            np.take_along_axis(np.append(before[q], np.inf),
                               np.where(homes >= 0, place[q][homes], len(before[q])).min(axis=1), axis=0)
            for q, homes in enumerate(x[:, :copies] for x in neighbours)
        ]
        needed = np.sort(np.concatenate(passed))
        if not len(needed):
            return 1, 0.0
        share = float(needed[int(np.ceil(target * len(needed))) - 1])
        rows = held[:copies].sum(axis=0)
        read = float((rows[order] * (before <= share)).sum(axis=1).mean())
        if best is None or read < 0.98 * best[0]:
            best = (read, copies, share)
    return best[1], best[2]


def _matrix(vectors: pa.Array) -> np.ndarray:
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 1))


def route(index, n: int):
    """Function from a vector column to its ``n`` most probable leaves, -1 where there are fewer."""

    @F.arrow_udf("array<int>")
    def routed(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.list_(pa.int32()))
        return pa.array(index.value.homes(_matrix(vectors), n).tolist(), pa.list_(pa.int32()))

    return routed


def probe(index, held: np.ndarray):
    """Function from a query vector and the rows it needs to the leaves it probes.

    These are the leaves up to the share of probability and, until they are home to that many rows,
    the next most probable ones.
    """

    @F.arrow_udf("array<int>")
    def probed(vectors: pa.Array, needed: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.list_(pa.int32()))
        order, before = index.value.order(_matrix(vectors))
        within = held[order].cumsum(axis=1)
        few = (within < needed.to_numpy(zero_copy_only=False)[:, None]).sum(axis=1)
        n = np.maximum((before <= index.value.share).sum(axis=1), few + 1)
        return pa.array([row[:i].tolist() for row, i in zip(order, n)], pa.list_(pa.int32()))

    return probed


def sample_vectors(rows: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """The ``n`` usable vectors with the smallest hashed ids, of their most common dimension."""
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(n).select("vector").toArrow()["vector"].to_pylist()
    if not picked:
        return np.zeros((0, 0)), 0
    sizes = pd.Series([len(v) for v in picked]).value_counts()
    dimension = int(sizes[sizes == sizes.max()].index.max())
    return np.array([v for v in picked if len(v) == dimension], dtype=np.float64), dimension


def fit_below(rows: DataFrame, top: Router, leaf_rows: int) -> dict[int, Router]:
    """Routers of the parts with more than ``leaf_rows`` rows, each fitted by one task on a sample."""
    index = rows.sparkSession.sparkContext.broadcast(Index(top, {}))
    parted = rows.select("id", "vector", F.element_at(route(index, 1)(F.col("vector")), 1).alias("part"))
    sizes = parted.groupBy("part").agg(F.count("*").alias("n")).filter(F.col("n") > leaf_rows)
    large = parted.join(sizes, "part")
    order = Window.partitionBy("part").orderBy(F.xxhash64("id", F.lit(2)), "id")
    sample = large.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SAMPLE_ROWS)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(group["vector"].to_numpy()).astype(np.float64)
        wanted = -(-int(group["n"].iloc[0]) // leaf_rows)
        return pd.DataFrame({"part": [group["part"].iloc[0]], "router": [pickle.dumps(fit_router(vectors, wanted))]})

    # At most MOST_PARTS small networks.
    fitted = sample.select("part", "vector", "n").groupBy("part").applyInPandas(fit, "part int, router binary")
    return {r.part: pickle.loads(r.router) for r in fitted.collect()}


def exact_neighbours(placed: DataFrame, queries: np.ndarray, k: int) -> list[np.ndarray]:
    """Leaves of the ``k`` nearest rows of a few queries among all rows, as a matrix per query.

    A row at distance zero is the query itself, or as good as it for this purpose.
    """
    asked = placed.sparkSession.sparkContext.broadcast(queries)

    def best(batches):
        q = asked.value
        squares = (q**2).sum(axis=1)[:, None]
        distance = np.full((len(q), k), np.inf)
        homes = np.full((len(q), k, MOST_COPIES), -1, dtype=np.int64)
        for batch in batches:
            rows, own = _matrix(batch.column(0)), _matrix(batch.column(1)).astype(np.int64)
            for i in range(0, len(rows), 1024):
                r, h = rows[i : i + 1024], own[i : i + 1024]
                d = np.maximum(squares - 2 * q @ r.T + (r**2).sum(axis=1)[None, :], 0)
                d[d <= 1e-12 * squares] = np.inf
                both = np.hstack([distance, d])
                at = np.argpartition(both, k - 1, axis=1)[:, :k]
                all_homes = np.concatenate([homes, np.broadcast_to(h, (len(q), *h.shape))], axis=1)
                homes = np.take_along_axis(all_homes, at[:, :, None], axis=1)
                distance = np.take_along_axis(both, at, axis=1)
        number, column = np.nonzero(np.isfinite(distance))
        yield pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int32()), pa.array(distance[number, column]),
             pa.array(homes[number, column].tolist(), pa.list_(pa.int32()))], ["query", "distance", "homes"],
        )

    found = placed.select("vector", "homes").mapInArrow(best, "query int, distance double, homes array<int>")
    order = Window.partitionBy("query").orderBy("distance")
    nearest_ = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).toPandas()
    empty = np.zeros((0, MOST_COPIES), dtype=np.int64)
    groups = {q: np.stack(g["homes"].to_numpy()).astype(np.int64) for q, g in nearest_.groupby("query")}
    return [groups.get(q, empty) for q in range(len(queries))]


_FOUND = "query_id bigint, vec_id bigint, row bigint, score double"


def _block_search(k: int):
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "row": [], "score": []})
        q = np.stack(queries["vector"].to_numpy()).astype(np.float64)
        r = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        ids, own = rows["id"].to_numpy(), queries["id"].to_numpy()
        numbers = rows["row"].to_numpy()
        squares = (r**2).sum(axis=1)
        # Rounding of the product form, generously: only a filter for the exact distances below.
        slack = 1e-9 * (squares.max() + (q**2).sum(axis=1).max() + 1e-300)
        parts = []
        for i in range(0, len(q), 128):
            d = squares[None, :] - 2 * q[i : i + 128] @ r.T + (q[i : i + 128] ** 2).sum(axis=1)[:, None]
            for j, row in enumerate(d):
                row[ids == own[i + j]] = np.inf
                n = min(k, len(row))
                limit = np.partition(row, n - 1)[n - 1]
                near = np.flatnonzero((row <= limit + slack) & np.isfinite(row))
                exact = np.sqrt(((r[near] - q[i + j]) ** 2).sum(axis=1))
                best = np.lexsort((ids[near], exact))[:k]
                parts.append((own[i + j], near[best], exact[best]))
        return pd.DataFrame({
            "query_id": np.concatenate([np.full(len(x), a) for a, x, _ in parts]),
            "vec_id": np.concatenate([ids[x] for _, x, _ in parts]),
            "row": np.concatenate([numbers[x] for _, x, _ in parts]),
            "score": np.concatenate([s for _, _, s in parts]),
        })

    return search


def build_index(rows: DataFrame, k: int, leaf_rows: int = LEAF_ROWS) -> tuple[Index, DataFrame, np.ndarray, int]:
    """Index of ``rows(id, vector, asks)``, its placed rows, and the rows at home in every leaf."""
    spark = rows.sparkSession
    sample, dimension = sample_vectors(rows, SAMPLE_ROWS + TUNING_QUERIES)
    # Rows that choose the setting are not among those the cut is fitted on, but for small tables.
    tuning, rest = sample[:TUNING_QUERIES], sample[TUNING_QUERIES:]
    rows = rows.filter(F.size("vector") == dimension)
    if len(rest) < 2 * ROWS_PER_PART:
        index = Index(single_part(max(dimension, 1)), {})
    else:
        top = fit_router(rest)
        index = Index(top, fit_below(rows, top, leaf_rows))
    shared = spark.sparkContext.broadcast(index)
    homes = route(shared, MOST_COPIES)(F.col("vector"))
    placed = materialize(
        rows.withColumns({"homes": homes, "row": F.monotonically_increasing_id()})
    )
    # Rows per leaf and copy: a few thousand numbers at most.
    held = np.zeros((MOST_COPIES, index.n_leaves), dtype=np.int64)
    counts = placed.select(F.posexplode("homes").alias("copy", "leaf")).filter("leaf >= 0")
    for r in counts.groupBy("copy", "leaf").count().collect():
        held[r.copy, r.leaf] = r["count"]
    if index.n_leaves > 1:
        index.copies, index.share = choose_setting(index, tuning, exact_neighbours(placed, tuning, k), held)
    return index, placed, held, dimension


def nearest(table: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id",
            vector: str = "embedding", leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The ``k`` nearest rows found for every query row: query_id, rank, vec_id, score."""
    spark = table.sparkSession
    rows = table.select(
        F.col(key).alias("id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    index, placed, held, _ = build_index(rows, k, leaf_rows)
    asked = materialize(probing(placed, index, held, k))
    stored = placed.select("id", "vector", "row", F.explode(F.slice("homes", 1, index.copies)).alias("leaf"))
    stored = stored.filter("leaf >= 0")
    # Blocks per leaf, from its counts; ids are dealt by hash.
    sizes = stored.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("row_blocks")).join(
        asked.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("query_blocks")), "leaf"
    )
    row_block = F.pmod(F.xxhash64("id"), F.col("row_blocks"))
    query_block = F.pmod(F.xxhash64("id", F.lit(1)), F.col("query_blocks"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    right = stored.join(sizes, "leaf").select(
        "id", "vector", "row", "leaf", row_block.alias("rb"), every("query_blocks").alias("qb")
    )
    left = asked.join(sizes, "leaf").select(
        "id", "vector", "leaf", query_block.alias("qb"), every("row_blocks").alias("rb")
    )
    block = ["leaf", "rb", "qb"]
    found = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInPandas(_block_search(k), _FOUND)
    if index.copies > 1:
        # A row met in several of its leaves counts once; repeated ids are different rows.
        found = found.dropDuplicates(["query_id", "row"])
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def probing(placed: DataFrame, index: Index, held: np.ndarray, k: int) -> DataFrame:
    """``id``, ``vector`` and ``leaf`` for every leaf a query probes."""
    shared = placed.sparkSession.sparkContext.broadcast(index)
    queries = placed.filter("asks").select("id", "vector")
    # Rows with a query's own id are no candidates.
    own = placed.join(queries.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.count("*").alias("own"))
    leaves = probe(shared, held[0])(F.col("vector"), F.col("own") + k)
    return queries.join(own, "id").withColumn("leaf", F.explode(leaves)).drop("own")


def reading(table: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
            leaf_rows: int = LEAF_ROWS) -> dict[str, float]:
    """How much a query reads: leaves there are, leaves probed, and the share of rows compared."""
    rows = table.select(
        F.col(key).alias("id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    index, placed, held, _ = build_index(rows, k, leaf_rows)
    probed = probing(placed, index, held, k).groupBy("leaf").count().collect()
    n_queries, n_rows = placed.filter("asks").count(), placed.count()
    stored = held[: index.copies].sum(axis=0)
    compared = sum(int(stored[r.leaf]) * r["count"] for r in probed)
    return {
        "leaves": index.n_leaves, "copies": index.copies, "probes": sum(r["count"] for r in probed) / n_queries,
        "compared": compared / n_queries / n_rows,
    }
