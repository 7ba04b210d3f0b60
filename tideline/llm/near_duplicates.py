"""Near-duplicate groups by word shingles: SetSketch registers, banding, likelihood, verification.

1. Every text becomes its set of hashed shingles. Texts with equal sets form one class; only one
   text of a class goes on, so thousands of copies cost one row.
2. A class is sketched by SetSketch registers: per register the smallest of the members' uniform
   hashes, read as exponential variate and stored as truncated logarithm to base 1.001. Registers
   of a union are the maxima of the parts' registers.
3. Register values are banded; classes with an equal band meet in a bucket. A bucket yields a star
   from one of its members to all others, never all pairs; four choices of centre take turns.
4. Edges of stars that two buckets agree on, and the others whose similarity is not far too
   unlikely by the joint likelihood of their register comparisons, connect classes to families.
5. Links are verified on full sets inside a family: a search from class to class over an inverted
   index of the classes not yet reached, so a family of near copies costs little more than its
   size. A family too large for one task is dealt into blocks; what a block's largest component
   leaves over is compared with all other blocks. Only spanning links leave a task.

A pair of similarity 0.8 shares none of the 40 bands of 6 registers with probability 5e-6.

Sets hold 64-bit hashes of shingles (of XXH64 of words): sets of n and m shingles count a pair of
different ones as equal with probability n * m / 2^64, 1e-10 for texts of 40,000 words, and equal
sets are told by 128 bits.

Defined results: a text without words (null, empty) has an empty set and is linked with nothing;
a text of fewer words than a shingle is one shingle; repeated rows are equal texts; of a group the
smallest id represents it; a null id never represents a group that has another; an empty table
gives an empty result. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.text import NON_BLANK_BYTES, Words, free_name, mix, word_chunks
from tideline.session import materialize

SHINGLE = 5
MIN_PERCENT = 80
BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
LOG_BASE = 1.001
LARGEST_REGISTER = 65534
# A pair is dropped unverified if its likelihood at every similarity from 0.8 on is smaller than
# its best by this factor's logarithm.
LOG_LIKELIHOOD_GAP = 14.0
# Centres that take turns among the buckets of a group.
CENTERS = 4
# Shingles of the classes that one task compares with each other.
BLOCK_SHINGLES = 1_500_000

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(1 << 31, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_BAND_FACTORS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Distinct shingle hashes, sorted, of every text of a chunk."""
    n = len(words.hash)
    with np.errstate(over="ignore"):
        codes = np.zeros(n, dtype=np.uint64)
        # Shingles that begin at each word; those that cross into the next text are not used.
        for k in range(min(size, n)):
            codes[: n - k] = codes[: n - k] * np.uint64(0x9FB21C651E98DF25) + words.hash[k:]
        codes = mix(codes)
    sets = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(codes[a : b - size + 1]))
        elif b > a:
            code = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for h in words.hash[a:b]:
                    code = code * np.uint64(0xD6E8FEB86659FD93) + h
            sets.append(mix(np.array([code], dtype=np.uint64)))
        else:
            sets.append(codes[:0])
    return sets


_BLOCK = 512


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers of one non-empty set."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    smallest = np.full(REGISTERS, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(low), _BLOCK):
        products = _FACTORS[:, None] * low[None, i : i + _BLOCK]
        products += _SHIFTS[:, None]
        np.minimum(smallest, products.min(axis=1), out=smallest)
    # The smallest uniform value is the smallest exponential variate after a monotone map.
    uniform = (smallest.astype(np.float64) + 0.5) / 4294967296.0
    variate = -np.log1p(-uniform)
    levels = np.floor(1.0 - np.log(variate) / np.log(LOG_BASE))
    return np.clip(levels, 0, LARGEST_REGISTER).astype(np.uint16)


def band_keys(registers_: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    with np.errstate(over="ignore"):
        terms = mix(registers_.astype(np.uint64) + _BAND_FACTORS) * _BAND_FACTORS
        return mix(terms.reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)).view(np.int64)


def log_likelihood_gap(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray,
                       least: float) -> np.ndarray:
    """Log likelihood at the best similarity minus that at the best from ``least`` on.

    ``a`` and ``b`` hold one sketch per row, ``na`` and ``nb`` the set sizes. A register of one
    set exceeds the other's with a probability that depends on the similarity and the shares of
    the sizes; the three counts of comparisons are multinomial.
    """
    above = (a > b).sum(axis=1)[:, None]
    below = (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - above - below
    share = (na / (na + nb))[:, None]
    limit = np.minimum(share, 1 - share) / np.maximum(share, 1 - share)
    similarity = np.linspace(0.0, 1.0, 101)[None, :] * limit

    def larger(x):
        return -np.log1p(-np.clip(x, 0, 1) * (LOG_BASE - 1) / LOG_BASE) / np.log(LOG_BASE)

    p_above = np.clip(larger(share - (1 - share) * similarity), 1e-9, 1)
    p_below = np.clip(larger(1 - share - share * similarity), 1e-9, 1)
    p_equal = np.clip(1 - p_above - p_below, 1e-9, 1)
    log_l = above * np.log(p_above) + below * np.log(p_below) + equal * np.log(p_equal)
    eligible = np.where(similarity >= least - 1e-9, log_l, -np.inf)
    return log_l.max(axis=1) - eligible.max(axis=1)


_DESCRIBED = "struct<n_shingles:bigint,set_a:bigint,set_b:bigint,sketch:binary>"


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """Two order-free 64-bit sums that identify a set."""
    with np.errstate(over="ignore"):
        a = shingles.sum(dtype=np.uint64)
        b = mix(shingles ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def describe(text: Column, size: int) -> Column:
    """Set size, identity of the set and registers of every text."""

    @F.arrow_udf(_DESCRIBED)
    def described(texts: pa.Array) -> pa.Array:
        rows = []
        for words in word_chunks(texts, NON_BLANK_BYTES):
            for s in shingle_sets(words, size):
                rows.append((len(s), *_digest(s), registers(s).tobytes() if len(s) else None))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        return pa.StructArray.from_arrays(columns, ("n_shingles", "set_a", "set_b", "sketch"))

    return described(text)


def _bands(sketches: pa.Array) -> pa.Array:
    keys = [band_keys(np.frombuffer(s, np.uint16)) for s in sketches.to_pylist()]
    values = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    offsets = np.arange(len(keys) + 1, dtype=np.int32) * BANDS
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _plausible(least: float):
    @F.arrow_udf("boolean")
    def plausible(a: pa.Array, b: pa.Array, na: pa.Array, nb: pa.Array) -> pa.Array:
        kept = []
        step = 2048
        for i in range(0, len(a), step):
            left = np.frombuffer(b"".join(a[i : i + step].to_pylist()), np.uint16).reshape(-1, REGISTERS)
            right = np.frombuffer(b"".join(b[i : i + step].to_pylist()), np.uint16).reshape(-1, REGISTERS)
            sizes = [x[i : i + step].to_numpy().astype(np.float64) for x in (na, nb)]
            kept.append(log_likelihood_gap(left, right, *sizes, least) <= LOG_LIKELIHOOD_GAP)
        return pa.array(np.concatenate(kept) if kept else np.zeros(0, bool), pa.bool_())

    return plausible


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable, for every node of ``links(a, b)``: columns ``node``, ``component``.

    In each round a node points to its smallest neighbour, or itself, and to where that one points;
    then the links are drawn between what their ends point to, and those that have become loops or
    repeats fall away. A family of many links is a few after one round, so later rounds cost little;
    their number grows with the logarithm of the longest chain. Only a count reaches the driver.
    """
    a, b = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = materialize(links.select(a, b).filter("a <> b").distinct())
    labels = None
    while labels is None or not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
        points = ends.groupBy("node").agg(F.min("near").alias("near"))
        points = materialize(points.select("node", F.least("node", "near").alias("to")))
        for _ in range(2):
            beyond = points.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
            points = materialize(points.join(beyond, "to").select("node", F.col("beyond").alias("to")))
        if labels is None:
            labels = points.withColumnRenamed("to", "component")
        else:
            onward = points.select(F.col("node").alias("component"), "to")
            labels = materialize(
                labels.join(onward, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            )
        drawn = edges.join(points.toDF("a", "to_a"), "a").join(points.toDF("b", "to_b"), "b").select(
            F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")
        )
        edges = materialize(drawn.filter("a <> b").distinct())
    return labels


class _Index:
    """Inverted index from shingles to the sets that hold them."""

    def __init__(self, sets: list[np.ndarray], numbers: np.ndarray):
        self.numbers = numbers
        sizes = np.fromiter((len(sets[i]) for i in numbers), np.int64, len(numbers))
        flat = np.concatenate([sets[i] for i in numbers])
        order = np.argsort(flat, kind="stable")
        self.owner = np.repeat(np.arange(len(numbers)), sizes)[order]
        self.shingles = flat[order]
        self.sizes = sizes

    def linked(self, own: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the indexed sets that are similar enough to ``own``."""
        begin = np.searchsorted(self.shingles, own, side="left")
        count = np.searchsorted(self.shingles, own, side="right") - begin
        stop = np.cumsum(count)
        at = np.repeat(begin - (stop - count), count) + np.arange(stop[-1] if len(stop) else 0)
        common = np.bincount(self.owner[at], minlength=len(self.numbers))
        hit = common * 100 >= (len(own) + self.sizes - common) * percent
        return self.numbers[hit & (common > 0)]


def spanning_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """One link for every set but one of each component, as (from, to) numbers."""
    links = []
    left = np.ones(len(sets), dtype=bool)
    index = _Index(sets, np.arange(len(sets)))
    for first in range(len(sets)):
        if not left[first]:
            continue
        left[first] = False
        waiting = [first]
        while waiting:
            current = waiting.pop()
            n_left = int(left.sum())
            if not n_left:
                return links
            if 2 * n_left < len(index.numbers):
                index = _Index(sets, np.flatnonzero(left))
            found = index.linked(sets[current], percent)
            found = found[left[found]]
            left[found] = False
            links += [(current, x) for x in found.tolist()]
            waiting += found.tolist()
    return links


def _grouped(batches, keys: int, size: int):
    """Consecutive rows with equal first ``keys`` columns: key, columns, and shingle sets.

    The last column is the text, the two before it identify the class's own set: rows whose text
    has another one (an id on several texts), and repeated rows of a class, are left out.
    """
    key, rows, sets, seen = None, [], [], set()
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:-1]]
        chunks = word_chunks(batch.column(batch.num_columns - 1), NON_BLANK_BYTES)
        found = (s for words in chunks for s in shingle_sets(words, size))
        for *row, own in zip(*columns, found):
            if tuple(row[:keys]) != key:
                if rows:
                    yield key, rows, sets
                key, rows, sets, seen = tuple(row[:keys]), [], [], set()
            member = tuple(row[keys:-2])
            if member not in seen and _digest(own) == (row[-2], row[-1]):
                seen.add(member)
                rows.append(row)
                sets.append(own)
    if rows:
        yield key, rows, sets


def _links_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def _link_blocks(size: int, percent: int):
    """Function over rows sorted by (family, block): spanning links of every block."""

    def linked(batches):
        links = []
        for _, rows, sets in _grouped(batches, 2, size):
            links += [(rows[i][2], rows[j][2]) for i, j in spanning_links(sets, percent)]
            if len(links) > 10_000:
                yield _links_batch(links)
                links = []
        yield _links_batch(links)

    return linked


def _link_across(size: int, percent: int):
    """Function over rows sorted by (family, block, question): links of the asking to the others.

    Of all links between two components one is enough.
    """

    def linked(batches):
        for _, rows, sets in _grouped(batches, 3, size):
            asking = [i for i, row in enumerate(rows) if row[5]]
            others = np.array([i for i, row in enumerate(rows) if not row[5]], dtype=np.int64)
            if not len(others):
                continue
            index, links = _Index(sets, others), {}
            for i in asking:
                for j in index.linked(sets[i], percent).tolist():
                    if rows[i][4] != rows[j][4]:
                        links[rows[i][4], rows[j][4]] = (rows[i][3], rows[j][3])
            yield _links_batch(list(links.values()))

    return linked


class _Search:
    """The links between the classes of one table."""

    def __init__(self, docs: DataFrame, classes: DataFrame, size: int, percent: int,
                 block_shingles: int):
        """``docs(id, text)``; ``classes(node, low, n_shingles, set_a, set_b, sketch)``."""
        self.docs, self.classes = docs, classes
        self.size, self.percent, self.block_shingles = size, percent, block_shingles

    def star_edges(self) -> DataFrame:
        """``a``, ``b`` and the number of buckets whose star has this edge."""
        spread = self.classes.select(
            "node", F.explode(F.arrow_udf(_bands, "array<bigint>")("sketch")).alias("key")
        )
        turn = F.xxhash64("node", F.pmod("key", F.lit(CENTERS)))
        buckets = spread.groupBy("key").agg(
            F.count("*").alias("n"), F.min_by("node", turn).alias("center")
        )
        star = spread.join(buckets.filter("n > 1").drop("n"), "key").filter("node <> center")
        a, b = F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")
        return star.groupBy(a, b).agg(F.count("*").alias("shared"))

    def families(self) -> DataFrame:
        """Node and family of the classes that may have links."""
        edges = materialize(self.star_edges())
        sketch_of = self.classes.select("node", "n_shingles", "sketch")
        small, large = F.least("na", "nb"), F.greatest("na", "nb")
        likely = (
            edges.filter("shared = 1")
            .join(sketch_of.toDF("a", "na", "sa"), "a").join(sketch_of.toDF("b", "nb", "sb"), "b")
            .filter(small * 100 >= large * self.percent)
            .filter(_plausible(self.percent / 100)("sa", "sb", "na", "nb"))
        )
        kept = edges.filter("shared > 1").select("a", "b").unionByName(likely.select("a", "b"))
        return components(kept).withColumnRenamed("component", "family")

    def texts(self, members: DataFrame, columns: list[str]) -> DataFrame:
        """``members`` with the text of their class, after the given columns."""
        wanted = members.select(
            *columns, "low", F.col("set_a").alias("own_a"), F.col("set_b").alias("own_b")
        )
        # The same join at every size: the wanted classes grow with the table, so none is broadcast.
        found = self.docs.join(wanted.hint("merge"), F.col("id").eqNullSafe(F.col("low")))
        return found.select(*columns, "own_a", "own_b", "text")

    def run(self) -> DataFrame:
        """Component of every class that has links."""
        families = materialize(self.families())
        members = families.join(self.classes.drop("sketch"), "node")
        sizes = members.groupBy("family").agg(
            F.ceil(F.sum("n_shingles") / self.block_shingles).alias("n_blocks")
        )
        block = F.pmod(F.xxhash64("node"), F.col("n_blocks")).alias("block")
        members = materialize(members.join(sizes, "family").select("*", block))
        key = ["family", "block"]
        rows = self.texts(members, [*key, "node"]).repartition(*key).sortWithinPartitions(*key)
        links = materialize(rows.mapInArrow(_link_blocks(self.size, self.percent), "a bigint, b bigint"))
        split = members.filter("n_blocks > 1")
        if not split.isEmpty():
            links = links.unionByName(self.across_blocks(split, links))
        return components(links)

    def across_blocks(self, members: DataFrame, links: DataFrame) -> DataFrame:
        """Links between the blocks of families that have several."""
        links = links.unionByName(self.between_largest(members, links))
        members = materialize(self.labelled(members, links))
        counts = members.groupBy("family", "component").agg(F.count("*").alias("n"))
        largest = counts.groupBy("family").agg(
            F.max_by("component", F.struct("n", "component")).alias("largest")
        )
        left = members.join(largest, "family").filter("component <> largest").drop("largest")
        asking = left.groupBy("family").agg(
            F.ceil(F.sum("n_shingles") / self.block_shingles).alias("questions")
        )
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
        question = F.pmod(F.xxhash64("node", F.lit(1)), F.col("questions"))
        asked = left.join(asking, "family").withColumn("question", question).withColumn(
            "block", every("n_blocks")
        ).withColumn("asks", F.lit(True))
        others = members.join(asking, "family").withColumn("question", every("questions")).withColumn(
            "asks", F.lit(False)
        )
        columns = ["family", "block", "question", "node", "component", "asks"]
        both = asked.select(*columns, "low", "set_a", "set_b").unionByName(
            others.select(*columns, "low", "set_a", "set_b")
        )
        key = columns[:3]
        rows = self.texts(both, columns).repartition(*key).sortWithinPartitions(*key, "asks")
        return links.unionByName(
            materialize(rows.mapInArrow(_link_across(self.size, self.percent), "a bigint, b bigint"))
        )

    def labelled(self, members: DataFrame, links: DataFrame) -> DataFrame:
        found = members.drop("component").join(components(links), "node", "left")
        return found.withColumn("component", F.coalesce("component", "node"))

    def between_largest(self, members: DataFrame, links: DataFrame) -> DataFrame:
        """Links among one member of the largest component of every block of a family."""
        counts = self.labelled(members, links).groupBy("family", "block", "component").agg(
            F.count("*").alias("n"), F.min("node").alias("node")
        )
        chosen = counts.groupBy("family", "block").agg(
            F.max_by("node", F.struct("n", "component")).alias("node")
        ).select("node")
        picked = members.join(chosen, "node").withColumn("block", F.lit(0).cast("bigint"))
        key = ["family", "block"]
        rows = self.texts(picked, [*key, "node"]).repartition(*key).sortWithinPartitions(*key)
        return materialize(rows.mapInArrow(_link_blocks(self.size, self.percent), "a bigint, b bigint"))


def find_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                percent: int = MIN_PERCENT, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Per document: ``key``, ``n_shingles``, ``component_id`` (smallest id of its group), ``kept``."""
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = materialize(docs.select("id", describe(F.col("text"), size).alias("set")).select("id", "set.*"))
    identity = ["set_a", "set_b", "n_shingles"]
    # Texts with equal sets are one class, and the smallest id stands for it.
    classes = materialize(
        rows.filter("n_shingles > 0").groupBy(*identity)
        .agg(F.min("id").alias("low"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.xxhash64(*identity))
    )
    labels = _Search(docs, classes, size, percent, block_shingles).run()
    grouped = classes.join(labels, "node", "left").select(
        *identity, "low", F.coalesce("component", "node").alias("component")
    )
    lowest = grouped.groupBy("component").agg(F.min("low").alias("component_id"))
    # Classes without a link are their own component and need no second look.
    named = grouped.join(lowest, "component").select(*identity, "component_id")
    out = rows.select("id", *identity).join(named, identity, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
             percent: int = MIN_PERCENT) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id, once."""
    own = free_name(docs, "own_id")
    groups = materialize(find_groups(docs, key, text, size, percent).select(key, "kept"))
    ids = groups.groupBy(F.col(key).alias(own)).agg(
        F.bool_or("kept").alias("kept"), F.count("*").alias("n")
    )
    same = F.col(key).eqNullSafe(F.col(own))
    gone = ids.filter(~F.col("kept")).select(own)
    repeated = ids.filter(F.col("kept") & (F.col("n") > 1)).select(own)
    # The dropped ids grow with the table: the same merge at every size, no broadcast.
    out = docs.join(gone.hint("merge"), same, "left_anti")
    if repeated.isEmpty():
        return out
    # One id on several rows: of rows with equal texts one stays.
    twice = out.join(repeated, same, "left_semi").dropDuplicates([key, text])
    return out.join(repeated, same, "left_anti").unionByName(twice)
