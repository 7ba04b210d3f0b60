"""Spelling variants: words one edit apart, found in k-d trees over letter counts.

1. Runs of letters are counted in Spark; words long and frequent enough form the vocabulary.
2. Per word length there is a k-d tree over letter counts. A replaced letter raises one count by one
   and lowers another, an inserted one raises one, so a range search may cross at most one split
   upwards and one downwards (L1 distance two; for the next length one upwards only). Once a split
   is crossed on a letter, that letter's count in the variant is known and no longer branches.
   A pair of equal length is looked for from one side only: the raised letter is the smaller one.
3. The upper part of every tree, fitted on a bounded sample, deals words to tasks: a word is stored
   in one leaf and sent to every leaf that its range reaches. A task goes on splitting its leaf, with
   all searches at once, and where few words are left compares letters in order. Words with equal
   counts everywhere (anagrams) are split by the counts of their beginnings, which an edit moves by
   at most one.
4. Per word Spark adds up how many are near and which of them is the most frequent; chains of forms
   are followed by joins, one for each doubling of their length.

Defined results: null and empty texts have no words; a null id is the empty string in the hash;
repeated rows count each time; only A-Z are lower-cased, other letters count as they stand; an empty
table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.session import materialize

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
# A form is this many times as frequent as the word.
FORM_RATIO = 10
# One in so many occurrences per document loses a letter.
SLIP_RATE = 31
# Words the upper trees are fitted on, words that a leaf should hold, and leaves at most.
SAMPLE_WORDS = 200_000
LEAF_WORDS = 15_000
MOST_LEAVES = 4_096
# Words that are compared without further splits, rows that choose a split, pairs compared at once.
FEW_WORDS = 48
SPLIT_ROWS = 2_048
BLOCK_PAIRS = 1 << 20

# Words that are dealt to leaves at once.
ROUTED_WORDS = 1 << 16

# What a row asks of a leaf: to be found there, to search equal lengths, to search one letter more.
STORED, EQUAL, SHORTER = 1, 2, 4
_NONE = -1


def slipped(word: Column, key: Column) -> Column:
    """``word`` without one letter where the hash of its document and itself says so."""
    digest = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = F.pmod(digest, F.length(word)).cast("int")
    shorter = F.concat(word.substr(F.lit(1), at), word.substr(at + 2, F.length(word)))
    return F.when(F.pmod(digest, F.lit(SLIP_RATE)) == 0, shorter).otherwise(word)


def vocabulary(docs: DataFrame, key: str, text: str, length: int, least: int) -> DataFrame:
    """``word`` and its number ``n`` of occurrences."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # A run too short stays so when it loses a letter.
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{length},}}"), F.lit(0))
    found = docs.select(F.col(key).alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", upper, lower).alias("run"))
    words = found.select(slipped(F.col("run"), F.col("id")).alias("word")).filter(F.length("word") >= length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


@dataclass
class Vectors:
    """Words of one length as letters, and their letter counts."""

    codes: np.ndarray  # one row per word
    counts: np.ndarray  # one column per letter value

    @classmethod
    def of(cls, codes: np.ndarray) -> Vectors:
        return cls(codes, prefix_counts(codes, codes.shape[1]))


def prefix_counts(codes: np.ndarray, size: int) -> np.ndarray:
    """How often each of the 256 letter values stands among the first ``size`` letters."""
    kind = np.uint8 if size < 256 else np.int32
    counts = np.zeros((len(codes), 256), kind)
    rows = np.arange(len(codes))
    for i in range(size):
        counts[rows, codes[:, i]] += 1
    return counts


def letters_of(words: list[str], length: int) -> np.ndarray:
    """Words of equal length as rows of letter values; all letters are below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


@dataclass
class Split:
    letter: int
    most: int  # the left side has at most so many of it
    size: int  # among the first ``size`` letters; 0: among all


def choose_split(words: Vectors, rows: np.ndarray) -> Split | None:
    """The split that divides ``rows`` most evenly, by whole words if any such split divides them."""
    rows = rows[:: max(len(rows) // SPLIT_ROWS, 1)]
    codes = words.codes[rows]
    length = codes.shape[1]
    for sizes in ((0,), (length // 2,), (length // 4, 3 * length // 4)):
        best = None
        for size in sizes:
            counts = words.counts[rows] if size == 0 else prefix_counts(codes, size)
            used = np.flatnonzero(counts.max(axis=0) > counts.min(axis=0))
            if not len(used):
                continue
            counts = counts[:, used].astype(np.int64)
            middle = np.partition(counts, len(counts) // 2, axis=0)[len(counts) // 2]
            for most in (middle, middle - 1):
                share = (counts <= most).mean(axis=0)
                off = np.where((share > 0) & (share < 1), np.abs(share - 0.5), 1.0)
                i = int(off.argmin())
                if off[i] < 1 and (best is None or off[i] < best[0]):
                    best = (off[i], Split(int(used[i]), int(most[i]), size))
        if best:
            return best[1]
    return None


@dataclass
class Queries:
    """Searches on their way down: rows of some words, and the letters whose counts have moved."""

    words: Vectors
    rows: np.ndarray
    up: np.ndarray
    down: np.ndarray

    @classmethod
    def all(cls, words: Vectors) -> Queries:
        n = len(words.codes)
        return cls(words, np.arange(n), np.full(n, _NONE, np.int16), np.full(n, _NONE, np.int16))

    def part(self, chosen: np.ndarray, **changed) -> Queries:
        up, down = changed.get("up", self.up), changed.get("down", self.down)
        return Queries(self.words, self.rows[chosen], up[chosen], down[chosen])

    def sides(self, split: Split, equal: bool) -> tuple[Queries, Queries]:
        """The searches that go left and those that go right of a split; many go both ways."""
        x, most = split.letter, split.most
        if split.size:
            head = prefix_counts(self.words.codes[self.rows], split.size)[:, x].astype(np.int64)
            return self.part(head <= most + 1), self.part(head >= most)
        count = self.words.counts[self.rows, x].astype(np.int64)
        raised, lowered = self.up == x, self.down == x
        count = count + raised - lowered
        known = raised | lowered
        left, right = count <= most, count > most
        sink = (count == most + 1) & ~known & (self.down == _NONE) & equal
        sink &= (self.up == _NONE) | (self.up < x)
        rise = (count == most) & ~known & (self.up == _NONE)
        rise &= (self.down == _NONE) | (x < self.down)
        return (self.part(left | sink, down=np.where(sink, np.int16(x), self.down)),
                self.part(right | rise, up=np.where(rise, np.int16(x), self.up)))


def one_replaced(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which words of ``left`` differ from which of ``right`` in one letter, smaller on the right."""
    differ = np.zeros((len(left), len(right)), np.uint8 if left.shape[1] < 256 else np.int32)
    for i in range(left.shape[1]):
        differ += left[:, i, None] != right[None, :, i]
    a, b = np.nonzero(differ == 1)
    at = (left[a] != right[b]).argmax(axis=1)
    smaller = right[b, at] < left[a, at]
    return np.stack((a[smaller], b[smaller]))


def one_inserted(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which words of ``left`` become which of ``right``, one letter longer, by an insertion."""
    length = left.shape[1]
    same = np.zeros((len(left), len(right)), np.uint16 if length < 30_000 else np.int64)
    for shift, order in ((0, range(length)), (1, range(length - 1, -1, -1))):
        going = np.ones(same.shape, dtype=bool)
        for i in order:
            going &= left[:, i, None] == right[None, :, i + shift]
            if not going.any():
                break
            same += going
    return np.stack(np.nonzero(same >= length))


def search(stored: Vectors, queries: Queries, equal: bool, found: Callable[[np.ndarray, np.ndarray], None]) -> None:
    """Report (query rows, stored rows) of near words, one call per place of the tree."""
    waiting = [(np.arange(len(stored.codes)), queries)]
    while waiting:
        rows, asked = waiting.pop()
        if not len(rows) or not len(asked.rows):
            continue
        split = choose_split(stored, rows) if len(rows) > FEW_WORDS else None
        if split is not None:
            head = prefix_counts(stored.codes[rows], split.size) if split.size else stored.counts[rows]
            below = head[:, split.letter] <= split.most
            left, right = asked.sides(split, equal)
            waiting += [(rows[below], left), (rows[~below], right)]
            continue
        compare = one_replaced if equal else one_inserted
        wide = max(BLOCK_PAIRS // len(asked.rows), 1)
        for j in range(0, len(rows), wide):
            tall = max(BLOCK_PAIRS // len(rows[j : j + wide]), 1)
            for i in range(0, len(asked.rows), tall):
                own, other = asked.rows[i : i + tall], rows[j : j + wide]
                a, b = compare(asked.words.codes[own], stored.codes[other])
                if len(a):
                    found(own[a], other[b])


@dataclass
class Node:
    """The upper part of a tree: a split with two sides, or a leaf."""

    leaf: int = 0
    split: Split | None = None
    sides: tuple[Node, Node] | None = None


def fit_tree(words: Vectors, leaves: int) -> Node:
    """A tree of about ``leaves`` leaves over sampled words."""
    numbers = iter(range(2 * leaves + 1))

    def grow(rows: np.ndarray, wanted: int) -> Node:
        split = choose_split(words, rows) if wanted > 1 and len(rows) > 1 else None
        if split is None:
            return Node(leaf=next(numbers))
        head = prefix_counts(words.codes[rows], split.size) if split.size else words.counts[rows]
        below = head[:, split.letter] <= split.most
        small = min(max(round(wanted * float(below.mean())), 1), wanted - 1)
        return Node(split=split, sides=(grow(rows[below], small), grow(rows[~below], wanted - small)))

    return grow(np.arange(len(words.codes)), leaves)


def reached(tree: Node, words: Vectors, asks: int) -> Iterator[tuple[int, np.ndarray]]:
    """Every leaf with the rows of the words that are stored there or whose search reaches it."""
    waiting = [(tree, Queries.all(words))]
    while waiting:
        node, asked = waiting.pop()
        if not len(asked.rows):
            continue
        if node.split is None:
            yield node.leaf, asked.rows
        elif asks == STORED:
            # Nothing moves: each word goes to its own side.
            size = node.split.size
            head = prefix_counts(words.codes[asked.rows], size) if size else words.counts[asked.rows]
            below = head[:, node.split.letter] <= node.split.most
            waiting += [(node.sides[0], asked.part(below)), (node.sides[1], asked.part(~below))]
        else:
            waiting += list(zip(node.sides, asked.sides(node.split, asks == EQUAL)))


_ROUTED = "length int, leaf int, asks int, word string, n bigint"


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Consecutive batches as tables of about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _route(trees) -> Callable:
    """Every word to the leaf that stores it and to those it searches."""

    def routed(batches):
        for table in _gathered(batches, ROUTED_WORDS):
            words = table.column(0).to_pylist()
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            for length in np.unique(sizes).tolist():
                chosen = np.flatnonzero(sizes == length)
                vectors = Vectors.of(letters_of([words[i] for i in chosen], length))
                for asks in (STORED, EQUAL, SHORTER):
                    own = length + (asks == SHORTER)
                    for leaf, rows in reached(trees.value.get(own, Node()), vectors, asks):
                        out = table.take(pa.array(chosen[rows]))
                        for name, value in (("asks", asks), ("leaf", leaf), ("length", own)):
                            out = out.add_column(0, name, pa.array(np.full(len(rows), value, np.int32)))
                        yield from out.to_batches()

    return routed


_NEAR = "word string, near string, near_n bigint"


class _Pairs:
    """Near words of one leaf, both ways, as Arrow batches."""

    def __init__(self, stored: list, asking: list):
        self.stored, self.asking = stored, asking
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        self.left.append(left)
        self.right.append(right)

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.left:
            return
        sides = []
        for rows, listed in ((np.concatenate(self.left), self.asking), (np.concatenate(self.right), self.stored)):
            at = pa.array(rows)
            sides.append([pa.array([w for w, _ in listed]).take(at), pa.array([n for _, n in listed], pa.int64()).take(at)])
        for (word, _), (near, near_n) in (sides, sides[::-1]):
            yield pa.RecordBatch.from_arrays([word, near, near_n], ["word", "near", "near_n"])


def _near_in_leaf(length: int, rows: dict[int, list]) -> Iterator[pa.RecordBatch]:
    stored = rows.get(STORED, [])
    if not stored:
        return
    vectors = Vectors.of(letters_of([w for w, _ in stored], length))
    for asks in (EQUAL, SHORTER):
        asking = rows.get(asks, [])
        if asking:
            own = Vectors.of(letters_of([w for w, _ in asking], length - (asks == SHORTER)))
            pairs = _Pairs(stored, asking)
            search(vectors, Queries.all(own), asks == EQUAL, pairs.add)
            yield from pairs.batches()


def _find_near(batches):
    """Near words of every leaf; rows come sorted by (length, leaf)."""
    key, rows = None, {}
    for batch in batches:
        for length, leaf, asks, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if (length, leaf) != key:
                if key:
                    yield from _near_in_leaf(key[0], rows)
                key, rows = (length, leaf), {}
            rows.setdefault(asks, []).append((word, n))
    if key:
        yield from _near_in_leaf(key[0], rows)


def fit_trees(words: DataFrame, sample_words: int, leaf_words: int, most_leaves: int) -> dict[int, Node]:
    """The upper trees of the lengths that fill more than one leaf."""
    total = words.count()
    sample = words.orderBy(F.xxhash64("word"), "word").limit(sample_words).select("word").toArrow()
    by_length: dict[int, list[str]] = {}
    for word in sample.column(0).to_pylist():
        by_length.setdefault(len(word), []).append(word)
    trees = {}
    for length, listed in by_length.items():
        share = len(listed) / sample.num_rows
        leaves = round(min(share * total / leaf_words, share * most_leaves))
        if leaves > 1:
            trees[length] = fit_tree(Vectors.of(letters_of(listed, length)), leaves)
    return trees


def near_words(words: DataFrame, sample_words: int = SAMPLE_WORDS, leaf_words: int = LEAF_WORDS,
               most_leaves: int = MOST_LEAVES) -> DataFrame:
    """``word``, ``near``, ``near_n`` for all words one edit apart, in both directions.

    The trees decide which task compares what, not what is found.
    """
    trees = words.sparkSession.sparkContext.broadcast(fit_trees(words, sample_words, leaf_words, most_leaves))
    routed = words.select("word", "n").mapInArrow(_route(trees), _ROUTED)
    dealt = routed.repartition("length", "leaf").sortWithinPartitions("length", "leaf")
    return dealt.mapInArrow(_find_near, _NEAR)


def follow_forms(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last of the chain of ``forms(word, form)``."""
    chains = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        # A root that has a form itself is replaced by the end of what is known of that one's chain.
        onward = chains.toDF("root", "further")
        longer = materialize(chains.join(onward, "root", "left").select("word", "root", "further"))
        if longer.filter("further is not null").isEmpty():
            return chains
        chains = longer.select("word", F.coalesce("further", "root").alias("root"))


def group_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LEAST_LENGTH,
                   least: int = LEAST_COUNT, ratio: int = FORM_RATIO, **trees: int) -> DataFrame:
    """Per word: word, n, n_near (near words), form, form_n, root; see ``near_words`` for ``trees``."""
    words = materialize(vocabulary(docs, key, text, length, least))
    near = near_words(words, **trees).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    )
    known = words.join(near, "word", "left")
    has_form = -F.col("best.n") >= F.col("n") * ratio
    found = materialize(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, -F.col("best.n")).alias("form_n"),
    ))
    chains = follow_forms(found.filter("form is not null"))
    return found.join(chains, "word", "left").withColumn("root", F.coalesce("root", "word"))
