"""Benchmark passages in training texts, by a generalised suffix automaton of the test items.

The automaton is built over the items' words (lower-cased, punctuation dropped). Training words are
streamed through it; at every word the state tells the longest run of words that ends there and
occurs in some item. Where the run reaches the window length, the window that ends there occurs in
the items known for that state, and its words are hit. Words foreign to the benchmark reset the
automaton, so only runs of benchmark words at least one window long enter it.

The items are read in blocks of bounded size, one automaton at a time: a benchmark of any size
costs bounded memory in driver and tasks. With one block no row is shuffled; with several the texts
are written once and read by each block, and what the blocks hit is joined to them once.

Words are told apart by XXH64: a word of n distinct ones in the texts is mistaken for one of m in
the items with probability n * m / 2^64, 1e-4 for 10^9 and 10^6.

Defined results: null text has no words; an item without words matches nothing; a short item (fewer
words than a window) is one window; an item without id hits but is not listed; repeated items and rows count as they are, item ids once;
``max_coverage`` 0.05 is inclusive; an empty benchmark hits nothing; texts are streamed whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.text import ALNUM_BYTES, Words, free_name, word_chunks
from tideline.session import materialize

WINDOW = 13
MAX_COVERAGE = 0.05
# A character of a word, as in ``ALNUM_BYTES``, in either case.
_WORD = r"[0-9A-Za-z]|[^\x00-\x7F]"
# UTF-8 bytes of items in one automaton; about 40 times as much memory in each task.
BLOCK_BYTES = 4_000_000


@dataclass
class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the windows of the items marked."""

    window: int
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    # State of a window -> numbers of the items that contain it, per window length.
    marked: dict[int, dict[int, set[int]]] = field(default_factory=dict)

    def add(self, words: list[int]) -> None:
        """Extend by one item; equal substrings of several items share a state."""
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.length) - 1

    def _split(self, p: int, w: int) -> int:
        """The state reached from ``p`` by ``w`` whose longest string is one longer than ``p``'s."""
        q = self.step[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = clone
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if w in self.step[last]:
            return self._split(last, w)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w)
        return new

    def mark(self, item: int, words: list[int]) -> None:
        """Remember the windows of an item; call after all items were added."""
        size = min(self.window, len(words))
        if size:
            states = self.marked.setdefault(size, {})
            for _, state in self.occurrences(words, size):
                states.setdefault(state, set()).add(item)

    def occurrences(self, words, size: int):
        """End positions (exclusive) of runs of ``size`` words known to the automaton, and states."""
        state = run = 0
        step, link, length = self.step, self.link, self.length
        for i, w in enumerate(words):
            while state and w not in step[state]:
                state = link[state]
                run = length[state]
            if w in step[state]:
                state = step[state][w]
                run += 1
            if run >= size:
                # The state of the last ``size`` words; longer context is of no further use.
                while length[link[state]] >= size:
                    state = link[state]
                run = min(run, length[state])
                yield i + 1, state

    def hits(self, words) -> tuple[list[tuple[int, int]], set[int]]:
        """Ranges of words inside marked windows, and the items they are from."""
        ranges, items = [], set()
        for size, states in self.marked.items():
            for end, state in self.occurrences(words, size):
                if state in states:
                    ranges.append((end - size, end))
                    items |= states[state]
        return ranges, items


class Matcher:
    """One block of items: their vocabulary as sorted hashes, the automaton, and the item ids."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.ids = [item_id for item_id, _ in items]
        chunks = list(word_chunks(pa.array([text for _, text in items], pa.string()), ALNUM_BYTES))
        hashes = np.concatenate([c.hash for c in chunks]) if chunks else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(hashes)
        texts = [
            self._numbers(c.hash[c.bounds[i] : c.bounds[i + 1]]).tolist()
            for c in chunks
            for i in range(c.n_rows)
        ]
        self.automaton = SuffixAutomaton(window)
        for words in texts:
            self.automaton.add(words)
        for item, words in enumerate(texts):
            self.automaton.mark(item, words)

    def _numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of word hashes, -1 for foreign words."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def match(self, words: Words) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """Merged hit ranges (words from 0) and item ids of every text of a chunk."""
        out: list = [([], set()) for _ in range(words.n_rows)]
        shortest = min(self.automaton.marked, default=0)
        if not shortest:
            return out
        numbers = self._numbers(words.hash)
        # Runs of known words within one text, at least one window long.
        known = np.zeros(len(numbers) + 2, dtype=bool)
        known[1:-1] = numbers >= 0
        cut = np.zeros(len(numbers) + 1, dtype=bool)
        cut[words.bounds] = True
        begins = np.flatnonzero(known[1:] & (~known[:-1] | cut))
        ends = np.flatnonzero(known[:-1] & (~known[1:] | cut))
        long = ends - begins >= shortest
        for begin, end in zip(begins[long].tolist(), ends[long].tolist()):
            ranges, items = self.automaton.hits(numbers[begin:end].tolist())
            if ranges:
                row = int(words.row[begin])
                first = begin - int(words.bounds[row])
                out[row][0].extend((s + first, e + first) for s, e in ranges)
                out[row][1].update(self.ids[i] for i in items if self.ids[i] is not None)
        return [(union(ranges), items) for ranges, items in out]


def union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


_HITS = "struct<n_words:bigint,starts:array<bigint>,ends:array<bigint>,items:array<string>>"
_HIT_NAMES = ("n_words", "starts", "ends", "items")
_LONGS, _STRINGS = pa.list_(pa.int64()), pa.list_(pa.string())


def _hits_udf(spark, items: list[tuple[str, str]], window: int):
    """Function from a text to its hits."""
    shared = spark.sparkContext.broadcast(Matcher(items, window))

    @F.arrow_udf(_HITS)
    def hits(texts: pa.Array) -> pa.Array:
        rows = []
        for words in word_chunks(texts, ALNUM_BYTES):
            counts = np.diff(words.bounds)
            for i, (ranges, ids) in enumerate(shared.value.match(words)):
                rows.append((int(counts[i]), [s for s, _ in ranges], [e for _, e in ranges], sorted(ids)))
        return _hits_array(rows)

    return hits


def find_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, into: str = "hits",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column ``into``: words, hit ranges of words, and item ids."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("string").alias("id"), F.col(item_text).alias("body"))
    # Neither repeats nor items without words change a result; they would only swell a block.
    items = materialize(items.filter(F.col("body").rlike(_WORD)).distinct())
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n_blocks = max(1, -(-2 * size // block_bytes)) if size > block_bytes else 1
    block = F.pmod(F.xxhash64("id", "body"), F.lit(n_blocks))

    def found_in(number: int) -> Column:
        part = [(r.id, r.body) for r in items.filter(block == number).collect()]
        return _hits_udf(spark, part, window)(F.col(text))

    if n_blocks == 1:
        return docs.withColumn(into, found_in(0))
    # The rows are numbered and written once; a block leaves only numbers and what it hit.
    row = free_name(docs, "row_number")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()))
    scanned = [
        materialize(numbered.select(row, found_in(number).alias(into)).filter(
            F.lit(True) if number == 0 else F.size(f"{into}.starts") > 0
        ))
        for number in range(n_blocks)
    ]
    gathered = reduce(DataFrame.unionByName, scanned).groupBy(row).agg(F.collect_list(into).alias(into))
    merged = gathered.select(row, F.arrow_udf(_merged, _HITS)(into).alias(into))
    return numbered.join(merged, row).drop(row)


def _merged(rows: pa.Array) -> pa.Array:
    """Hits of all blocks in a text as one."""
    out = []
    for hits in rows.to_pylist():
        ranges = union([r for h in hits for r in zip(h["starts"], h["ends"])])
        items = sorted({i for h in hits for i in h["items"]})
        out.append((hits[0]["n_words"], [s for s, _ in ranges], [e for _, e in ranges], items))
    return _hits_array(out)


def _hits_array(rows: list[tuple]) -> pa.Array:
    types = (pa.int64(), _LONGS, _LONGS, _STRINGS)
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], _HIT_NAMES)


def hit_words(hits: str = "hits") -> Column:
    lengths = F.zip_with(f"{hits}.starts", f"{hits}.ends", lambda s, e: e - s)
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, b: a + b)


def is_contaminated(hits: str = "hits", max_coverage: float = MAX_COVERAGE) -> Column:
    """Whether at least ``max_coverage`` of the words are hit, and any is."""
    per_million = round(max_coverage * 1_000_000)
    hit = hit_words(hits)
    return (hit > 0) & (hit * 1_000_000 >= F.col(f"{hits}.n_words") * per_million)


def _cut(texts: pa.Array, hits: pa.Array) -> pa.Array:
    found = hits.to_pylist()
    originals = texts.to_pylist()
    out: list = []
    for words in word_chunks(texts, ALNUM_BYTES):
        for i in range(words.n_rows):
            text = originals[words.first_row + i]
            hit = found[words.first_row + i]
            if not hit or not hit["starts"]:
                out.append(text)
                continue
            base = int(words.bounds[i])
            data, shift = text.encode(), int(words.text_start[i])
            pieces, at = [], 0
            for start, end in zip(hit["starts"], hit["ends"]):
                pieces.append(data[at : int(words.start[base + start]) - shift])
                at = int(words.end[base + end - 1]) - shift
            out.append(b"".join([*pieces, data[at:]]).decode())
    return pa.array(out, pa.string())


def without_spans(docs: DataFrame, text: str = "text", hits: str = "hits",
                  max_length: int = WINDOW, max_coverage: float | None = None) -> DataFrame:
    """Cut the hit ranges of at least ``max_length`` words out of ``text``.

    With ``max_coverage`` only documents that reach it are cut, and then all their ranges are.
    """
    ranges = F.filter(
        F.arrays_zip(f"{hits}.starts", f"{hits}.ends"),
        lambda r: (r["ends"] - r["starts"] >= max_length) | F.lit(max_coverage is not None),
    )
    cut = F.struct(
        F.transform(ranges, lambda r: r["starts"]).alias("starts"),
        F.transform(ranges, lambda r: r["ends"]).alias("ends"),
    )
    wanted = F.lit(True) if max_coverage is None else is_contaminated(hits, max_coverage)
    return docs.withColumn(text, F.when(wanted, F.arrow_udf(_cut, "string")(F.col(text), cut)).otherwise(F.col(text)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """Drop the documents of which benchmark passages make up ``max_coverage`` or more."""
    into = free_name(docs, "hits")
    found = find_passages(docs, benchmark, text, into=into)
    return found.filter(~is_contaminated(into, max_coverage)).drop(into)
