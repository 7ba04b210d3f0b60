"""Collocations: phrases of two or three words that hold together, the best of every language.

A phrase's score is its weakest cut: of the count ``a`` of the phrase and the counts ``l``, ``r`` of
the two parts, the least of floor(1000000 * a * a / (l * r)). The search grows phrases from their
prefixes and counts only those that can still reach the wanted rank, a level of scores at a time:

1. Words are counted once. The counts bound what any phrase can reach: a phrase occurs at most as
   often as its rarest word, and its parts at least as often as itself, so no pair scores above
   min(f1, f2) / max(f1, f2) and no triple above min(f1, f2, f3) / max(f1, f3).
2. A level counts the pairs whose bound reaches it, then the triples whose bound reaches it or that
   grow from a pair which scored there (these may absorb it), then the parts of the triples left.
3. A language whose phrases that survive at the level number as many as wanted is settled, ties
   included, because everything with such a score has been counted. The others go on to the next
   level; the last one is zero, where every phrase that is frequent enough is counted.

Each step reads the texts again and counts in tasks, chunk by chunk; Spark adds up the counts. What
the tasks know about the corpus has a fixed size: logarithms of word counts in ``CELLS`` cells and
filters of ``FILTER_BITS`` bits for pairs. Where words share a cell or pairs a bit, bounds widen and
more phrases are counted; the results stay the same, since scores come from exact joins.

Defined results: a null language is ``und``; a null or empty text has no words; repeated rows count
each time; ties in score and count go by phrase, in the order of UTF-8 bytes; an empty table gives
an empty result. Texts are read whole, one longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.text import mix
from tideline.session import materialize

WANTED = 2000
LEAST_COUNT = 10
# A phrase is dropped if a longer one has at least this share of its occurrences, in percent.
ABSORBED_PERCENT = 50
UNIT = 1_000_000
# Scores down to which everything is counted, one after the other. More levels cost more passes.
LEVELS = (250_000, 20_000, 0)
# Both sizes are powers of two.
CELLS = 1 << 22
FILTER_BITS = 1 << 25
# Bytes of text counted at once, and numbers in one row of a table that travels to the tasks.
CHUNK_BYTES = 4 << 20
SLAB = 1 << 17
# Steps of the logarithm of a count per doubling.
STEPS = 5

_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_OUTSIDE = _BREAK.copy()
_OUTSIDE[list(b" \t")] = True
# Tables of bytes.translate, which looks a byte up several times as fast as an index does.
_LOWER = bytes(range(256)).lower()
_IS_BREAK, _IS_INSIDE = _BREAK.tobytes(), (~_OUTSIDE).tobytes()


@dataclass
class Words:
    """Words of some texts in order, as numbers of distinct (language, word) entries."""

    langs: pa.Array  # distinct languages
    words: pa.Array  # distinct words
    lang: np.ndarray  # of every word: number of its language
    word: np.ndarray  # of every word: number of the word
    joined: np.ndarray  # of every word but the last: whether the next one is in the same piece

    def keys(self) -> np.ndarray:
        """One number per (language, word)."""
        return self.lang * np.int64(max(len(self.words), 1)) + self.word


def _segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of texts, and the text of each; one longer than a chunk is cut where a piece ends."""
    bounds, owner = [], []
    for text, (start, end) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
        bounds.append(start)
        owner.append(text)
        if end - start > CHUNK_BYTES:
            breaks = np.flatnonzero(_BREAK[data[start:end]]) + start
            while end - bounds[-1] > CHUNK_BYTES:
                after = breaks[np.searchsorted(breaks, bounds[-1], side="right") :]
                if not len(after):
                    break
                bounds.append(int(after[max(np.searchsorted(after, bounds[-1] + CHUNK_BYTES) - 1, 0)]))
                owner.append(text)
    return np.array([*bounds, int(ends[-1])]), np.array(owner)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(1).fill_null("").cast(pa.large_string())
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        bounds, owner = _segments(data, ends)
        at = 0
        while at < len(owner):
            to = int(np.searchsorted(bounds, bounds[at] + CHUNK_BYTES, side="right")) - 1
            to = min(max(to, at + 1), len(owner))
            langs = batch.column(0).take(pa.array(owner[at:to]))
            yield _words(langs, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
            at = to


def _words(lang: pa.Array, data: np.ndarray, text_start: np.ndarray) -> Words:
    data = data.tobytes().translate(_LOWER)
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = np.frombuffer(data.translate(_IS_INSIDE), bool)
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[text_start[1:-1]] = True
    begins = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    # Bytes up to a byte that end a piece, text boundaries included: equal for words of one piece only.
    pieces = np.cumsum(cut[:-1] | np.frombuffer(data.translate(_IS_BREAK), bool), dtype=np.int32)
    piece = pieces[begins]
    letters = np.frombuffer(data, np.uint8)[inside[1:-1]]
    offsets = np.concatenate(([0], np.cumsum(ends - begins)))
    listed = pa.LargeStringArray.from_buffers(
        len(begins), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)
    ).dictionary_encode()
    # Empty texts share a start with their neighbour; the last of equal starts owns the words.
    row = np.repeat(np.arange(len(text_start) - 1), np.diff(np.searchsorted(begins, text_start)))
    langs = lang.dictionary_encode()
    return Words(
        langs.dictionary, listed.dictionary, langs.indices.to_numpy().astype(np.int64)[row],
        listed.indices.to_numpy().astype(np.int64), piece[1:] == piece[:-1],
    )


def _entry_hashes(words: Words) -> np.ndarray:
    """Hash of (language, word) for every word occurrence; each distinct word is hashed once."""
    return _joined_hashes(_text_hashes(words.langs)[words.lang], _text_hashes(words.words)[words.word])


def _text_hashes(texts: pa.Array) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    texts = texts.cast(pa.large_binary())
    # Slices of the array's bytes: a list of its values takes five times as long.
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset :][: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = memoryview(data)[bounds[0] : bounds[-1]].tobytes() if bounds[-1] > bounds[0] else b""
    bounds = (bounds - bounds[0]).tolist()
    return np.fromiter((digest(data[a:b]) for a, b in zip(bounds, bounds[1:])), np.uint64, len(texts))


def _joined_hashes(lang: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(word + lang * np.uint64(0xD6E8FEB86659FD93))


def _hashes(lang: pa.Array, word: pa.Array) -> np.ndarray:
    """The same for rows of a table."""
    langs = lang.dictionary_encode()
    return _joined_hashes(_text_hashes(langs.dictionary)[langs.indices.to_numpy()], _text_hashes(word))


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(first * np.uint64(0x9FB21C651E98DF25) + second)


def _positions(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two of the ``size`` bits (a power of two) of a filter for every hash."""
    last = np.uint64(size - 1)
    return (hashes & last).astype(np.int64), ((hashes >> np.uint64(33)) & last).astype(np.int64)


def _counted(words: Words, at: np.ndarray, size: int) -> pa.RecordBatch:
    """Distinct phrases of ``size`` words that begin at the positions ``at``, with their counts."""
    n = max(len(words.words), 1)
    codes = words.keys()[at]
    top = len(words.langs) * n
    tables: list[np.ndarray | None] = []
    for k in range(1, size):
        # Where a number for the beginning and one for a word no longer fit in 64 bits, the distinct
        # beginnings are numbered anew.
        table = None
        if top > (1 << 62) // n:
            table, codes = np.unique(codes, return_inverse=True)
            top = len(table)
        tables.append(table)
        codes = codes.astype(np.int64) * n + words.word[at + k]
        top *= n
    codes, count = np.unique(codes, return_counts=True)
    parts = []
    for table in reversed(tables):
        parts.append(codes % n)
        codes = codes // n
        if table is not None:
            codes = table[codes]
    parts.append(codes % n)
    columns = [words.langs.take(pa.array(codes // n)).cast(pa.string())]
    columns += [words.words.take(pa.array(p)).cast(pa.string()) for p in reversed(parts)]
    names = ["lang", *(f"w{i + 1}" for i in range(size)), "n"]
    return pa.RecordBatch.from_arrays([*columns, pa.array(count, pa.int64())], names)


def _schema(size: int) -> str:
    return ", ".join(["lang string", *(f"w{i + 1} string" for i in range(size)), "n bigint"])


def _sums(rows: DataFrame, size: int) -> DataFrame:
    return rows.groupBy("lang", *(f"w{i + 1}" for i in range(size))).agg(F.sum("n").alias("n"))


def _word_batches(batches):
    """Counts of words, and under a null word the number of all words of a language."""
    for words in _chunks(batches):
        if len(words.word):
            yield _counted(words, np.arange(len(words.word)), 1)
            lang, count = np.unique(words.lang, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [words.langs.take(pa.array(lang)).cast(pa.string()), pa.nulls(len(lang), pa.string()),
                 pa.array(count, pa.int64())], ["lang", "w1", "n"],
            )


def _table(rows: DataFrame, size: int, kind: type) -> np.ndarray:
    """Array of ``size`` numbers from ``rows(at, value)``, distinct places, packed slab by slab; else 0.

    ``size`` is a constant, so what reaches the driver has a fixed bound.
    """
    length = SLAB

    @F.arrow_udf("binary")
    def packed(cells: pa.Array) -> pa.Array:
        slabs = []
        for members in cells:
            slab = np.zeros(length, kind)
            slab[members.values.field(0).to_numpy()] = members.values.field(1).to_numpy()
            slabs.append(slab.tobytes())
        return pa.array(slabs, pa.binary())

    place = F.struct((F.col("at") % SLAB).alias("place"), "value")
    slabs = rows.groupBy(F.floor(F.col("at") / SLAB).alias("slab")).agg(F.collect_list(place).alias("cells"))
    table = np.zeros(size, kind)
    for slab, data in slabs.select("slab", packed("cells")).collect():
        table[slab * SLAB : (slab + 1) * SLAB] = np.frombuffer(data, kind)
    return table


class _Counts:
    """Bounds of word counts by cell: logarithms, rounded down for the least, up for the largest."""

    def __init__(self, words: DataFrame):
        size = CELLS

        @F.arrow_udf("bigint")
        def cell(lang: pa.Array, word: pa.Array) -> pa.Array:
            return pa.array((_hashes(lang, word) & np.uint64(size - 1)).astype(np.int64))

        step = F.least(F.floor(F.log2("n") * STEPS), F.lit(253)).cast("int") + 1
        cells = words.select(cell("lang", "w1").alias("at"), step.alias("step")).groupBy("at").agg(
            (F.min("step") * 256 + F.max("step")).alias("value")
        )
        both = _table(cells, size, np.uint16)
        self.least, self.most = (both >> 8).astype(np.uint8), (both & 255).astype(np.uint8)
        # Zero: no frequent word has this cell. The rounding of log2 is allowed for by one part in 1e9.
        scale = 2.0 ** ((np.arange(256) - 1) / STEPS)
        self.low = np.where(np.arange(256) > 0, scale * (1 - 1e-9), np.inf)
        self.high = np.where(np.arange(256) > 0, scale * 2 ** (1 / STEPS) * (1 + 1e-9), 0.0)
        self.high[254] = np.inf

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (hashes & np.uint64(len(self.least) - 1)).astype(np.int64)
        return self.low[self.least[at]], self.high[self.most[at]]


def _reaches(inner: list[np.ndarray], outer: list[np.ndarray], level: int) -> np.ndarray:
    """Whether least(inner) / largest(outer) can be ``level`` millionths; with rare words never."""
    top = np.minimum.reduce(inner)
    if not level:
        return top > 0
    return (top > 0) & (top * UNIT >= level * np.maximum.reduce(outer) * (1 - 1e-9))


def _pair_filter(pairs: DataFrame) -> np.ndarray:
    """Bits of all ``pairs(lang, w1, w2)``, packed; other pairs may share them."""
    size = FILTER_BITS

    @F.arrow_udf("array<bigint>")
    def bits(lang: pa.Array, w1: pa.Array, w2: pa.Array) -> pa.Array:
        found = np.stack(_positions(_pair_hashes(_hashes(lang, w1), _hashes(lang, w2)), size), axis=1)
        offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * 2)
        return pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))

    set_bits = pairs.select(F.explode(bits("lang", "w1", "w2")).alias("bit")).distinct()
    octets = set_bits.groupBy(F.floor(F.col("bit") / 8).alias("at")).agg(
        F.sum(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (F.col("bit") % 8 + 1).cast("int"))).alias("value")
    )
    return _table(octets, size // 8, np.uint8)


def _in_filter(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    hit = np.ones(len(hashes), dtype=bool)
    for bit in _positions(hashes, 8 * len(packed)):
        hit &= (packed[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
    return hit


def _pairs_at(counts, level: int) -> Callable:
    """Counts of the pairs whose bound reaches the level."""

    def counted(batches):
        for words in _chunks(batches):
            low, high = counts.value.of(_entry_hashes(words))
            reaches = _reaches([high[:-1], high[1:]], [low[:-1], low[1:]], level)
            at = np.flatnonzero(words.joined & reaches)
            if len(at):
                yield _counted(words, at, 2)

    return counted


def _triples_at(counts, grown, level: int) -> Callable:
    """Counts of the triples whose bound reaches the level, or that hold a pair of ``grown``."""

    def counted(batches):
        for words in _chunks(batches):
            if len(words.word) < 3:
                continue
            hashes = _entry_hashes(words)
            low, high = counts.value.of(hashes)
            inner = [high[:-2], high[1:-1], high[2:]]
            reaches = _reaches(inner, [low[:-2], low[2:]], level)
            known = np.minimum.reduce(inner) > 0
            both = words.joined[:-1] & words.joined[1:] & known
            held = _in_filter(grown.value, _pair_hashes(hashes[:-1], hashes[1:]))
            at = np.flatnonzero(both & (reaches | held[:-1] | held[1:]))
            if len(at):
                yield _counted(words, at, 3)

    return counted


def _pairs_in(wanted) -> Callable:
    """Counts of the pairs in a filter."""

    def counted(batches):
        for words in _chunks(batches):
            hashes = _entry_hashes(words)
            at = np.flatnonzero(words.joined & _in_filter(wanted.value, _pair_hashes(hashes[:-1], hashes[1:])))
            if len(at):
                yield _counted(words, at, 2)

    return counted


def _cut_score(left: str, right: str) -> Column:
    """floor(1000000 * n * n / (left * right)), exact up to counts of 10^15 (38 digits)."""
    wide = "cast({} as decimal(19,0))".format
    return F.expr(
        f"cast({UNIT} as decimal(7,0)) * ({wide('n')} * {wide('n')}) div ({wide(left)} * {wide(right)})"
    )


def _pairs_of(triples: DataFrame, *columns: str) -> DataFrame:
    """Both pairs of every triple."""
    pairs = F.array(*[F.struct(F.col(a).alias("w1"), F.col(b).alias("w2")) for a, b in (("w1", "w2"), ("w2", "w3"))])
    return triples.select("lang", F.explode(pairs).alias("pair"), *columns).select("lang", "pair.*", *columns)


class _Search:
    """One level after the other over ``rows(lang, text)``."""

    def __init__(self, rows: DataFrame, frequent: DataFrame, least: int, absorbed: int):
        self.rows, self.frequent, self.least, self.absorbed = rows, frequent, least, absorbed
        self.shared = []
        self.counts = self.share(_Counts(frequent))

    def share(self, value):
        self.shared.append(self.rows.sparkSession.sparkContext.broadcast(value))
        return self.shared[-1]

    def close(self) -> None:
        for held in self.shared:
            held.unpersist()

    def phrases(self, rows: DataFrame, counted: Callable, size: int) -> DataFrame:
        """Phrases of ``size`` words that a step counts, the frequent ones."""
        return _sums(rows.mapInArrow(counted, _schema(size)), size).filter(F.col("n") >= self.least)

    def with_count(self, phrases: DataFrame, word: str, name: str) -> DataFrame:
        counts = self.frequent.select("lang", F.col("w1").alias(word), F.col("n").alias(name))
        return phrases.join(counts, ["lang", word])

    def pairs(self, rows: DataFrame, level: int) -> DataFrame:
        """All pairs that score ``level`` or more."""
        found = self.phrases(rows, _pairs_at(self.counts, level), 2)
        found = self.with_count(self.with_count(found, "w1", "l"), "w2", "r")
        return found.withColumn("score", _cut_score("l", "r")).filter(F.col("score") >= level)

    def scored_triples(self, rows: DataFrame, triples: DataFrame, level: int) -> DataFrame:
        """Those of the triples that score ``level`` or more."""
        found = self.with_count(self.with_count(triples, "w1", "first"), "w3", "last")
        # The parts occur at least as often as the triple.
        outer = F.greatest("first", "last").cast("decimal(19,0)")
        found = materialize(
            found.filter(F.col("n").cast("decimal(19,0)") * UNIT >= outer * F.lit(level))
        )
        parts = materialize(_pairs_of(found).distinct())
        filter_ = self.share(_pair_filter(parts))
        counts = _sums(rows.mapInArrow(_pairs_in(filter_), _schema(2)), 2)
        counts = materialize(counts.join(parts, ["lang", "w1", "w2"], "left_semi"))
        head = counts.withColumnRenamed("n", "head")
        tail = counts.toDF("lang", "w2", "w3", "tail")
        cuts = F.array(*[
            F.struct(_cut_score(l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
            for k, (l, r) in enumerate((("first", "tail"), ("head", "last")))
        ])
        found = found.join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
        found = found.withColumn("cut", F.array_min(cuts))
        phrase = F.concat_ws(" ", "w1", "w2", "w3").alias("phrase")
        return found.select("lang", phrase, "n", "cut.l", "cut.r", "cut.score").filter(F.col("score") >= level)

    def level(self, rows: DataFrame, level: int) -> DataFrame:
        """All phrases that score ``level`` or more and that no longer one absorbs."""
        pairs = materialize(self.pairs(rows, level))
        grown = self.share(_pair_filter(pairs))
        triples = materialize(self.phrases(rows, _triples_at(self.counts, grown, level), 3))
        longer = _pairs_of(triples, "n").groupBy("lang", "w1", "w2").agg(F.max("n").alias("longer"))
        kept = pairs.join(longer, ["lang", "w1", "w2"], "left").filter(
            F.col("longer").isNull()
            | (F.col("longer").cast("decimal(19,0)") * 100 < F.col("n").cast("decimal(19,0)") * F.lit(self.absorbed))
        )
        phrase = F.concat_ws(" ", "w1", "w2").alias("phrase")
        kept = kept.select("lang", phrase, "n", "l", "r", "score")
        return materialize(kept.unionByName(self.scored_triples(rows, triples, level)))


def find_collocations(docs: DataFrame, lang: str = "lang", text: str = "text", wanted: int = WANTED,
                      least: int = LEAST_COUNT, absorbed: int = ABSORBED_PERCENT,
                      levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """Per language the best ``wanted`` phrases: lang, rank, phrase, a, l, r, n, score.

    ``levels`` fall to 0; which ones there are decides how much is counted, not what is found.
    """
    if not levels or levels[-1] != 0 or list(levels) != sorted(set(levels), reverse=True):
        raise ValueError("levels must fall and end at 0")
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words = materialize(_sums(rows.mapInArrow(_word_batches, _schema(1)), 1))
    totals = materialize(words.filter("w1 is null").select("lang", F.col("n").alias("total")))
    search = _Search(rows, words.filter(F.col("w1").isNotNull() & (F.col("n") >= least)), least, absorbed)
    found, left = None, totals.select("lang")
    for level in levels:
        # Few languages, so the table of those left is small, whatever the size of the corpus.
        own = rows if found is None else rows.join(left, "lang", "left_semi")
        phrases = search.level(own, level)
        if level:
            full = phrases.groupBy("lang").agg(F.count("*").alias("n")).filter(F.col("n") >= wanted)
            settled = materialize(full.select("lang"))
            phrases = phrases.join(settled, "lang", "left_semi")
            left = materialize(left.join(settled, "lang", "left_anti"))
        found = phrases if found is None else found.unionByName(phrases)
        if level and left.isEmpty():
            break
    search.close()
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("n"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("bigint")).filter(F.col("rank") <= wanted)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", F.col("n").alias("a"), "l", "r", F.col("total").alias("n"), "score"
    )
