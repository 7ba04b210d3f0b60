"""Language of whole texts: interpolated Kneser-Ney character models in sorted hash arrays.

Training counts the character 4-grams of every learning text with one shuffle of distinct grams per
task; continuation counts of the lower orders follow from the distinct grams by grouping. Every
gram is stored, so the model grows with the corpus. One of more than ``BLOCK_CELLS`` numbers is cut
into blocks by the two middle characters of a gram, which its contexts and shorter grams share; the
short grams of one and two characters are in every block. Texts are scored one block at a time,
each block adding the grams it owns, so driver and tasks hold one block whatever the corpus size.

A gram of up to four characters is a 64-bit number (16 bits each; rarer planes share codes), made a
hash by an invertible mix. The hashes of all languages are kept in one sorted array per order with
an index of bucket starts, and one row of log probabilities per hash. A text gets the language with
the lowest cross-entropy per character. Rejection is calibrated on learning texts the counts have
not seen, a third of them at a time; the final counts are of all learning texts. A text is rejected
if its cross-entropy exceeds its language's usual one by more than ``tolerance`` deviations, which
shrink with the square root of the length. A language with few calibration texts takes at least
the deviation of all languages together; one without any rejects nothing.

Defined results: null text or text without letters gives ``und``, score 0 and is rejected; ties
between languages go to the first name in order; texts are read whole; repeated rows count as they
are; without any learning text every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.text import free_name, give_back, mix, text_slices
from tideline.session import materialize

UNKNOWN = "und"
ORDER = 4
# Numbers (grams of three and four characters times languages) in one block of the model.
BLOCK_CELLS = 8_000_000
TOLERANCE = 8.0
# Nats per character that never count as excess.
SLACK = 0.35
# Fewer calibration texts than these do not tell a language's deviation by themselves.
FEW_TEXTS = 30
# Characters normalised and scored at once.
CHUNK_CHARS = 1 << 18
# Distinct grams that a task holds before it hands them on.
HELD_GRAMS = 1 << 19

_BITS, _MASK = 16, 0xFFFF
_BLANK = 32


def _letter_tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(1 << 16, dtype=np.uint16)
    for code in range(1 << 16):
        low = chr(code).lower()
        lower[code] = ord(low) if len(low) == 1 else code
    letter = np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)
    return np.where(letter, lower, _BLANK).astype(np.uint16), letter


_LOWER, _LETTER = _letter_tables()


@dataclass
class Letters:
    """Characters of several texts: letters lower-cased, all else blanks that do not repeat."""

    chars: np.ndarray
    begin: np.ndarray  # number of the gram that ends at the first character of each text
    end: np.ndarray  # and that of the one after the gram that ends at the blank behind it


def letters(texts: list[str | None]) -> Letters:
    """Normalise texts; ``ORDER - 1`` blanks stand before, between and behind them."""
    gap = ORDER - 1
    raw = (" " * gap).join(["", *(t or "" for t in texts), ""])
    codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = codes > _MASK
    if wide.any():
        # Letters beyond the first plane share the codes of the surrogates, which no text holds.
        kinds, where = np.unique(codes[wide], return_inverse=True)
        is_letter = np.fromiter((chr(c).isalpha() for c in kinds), bool, len(kinds))
        normal = np.where(wide, _BLANK, _LOWER[codes & _MASK]).astype(np.uint16)
        normal[wide] = np.where(is_letter, 0xD800 + kinds % 2048, _BLANK)[where]
    else:
        normal = _LOWER[codes]
    lengths = np.fromiter((len(t or "") for t in texts), np.int64, len(texts))
    ends = np.cumsum(lengths + gap)  # first blank behind each text
    starts = ends - lengths  # first character of each text
    blank = normal == _BLANK
    keep = np.ones(len(normal), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    for i in range(gap):
        keep[ends + i] = True
    keep[:gap] = True
    position = np.cumsum(keep) - 1
    # The gram that ends at character q has number q - gap.
    return Letters(normal[keep], position[starts - 1] + 1 - gap, position[ends] + 1 - gap)


def grams(chars: np.ndarray) -> np.ndarray:
    """The gram of ``ORDER`` characters that ends at each position, as number."""
    n = max(0, len(chars) - ORDER + 1)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(ORDER):
        key = (key << np.uint64(_BITS)) | chars[i : i + n].astype(np.uint64)
    return key


def _chunks(texts: list[str | None], chars: int):
    """Consecutive texts of together about ``chars`` characters, with their first position."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "") + ORDER
        if size >= chars or i == len(texts) - 1:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0


class _Counter:
    """Distinct grams of one language with their counts."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, texts: list[str | None]) -> None:
        for _, chunk in _chunks(texts, CHUNK_CHARS):
            part = letters(chunk)
            keys = grams(part.chars)
            inside = np.ones(len(keys), dtype=bool)
            for i in range(ORDER - 2):  # grams that end between two texts
                inside[part.end[:-1] + i] = False
            self.parts.append(np.unique(keys[inside], return_counts=True))
            if len(self.parts) > 8:
                self.parts = [self.total()]

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        counts = np.concatenate([n for _, n in self.parts])
        return keys, np.bincount(where, counts).astype(np.int64)

    def __len__(self) -> int:
        return sum(len(k) for k, _ in self.parts)


def _count_batches(batches):
    """Grams and counts per language of a task's texts, handed on whenever many are held."""
    held: dict[str, _Counter] = {}

    def rows():
        for lang, counter in held.items():
            keys, counts = counter.total()
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)],
                ["lang", "gram", "n"],
            )
        held.clear()

    for batch in batches:
        langs = iter(batch.column(0).to_pylist())
        for part in text_slices(batch.column(1)):
            texts: dict[str, list] = {}
            for text in part:
                texts.setdefault(next(langs), []).append(text)
            for lang, own in texts.items():
                held.setdefault(lang, _Counter()).add(own)
        if sum(map(len, held.values())) > HELD_GRAMS:
            yield from rows()
    yield from rows()
    give_back()


def count_grams(texts: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang``, ``gram``, ``n`` of the ``ORDER``-grams of all texts."""
    rows = texts.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = rows.mapInArrow(_count_batches, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _orders(counted: DataFrame) -> DataFrame:
    """All orders: raw counts of the highest, continuation counts of the lower ones."""
    tables = [counted.withColumn("k", F.lit(ORDER))]
    for k in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND((1 << _BITS * k) - 1)
        lower = tables[-1].groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n"))
        tables.append(lower.withColumn("k", F.lit(k)))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def kneser_ney(counted: DataFrame, min_share: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Discounted probabilities of the stored grams, and size and alphabet per language and order.

    All grams are stored unless ``min_share`` asks for those of at least that share of their order.

    Columns ``lang k gram context p``; the share of a context that its stored grams leave over goes
    to the lower order, so every conditional distribution sums to one.
    """
    grams_ = materialize(_orders(materialize(counted)))
    of_order = grams_.groupBy("lang", "k").agg(
        F.sum("n").alias("total"),
        F.count("*").alias("distinct"),
        F.sum((F.col("n") == 1).cast("long")).alias("once"),
        F.sum((F.col("n") == 2).cast("long")).alias("twice"),
    )
    discount = F.try_divide(F.col("once"), F.col("once") + 2 * F.col("twice"))
    sizes = of_order.select(
        "lang", "k", "total", "distinct",
        F.least(F.greatest(F.coalesce(discount, F.lit(0.5)), F.lit(0.05)), F.lit(0.95)).alias("d"),
    )
    rows = grams_.withColumn("context", F.shiftrightunsigned("gram", _BITS))
    totals = rows.groupBy("lang", "k", "context").agg(F.sum("n").alias("seen"))
    stored = (
        # One row per language and order: bounded, and by nature few keys, so no shuffle by them.
        rows.join(F.broadcast(sizes), ["lang", "k"]).filter(F.col("n") >= F.col("total") * min_share)
        .join(totals, ["lang", "k", "context"])
        .select(
            "lang", "k", "gram", "context",
            (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("seen")).alias("p"),
        )
    )
    return stored, sizes


# A block is a hash of the middle characters; both factors keep the product below 2**63.
_FACTOR, _PRIME = 1_000_003, (1 << 31) - 1
_MIDDLE = (1 << 2 * _BITS) - 1
# Orders up to this one are in every block.
_SHARED_ORDERS = 2


def _in_block(block: int, n_blocks: int) -> Column:
    """Whether a stored gram belongs to a block."""
    middle = F.col("context").bitwiseAND(F.lit(_MIDDLE))
    return (F.col("k") <= _SHARED_ORDERS) | (middle * _FACTOR % _PRIME % n_blocks == block)


class HashTable:
    """Sorted hashes with an index of bucket starts; ``find`` gives positions, -1 if absent."""

    def __init__(self, keys: np.ndarray):
        self.hashes = np.sort(mix(keys.astype(np.uint64)))
        bits = max(1, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        bounds = np.arange((1 << bits) + 1, dtype=np.float64)
        tops = (self.hashes >> self.shift).astype(np.int64)
        self.starts = np.searchsorted(tops, bounds).astype(np.int32)
        self.deepest = int(np.diff(self.starts).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int32)
        if not len(self.hashes):
            return out
        wanted = mix(keys)
        bucket = (wanted >> self.shift).astype(np.int32)
        at, stop = self.starts[bucket], self.starts[bucket + 1]
        open_ = np.flatnonzero(at < stop)
        at, stop, wanted = at[open_], stop[open_], wanted[open_]
        for _ in range(self.deepest):
            hit = self.hashes[at] == wanted
            out[open_[hit]] = at[hit]
            at = at + 1
            go = ~hit & (at < stop)
            if not go.any():
                break
            open_, at, stop, wanted = open_[go], at[go], stop[go], wanted[go]
        return out


@dataclass
class Model:
    """Tables per order, the languages in order, and per language the calibration."""

    languages: list[str]
    floor: np.ndarray
    grams: dict[int, tuple[HashTable, np.ndarray]] = field(default_factory=dict)
    contexts: dict[int, tuple[HashTable, np.ndarray]] = field(default_factory=dict)
    usual: np.ndarray | None = None  # cross-entropy per language
    deviation: np.ndarray | None = None  # times the square root of the length
    tolerance: float = TOLERANCE
    block: int = 0
    n_blocks: int = 1

    def own(self, keys: np.ndarray) -> np.ndarray:
        """Positions of the grams that this block of the model scores."""
        middle = (keys >> np.uint64(_BITS)) & np.uint64(_MIDDLE)
        hashed = middle * np.uint64(_FACTOR) % np.uint64(_PRIME) % np.uint64(self.n_blocks)
        return np.flatnonzero(hashed == self.block)

    def probabilities(self, keys: np.ndarray, highest: int = ORDER) -> np.ndarray:
        """Interpolated probability of each gram's last character, one column per language."""
        p = np.repeat(self.floor[None, :], len(keys), axis=0)
        for k in range(1, highest + 1):
            part = keys & np.uint64((1 << _BITS * k) - 1)
            table, share = self.contexts[k]
            at = table.find(part >> np.uint64(_BITS))
            p *= np.where(at[:, None] >= 0, share[at], 1.0)
            table, own = self.grams[k]
            at = table.find(part)
            found = at >= 0
            p[found] += own[at[found]]
        return p

    def log_probabilities(self, keys: np.ndarray) -> np.ndarray:
        table, logs = self.grams[0]
        at = table.find(keys)
        out = logs[at]
        missing = np.flatnonzero(at < 0)
        if len(missing):
            out[missing] = np.log(self.probabilities(keys[missing]))
        return out

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log likelihood per text and language, characters scored, and letters."""
        sums, sizes, n_letters = [], [], []
        for chunk in text_slices(texts, CHUNK_CHARS * 4 // max(4, len(self.languages))):
            part = letters(chunk)
            keys = grams(part.chars)
            if self.n_blocks == 1:
                logs = self.log_probabilities(keys)
            else:
                own = self.own(keys)
                logs = np.zeros((len(keys), len(self.languages)), dtype=np.float32)
                logs[own] = self.log_probabilities(keys[own])
            total = np.zeros((len(logs) + 1, len(self.languages)))
            np.cumsum(logs, axis=0, out=total[1:])
            is_letter = np.concatenate([[0], np.cumsum(part.chars[ORDER - 1 :] != _BLANK)])
            sums.append(total[part.end] - total[part.begin])
            sizes.append(part.end - part.begin)
            n_letters.append(is_letter[part.end] - is_letter[part.begin])
        return np.concatenate(sums), np.concatenate(sizes), np.concatenate(n_letters)


def _table(keys, langs, values, n_langs) -> tuple[HashTable, np.ndarray]:
    """A table over the union of the languages' keys; absent pairs are NaN."""
    union = np.unique(keys)
    table = HashTable(union)
    matrix = np.full((len(union), n_langs), np.nan)
    matrix[table.find(keys), langs] = values
    return table, matrix


@dataclass
class Blocks:
    """A model whose tables are gathered one block at a time; calibration as in ``Model``."""

    languages: list[str]
    stored: DataFrame
    sizes: DataFrame
    n_blocks: int
    usual: np.ndarray | None = None
    deviation: np.ndarray | None = None
    tolerance: float = TOLERANCE


def model_of(stored: DataFrame, sizes: DataFrame, block_cells: int = BLOCK_CELLS) -> Model | Blocks:
    """The model of all stored grams, in as many blocks as its size asks for."""
    stored, sizes = materialize(stored), materialize(sizes)
    languages = sorted(r.lang for r in sizes.select("lang").distinct().collect())
    cells = stored.filter(F.col("k") > _SHARED_ORDERS).count() * len(languages)
    n_blocks = -(-cells // block_cells)
    return build_model(stored, sizes) if n_blocks <= 1 else Blocks(languages, stored, sizes, n_blocks)


def build_model(stored: DataFrame, sizes: DataFrame, block: int = 0, n_blocks: int = 1) -> Model:
    """Gather the stored grams, or one block of them, and lay them out for lookup."""
    rows = (stored if n_blocks == 1 else stored.filter(_in_block(block, n_blocks))).toArrow()
    alphabet = {r.lang: r.distinct for r in sizes.filter("k = 1").collect()}
    languages = sorted(alphabet)
    floor = np.array([1.0 / (alphabet[x] + 1) for x in languages])
    model = Model(languages, floor, block=block, n_blocks=n_blocks)
    if not languages:
        return model
    number = {x: i for i, x in enumerate(languages)}
    names = rows["lang"].combine_chunks().dictionary_encode()
    lang = np.array([number[x] for x in names.dictionary.to_pylist()])[names.indices.to_numpy()]
    k, p = rows["k"].to_numpy(), rows["p"].to_numpy()
    gram, context = (rows[c].to_numpy().view(np.uint64) for c in ("gram", "context"))
    for order in range(1, ORDER + 1):
        own = k == order
        table, matrix = _table(gram[own], lang[own], p[own], len(languages))
        model.grams[order] = table, np.nan_to_num(matrix)
        pairs, where = np.unique(
            np.stack([context[own], lang[own].astype(np.uint64)], axis=1), axis=0, return_inverse=True
        )
        used = np.bincount(where.ravel(), p[own], len(pairs))
        left = np.clip(1.0 - used, 1e-6, 1.0)
        table, matrix = _table(pairs[:, 0], pairs[:, 1].astype(np.int64), left, len(languages))
        model.contexts[order] = table, np.nan_to_num(matrix, nan=1.0)
    # The highest order's stored grams with their whole interpolated probability.
    known = np.unique(gram[k == ORDER])
    table = HashTable(known)
    logs = np.empty((len(known), len(languages)), dtype=np.float32)
    logs[table.find(known)] = np.log(model.probabilities(known))
    model.grams[0] = table, logs
    return model


def _likelihoods(model):
    @F.arrow_udf("struct<n:bigint,ll:array<double>>")
    def likelihoods(texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.struct([("n", pa.int64()), ("ll", pa.list_(pa.float64()))]))
        sums, sizes, n_letters = model.value.score(texts)
        n = np.where(n_letters > 0, sizes, 0)
        lists = pa.array([row.tolist() for row in sums], pa.list_(pa.float64()))
        give_back()
        return pa.StructArray.from_arrays([pa.array(n), lists], ("n", "ll"))

    return likelihoods


def score_texts(rows: DataFrame, model: Model | Blocks, text: str, into: str) -> DataFrame:
    """``rows`` with a struct column ``into``: characters scored, log likelihood per language."""
    context = rows.sparkSession.sparkContext
    if isinstance(model, Model):
        return rows.withColumn(into, _likelihoods(context.broadcast(model))(F.col(text)))
    row = free_name(rows, "row")
    rows = materialize(rows.withColumn(row, F.monotonically_increasing_id()))
    parts = None
    for block in range(model.n_blocks):
        shared = context.broadcast(build_model(model.stored, model.sizes, block, model.n_blocks))
        part = materialize(
            rows.select(F.col(row).alias("row"), F.lit(block).alias("block"), _likelihoods(shared)(F.col(text)).alias("s"))
        )
        shared.destroy()
        parts = part if parts is None else parts.unionByName(part)
    # In the order of the blocks, so that sums do not depend on the order of rows.
    added = F.aggregate(
        F.array_sort(F.collect_list(F.struct("block", "s.ll"))),
        F.array_repeat(F.lit(0.0), len(model.languages)),
        lambda a, b: F.zip_with(a, b["ll"], lambda x, y: x + y),
    )
    sums = parts.groupBy(F.col("row").alias(row)).agg(
        F.struct(F.max("s.n").alias("n"), added.alias("ll")).alias(into)
    )
    return rows.join(sums, row).drop(row)


def _own_entropies(model: Model | Blocks, texts: DataFrame, lang: str, text: str) -> list:
    """Per language: characters, sums of its texts' entropies and of their squares, and texts."""
    if not model.languages:
        return []
    number = F.create_map(*[F.lit(v) for i, x in enumerate(model.languages) for v in (x, i + 1)])
    known = texts.filter(F.col(lang).isin(model.languages)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    own = (
        score_texts(known, model, "text", "s")
        .filter("s.n > 0")
        .select("lang", "s.n", (-F.element_at("s.ll", F.element_at(number, F.col("lang")))).alias("h"))
    )
    return own.groupBy("lang").agg(
        F.sum("n").alias("n"), F.sum("h").alias("h"), F.sum(F.col("h") * F.col("h") / F.col("n")).alias("hh"),
        F.count("*").alias("texts"),
    ).collect()


def _set_usual(model: Model | Blocks, sums: list) -> None:
    """Set each language's usual cross-entropy and its deviation from sums of texts not trained on."""
    total = np.zeros((len(model.languages), 4))
    for r in sums:
        total[model.languages.index(r.lang)] += (r.n, r.h, r.hh, r.texts)
    n, h, hh, texts = total.T
    seen = texts > 0
    mean = h / np.maximum(n, 1)
    squares = np.maximum(0.0, hh - 2 * mean * h + mean * mean * n)
    # Each mean is taken from the same texts; with one text per language nothing is known.
    free = texts.sum() - seen.sum()
    pooled = np.sqrt(squares.sum() / free) if free > 0 else np.inf
    own = np.sqrt(squares / np.maximum(texts, 1))
    model.usual = np.where(seen, mean, np.inf)
    model.deviation = np.where(texts < FEW_TEXTS, np.maximum(own, pooled), own)


def calibrate(model: Model | Blocks, texts: DataFrame, lang: str = "lang", text: str = "text") -> Model | Blocks:
    """Set each language's usual cross-entropy and its deviation from texts not trained on."""
    _set_usual(model, _own_entropies(model, texts, lang, text))
    return model


def train(texts: DataFrame, calibration: DataFrame, lang: str = "lang", text: str = "text",
          block_cells: int = BLOCK_CELLS) -> Model | Blocks:
    """Model of the non-null languages of ``texts``, calibrated on ``calibration``."""
    known = texts.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    model = model_of(*kneser_ney(count_grams(known, lang, text)), block_cells)
    if model.languages:
        calibrate(model, calibration.filter(F.col(lang).isNotNull()), lang, text)
    return model


_RESULT = "struct<lang_pred:string,score:double,entropy:double,rejected:boolean>"
_NAMES = ("lang_pred", "score", "entropy", "rejected")


def _judged(model: Model | Blocks, sums: np.ndarray, sizes: np.ndarray, known: np.ndarray) -> pa.Array:
    """Language, confidence and rejection of texts from their log likelihoods."""
    n = len(sizes)
    if not model.languages or not n:
        columns = [[UNKNOWN] * n, [0.0] * n, [None] * n, [True] * n]
    else:
        entropy = -sums / np.maximum(sizes, 1)[:, None]
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(n), best]
        # How far the others are behind, in deviations of a text of this length.
        behind = (entropy - lowest[:, None]) * np.sqrt(np.maximum(sizes, 1))[:, None]
        score = 1.0 / np.exp(-behind).sum(axis=1)
        allowed = SLACK + model.tolerance * model.deviation[best] / np.sqrt(np.maximum(sizes, 1))
        rejected = ~known | (lowest > model.usual[best] + allowed)
        langs = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        columns = [langs, np.where(known, score, 0.0), np.where(known, lowest, 0.0), rejected]
    types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _NAMES)


def predict(spark, model: Model):
    """Function from a text column to the predicted language, confidence and rejection."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(_RESULT)
    def predicted(texts: pa.Array) -> pa.Array:
        model, n = shared.value, len(texts)
        if not model.languages or not n:
            return _judged(model, np.zeros((n, 0)), np.zeros(n), np.zeros(n, bool))
        sums, sizes, n_letters = model.score(texts)
        give_back()
        return _judged(model, sums, sizes, n_letters > 0)

    return predicted


def _predict_blocks(docs: DataFrame, model: Blocks, text: str, into: str) -> DataFrame:
    """``docs`` with the struct of ``predict``, scored one block of the model at a time."""
    frame = Model(model.languages, np.zeros(0), usual=model.usual, deviation=model.deviation,
                  tolerance=model.tolerance)

    @F.arrow_udf(_RESULT)
    def judged(sizes: pa.Array, sums: pa.Array) -> pa.Array:
        n = sizes.to_numpy(zero_copy_only=False)
        values = sums.flatten().to_numpy(zero_copy_only=False).reshape(len(n), -1) if len(n) else np.zeros((0, 0))
        return _judged(frame, values, n, n > 0)

    likely = free_name(docs, "likely")
    scored = score_texts(docs, model, text, likely)
    return scored.withColumn(into, judged(F.col(f"{likely}.n"), F.col(f"{likely}.ll"))).drop(likely)


def fold(key: str = "doc_id", parts: int = 8) -> Column:
    """A document's part, by the checksum of its id as text."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


# Parts of the learnable documents that are kept from the counts together, to calibrate on.
TURNS = ((0, 1), (3, 4), (5, 7))


def learn(docs: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text",
          block_cells: int = BLOCK_CELLS) -> Model | Blocks:
    """Train on all documents outside the held-out quarter, calibrated by thirds of them in turn."""
    turn = F.lit(None)
    for i, parts in enumerate(TURNS):
        turn = F.when(fold(key).isin(*parts), F.lit(str(i))).otherwise(turn)
    rows = docs.select(turn.alias("turn"), F.col(lang).alias("lang"), F.col(text).alias("text")).filter(
        "turn IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL"
    )
    by_turn = materialize(count_grams(rows.withColumn("lang", F.concat("turn", "lang")))).select(
        F.substring("lang", 1, 1).alias("turn"), F.expr("substring(lang, 2)").alias("lang"), "gram", "n"
    )
    add_up = lambda counted: counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    sums = []
    for i in map(str, range(len(TURNS))):
        others = model_of(*kneser_ney(add_up(by_turn.filter(F.col("turn") != i))), block_cells)
        sums += _own_entropies(others, rows.filter(F.col("turn") == i), "lang", "text")
    model = model_of(*kneser_ney(add_up(by_turn)), block_cells)
    _set_usual(model, sums)
    return model


def identify(docs: DataFrame, text: str = "text", into: str = "language",
             model: Model | Blocks | None = None) -> DataFrame:
    """``docs`` with a struct column ``into``; without a model, one is learnt from ``docs``."""
    model = learn(docs, text=text) if model is None else model
    if isinstance(model, Blocks):
        return _predict_blocks(docs, model, text, into)
    return docs.withColumn(into, predict(docs.sparkSession, model)(F.col(text)))


def keep_identified(docs: DataFrame, text: str = "text", model: Model | Blocks | None = None) -> DataFrame:
    """``docs`` without the documents whose language is rejected."""
    into = free_name(docs, "language")
    found = identify(docs, text, into, model)
    return found.filter(~F.col(f"{into}.rejected")).drop(into)
