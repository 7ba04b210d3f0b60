"""Word spans and word hashes of whole Arrow string columns, without a Python object per word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

# Bytes of text hashed at once; the working memory is about 60 times that at most. One longer text
# is a chunk of its own.
CHUNK_BYTES = 1 << 19

# Rows and bytes of one batch that Spark hands to Python. A document may be a thousand times as long
# as the rows that Spark's default of 10,000 is made for.
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SEED = 0x2545F491

# Bytes of lower-cased UTF-8 that belong to words: digits, a-z, and all of multi-byte characters.
ALNUM_BYTES = np.zeros(256, dtype=bool)
ALNUM_BYTES[0x30:0x3A] = ALNUM_BYTES[0x61:0x7B] = ALNUM_BYTES[0x80:] = True
# All bytes but blank, tab, line feed, vertical tab, form feed and carriage return.
NON_BLANK_BYTES = np.ones(256, dtype=bool)
NON_BLANK_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XXH64 of words that stand one after another in ``letters``; each distinct word is hashed once.

    Two different words given in advance share a hash with probability 2^-64: of n words and m others
    none is mistaken for another but with probability n * m / 2^64 (1e-4 for 10^9 and 10^6).
    """
    ends = np.concatenate(([0], np.cumsum(lengths)))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths),
        [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(letters))],
    ).dictionary_encode()
    digest = xxhash.xxh64_intdigest
    distinct = np.fromiter((digest(w, SEED) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return distinct[words.indices.to_numpy()] if len(lengths) else distinct


def bound_batches(spark: SparkSession) -> None:
    """Settings of a session that sends whole texts to Python: batches of bounded memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


# Of the C library of Linux; others keep what is free or hand it back by themselves.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Hand the memory that is free in this process back to the system.

    Allocators keep the most that a task ever held, and Spark keeps its Python workers for the tasks
    to come: without this an executor holds that much once for every worker, busy or idle.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def text_slices(column: pa.Array, size: int = 1 << 20) -> Iterator[list[str | None]]:
    """Consecutive texts of an Arrow array as Python strings, about ``size`` bytes at a time."""
    ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False) + 1)
    at, n = 0, len(column)
    while at < n:
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right"))
        to = min(max(to, at + 1), n)
        yield column.slice(at, to - at).to_pylist()
        at = to


@dataclass
class Words:
    """Words of ``n_rows`` consecutive texts; offsets are bytes into ``data`` (lower-cased)."""

    first_row: int
    n_rows: int
    data: np.ndarray
    row: np.ndarray  # of each word, from 0 within these texts
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray  # word positions where each text begins, and the end
    text_start: np.ndarray  # byte where each text begins, and the end


def word_chunks(column: pa.Array, word_bytes: np.ndarray) -> Iterator[Words]:
    """Words of every text of an Arrow string array, in chunks of whole texts; null is empty."""
    column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, width)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield _words(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at, word_bytes)
        at = to


def _words(data: np.ndarray, text_start: np.ndarray, first_row: int, word_bytes: np.ndarray) -> Words:
    data = _LOWER[data]
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = word_bytes[data]
    # A text boundary ends a word even where no separator stands.
    cut = np.zeros(n + 1, dtype=bool)
    cut[text_start] = True
    begins = inside[1:] & (~inside[:-1] | cut)
    ends = inside[:-1] & (~inside[1:] | cut)
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends)
    hashes = word_hashes(data[inside[1:-1]], end - start)
    row = np.searchsorted(text_start, start, side="right") - 1
    n_rows = len(text_start) - 1
    # Empty texts share a start with their neighbour; the last of equal starts owns the word.
    bounds = np.searchsorted(start, text_start, side="left")
    return Words(first_row, n_rows, data, row, start, end, hashes, bounds, text_start)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
