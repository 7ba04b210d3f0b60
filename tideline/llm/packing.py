"""Best-fit packing of documents into sequences of fixed length, planned on the length histogram.

Tasks tokenise and cut documents into pieces; only the histogram of piece lengths reaches the
driver (at most ``capacity`` numbers, however many pieces there are). There, patterns of two and
three lengths that fill a sequence exactly are enumerated, their repeat counts are fitted to the
histogram by non-negative least squares (coordinate descent) and rounded down, and what is left over
is packed best-fit in decreasing length, many equal pieces at a time. The plan is a list of slots:
"the next ``n`` pieces of length ``l`` go to sequences ``s ...`` at offset ``o``". Every piece then
finds its place by its rank among the pieces of its length.

Ranks need no global sort: a task numbers its pieces per length, and the tasks' counts per length
are summed up in front of it.

Defined results: null text is empty and leaves one piece that holds the end mark; only documents
longer than a sequence are cut, the remainder first; repeated rows are packed as they are; ties
between patterns go to the first enumerated; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.text import give_back, text_slices
from tideline.llm.tokens import encode
from tideline.session import materialize

CAPACITY = 2048
END_ID = 0
# Middle lengths tried for each smallest length of a pattern of three.
MIDDLES = 24
SWEEPS = 12


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: the remainder first, then full ones."""
    rest = n % capacity
    return ([rest] if rest else []) + [capacity] * (n // capacity)


def _cutter(path: str, capacity: int, keep_ids: bool, key_type: pa.DataType):
    """Function over a task's (key, text) batches; yields pieces numbered per length."""
    fields = [("key", key_type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("part", pa.int64()), ("number", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if keep_ids else []))

    def pieces(batches):
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            keys, rows = batch.column(0).to_pylist(), []
            texts = chain.from_iterable(text_slices(batch.column(1)))
            for key, ids in zip(keys, encode(texts, path), strict=True):
                ids = np.append(ids, END_ID).astype("<u4")
                start = 0
                for piece, length in enumerate(cut_lengths(len(ids), capacity)):
                    own = ids[start : start + length]
                    row = (key, piece, start, length, zlib.crc32(own.tobytes()), part, seen[length])
                    rows.append((*row, own.astype(np.int32)) if keep_ids else row)
                    seen[length] += 1
                    start += length
            columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        give_back()

    return pieces


def cut(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
        capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents: key, piece, start, length, checksum, task and number in it."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType
    schema = (
        f"key {kind.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "part bigint, number bigint" + (", ids array<int>" if keep_ids else "")
    )
    return rows.mapInArrow(_cutter(path, capacity, keep_ids, to_arrow_type(kind)), schema)


def patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of three lengths (the first may be 0) that fill a sequence, all of them in use."""
    used = np.zeros(capacity + 1, dtype=bool)
    used[lengths] = True
    used[0] = True
    small = lengths[lengths < capacity]
    if not len(small):
        return np.zeros((0, 3), dtype=np.int64)
    # Middle lengths at even shares of the pieces, so frequent lengths are tried more often.
    share = np.cumsum(counts[lengths < capacity]) / counts[lengths < capacity].sum()
    middles = np.unique(small[np.searchsorted(share, (np.arange(MIDDLES) + 0.5) / MIDDLES)])
    a = np.concatenate([np.repeat(small, len(middles)), np.zeros(len(small), np.int64)])
    b = np.concatenate([np.tile(middles, len(small)), small])
    c = capacity - a - b
    rows = np.sort(np.stack([a, b, c], axis=1), axis=1)
    rows = np.unique(rows[(c > 0) & used[np.clip(c, 0, capacity)]], axis=0)
    return rows[::-1]  # patterns of many tiny pieces last


def fit_counts(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-negative repeat counts whose pieces come nearest to the histogram, least squares."""
    left = counts.astype(np.float64).tolist()
    fitted = [0.0] * len(rows)
    columns = []
    for row in rows.tolist():
        times: dict[int, int] = {}
        for length in row:
            if length:
                times[length] = times.get(length, 0) + 1
        columns.append((list(times.items()), sum(t * t for t in times.values())))
    for _ in range(SWEEPS):
        for j, (entries, norm) in enumerate(columns):
            gain = 0.0
            for length, t in entries:
                gain += t * left[length]
            step = max(-fitted[j], gain / norm)
            if step:
                fitted[j] += step
                for length, t in entries:
                    left[length] -= t * step
    return np.array(fitted)


@dataclass
class Plan:
    """Slots in parallel arrays, sorted by length and first rank."""

    length: np.ndarray
    first_rank: np.ndarray
    sequences: np.ndarray  # so many sequences from ``base`` on take one piece each, then again
    base: np.ndarray
    offset: np.ndarray
    n_sequences: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of these lengths and ranks."""
        wide = np.int64(1) << np.int64(44)
        at = np.searchsorted(self.length * wide + self.first_rank, length * wide + rank, "right") - 1
        round_, which = np.divmod(rank - self.first_rank[at], self.sequences[at])
        return self.base[at] + which, self.offset[at] + round_ * length


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Plan for ``counts[l]`` pieces of length ``l``."""
    left = counts.astype(np.int64).copy()
    groups: list[tuple[int, list[tuple[int, int]]]] = []  # sequences, (length, pieces in each)
    if left[capacity]:
        groups.append((int(left[capacity]), [(capacity, 1)]))
        left[capacity] = 0
    lengths = np.flatnonzero(left)
    rows = patterns(lengths, left[lengths], capacity)
    fitted = fit_counts(rows, left)
    for j in np.argsort(-fitted, kind="stable").tolist():
        used: dict[int, int] = {}
        for length in rows[j].tolist():
            if length:
                used[length] = used.get(length, 0) + 1
        n = min(int(fitted[j] + 1e-6), *(int(left[x]) // t for x, t in used.items()))
        if n > 0:
            groups.append((n, sorted(used.items(), reverse=True)))
            for length, t in used.items():
                left[length] -= n * t
    groups += _best_fit(left, capacity)
    return _slots(groups, counts, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing over equal pieces at once: the fullest bins that can take them first."""
    bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}  # room -> groups of equal bins
    rooms = np.zeros(capacity + 1, dtype=bool)

    def put(room, n, content):
        bins.setdefault(room, []).append((n, content))
        rooms[room] = True

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            fitting = np.flatnonzero(rooms[length:])
            if len(fitting):
                room = length + int(fitting[0])
                there, content = bins[room].pop()
                if not bins[room]:
                    rooms[room] = False
            else:
                room, there, content = capacity, n, []
            each = room // length
            full = min(there, n // each)
            if full:
                put(room - each * length, full, [*content, (length, each)])
                n -= full * each
            if full < there and n:
                if n >= each:
                    continue
                put(room - n * length, 1, [*content, (length, n)])
                full, n = full + 1, 0
            if full < there and content:
                put(room, there - full, content)
    return [group for groups in bins.values() for group in groups]


def _slots(groups, counts: np.ndarray, capacity: int) -> Plan:
    rank = [0] * (capacity + 1)
    rows, base = [], 0
    for n, content in groups:
        offset = 0
        for length, each in content:
            rows.append((length, rank[length], n, base, offset))
            rank[length] += n * each
            offset += length * each
        base += n
    if rank != counts.tolist():
        raise AssertionError("the plan does not place every piece")
    columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, n_sequences=base)


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; with ``keep_ids`` also their token ids."""
    pieces = materialize(cut(docs, path, key, text, capacity, keep_ids))
    in_task = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in in_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row.length] = row.n
    shared = docs.sparkSession.sparkContext.broadcast(plan(counts, capacity))

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        found = shared.value.places(length.to_numpy(), rank.to_numpy())
        return pa.StructArray.from_arrays([pa.array(x) for x in found], ("sequence_id", "offset"))

    earlier = Window.partitionBy("length").orderBy("part")
    before = in_task.select("part", "length", (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    ranked = pieces.join(before, ["part", "length"])
    placed = ranked.withColumn("at", place("length", F.col("before") + F.col("number")))
    return placed.select(
        F.col("key").alias(key), "piece", "start", "length", "ids_crc32",
        "at.sequence_id", "at.offset", *(["ids"] if keep_ids else []),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """Token ids of whole sequences, and where each piece in them ends, from ``pack(keep_ids=True)``."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("pieces")).select(
        "sequence_id",
        F.flatten("pieces.ids").alias("ids"),
        F.transform("pieces", lambda p: p["offset"] + F.size(p["ids"])).alias("ends"),
    )
