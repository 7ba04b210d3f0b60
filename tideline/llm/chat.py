"""Chat turns as training windows of bounded length, with a loss mask on the assistant's words.

Turns are counted in tokens, and prefix sums over a conversation choose turn-aligned spans: a window
holds the system turn, a limited repeat of the turns before it, and as many new turns as the budget
takes. Only assistant turns that are new in a window are under its loss mask, so every one is learnt
exactly once. Control strings inside texts are escaped and can be restored.

A conversation of any length is handled in segments: prefix sums cut it about every ``SEGMENTS``
budgets, where a window ends anyway; a segment gets a copy of the turns just before it and of the
system turn. Positions come from written, range-partitioned rows, so one conversation may spread
over many tasks.

Defined results: null texts and roles are empty; turns are ordered by number, then role, then text
(null numbers first), repeated rows are turns of their own; a turn longer than the budget has a
window of its own, whole; ids are whole numbers, or text that reads as one; the system turn is the conversation's first one if its role is ``system``;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.text import text_slices
from tideline.llm.tokens import encode
from tideline.session import materialize

BUDGET = 1024
HISTORY = 256
SEGMENTS = 64
# Tokens that a turn's marks count for.
FRAME = 5

# The template: marks of a turn's begin and end. Escaping puts one more backslash between the first
# two characters of any mark in a text, so a text never holds one.
BEGIN, END = "<|im_start|>", "<|im_end|>"
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<(\\*)\\\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    pairs = {"\\\\": "\\", "\\n": "\n"}
    return re.sub(r"\\\\|\\n", lambda m: pairs[m[0]], unescape(role))


def format_turns(turns: list[tuple[str, str]], learnt: list[bool]) -> tuple[str, list[tuple[int, int]]]:
    """The template's text of turns (role, text), and the spans of the texts that are learnt."""
    pieces, spans, at = [], [], 0
    for (role, text), is_learnt in zip(turns, learnt, strict=True):
        head, body = f"{BEGIN}{escape_role(role)}\n", escape(text)
        if is_learnt:
            spans.append((at + len(head), at + len(head) + len(body)))
        pieces += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(pieces), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted text, unescaped."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def windows(sizes: list[int], budget: int, history: int, first_new: int = 0,
            system: int = 0) -> Iterator[tuple[int, int, int]]:
    """Windows over turns of these sizes: first repeated turn, first new turn, end.

    ``first_new`` turns in front are only repeats; ``system`` tokens are taken in every window.
    """
    total = [0]
    for size in sizes:
        total.append(total[-1] + size)
    new = first_new
    while new < len(sizes):
        repeat = new
        # Repeat as much as the history takes and still leaves room for the first new turn.
        spare = min(history, budget - system - sizes[new])
        while repeat and total[new] - total[repeat - 1] <= spare:
            repeat -= 1
        end = new + 1
        while end < len(sizes) and system + total[end + 1] - total[repeat] <= budget:
            end += 1
        yield repeat, new, end
        new = end


def _token_counter(path: str):
    @F.arrow_udf("bigint")
    def counts(texts: pa.Array) -> pa.Array:
        values = chain.from_iterable(text_slices(texts))
        return pa.array([len(ids) + FRAME for ids in encode(values, path)], pa.int64())

    return counts


def _positions(turns: DataFrame) -> DataFrame:
    """Add ``position`` (turns before in the conversation) and ``before`` (their tokens)."""
    order = ["conv", "turn", "role", "text"]
    ranged = materialize(
        turns.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, "tie").withColumn("part", F.spark_partition_id())
    )
    sums = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
    ahead = Window.partitionBy("conv").orderBy("part")
    heads = sums.select(
        "conv", "part", (F.sum("n").over(ahead) - F.col("n")).alias("n_ahead"),
        (F.sum("t").over(ahead) - F.col("t")).alias("t_ahead"),
    )
    inside = Window.partitionBy("conv", "part").orderBy("turn", "role", "text", "tie")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = ranged.withColumn("i", F.row_number().over(inside) - 1).withColumn(
        "t", F.sum("tokens").over(upto) - F.col("tokens")
    )
    heads = heads.withColumnsRenamed({"conv": "conv_", "part": "part_"})
    same = F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("part") == F.col("part_"))
    return numbered.join(heads, same).select(
        "conv", "role", "text", "tokens", (F.col("n_ahead") + F.col("i")).alias("position"),
        (F.col("t_ahead") + F.col("t")).alias("before"),
    )


_WINDOWS = (
    "conv bigint, segment bigint, window int, first_turn bigint, n_system int, n_repeated int, n_turns int, "
    "text string, loss_starts array<bigint>, loss_ends array<bigint>"
)


_WINDOW_TYPES = (
    ("conv", pa.int64()), ("segment", pa.int64()), ("window", pa.int32()), ("first_turn", pa.int64()),
    ("n_system", pa.int32()), ("n_repeated", pa.int32()), ("n_turns", pa.int32()), ("text", pa.string()),
    ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64())),
)


def segment_windows(rows: list[dict], budget: int, history: int) -> Iterator[tuple]:
    """Windows of one segment from its turns in order; columns after ``segment``."""
    system = next((r for r in rows if r["is_system"]), None)
    body = [r for r in rows if r["own"] or not r["is_system"]]
    first_new = next((i for i, r in enumerate(body) if r["own"]), len(body))
    sizes = [r["tokens"] for r in body]
    taken = system["tokens"] if system else 0
    for number, (repeat, new, end) in enumerate(windows(sizes, budget, history, first_new, taken)):
        # The system turn stands in front unless the window begins with it anyway.
        front = [system] if system and body[repeat]["position"] > 0 else []
        turns = [(r["role"], r["text"]) for r in front + body[repeat:end]]
        learnt = [False] * (len(front) + new - repeat) + [r["role"] == "assistant" for r in body[new:end]]
        text, spans = format_turns(turns, learnt)
        yield (
            number, body[new]["position"], len(front), new - repeat, end - new, text,
            [s for s, _ in spans], [e for _, e in spans],
        )


def _format_segments(budget: int, history: int):
    """Function over rows sorted by conversation, segment and position; one segment is open at a time."""

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, done = None, [], []

        def batch():
            columns = [pa.array([r[i] for r in done], t) for i, (_, t) in enumerate(_WINDOW_TYPES)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, [name for name, _ in _WINDOW_TYPES])

        for part in batches:
            for row in part.to_pylist():
                if (row["conv"], row["segment"]) != key:
                    done += [(*key, *w) for w in segment_windows(rows, budget, history)] if rows else []
                    key, rows = (row["conv"], row["segment"]), []
                rows.append(row)
            if done:
                yield batch()
        if rows:
            done += [(*key, *w) for w in segment_windows(rows, budget, history)]
            yield batch()

    return formatted


def format_windows(conversations: DataFrame, path: str, budget: int = BUDGET, history: int = HISTORY,
                   segments: int = SEGMENTS) -> DataFrame:
    """One row per window of ``conversations(conv_id, turn, role, text)``.

    ``conv``, ``segment`` and ``window`` order the windows; ``n_system`` and ``n_repeated`` turns in
    front are repeats; ``loss_starts`` and ``loss_ends`` are code points of ``text``.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = turns.withColumn("tokens", _token_counter(path)(F.col("text")))
    placed = materialize(_positions(turns))
    length = segments * budget
    segment = F.floor(F.col("before") / length)
    # Turns that end at most one history before the next segment are copied into it.
    after = F.col("before") + F.col("tokens")
    next_start = (segment + 1) * length
    homes = F.when(
        after >= next_start - history, F.array(segment, segment + 1)
    ).otherwise(F.array(segment))
    is_system = (F.col("position") == 0) & (F.col("role") == "system")
    rows = placed.withColumn("segment", F.explode(homes)).withColumn("own", F.col("segment") == segment)
    rows = rows.withColumn("is_system", is_system & F.col("own"))
    # A copied turn whose next segment stays empty belongs to no window and yields none.
    later = rows.filter("own and segment > 0").select("conv", "segment").distinct()
    opening = placed.filter(is_system).select("conv", "role", "text", "tokens", "position", "before")
    copies = opening.withColumnRenamed("conv", "conv_").join(
        later, F.col("conv_").eqNullSafe(F.col("conv"))
    ).select("conv", "role", "text", "tokens", "position", "before", "segment").withColumns(
        {"own": F.lit(False), "is_system": F.lit(True)}
    )
    every = rows.select(*copies.columns).unionByName(copies)
    order = ["conv", "segment", "position"]
    ordered = every.repartition("conv", "segment").sortWithinPartitions(*order)
    return ordered.mapInArrow(_format_segments(budget, history), _WINDOWS)


def _digest_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations from their windows in order; one conversation at a time is open."""
    names = ("conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    current, state, done = None, None, []

    def closed():
        conv, n, turns, chars, loss, formatted = state
        done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

    def batch():
        columns = [pa.array([r[i] for r in done], t) for i, t in enumerate(types)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for rows in batches:
        for row in rows.to_pylist():
            if state is None or row["conv"] != current:
                if state is not None:
                    closed()
                current = row["conv"]
                state = [current, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse_turns(row["text"])[row["n_system"] + row["n_repeated"] :]:
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            for start, end in zip(row["loss_starts"], row["loss_ends"]):
                learnt = unescape(row["text"][start:end])
                state[3] += len(learnt)
                state[4].update(learnt.encode())
            state[5] += len(row["text"])
        if done:
            yield batch()
    if state is not None:
        closed()
        yield batch()


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and learnt text of every conversation as its windows hold them, digested."""
    ordered = formatted.repartition("conv").sortWithinPartitions("conv", "segment", "window")
    return ordered.mapInArrow(
        _digest_windows,
        "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint",
    )
