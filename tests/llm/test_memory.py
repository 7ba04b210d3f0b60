"""What a worker's task leaves behind in its process, which lives on for the next ones."""

import ctypes
import random
import re
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark import TaskContext

from tideline.llm import language_id, packing
from tideline.llm.queries import vocabulary

STATUS = Path("/proc/self/smaps_rollup")
pytestmark = pytest.mark.skipif(not STATUS.exists(), reason="needs the memory figures of Linux")


def held_mb():
    return int(re.search(r"\nAnonymous:\s+(\d+)", STATUS.read_text())[1]) / 1024


def batches(n=4):
    r = random.Random(5)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 9))) for _ in range(4_000)]
    for _ in range(n):
        texts = [" ".join(r.choices(words, k=1_000)) for _ in range(1_000)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(r.choices(["en", "de"], k=1_000)), pa.array(texts)], ["lang", "text"]
        )


def free_mb_after(rows):
    """Memory that the process holds after the last row, though nothing uses it."""
    for _ in rows:
        pass
    held = held_mb()
    pa.default_memory_pool().release_unused()
    ctypes.CDLL(None).malloc_trim(0)
    return held - held_mb()


def test_counting_grams_leaves_no_free_memory_behind():
    assert free_mb_after(language_id._count_batches(batches())) < 16


def test_packing_leaves_no_free_memory_behind(monkeypatch):
    monkeypatch.setattr(TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    pieces = packing._cutter(vocabulary(), 2_048, False, pa.string())
    assert free_mb_after(pieces(batches())) < 16
