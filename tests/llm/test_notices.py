"""Inexact licence notices: linear in the text, whole words, the best of overlapping finds."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import licenses


def seconds(words):
    start = time.process_time()
    found = licenses.find_notices(words)
    return time.process_time() - start, found


@pytest.mark.parametrize("line", ["this was relesed under the mit licence by us", "license " * 5, "released under the mit license"])
def test_time_grows_with_the_text(line):
    licenses.find_notices(line)
    small, _ = min((seconds(" ".join([line] * 1000)) for _ in range(3)), key=lambda x: x[0])
    large, found = min((seconds(" ".join([line] * 2000)) for _ in range(3)), key=lambda x: x[0])
    assert large <= 3 * small + 0.05
    assert "mit" not in line or len(found) == 2000


def test_notices_begin_and_end_with_words():
    find = lambda text: [(f.label, f.start, f.end, f.errors) for f in licenses.find_notices(licenses.normalise(text))]
    assert find("so released under the mit license.") == [("mit", 1, 6, 0)]
    # Letters in front of the first one: the notice stands in the middle of a word.
    assert find("prereleased under the mit license") == []
    assert find("xxxxxreleased under the mit licenseyyyyy") == []
    assert find("released under the mit licenses and more") == [("mit", 0, 5, 1)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6))
def test_planted_notices_are_found(seed):
    r = random.Random(seed)
    notice, label = r.choice(licenses.NOTICES)
    text = list(notice)
    for _ in range(r.randrange(licenses.allowed_errors(notice) + 1)):
        i = r.randrange(1, len(text) - 1)
        text[i : i + 1] = r.choice([[], [r.choice("abcxyz")], [text[i], r.choice("abcxyz")]])
    planted = " ".join("".join(text).split())
    errors = edits(notice, planted)
    before = ["lorem"] * r.randrange(4)
    found = licenses.find_notices(" ".join([*before, planted, "ipsum"]))
    if errors <= licenses.allowed_errors(notice):
        best = min((f for f in found if f.label == label), key=lambda f: f.errors)
        assert best.errors <= errors


def test_of_overlapping_finds_the_best_stays():
    assert licenses._best_apart({(2, 0, 10), (1, 5, 15), (0, 14, 20), (1, 20, 25)}) == [(0, 10, 2), (14, 20, 0), (20, 25, 1)]
