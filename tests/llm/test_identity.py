"""Words whose structure defeats polynomial hashes are told apart."""

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tideline.llm import decontaminate, near_duplicates, tokens
from tideline.llm.queries import vocabulary
from tideline.llm.text import ALNUM_BYTES, NON_BLANK_BYTES, word_chunks


def thue_morse(n, letters="ab"):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


A, B = thue_morse(2048), thue_morse(2048, "ba")


def test_token_ids():
    library = tokens.load(vocabulary())
    texts = [A, B, f"{A} {B}", "  " + B, thue_morse(2048, " \n") + "x", thue_morse(2048, "\n ") + "x"]
    for text, ids in zip(texts, tokens.encode(texts, vocabulary()), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_memory_starts_anew(monkeypatch):
    library = tokens.load(vocabulary())
    tokens._memory.cache_clear()
    for name in ("REMEMBERED", "REMEMBERED_BYTES"):
        with monkeypatch.context() as m:
            m.setattr(tokens, name, 3)
            for text in ("one two three", "two four", "one five two", "", "six"):
                ids = next(tokens.encode([text], vocabulary())).tolist()
                assert ids == library.encode(text, add_special_tokens=False).ids
    tokens._memory.cache_clear()


def test_near_duplicates(spark):
    rows = [(1, f"{A} one two three"), (2, f"{B} one two three"), (3, f"{A} one two three"), (4, A), (5, B)]
    found = near_duplicates.find_groups(spark.createDataFrame(rows, "doc_id int, text string"), size=2).collect()
    groups = brute.near_groups(rows, 2)
    expected = {d: groups[i] for i, (d, _) in enumerate(rows)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert expected[2][1] == 2 and expected[5][1] == 5


def test_decontamination(spark):
    docs = spark.createDataFrame([(1, f"x {A} y"), (2, f"x {B} y")], "doc_id int, text string")
    items = spark.createDataFrame([("i", A)], "item_id string, text string")
    found = decontaminate.find_passages(docs, items).select("doc_id", decontaminate.hit_words().alias("n")).collect()
    assert {r.doc_id: r.n for r in found} == {1: 1, 2: 0}


@pytest.mark.parametrize("kinds", [ALNUM_BYTES, NON_BLANK_BYTES])
def test_equal_hashes_are_equal_words(kinds):
    texts = [A, B, A + "a", "", None, "é É ß a A a", f"{B}\t{A}"]
    seen = {}
    for chunk in word_chunks(pa.array(texts), kinds):
        for h, s, e in zip(chunk.hash.tolist(), chunk.start, chunk.end):
            seen.setdefault(h, set()).add(chunk.data[s:e].tobytes())
    assert all(len(words) == 1 for words in seen.values())
    assert {b"a", A.encode(), B.encode(), (A + "a").encode()} <= {w for words in seen.values() for w in words}
    assert np.array_equal(*[np.concatenate([c.hash for c in word_chunks(pa.array(x), kinds)]) for x in ([A, B], [A + " " + B])])
