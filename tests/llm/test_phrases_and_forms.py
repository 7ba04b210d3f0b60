"""Spelling variants, collocations and fingerprints on planted tables, against plain versions."""

import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_operators import ROWS, SCHEMA, prose
from tideline.llm import collocations, simhash, spelling


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


# Spelling variants.


def forms_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {}
    for r in spelling.group_variants(df, **options).collect():
        assert r.word not in found
        found[r.word] = (r.form, r.root, r.n, r.n_near, r.form_n)
    return found


def variants(word, r):
    """Words one edit from ``word``."""
    letters = "abcdeéÿß"
    i = r.randrange(len(word))
    return r.choice([word[:i] + word[i + 1 :], word[:i] + r.choice(letters) + word[i:],
                     word[:i] + r.choice(letters) + word[i + 1 :]])


@pytest.mark.parametrize("options", [{}, {"leaf_words": 20, "sample_words": 150}, {"leaf_words": 5, "most_leaves": 64}])
def test_variants_equal_all_pairs(spark, options):
    r = random.Random(3)
    rows = []
    # Few letters, so that many words are anagrams and many are near.
    for i in range(40):
        stem = "".join(r.choice("abcdé") for _ in range(r.randrange(7, 12)))
        listed = [stem] * 30 + [variants(stem, r) for _ in range(6)]
        rows.append((i, " ".join(listed) + " " + " ".join(variants(x, r) for x in listed)))
        rows.append((100 + i, " ".join(variants(x, r).upper() for x in listed)))
    assert forms_of(spark, rows, **options) == brute.spelling(rows)


def test_anagrams_are_split_by_their_beginnings():
    words = ["".join(p) for p in product("ab", repeat=12) if p.count("a") == 6]
    vectors = spelling.Vectors.of(spelling.letters_of(words, 12))
    seen = []
    spelling.search(vectors, spelling.Queries.all(vectors), True, lambda a, b: seen.append(len(a)))
    assert not seen  # one replaced letter changes the counts
    longer = spelling.Vectors.of(spelling.letters_of([w[:5] + "c" + w[5:] for w in words], 13))
    pairs = set()
    spelling.search(longer, spelling.Queries.all(vectors), False, lambda a, b: pairs.update(zip(a.tolist(), b.tolist())))
    assert pairs == {(i, i) for i in range(len(words))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcé", min_size=3, max_size=5), min_size=1, max_size=60, unique=True))
def test_search_finds_every_near_word(words):
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    found = set()
    for length, stored in by_length.items():
        vectors = spelling.Vectors.of(spelling.letters_of(stored, length))
        for own, equal in ((length, True), (length - 1, False)):
            asking = by_length.get(own, [])
            if asking:
                queries = spelling.Queries.all(spelling.Vectors.of(spelling.letters_of(asking, own)))
                spelling.search(vectors, queries, equal, lambda a, b: found.update(
                    frozenset((asking[i], stored[j])) for i, j in zip(a.tolist(), b.tolist())))
    assert found == {frozenset((a, b)) for a in words for b in words if brute.one_edit(a, b)}


def test_chains_of_forms_lead_to_one_root(spark):
    words = ["xmnopqrstuv", "amnopqrstuv", "abnopqrstuv", "abcopqrstuv", "abcdpqrstuv"]
    text = " ".join(w for i, w in enumerate(words) for _ in range(2 * 10**i))
    rows = [(i, text) for i in range(3) if not any(zlib.crc32(f"{i}:{w}".encode()) % 31 == 0 for w in words)]
    found = forms_of(spark, rows)
    assert [found[w][0] for w in words] == [*words[1:], None]
    assert {found[w][1] for w in words} == {words[-1]}


def test_odd_words(spark):
    long = "ab" * 5000
    rows = [(None, None), (1, ""), (2, "Ünïçödé ünïçödé ÜNÏÇÖDÉ"), (None, "letters letters"), (3, f"{long} {long} {long}c {long}c"),
            (4, "naïveté漢字naïveté naïveté"), (4, "naïveté"), (5, "x1234567 abcdefg7abcdefg")]
    assert forms_of(spark, rows) == brute.spelling(rows)
    assert forms_of(spark, []) == {}


# Collocations.


def phrases_of(df, **options):
    return sorted(tuple(r) for r in collocations.find_collocations(df, **options).collect())


def planted(spark, seed=1, langs=("en", None, "de")):
    r = random.Random(seed)
    rows = []
    for i in range(60):
        words = [r.choice("the of and to in is it on as at by".split()) for _ in range(120)]
        for phrase in ("New York City", "hot dog", "as well as", "rare pair"):
            if r.random() < 0.6:
                words[r.randrange(100)] = phrase
        rows.append((r.choice(langs), " ".join(w + r.choice(["", "", "", ".", ", ", "\t", "\n", " !"]) for w in words)))
    return rows, spark.createDataFrame(rows, "lang string, text string")


@pytest.mark.parametrize("levels", [collocations.LEVELS, (0,), (900_000, 400_000, 90_000, 7_000, 0)])
@pytest.mark.parametrize("wanted", [5, 40, 2000])
def test_collocations_equal_full_count(spark, levels, wanted):
    rows, df = planted(spark)
    expected = brute.collocations(rows, wanted)
    assert phrases_of(df, levels=levels, wanted=wanted) == expected
    assert {x[2] for x in expected if x[0] == "en"} & {"hot dog", "new york city"}


def test_shared_cells_only_widen_bounds(spark, monkeypatch):
    rows, df = planted(spark, 2)
    monkeypatch.setattr(collocations, "CELLS", 8)
    monkeypatch.setattr(collocations, "FILTER_BITS", 64)
    monkeypatch.setattr(collocations, "SLAB", 8)
    assert phrases_of(df, wanted=30) == brute.collocations(rows, 30)


def test_long_texts_are_cut_between_pieces(monkeypatch):
    import pyarrow as pa

    texts = ["a b. c d e\nf  g", None, "", "h", "i\tj " * 5, "k. l" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y", "x", "x", "y", "x"]), pa.array(texts)], ["lang", "text"])

    def read():
        out = []
        for words in collocations._chunks([batch]):
            listed = [words.words[i].as_py() for i in words.word.tolist()]
            langs = [words.langs[i].as_py() for i in words.lang.tolist()]
            out += zip(langs, listed, [*words.joined.tolist(), False])
        return out

    whole = read()
    for size in (1, 3, 7, 20):
        monkeypatch.setattr(collocations, "CHUNK_BYTES", size)
        assert read() == whole


def test_splitting_a_chunk_takes_little_memory_beside_its_words():
    import pyarrow as pa

    data = np.frombuffer(b"x" * (1 << 20) + b" Y. z", np.uint8)
    tracemalloc.start()
    words = collocations._words(pa.array(["en"]), data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert words.words.to_pylist()[1:] == ["y", "z"] and words.joined.tolist() == [True, False]
    assert peak < 14 * len(data)


def test_scores_beyond_64_bits(spark):
    row = [(3_000_000_000, 3_000_000_001, 3_000_000_007)]
    n, left, right = row[0]
    score = spark.createDataFrame(row, "n bigint, l bigint, r bigint").select(collocations._cut_score("l", "r")).first()[0]
    assert score == 1_000_000 * n * n // (left * right)


def test_odd_collocations(spark):
    odd = spark.createDataFrame([(i, t, l) for i, t, l in ROWS], SCHEMA).withColumns(
        {c: F.lit(c) for c in ("n", "w1", "w2", "phrase", "rank", "score", "total", "l")}
    )
    expected = brute.collocations([(l, t) for _, t, l in ROWS])
    assert phrases_of(odd) == expected and expected
    assert phrases_of(odd.limit(0)) == []
    with pytest.raises(ValueError):
        collocations.find_collocations(odd, levels=(10, 20, 0))


# Fingerprints.


def test_fingerprints_equal_all_pairs(spark):
    r = random.Random(5)
    texts = [None, "", " \n", "one", "one two", "One TWO", "é漢 😀 \x00"]
    for i in range(30):
        text = prose(i, r.randrange(3, 200))
        texts += [text, text.upper(), text + " more", text.replace("the", "teh", 1)]
    expected = brute.fingerprints(list(enumerate(texts)))
    for most_classes in (256, 1):
        found = simhash.find_groups(table(spark, texts), most_classes=most_classes).collect()
        assert {r.doc_id: (r.fingerprint % (1 << 64), r.component_id) for r in found} == expected
    assert sum(i != c for i, (_, c) in expected.items()) > 30


@pytest.mark.parametrize("most_classes", [1, 4, 256])
def test_crowded_places_lose_no_link(spark, most_classes):
    r = random.Random(7)
    values = set()
    # Families within few bits of each other, so that places hold many classes.
    for _ in range(4):
        base = r.getrandbits(64)
        for _ in range(120):
            values.add(base ^ sum(1 << r.randrange(64) for _ in range(r.randrange(4))) % (1 << 64))
    values = sorted(values)
    classes = spark.createDataFrame([(v - (v >> 63 << 64),) for v in values], "fingerprint bigint")
    links = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.link_fingerprints(classes, 2, most_classes).collect()]
    assert all(0 < (a ^ b).bit_count() <= 2 for a, b in links)
    pairs = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 2]
    assert brute.lowest(values, links) == brute.lowest(values, pairs)


def test_zero_fingerprints_link(spark):
    found = simhash.find_groups(table(spark, [None, "", "a b c d"])).collect()
    zero = [r.component_id for r in found if r.doc_id < 2]
    assert zero == [0, 0]


def test_odd_fingerprints(spark):
    odd = spark.createDataFrame(ROWS, SCHEMA).withColumns(
        {c: F.lit(c) for c in ("fingerprint", "id", "open", "low", "component", "component_id", "node", "n", "place0")}
    )
    found = simhash.find_groups(odd).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _, _ in ROWS)
    assert simhash.find_groups(odd.limit(0)).count() == 0
    assert next(r.component_id for r in found if r.doc_id == 9) == 5


def test_bits_of_a_long_text(monkeypatch):
    text = prose(1, 3000)
    whole = simhash.fingerprint_of(simhash.shingle_hashes(text))
    monkeypatch.setattr(simhash, "STEP", 7)
    assert simhash.fingerprint_of(simhash.shingle_hashes(text)) == whole
    assert simhash.fingerprint_of(np.array([3, 1], np.uint64)) == 1


def test_many_distinct_words_are_counted(monkeypatch):
    import pyarrow as pa

    r = random.Random(11)
    texts = [" ".join(r.choice("abcdef") for _ in range(50)) for _ in range(6)]
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y"] * 3), pa.array(texts)], ["lang", "text"])
    (words,) = collocations._chunks([batch])
    at = np.flatnonzero(words.joined[:-1] & words.joined[1:])
    plain = collocations._counted(words, at, 3).to_pylist()
    expected = Counter(
        (lang, *ws[i : i + 3]) for lang, t in zip(["x", "y"] * 3, texts) for ws in [t.split()] for i in range(48)
    )
    assert Counter({(p["lang"], p["w1"], p["w2"], p["w3"]): p["n"] for p in plain}) == expected
    # A dictionary too large for one number per phrase.
    padded = pa.concat_arrays([words.words, pa.array([f"w{i}" for i in range(3_000_000)], pa.large_string())])
    wide = collocations.Words(words.langs, padded, words.lang, words.word, words.joined)
    again = collocations._counted(wide, at, 3).to_pylist()
    assert sorted(map(repr, again)) == sorted(map(repr, plain))
