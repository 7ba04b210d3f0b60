"""Licence notices in whole texts: exact phrases, and short notices with a bounded number of edits.

A notice that may differ in ``k`` characters is split into ``k + 1`` pieces; by the pigeonhole
principle every occurrence contains one of them unchanged. One Aho-Corasick pass finds the pieces,
and around each hit the regex library verifies the notice with at most ``k`` errors, from the
beginning of a word to the end of one (letters in front of its first one are not tried), and reports where it stands. Texts are compared as
lower-cased words joined by single blanks.

Defined results: a null or empty text has no words, no places and score 0; each text is judged on
its own; equal labels count once; texts are scanned whole; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases that are always found exactly, and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
# End of the fixed values.

# Short notices found with errors. Wording as in the licences' own headers, normalised.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("released under the mit license", "mit"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("licensed under the gnu general public license version", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("dedicated to the public domain", "public-domain"),
    ("spdx license identifier", "spdx"),
)
# One error for so many characters of a notice.
CHARS_PER_ERROR = 10

_BLANKED = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


class Found(NamedTuple):
    label: str
    start: int  # words from 0, end exclusive
    end: int
    errors: int
    score: float


class _Notice(NamedTuple):
    text: str
    label: str
    errors: int
    pattern: regex.Pattern


def allowed_errors(notice: str) -> int:
    return len(notice) // CHARS_PER_ERROR


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces of near-equal length, with their offsets."""
    cuts = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def _seeds() -> tuple[ahocorasick.Automaton, list[_Notice]]:
    notices, seeds = [], {}
    for i, (text, label) in enumerate(NOTICES):
        errors = allowed_errors(text)
        exact = regex.escape(text, literal_spaces=True)
        pattern = regex.compile(f"(?b)(?<![^ ])(?:{exact}){{e<={errors}}}(?![^ ])")
        notices.append(_Notice(text, label, errors, pattern))
        for offset, piece in pieces(text, errors):
            seeds.setdefault(piece, []).append((i, offset))
    automaton = ahocorasick.Automaton()
    for piece, uses in seeds.items():
        automaton.add_word(piece, (len(piece), uses))
    automaton.make_automaton()
    return automaton, notices


def normalise(text: str | None) -> str:
    """Lower-cased words joined by blanks, one character per byte so that offsets are cheap."""
    return b" ".join((text or "").encode().translate(_BLANKED).split()).decode("latin-1")


def phrase_places(words: str, phrase: str) -> list[int]:
    """Word positions where the words of ``phrase`` stand one after another."""
    found, at = [], words.find(phrase)
    while at >= 0:
        end = at + len(phrase)
        if (at == 0 or words[at - 1] == " ") and (end == len(words) or words[end] == " "):
            found.append(at)
        at = words.find(phrase, at + 1)
    positions, count, last = [], 0, 0
    for at in found:
        count += words.count(" ", last, at)
        last = at
        positions.append(count)
    return positions


def _best_apart(matches: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of overlapping (errors, start, end) the one with fewest errors, the leftmost of equal ones."""
    kept: list[tuple[int, int, int]] = []  # by start
    for errors, start, end in sorted(matches):
        at = bisect_left(kept, (start, end, errors))
        if (at == 0 or kept[at - 1][1] <= start) and (at == len(kept) or end <= kept[at][0]):
            kept.insert(at, (start, end, errors))
    return kept


def find_notices(words: str) -> list[Found]:
    """Notices within their error bound, leftmost first; of overlapping finds of one the best stays.

    Every seed is verified in a window of its own, as long as its notice and twice its errors, so
    the work grows with the seeds of a text, however they lie.
    """
    automaton, notices = _seeds()
    # Where a notice would begin without errors, as its seeds say.
    begins: dict[int, set[int]] = {}
    for last, (length, uses) in automaton.iter(words):
        for i, offset in uses:
            begins.setdefault(i, set()).add(last - length + 1 - offset)
    if not begins:
        return []
    blanks = np.flatnonzero(np.frombuffer(words.encode("latin-1"), np.uint8) == 0x20)
    found = []
    for i, starts in begins.items():
        notice = notices[i]
        matches = set()
        for at in starts:
            stop = at + len(notice.text) + notice.errors + 1
            m = notice.pattern.search(words, max(at - notice.errors, 0), min(stop, len(words)))
            # The window may end inside a word, which the pattern cannot see.
            if m and (m.end() == len(words) or words[m.end()] == " "):
                matches.add((sum(m.fuzzy_counts), m.start(), m.end()))
        for start, end, errors in _best_apart(matches):
            text = words[start:end]
            start += len(text) - len(text.lstrip())
            first = int(np.searchsorted(blanks, start))
            until = int(np.searchsorted(blanks, start + len(text.strip()))) + 1
            found.append(Found(notice.label, first, until, errors, 1 - errors / len(notice.text)))
    return sorted(found, key=lambda f: (f.start, f.errors, f.label))


_RESULT = (
    "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,"
    "labels:string,score:double,notices:string>"
)
_TYPES = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
_NAMES = (
    "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices",
)


def scan_text(text: str | None) -> tuple:
    """The result columns of one text; ``notices`` lists label:start:end:errors, in words."""
    words = normalise(text)
    n_words = words.count(" ") + 1 if words else 0
    places, base = [], set()
    for phrase, label in PHRASES:
        if at := phrase_places(words, phrase):
            places += at
            base.add(label)
    found = find_notices(words)
    labels = base | {f.label for f in found}
    score = 1.0 if places else max((f.score for f in found), default=0.0)
    return (
        n_words, len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), score,
        ",".join(f"{f.label}:{f.start}:{f.end}:{f.errors}" for f in found),
    )


def _scan(texts: pa.Array) -> pa.Array:
    rows = [scan_text(value.as_py()) for value in texts]
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)]
    return pa.StructArray.from_arrays(columns, _NAMES)


def scan(text: Column) -> Column:
    """Struct of places, labels, score and verified notices of a text column."""
    return F.arrow_udf(_scan, _RESULT)(text)


def license_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with the columns of ``scan``."""
    return docs.select(F.col(key), scan(F.col(text)).alias("found")).select(key, "found.*")
