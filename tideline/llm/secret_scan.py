"""Secrets in whole texts: an assignment-aware lexer over source, configuration and prose.

``assignments`` reads name-literal pairs and references from name to name; its docstring lists the
syntax. Literals are propagated through the references (``key = "..."``, later ``password = key`` or
``f"{key}"``), and a literal is reported when one of the names it reaches is a sensitive one and the
literal looks like a credential: the score adds the weight of the name to the literal's entropy per
character, and a quoted literal of words counts as a passphrase if few of them are words that prompts
and sentences are made of.

Besides these, three base kinds are always reported: ``assign``, ``access`` and ``hex``.

Defined results: a null or empty text has no spans; each text is judged on its own, so repeated
rows get equal results; ties between spans are ordered by start, then kind; texts are scanned
whole, at whatever length; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.assignments import lex_assignments
from tideline.llm.spans import Span, joined, masked, sha256_hex
from tideline.llm.text import free_name, text_slices

# The base kinds, in their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "literal")
# End of the fixed values.

MARK = "[SECRET]"

# Weight of the words a sensitive name is made of.
NAME_WEIGHTS = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "secret": 3.0, "token": 2.5,
    "apikey": 3.0, "credential": 2.5, "credentials": 2.5, "privatekey": 3.0, "accesskey": 3.0,
    "secretkey": 3.0, "authorization": 2.0, "auth": 1.5, "bearer": 2.0,
}
# Neighbouring words of a name that together are one of the above.
NAME_PAIRS = {("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key")}
MIN_LITERAL = 8
MIN_SCORE = 5.0

_SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_SENSITIVE = re.compile(
    "pass|pwd|secret|token|apikey|api[_-]key|credential|key|auth|bearer", re.IGNORECASE
)


def name_weight(name: str) -> float:
    """How sensitive an identifier is: the largest weight among its words and word pairs."""
    words = [w.lower() for w in _SPLIT.findall(name)]
    found = [NAME_WEIGHTS.get(w, 0.0) for w in words]
    found += [3.0 for pair in zip(words, words[1:]) if pair in NAME_PAIRS]
    return max(found, default=0.0)


def entropy(literal: str) -> float:
    """Bits per character."""
    n = len(literal)
    return -sum(c / n * math.log2(c / n) for c in Counter(literal).values()) if n else 0.0


# Words of prompts, messages and sentences; a passphrase has few of them.
COMMON_WORDS = frozenset(
    "a an and any are as at be been but by can do for from has have here if in is it its may more must my new no "
    "not of on or our please should that the their then there this to too was we when which will with you your "
    "account change character characters confirm correct default digits does enter error expired failed field "
    "forgot forgotten hint incorrect invalid key length letters login match missing name number optional "
    "password required reset secret see set short strong token type used user username valid value weak wrong".split()
)
_WORD = re.compile(r"[A-Za-z]+")


def like_credential(value: str, quoted: bool) -> bool:
    """Whether a value reads as something to be kept, not as a word, a number of words or a prompt."""
    if len(value) < MIN_LITERAL:
        return False
    words = _WORD.findall(value)
    if any(c.isspace() for c in value):
        # Passphrases are quoted, of four words or more, and hardly any of a prompt's words.
        if not quoted or len(words) < 4 or len(" ".join(words)) < 0.9 * len(value):
            return False
        common = sum(w.lower() in COMMON_WORDS for w in words)
        return common <= len(words) // 4 and len({w.lower() for w in words}) == len(words)
    if any(c.isdigit() for c in value):
        return True
    # Letters alone: signs between them or cases that change oftener than in a name.
    turns = sum(a.islower() and b.isupper() for a, b in zip(value, value[1:]))
    signs = sum(not c.isalnum() and c not in "_-./:" for c in value)
    known = any(w.lower() in COMMON_WORDS for part in words for w in _SPLIT.findall(part))
    return quoted and not known and (signs >= 1 or 3 * turns >= len(words) + 3)


def _reached(pairs, references) -> dict[str, float]:
    """Weight of every name: its own, or that of the most sensitive name its value is passed to."""
    names = [pair.name for pair in pairs] + [name for both in references for name in both]
    weight = {name: name_weight(name) for name in names}
    used_by: dict[str, set[str]] = {}
    for user, used in references:
        used_by.setdefault(user, set()).add(used)
    queue = list(weight)
    while queue:
        user = queue.pop()
        for used in used_by.get(user, ()):
            if weight[user] > weight[used]:
                weight[used] = weight[user]
                queue.append(used)
    return weight


def literal_spans(text: str) -> list[Span]:
    """Literals that reach a sensitive name and look like credentials."""
    if not _SENSITIVE.search(text):
        return []
    pairs, references = lex_assignments(text)
    weights = _reached(pairs, references)
    spans = set()
    for pair in pairs:
        weight = weights[pair.name]
        value = "".join(text[s:e] for s, e in pair.spans)
        if weight and like_credential(value, pair.quoted) and weight + entropy(value) >= MIN_SCORE:
            spans |= {("literal", s, e) for s, e in pair.spans if e > s}
    return sorted(spans, key=lambda x: (x[1], x[2]))


def base_spans(text: str) -> list[Span]:
    """The base kinds, by start and then in their order."""
    lower = text.lower()
    spans: list[Span] = []
    if any(word in lower for word in ASSIGN_WORDS):
        spans += [
            ("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED
        ]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def find_secrets(text: str | None) -> list[Span]:
    """All spans of a text, by start and then kind; literals a base span covers are not repeated."""
    text = text or ""
    base = base_spans(text)
    covered = [(s, e) for _, s, e in base]
    added = [x for x in literal_spans(text) if not any(s <= x[1] and x[2] <= e for s, e in covered)]
    return sorted(base + added, key=lambda x: (x[1], KINDS.index(x[0])))


_RESULT = (
    "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,n_literal:bigint,"
    "base_sha256:string,spans:string>"
)
_NOTHING = (0, 0, 0, 0, sha256_hex(""), "")


def _scan(texts: pa.Array) -> pa.Array:
    rows = []
    for value in texts:
        spans = find_secrets(value.as_py())
        if not spans:
            rows.append(_NOTHING)
            continue
        counts = Counter(kind for kind, _, _ in spans)
        base = [x for x in spans if x[0] != "literal"]
        rows.append((*(counts[k] for k in KINDS), sha256_hex(joined(base)), joined(spans)))
    names = ("n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans")
    types = [pa.int64()] * 4 + [pa.string()] * 2
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
    return pa.StructArray.from_arrays(columns, names)


def _redact(texts: pa.Array) -> pa.Array:
    def clean(text: str | None) -> str | None:
        spans = find_secrets(text)
        return masked(text, spans, MARK) if spans else text

    parts = [pa.array([clean(t) for t in part], pa.string()) for part in text_slices(texts)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def scan(text: Column) -> Column:
    """Struct of counts, base hash and spans of a text column."""
    return F.arrow_udf(_scan, _RESULT)(text)


def redact(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with every secret of ``text`` replaced by a mark; other texts stay as they are.

    The column ``length``, if named, is set to the new number of characters of changed texts.
    """
    clean = free_name(docs, "clean_text")
    out = docs.withColumn(clean, F.arrow_udf(_redact, "string")(F.col(text)))
    if length is not None:
        same = F.col(clean).eqNullSafe(F.col(text))
        changed = F.length(clean).cast(docs.schema[length].dataType)
        out = out.withColumn(length, F.when(same, F.col(length)).otherwise(changed))
    return out.withColumn(text, F.col(clean)).drop(clean)
