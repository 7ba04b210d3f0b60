"""Personal data in whole texts: anchors found in one pass, expanded by local parsers.

An Aho-Corasick automaton reports every at-sign, scheme, plus sign, digit run and identifier cue. At
each anchor a deterministic parser walks outwards to the boundaries of the address or number and
validates it (domain labels, parts up to 255, Luhn, IBAN check digits, digit counts). A parser
never starts inside what it has already consumed, so the result equals a left-to-right scan.

Base kinds: ``email ip card phone``. Added kinds: ``login`` (user part of a URL), ``iban`` (with
valid check digits), ``ssn`` and ``account`` (only behind a cue that names them; an ``ssn`` at most 24
characters behind it, on the same line and with no digit between, since a cue names what it stands by).

Defined results: a null or empty text has no spans; each text is judged on its own; spans are
ordered by kind, then start; texts are scanned whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.spans import Span, joined, masked, sha256_hex

# The base kinds, in their order.
BASE_KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# End of the fixed values.

KINDS = (*BASE_KINDS, "login", "iban", "ssn", "account")
MARK = "[PRIVATE]"
# ASCII letters only, so that places stay the same.

_DIGITS = re.compile(r"[0-9]")
_LOGIN = re.compile(r"[A-Za-z0-9._~%!$&'*+;=-]+(?::[^\s@/]*)?(?=@[A-Za-z0-9\[])")
_IBAN = re.compile(r"[\x20:#.]*([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(r"[^0-9\n]{0,24}?([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"\x20*(?:number|no\.?|nr\.?|#)?[\x20:#=]*([0-9][0-9\x20-]{4,24}[0-9])(?![0-9])", re.I)
# Cue words and the parser each leads to, found without regard to ASCII case.
CUES = {"iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "account", "konto": "account"}


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for digit in "0123456789":
        automaton.add_word(digit, ("digit", 1))
        automaton.add_word(f"+{digit}", ("plus", 2))
    automaton.add_word("@", ("at", 1))
    automaton.add_word("://", ("scheme", 3))
    for cue, kind in CUES.items():
        automaton.add_word(cue, (kind, len(cue)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[::-2]) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def iban_valid(code: str) -> bool:
    code = code.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _ascii_lower(text: str) -> str:
    """A-Z in lower case, all else as it is and where it is; bytes do that without a look at each character."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def _small(part: str) -> bool:
    return len(part := part.lstrip("0")) <= 3 and int(part or "0") <= 255


def find_personal_data(text: str | None) -> list[Span]:
    """All spans of a text, by kind as listed and then start."""
    text = text or ""
    spans: list[Span] = []
    # Where each kind of scan may go on: the end of what it last consumed.
    done = {"email": 0, "ip": 0, "card": 0}
    for last, (anchor, length) in _anchors().iter(_ascii_lower(text)):
        at = last - length + 1
        if anchor == "digit":
            if at >= done["card"]:
                if m := _CARD.match(text, at):
                    done["card"] = m.end()
                    number = "".join(_DIGITS.findall(m[0])) if m.end() - at >= 16 else ""
                    if 16 <= len(number) <= 19 and luhn(number):
                        spans.append(("card", *m.span()))
            if at >= done["ip"]:
                if m := _IP.match(text, at):
                    done["ip"] = m.end()
                    if all(map(_small, m[0].split("."))):
                        spans.append(("ip", *m.span()))
                else:
                    # The rest of this digit run has the same tail and fails as well.
                    end = at + 1
                    while end < len(text) and "0" <= text[end] <= "9":
                        end += 1
                    done["ip"] = end
        elif anchor == "at":
            start = at
            while start > done["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                spans.append(("email", start, m.end()))
                done["email"] = m.end()
        elif anchor == "plus":
            if m := _PHONE.match(text, at):
                if 8 <= len(_DIGITS.findall(m[0])) <= 15:
                    spans.append(("phone", *m.span()))
        elif anchor == "scheme":
            if m := _LOGIN.match(text, at + 3):
                spans.append(("login", *m.span()))
        elif anchor == "iban":
            if (m := _IBAN.match(text, last + 1)) and (end := _iban_end(text, m)):
                spans.append(("iban", m.start(1), end))
        elif anchor == "ssn":
            if m := _SSN.match(text, last + 1):
                spans.append(("ssn", *m.span(1)))
        elif m := _ACCOUNT.match(text, last + 1):
            if 6 <= len(_DIGITS.findall(m[1])) <= 17:
                spans.append(("account", *m.span(1)))
    return sorted(set(spans), key=lambda x: (KINDS.index(x[0]), x[1]))


def _iban_end(text: str, m: re.Match) -> int:
    """End of the longest prefix with valid check digits that ends at a word boundary, or 0."""
    for end in range(m.end(1), m.start(1) + 14, -1):
        if not text[end : end + 1].isalnum() and iban_valid(text[m.start(1) : end].rstrip()):
            return end
    return 0


_RESULT = "struct<" + "".join(f"n_{k}:bigint," for k in KINDS) + "base_sha256:string,spans:string>"
_NOTHING = (*[0] * len(KINDS), sha256_hex(""), "")


def _scan(texts: pa.Array) -> pa.Array:
    rows = []
    for value in texts:
        spans = find_personal_data(value.as_py())
        if not spans:
            rows.append(_NOTHING)
            continue
        counts = Counter(kind for kind, _, _ in spans)
        base = [x for x in spans if x[0] in BASE_KINDS]
        rows.append((*(counts[k] for k in KINDS), sha256_hex(joined(base)), joined(spans)))
    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
    return pa.StructArray.from_arrays(columns, names)


def _redact(texts: pa.Array) -> pa.Array:
    out = []
    for value in texts:
        text = value.as_py()
        spans = find_personal_data(text)
        out.append(masked(text, spans, MARK) if spans else text)
    return pa.array(out, pa.string())


def scan(text: Column) -> Column:
    """Struct of counts per kind, base hash and spans of a text column."""
    return F.arrow_udf(_scan, _RESULT)(text)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all personal data of ``text`` replaced by a mark."""
    return docs.withColumn(text, F.arrow_udf(_redact, "string")(F.col(text)))
