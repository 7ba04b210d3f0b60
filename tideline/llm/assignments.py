"""Name-literal pairs of source and configuration syntax, without knowing the language.

Read as assignments, from the operator outwards:

- ``name = value`` with ``=``, ``:=``, ``=>``, ``<-``, ``:``, ``?=``, ``+=``, ``==`` and the like; names
  bare, quoted, dotted, dashed (``--db-password=x``) or in a subscript (``environ["NAME"] = x``), of any
  length; behind a type (``String name = x``), before one (``name: str = x``, ``var name string = x``);
- several names at once (``a, b = x, y``);
- calls that carry a value (``setName("x")``) or a name and a value (``put("name", "x")``);
- tags (``<name>x</name>``) and attributes (``<add key="name" value="x"/>``);
- indented blocks behind ``name: |`` and ``name: >``.

Values are quoted literals, with prefixes (``rb"x"``), of triple quotes or back quotes; names; chains of
both joined by ``+``, ``..``, ``.`` or by standing side by side; such values inside parentheses or as
the longest argument of a call (``decode("x")``); else bare words. A name inside a literal (``f"{name}"``,
``"${name}"``, ``"#{name}"``) is a reference like a name in a chain.
"""

from __future__ import annotations

import re
from typing import NamedTuple

Span = tuple[int, int]


class Value(NamedTuple):
    spans: list[Span]  # of the literals, without quotes
    names: list[str]  # that the value refers to
    end: int
    quoted: bool = True


_OPERATOR = re.compile(r"<-(?![-<])|(?<![!<>=~])[:?+|&]{0,2}={1,3}>?|(?<!:):(?![:=])")
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.\-]*+")
_BLANKS = re.compile(r"[\x20\t]*+")
_WHITE = re.compile(r"\s*+")
_QUOTED = re.compile(
    r"""(?P<prefix>(?:[rbuRBU]{0,2}[fF]?[rR]?|[@$]{1,2})(?=["']))?"""
    r'''(?:"""(?P<a>(?:[^"\\]|\\.|"(?!""))*+)"""|\'\'\'(?P<b>(?:[^'\\]|\\.|'(?!''))*+)\'\'\''''
    r"""|"(?P<c>(?:[^"\\\n]|\\.)*+)"|'(?P<d>(?:[^'\\\n]|\\.)*+)'|`(?P<e>[^`]*+)`)""",
    re.DOTALL,
)
_REFERENCE = re.compile(r"\$\{(?:env[.:])?(\w++)\}|\$(\w++)|([A-Za-z_][A-Za-z0-9_.]*+)(?![/=@\-])")
_HOLE = re.compile(r"[$#]\{(?:env[.:])?(\w++)\}|\{(\w++)(?:![rsa])?\}|\$(\w++)")
_JOIN = re.compile(r"[\x20\t]*+(?:\+|\.\.|&)[\x20\t]*+(?!=)|[\x20\t]++\.[\x20\t]++")
# A bare word ends before another assignment; signs of padding belong to it.
_BARE = re.compile(r"[A-Za-z0-9+/_.~!@#%^*\-]++={0,2}")
_BLOCK = re.compile(r"[\x20\t]*+[|>][+\-0-9]*+[\x20\t]*+\r?\n")
_INDENTED = re.compile(r"(?:[\x20\t]++([^\n]*+)|[\x20\t]*+\r?)(?:\n|\Z)")
_OPEN = re.compile(r"\([\x20\t\r\n]*+(?=(?:[rbuRBUfF@$]{0,3})[\"'`])")
_TAG = re.compile(r"<([A-Za-z_][A-Za-z0-9_.:\-]*+)([^<>]*+)>(?:([^<>]*+)</)?")
_ATTRIBUTE = re.compile(r"([A-Za-z_][A-Za-z0-9_.:\-]*+)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)')")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.\-]*+\Z")


def _back_over(text: str, at: int, blanks: str = " \t") -> int:
    while at and text[at - 1] in blanks:
        at -= 1
    return at


def _name_before(text: str, end: int) -> tuple[str, int] | None:
    """The name that ends at ``end``, bare, quoted or in a quoted subscript, and where it begins."""
    at = end
    if at and text[at - 1] == "]":
        at = _back_over(text, at - 1)
        if not at or text[at - 1] not in "\"'":
            return None
    quote = text[at - 1] if at and text[at - 1] in "\"'`" else ""
    stop = at - len(quote)
    start = stop
    while start and text[start - 1] in _NAME_CHARS:
        start -= 1
    if quote and (start == 0 or text[start - 1] != quote):
        return None
    # Dashes of an option and digits in front are not part of a name.
    first = start
    while first < stop and not (text[first].isalpha() or text[first] == "_"):
        first += 1
    return (text[first:stop], start - len(quote)) if first < stop else None


def _names_before(text: str, operator: int) -> list[str]:
    """Names that an operator assigns to, the nearest last."""
    found = _name_before(text, _back_over(text, operator))
    if not found:
        return []
    names, at = [found[0]], _back_over(text, found[1])
    if at and text[at - 1] == ":":
        # A type behind a colon: the name stands before it.
        typed = _name_before(text, _back_over(text, at - 1))
        return [*names, typed[0]] if typed else names
    if at < found[1] and at and text[at - 1] in _NAME_CHARS:
        # ``var name type =``: the word before the name tells.
        middle = _name_before(text, at)
        keyword = middle and _name_before(text, _back_over(text, middle[1]))
        if keyword and keyword[0] == "var":
            return [*names, middle[0]]
    while at and text[at - 1] == ",":
        before = _name_before(text, _back_over(text, at - 1))
        if not before:
            break
        names.insert(0, before[0])
        at = _back_over(text, before[1])
    return names


def _literal(m: re.Match) -> tuple[list[Span], list[str]]:
    """Parts of a quoted literal between its references, and these."""
    group = next(g for g in "abcde" if m[g] is not None)
    start, end = m.span(group)
    plain = (m["prefix"] or "").lower()
    spans, names = [], []
    if "{" in m[0] or "$" in m[0]:
        for hole in _HOLE.finditer(m.string, start, end):
            if hole[2] and "f" not in plain and "$" not in plain:
                continue
            names.append(hole[1] or hole[2] or hole[3])
            spans.append((start, hole.start()))
            start = hole.end()
    spans.append((start, end))
    # Blanks around a literal of several lines are layout.
    text = m.string
    trimmed = []
    for a, b in spans:
        part = text[a:b]
        a += len(part) - len(part.lstrip())
        trimmed.append((a, a + len(part.strip())))
    return [s for s in trimmed if s[0] < s[1]], names


def read_value(text: str, at: int, depth: int = 0) -> Value | None:
    """The expression that begins at ``at``; inside parentheses it may go on over lines."""
    space = _WHITE if depth else _BLANKS
    spans, names, end, quoted = [], [], at, False
    while True:
        at = space.match(text, at).end()
        if m := _QUOTED.match(text, at):
            own, used = _literal(m)
            spans += own
            names += used
            end, quoted = m.end(), True
        elif depth < 3 and text[at : at + 1] == "(":
            inner = read_value(text, at + 1, depth + 1)
            if not inner:
                break
            spans, names, quoted = spans + inner.spans, names + inner.names, quoted or inner.quoted
            end = _closed(text, inner.end)
        elif m := _REFERENCE.match(text, at):
            end = m.end()
            if depth < 3 and text[end : end + 1] == "(":
                # What a call makes of its longest literal argument is its value, as far as can be told.
                longest: list[Span] = []
                inner = read_value(text, end + 1, depth + 1)
                while inner:
                    longest = max(longest, inner.spans, key=lambda spans: sum(b - a for a, b in spans))
                    names, quoted = names + inner.names, quoted or inner.quoted
                    end = inner.end
                    comma = _WHITE.match(text, end).end()
                    inner = read_value(text, comma + 1, depth + 1) if text[comma : comma + 1] == "," else None
                spans += longest
                end = _closed(text, end)
            else:
                names.append(m[1] or m[2] or m[3])
        else:
            break
        joined = _JOIN.match(text, end)
        if joined:
            at = joined.end()
            continue
        # Literals side by side are one.
        following = space.match(text, end).end()
        if quoted and _QUOTED.match(text, following) and text[following] != "`":
            at = following
            continue
        break
    return Value(spans, names, end, quoted) if spans or names or quoted else None


def _closed(text: str, at: int) -> int:
    after = _WHITE.match(text, at).end()
    return after + 1 if text[after : after + 1] == ")" else at


def _block(text: str, at: int) -> tuple[list[Span], int] | None:
    """Lines of an indented block scalar that begins behind a colon, and its end."""
    if not (m := _BLOCK.match(text, at)):
        return None
    spans, at = [], m.end()
    while at < len(text) and (m := _INDENTED.match(text, at)):
        if m[1]:
            spans.append((m.start(1), m.start(1) + len(m[1].rstrip())))
        at = m.end()
    return spans, at


class Pair(NamedTuple):
    name: str
    spans: list[Span]
    quoted: bool


def lex_assignments(text: str) -> tuple[list[Pair], list[tuple[str, str]]]:
    """Name-literal pairs and name-name references of a text."""
    pairs: list[Pair] = []
    references: list[tuple[str, str]] = []

    def give(name: str, value: Value) -> None:
        references.extend((name, used) for used in value.names)
        if value.spans:
            pairs.append(Pair(name, value.spans, value.quoted))

    block_end = 0
    for m in _OPERATOR.finditer(text):
        # The lines of a block are its value; they are not read as assignments.
        names = _names_before(text, m.start()) if m.start() >= block_end else []
        if not names:
            continue
        at = m.end()
        if m[0] == ":" and (block := _block(text, at)):
            lines, block_end = block
            if lines:
                pairs.append(Pair(names[-1], lines, True))
            continue
        value = read_value(text, at)
        if value:
            for name in {names[-1], *(names[:1] if len(names) == 2 else ())}:
                give(name, value)
        if (not value or not value.quoted) and (bare := _BARE.match(text, _BLANKS.match(text, at).end())):
            pairs.append(Pair(names[-1], [bare.span()], False))
        if len(names) > 1 and value:
            values = [value]
            while len(values) < len(names):
                comma = _BLANKS.match(text, values[-1].end).end()
                if text[comma : comma + 1] != "," or not (following := read_value(text, comma + 1)):
                    break
                values.append(following)
            if len(values) == len(names):
                for name, own in zip(names, values):
                    give(name, own)
    if "(" in text:
        _calls(text, pairs, give)
    if "<" in text:
        _tags(text, pairs)
    return pairs, references


def _calls(text: str, pairs: list[Pair], give) -> None:
    for m in _OPEN.finditer(text):
        called = _name_before(text, m.start())
        first = called and read_value(text, m.end(), 1)
        if not first:
            continue
        give(called[0], first)
        comma = _WHITE.match(text, first.end).end()
        if text[comma : comma + 1] == "," and len(first.spans) == 1:
            name = text[slice(*first.spans[0])]
            if _IDENTIFIER.match(name) and (second := read_value(text, comma + 1, 1)):
                give(name, second)


def _tags(text: str, pairs: list[Pair]) -> None:
    for m in _TAG.finditer(text):
        if m[3] and m[3].strip():
            a, b = m.span(3)
            body = text[a:b]
            a += len(body) - len(body.lstrip())
            pairs.append(Pair(m[1], [(a, a + len(body.strip()))], True))
        if m[2]:
            found = {x[1].lower(): x for x in _ATTRIBUTE.finditer(text, *m.span(2))}
            value = found.get("value")
            for key in ("name", "key", "id"):
                if value and key in found and (span := value.span(2) if value[2] is not None else value.span(3)):
                    pairs.append(Pair(found[key][2] or found[key][3] or "", [span], True))
