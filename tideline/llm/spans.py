"""Digest columns of span scans: spans as text, counts per kind, and the hash of the base spans."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]  # kind, start, end: code points, end exclusive


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def merged(spans: list[Span]) -> list[tuple[int, int]]:
    """Disjoint ranges that cover all spans, in order."""
    ranges: list[tuple[int, int]] = []
    for start, end in sorted((s, e) for _, s, e in spans):
        if ranges and start <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(end, ranges[-1][1]))
        else:
            ranges.append((start, end))
    return ranges


def masked(text: str, spans: list[Span], mark: str) -> str:
    """``text`` with every covered range replaced by ``mark``."""
    pieces, at = [], 0
    for start, end in merged(spans):
        pieces += [text[at:start], mark]
        at = end
    return "".join([*pieces, text[at:]])
