"""Token ids of whole texts by a public byte-level vocabulary, each distinct pre-token encoded once.

Byte-level BPE works inside pre-tokens (a word with its leading blank, a run of digits, of signs, or
of white space), so texts are cut into pre-tokens with array operations, equal ones are encoded by
the library once per worker, and their ids are copied to all places. Texts with characters outside
the scripts whose classes are tabulated here go through the library as a whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

CHUNK_CHARS = 1 << 20
# Pre-tokens a worker remembers, and their bytes; beyond that it starts anew.
REMEMBERED, REMEMBERED_BYTES = 1 << 19, 1 << 25

_BLANK, _SPACE, _LETTER, _NUMBER, _SIGN, _END, _OTHER = range(7)
_END_CODE = 0xFFFF
_END_MARK = "\uffff"
_END_BYTES = _END_MARK.encode("utf-16-le")
_CONTRACTION = regex.compile("'(?:s|t|re|ve|m|ll|d)")


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class per character up to Cyrillic and for general punctuation; the rest is other."""
    out = np.full(1 << 16, _OTHER, dtype=np.uint8)
    for code in [*range(0x530), *range(0x2010, 0x2028)]:
        c = chr(code)
        if c == " ":
            out[code] = _BLANK
        elif code in (0x85, 0xA0) or 0x09 <= code <= 0x0D:
            out[code] = _SPACE
        elif regex.match(r"\p{L}", c):
            out[code] = _LETTER
        elif regex.match(r"\p{N}", c):
            out[code] = _NUMBER
        else:
            out[code] = _SIGN
    out[_END_CODE] = _END
    return out


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a vocabulary file; strings of special tokens count as ordinary text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@lru_cache(maxsize=4)
def _word_encoder(path: str):
    """Encoder of single pre-tokens: the same vocabulary, in a library that is faster on short strings."""
    import tiktoken

    # The printable characters that stand for bytes in byte-level vocabularies.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    # End of the fixed values.
    shifted = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}
    tokenizer = load(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ranks = {
        bytes(byte_of[c] for c in token): rank
        for token, rank in tokenizer.get_vocab(with_added_tokens=True).items()
        if token not in special
    }
    own = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    return own.encode_ordinary


class _Memory:
    """Ids of the pre-tokens met so far, each a range of one pool of ids."""

    def __init__(self, path: str):
        self.path = path
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.bounds = np.zeros(1 << 16, np.int64)  # of pre-token i in the pool: from i to i + 1
        self.bytes = 0
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def ranges(self, pieces: list[bytes]) -> np.ndarray:
        """Offset and length in the pool for every pre-token (UTF-16), as two rows."""
        if len(self.known) > REMEMBERED or self.bytes > REMEMBERED_BYTES:
            self.clear()
        known, found, stops = self.known, [], []
        numbers = np.fromiter((known.get(piece, -1) for piece in pieces), np.int64, len(pieces))
        new = np.flatnonzero(numbers < 0)
        numbers[new] = np.arange(len(known), len(known) + len(new))
        encode_word = _word_encoder(self.path)
        for i in new.tolist():
            piece = pieces[i]
            if piece != _END_BYTES:
                found += encode_word(piece.decode("utf-16-le"))
            stops.append(self.used + len(found))
            known[piece] = len(known)
            self.bytes += len(piece)
        if len(known) >= len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros(len(known) + 1, np.int64)])
        self.bounds[len(known) - len(new) + 1 : len(known) + 1] = stops
        if self.used + len(found) > len(self.pool):
            grown = np.zeros(2 * (self.used + len(found)), np.uint32)
            grown[: self.used] = self.pool[: self.used]
            self.pool = grown
        self.pool[self.used : self.used + len(found)] = found
        self.used += len(found)
        return np.stack([self.bounds[numbers], self.bounds[numbers + 1] - self.bounds[numbers]])


_memory = lru_cache(maxsize=4)(_Memory)


def _starts(codes: np.ndarray, text: str) -> np.ndarray:
    """First character of every pre-token, text ends (their own pre-token) included."""
    kind = _classes()[codes]
    white = kind <= _SPACE
    group = np.where(white, _BLANK, kind)
    first = np.ones(len(codes), dtype=bool)
    first[1:] = group[1:] != group[:-1]
    first |= kind == _END
    # White space in front of a word: its last character is a pre-token or, a blank, joins it.
    last = np.zeros(len(codes), dtype=bool)
    last[:-1] = white[:-1] & ~white[1:] & (kind[1:] != _END)
    first[np.flatnonzero(last)] = True
    joined = np.flatnonzero(last & (kind == _BLANK)) + 1
    first[joined] = False
    # Contractions behind a word, a number or a line break.
    signs = np.flatnonzero(codes == 0x27)
    for i in signs[first[signs]].tolist():
        if m := _CONTRACTION.match(text, i):
            first[i + 1] = False
            first[m.end()] = True
    return np.flatnonzero(first)


def _encode_chunk(texts: list[str], path: str) -> list[np.ndarray]:
    joined = _END_MARK.join([*texts, ""])
    codes = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), np.uint16)
    if np.count_nonzero(_classes()[codes] >= _END) != len(texts):
        return _encode_mixed(texts, path)
    starts = _starts(codes, joined)
    bounds = 2 * np.append(starts, len(codes)).astype(np.int64)
    # Equal pre-tokens are told by their characters, not by a hash of them.
    distinct = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(codes)]
    ).dictionary_encode()
    memory = _memory(path)
    ranges = memory.ranges(distinct.dictionary.to_pylist())
    offset, sizes = ranges[:, distinct.indices.to_numpy()]
    to = np.cumsum(sizes)
    ids = memory.pool[np.repeat(offset - (to - sizes), sizes) + np.arange(to[-1])]
    # A text ends with the pre-token that its end mark is.
    stops = to[codes[starts] == _END_CODE]
    return np.split(ids, stops[:-1])


def _encode_mixed(texts: list[str], path: str) -> list[np.ndarray]:
    """Texts of a chunk some of which hold characters that are not tabulated."""
    wide = [_END_MARK in t or (_classes()[_codes(t)] == _OTHER).any() for t in texts]
    plain = iter(_encode_chunk([t for t, w in zip(texts, wide) if not w], path) if not all(wide) else ())
    return [_encode_whole(t, path) if w else next(plain) for t, w in zip(texts, wide)]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)


def _encode_whole(text: str, path: str) -> np.ndarray:
    return np.array(load(path).encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)


def encode(texts: Iterable[str | None], path: str) -> Iterator[np.ndarray]:
    """Ids of every text, in order; null is empty."""
    held: list[str] = []
    size = 0
    for text in texts:
        text = text or ""
        if len(text) > 2 * CHUNK_CHARS:
            if held:
                yield from _encode_chunk(held, path)
                held, size = [], 0
            yield _encode_whole(text, path)
            continue
        held.append(text)
        size += len(text) + 1
        if size >= CHUNK_CHARS:
            yield from _encode_chunk(held, path)
            held, size = [], 0
    if held:
        yield from _encode_chunk(held, path)
