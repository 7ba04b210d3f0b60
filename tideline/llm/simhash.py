"""Near-duplicate documents by 64-bit fingerprints that differ in few bits.

1. Every text becomes a fingerprint: a bit is 1 if more than half of the text's shingle hashes have
   it set. Equal fingerprints are one class, so thousands of copies cost one row.
2. Fingerprints are split into four blocks of 16 bits. Two that differ in at most two bits agree on
   at least two blocks, so each class is dealt to the six pairs of its blocks, 32 bits each, and
   classes meet where such a pair is equal.
3. A place shared by few classes is verified there: Hamming distances of all its classes, of whose
   links only a spanning forest leaves the task. A place shared by more than ``MOST_CLASSES`` is
   split again in the same way: the 32 bits left open make four blocks of 8, then the 16 bits left
   open four blocks of 4. After that 8 bits are open, and no place holds more than 256 classes. No
   link is lost at any level, since two open bits at most differ and two blocks of four agree.

Defined results: a text without words (null, empty) has the fingerprint zero and is linked like any
other; fewer words than a shingle are one shingle; repeated rows are equal texts; a component of
rows without id has none; an empty table gives an empty result. Texts are read whole; the memory of
one text is about 60 bytes a word.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.near_duplicates import components
from tideline.llm.text import text_slices
from tideline.session import materialize

SHINGLE = 3
SEED = 42
MOST_BITS = 2
# Bits of a fingerprint that are open before each level; a quarter of them is a block.
OPEN_BITS = (64, 32, 16)
# Classes compared at one place; 8 open bits cannot tell more apart.
MOST_CLASSES = 256
# Hashes whose bits are counted at once.
STEP = 1 << 14


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of a text, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    body = b" ".join(words)
    stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate(([0], stop[:-1] + 1))
    n = max(len(words) - size + 1, 1)
    last = stop[min(size, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    spans = zip(start[:n].tolist(), last.tolist())
    return np.fromiter((digest(body[a:b], SEED) for a, b in spans), np.uint64, n)


def fingerprint_of(hashes: np.ndarray) -> int:
    """The 64 majority bits as a signed number."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), STEP):
        octets = hashes[i : i + STEP].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """Fingerprint of every text, as a bigint."""

    @F.arrow_udf("bigint")
    def fingerprints(texts: pa.Array) -> pa.Array:
        found = [fingerprint_of(shingle_hashes(t, size)) for part in text_slices(texts) for t in part]
        return pa.array(found, pa.int64())

    return fingerprints(text)


def hexadecimal(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _places(value: Column, bits: int) -> Column:
    """Array of (place, open): every pair of the four blocks of ``value``, and the bits besides it."""
    width = bits // 4
    block = [F.shiftrightunsigned(value, width * i).bitwiseAND(F.lit((1 << width) - 1)) for i in range(4)]

    def joined(a: int, b: int) -> Column:
        return F.shiftleft(block[a], width).bitwiseOR(block[b])

    places = []
    for number, (a, b) in enumerate(combinations(range(4), 2)):
        rest = [i for i in range(4) if i not in (a, b)]
        place = joined(a, b).bitwiseOR(F.lit(number << (2 * width)))
        places.append(F.struct(place.alias("place"), joined(*rest).alias("open")))
    return F.explode(F.array(*places))


def spanning_links(members: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A link to every member but one of each set of fingerprints linked with each other."""
    links, left = [], np.ones(len(members), dtype=bool)
    for first in range(len(members)):
        if not left[first]:
            continue
        left[first] = False
        waiting = [first]
        while waiting:
            at = waiting.pop()
            near = np.flatnonzero(left & (np.bitwise_count(members ^ members[at]) <= most))
            left[near] = False
            links += [(int(members[at]), int(members[x])) for x in near]
            waiting += near.tolist()
    return links


def _verified(most: int):
    @F.arrow_udf("array<struct<a:bigint,b:bigint>>")
    def verified(places: pa.Array) -> pa.Array:
        found = []
        for members in places:
            values = members.values.to_numpy(zero_copy_only=False).view(np.uint64)
            links = spanning_links(values, most)
            found.append([{"a": a - (a >> 63 << 64), "b": b - (b >> 63 << 64)} for a, b in links])
        return pa.array(found, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    return verified


def link_fingerprints(classes: DataFrame, most: int = MOST_BITS, most_classes: int = MOST_CLASSES) -> DataFrame:
    """Links ``a``, ``b`` that span the components of the distinct ``classes(fingerprint)``."""
    if not 0 <= most <= 2:
        raise ValueError("pairs of four blocks find at most two differing bits")
    rows = classes.select("fingerprint", F.col("fingerprint").alias("open"))
    keys: list[str] = []
    links = None
    for level, bits in enumerate(OPEN_BITS):
        dealt = rows.select(*keys, "fingerprint", _places(F.col("open"), bits).alias("at"))
        keys = [*keys, f"place{level}"]
        dealt = dealt.select(*keys[:-1], F.col("at.place").alias(keys[-1]), "fingerprint", "at.open")
        # Most places hold one class; they end here, before any row is gathered.
        counts = dealt.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
        shared = materialize(dealt.join(counts, keys))
        small = F.col("n") <= most_classes if level + 1 < len(OPEN_BITS) else F.lit(True)
        lists = shared.filter(small).groupBy(*keys).agg(F.collect_list("fingerprint").alias("members"))
        found = lists.select(F.explode(_verified(most)("members")).alias("link")).select("link.*")
        links = found if links is None else links.unionByName(found)
        rows = shared.filter(~small).drop("n")
        if rows.isEmpty():
            break
    return links.distinct()


def find_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                most: int = MOST_BITS, most_classes: int = MOST_CLASSES) -> DataFrame:
    """Per document: ``key``, ``fingerprint`` (bigint), ``component_id`` (smallest id of its group)."""
    rows = materialize(
        docs.select(F.col(key).alias("id"), fingerprint(F.col(text), size).alias("fingerprint"))
    )
    classes = materialize(rows.groupBy("fingerprint").agg(F.min("id").alias("low")))
    labels = components(materialize(link_fingerprints(classes, most, most_classes)))
    grouped = classes.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "low", F.coalesce("component", "fingerprint").alias("component")
    )
    lowest = grouped.groupBy("component").agg(F.min("low").alias("component_id"))
    named = grouped.join(lowest, "component").select("fingerprint", "component_id")
    # A fingerprint of a third of all rows is one row of ``named``: a skewed join that can be split.
    return rows.join(named, "fingerprint").select(F.col("id").alias(key), "fingerprint", "component_id")
