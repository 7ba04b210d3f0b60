"""Plain single-process versions of the queries, written from their contracts alone."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def secrets(text):
    text = text or ""
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.I | re.A,
    )
    found = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    found.sort(key=lambda x: (x[1], kinds.index(x[0])))
    counts = tuple(sum(x[0] == k for x in found) for k in kinds)
    return counts, sha(",".join(f"{k}:{s}:{e}" for k, s, e in found)), found


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    kinds = ["email", "ip", "card", "phone"]
    counts = tuple(sum(x[0] == k for x in found) for k in kinds)
    return counts, sha(",".join(f"{k}:{s}:{e}" for k, s, e in found)), found


def contamination(texts, items, window=13):
    """Per text: words, hit words, sorted item ids."""
    where = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            where[tuple(w[i : i + n])].add(str(item))
    sizes = {len(k) for k in where}
    out = []
    for text in texts:
        w = words(text)
        hit, ids = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := where.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    ids |= found
        out.append((len(w), len(hit), sorted(ids)))
    return out


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def near_groups(docs, size, percent=80):
    """docs: (id, text) rows -> {row number: (n_shingles, component)}, by comparing every pair that
    shares a shingle."""
    sets = [shingles(t, size) for _, t in docs]
    classes = defaultdict(list)
    for i, s in enumerate(sets):
        if s:
            classes[s].append(i)
    reps = list(classes)
    index = defaultdict(list)
    for r, s in enumerate(reps):
        for x in s:
            index[x].append(r)
    parent = list(range(len(reps)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for r, s in enumerate(reps):
        shared = defaultdict(int)
        for x in s:
            for other in index[x]:
                if other < r:
                    shared[other] += 1
        for other, n in shared.items():
            if 100 * n >= percent * (len(s) + len(reps[other]) - n):
                parent[find(r)] = find(other)
    lowest = {}
    for r, s in enumerate(reps):
        low = min((docs[i][0] for i in classes[s] if docs[i][0] is not None), default=None)
        root = find(r)
        known = lowest.get(root)
        lowest[root] = known if low is None else low if known is None else min(known, low)
    out = {}
    for i, (doc_id, _) in enumerate(docs):
        out[i] = (0, doc_id) if not sets[i] else (len(sets[i]), None)
    for r, s in enumerate(reps):
        for i in classes[s]:
            out[i] = (len(s), lowest[find(r)])
    return out


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def phrases(text):
    w = words(text)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def conversation(turns):
    """turns: (role, text) in order -> n_turns, turns hash, loss characters, loss hash."""
    said = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t or ''}\n" for r, t in turns)), len(said), sha(said)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def nearest(rows, query_ids, k=10):
    """rows: (id, vector) -> {query: [(id, distance), ...]}."""
    rows = [(i, np.array(v, np.float64)) for i, v in rows if usable(v)]
    out = {}
    for q, v in rows:
        if q in query_ids:
            d = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in rows if i != q)
            out[q] = [(i, s) for s, i in d[:k]]
    return out


def crc(text: str) -> int:
    return zlib.crc32(text.encode())


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling(rows, length=7, least=2, ratio=10):
    """Per word: form, root, n, near words, form's n."""
    counts = defaultdict(int)
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = crc(f"{'' if key is None else key}:{run}")
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= least}
    forms, out = {}, {}
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if abs(len(v) - len(w)) <= 1 and one_edit(v, w))
        form = near[0][1] if near and -near[0][0] >= ratio * n else None
        forms[w] = form
        out[w] = (form, n, len(near), words[form] if form else None)
    for w, (form, *rest) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (form, root, *rest)
    return out


def collocations(rows, wanted=2000, least=10):
    """Rows of the contract, in order of language and rank."""
    counts, totals = defaultdict(int), defaultdict(int)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            ws = re.findall("[^ \t]+", piece)
            totals[lang] += len(ws)
            for size in (1, 2, 3):
                for i in range(len(ws) - size + 1):
                    counts[lang, tuple(ws[i : i + size])] += 1
    found = defaultdict(list)
    for (lang, p), a in counts.items():
        if len(p) == 1 or a < least:
            continue
        if len(p) == 2 and any(
            100 * n >= 50 * a and n >= least and (q[:2] == p or q[1:] == p)
            for (other, q), n in counts.items() if other == lang and len(q) == 3
        ):
            continue
        cuts = [(10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    out = []
    for lang in found:
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found[lang])[:wanted], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def lowest(nodes, links):
    """Smallest node reachable from each."""
    near = defaultdict(list)
    for a, b in links:
        near[a].append(b)
        near[b].append(a)
    out = {}
    for first in sorted(nodes):
        waiting = [] if first in out else [first]
        while waiting:
            x = waiting.pop()
            if x not in out:
                out[x] = first
                waiting += near[x]
    return out


def fingerprints(rows, most=2):
    """Per document: fingerprint and smallest linked id."""
    import xxhash

    found = {}
    for key, text in rows:
        ws = re.findall("[^\x20\x09-\x0d]+", lower(text))
        grams = [" ".join(ws[i : i + 3]) for i in range(max(len(ws) - 2, 1))] if ws else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        found[key] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    keys = sorted(found)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if (found[a] ^ found[b]).bit_count() <= most]
    component = lowest(keys, links)
    return {k: (found[k], component[k]) for k in keys}
