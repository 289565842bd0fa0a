"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RULES = [
    (
        "assign",
        re.compile(
            r"(?a:((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
            r"([A-Za-z0-9+/_.=-]+))"
        ),
        2,
        8,
    ),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile("[0-9a-f]+"), 0, 32),
]


def shingles(text, width=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def lowest(nodes, links):
    """Smallest node reachable from each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def near_duplicates(rows, percent=75):
    """{(doc_id, n_shingles, component_id)} of (doc_id, text) rows with an id."""
    sets = [(i, shingles(t)) for i, t in rows]
    links = [
        (i, j)
        for n, (i, x) in enumerate(sets)
        for j, y in sets[:n]
        if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    low = lowest({i for i, _ in sets}, links)
    return sorted((i, len(x), low[i]) for i, x in sets)


def without_repeats(rows, window=50):
    first = {}
    docs = [(i, [w.encode() for w in WORD.findall(t or "")]) for i, t in rows]
    for i, w in docs:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def secrets(text):
    found = []
    for order, (kind, rule, group, least) in enumerate(RULES):
        found += [
            (m.start(), order, f"{kind}:{m.start()}:{m.end()}")
            for m in rule.finditer(text or "")
            if len(m[group]) >= least
        ]
    counts = [sum(1 for f in found if f[1] == k) for k in range(3)]
    return counts, ",".join(f[2] for f in sorted(found))


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def links(rows, threshold):
    """(id, n_links, component) of (id, vector, label) rows."""
    usable = []
    for i, v, label in rows:
        good = (
            i is not None and label is not None and v and None not in v
            and np.isfinite(v).all() and np.any(np.array(v) != 0)
        )
        usable.append((i, np.array(v, dtype=float) if good else None, label))
    near = []
    for n, (i, x, a) in enumerate(usable):
        for j, y, b in usable[:n]:
            if x is not None and y is not None and a == b and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    near.append((i, j))
    low = lowest({i for i, _, _ in usable}, near)
    return sorted((i, sum(i in pair for pair in near), low[i]) for i, _, _ in usable)


PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return PLAIN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(rows, items, width=10):
    """Sorted (doc_id, n_words, hit places, item ids) of (doc_id, text) and (item_id, text) rows."""
    grams = {}
    for item, text in items:
        w = plain_words(text)
        for k in range(max(len(w) - width, 0) + 1 if w else 0):
            grams.setdefault(tuple(w[k : k + width]), set()).add(item)
    out = []
    for i, text in rows:
        w, hit, named = plain_words(text), set(), set()
        for m in {len(g) for g in grams}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in grams:
                    hit |= set(range(k, k + m))
                    named |= grams[tuple(w[k : k + m])] - {None}
        out.append((i, len(w), sorted(hit), sorted(map(str, named))))
    return sorted(out, key=repr)


def hard_negatives(rows, asks, scale=256, k=5, percent=80):
    """Sorted result rows of (id, vector, label) rows, in Python's integers."""
    usable = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and None not in v and np.isfinite(v).all():
            usable.append((i, [int(np.floor(np.float64(x) * scale)) for x in v], label))
    out = []
    for i, v, label in {r[0]: r for r in sorted(usable, key=lambda r: (r[2], r[1]), reverse=True)}.values():
        if not asks(i):
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w)), j, same == label) for j, w, same in usable if j != i
        ]
        for p, j, _ in sorted(s for s in scored if s[2])[:k]:
            hard = sorted(s for s in scored if not s[2] and percent * -p <= 100 * -s[0] <= 100 * -p)
            out += [(i, j, r, n, -p, -s) for r, (s, n, _) in enumerate(hard[:k], 1)]
    return sorted(out)


def collocations(rows, width=5, least=100, first=2000, absorb=100):
    """Sorted result rows of (lang, text) rows, counted phrase by phrase."""
    f, n = {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] = n.get(lang, 0) + len(w)
            for m in range(1, width + 1):
                for i in range(len(w) - m + 1):
                    key = lang, tuple(w[i : i + m])
                    f[key] = f.get(key, 0) + 1
    f = {k: v for k, v in f.items() if v >= least}
    out = []
    for lang in n:
        found = []
        several = {p: a for (g, p), a in f.items() if g == lang and len(p) > 1}
        covered = {}
        for q, a in several.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    covered[q[i : i + m]] = max(covered.get(q[i : i + m], 0), a)
        for p, a in several.items():
            if p in covered and 100 * covered[p] >= absorb * a:
                continue
            cuts = [(f[lang, p[:k]], f[lang, p[k:]], k) for k in range(1, len(p))]
            score, _, l, r = min((1000 * a * n[lang] // (l * r), k, l, r) for l, r, k in cuts)
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)
