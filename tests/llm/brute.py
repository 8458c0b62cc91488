"""Plain-Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import xxhash

BLANK = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(docs):
    first, out = {}, {}
    keys = lambda t: [x.strip(BLANK).translate(LOWER) for x in (t or "").split("\n")]
    for d, t in docs:
        for k in keys(t):
            if len(k) >= 10 and d is not None:
                first[k] = min(d, first.get(k, d))
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, keys(t), strict=True) if d is None or len(k) < 10 or first[k] >= d]
        out.setdefault(d, []).append((len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def substring_dedup(docs, width=50):
    first, out = {}, {}
    for d, t in docs:
        w = WORD.findall(t or "")
        for i in range(len(w) - width + 1):
            if d is not None:
                k = tuple(w[i : i + width])
                first[k] = min(d, first.get(k, d))
    for d, t in docs:
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        out.setdefault(d, []).append((len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(docs, radius=3):
    rows = [(d, fingerprint(t)) for d, t in docs]
    ids = [d for d, _ in rows if d is not None]
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    marked = [(d, f) for d, f in rows if d is not None]
    for i, (a, f) in enumerate(marked):
        for b, g in marked[:i]:
            if (f ^ g).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted(((d, f"{f:016x}", None if d is None else find(d)) for d, f in rows), key=str)


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    where, lines = defaultdict(list), defaultdict(int)
    for i in range(len(w) - 2):
        where[tuple(w[i : i + 3])].append(i)
    covered = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(3)}
    for x in text.split("\n"):
        if WORD.search(x):
            lines[x] += 1
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), sum(n - 1 for n in lines.values()), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)  # letters are A-Z and a-z


def secrets(text, extra=()):
    """Counts and digest of the contract's kinds, and all spans; ``extra`` holds (kind, pattern) in order."""
    text = text or ""
    found = [("assign", 0, m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", 1, m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", 2, m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    found += [(kind, 3 + k, m.span()) for k, (kind, pattern) in enumerate(extra) for m in re.finditer(pattern, text, re.ASCII)]
    found.sort(key=lambda x: (x[2][0], x[1]))
    kinds = [k for k, _, _ in found]
    said = lambda some: ",".join(f"{k}:{a}:{b}" for k, _, (a, b) in some)
    return (kinds.count("assign"), kinds.count("access"), kinds.count("hex"), sha(said([x for x in found if x[1] < 3])), said(found))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def url(u):
    if u is None or "://" not in u:
        host = path = ""
    else:
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOWER)
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def targets(sizes, weights=(3, 1, 2), budget=1.5, cap=2):
    """Reshare the excess again and again; sizes: {source: words}."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = budget * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free} if free else {}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: float(cap * sizes[s]) for s in over}


def sainte_lague(votes, seats):
    got = {k: 0 for k in votes}
    for _ in range(seats):
        best = max(votes, key=lambda k: (votes[k] / (2 * got[k] + 1), [-ord(c) for c in k]))
        got[best] += 1
    return got


def overlaps(docs, items, stretch=20, similarity=0.8, min_words=1):
    """Every diagonal of every document and item, by the 80 % rule alone; {(doc, item): (start, matched)}."""
    best = {}
    for d, t in docs:
        w = [x.lower() for x in WORD.findall(t or "")]
        for i, text in items:
            item = [x.lower() for x in WORD.findall(text or "")]
            n = len(item)
            for start in range(1 - n, len(w)) if d is not None and i is not None and n >= max(1, min_words) else ():
                same = [0 <= start + k < len(w) and w[start + k] == x for k, x in enumerate(item)]
                long = n > stretch and max(sum(same[k : k + stretch]) for k in range(n - stretch + 1)) >= math.ceil(similarity * stretch)
                if long or sum(same) >= math.ceil(similarity * n):
                    best[d, i] = max(best.get((d, i), (0, 0)), (sum(same), -start))
    return {k: (-back, matched) for k, (matched, back) in best.items()}
