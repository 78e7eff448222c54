"""Plain Python versions of the operators, for comparison on small data."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def pii_base(text):
    text = text or ""
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    spans = {k: [(m.start(), m.end()) for m in re.finditer(p, text) if ok(m[0])] for k, (p, ok) in kinds.items()}
    joined = ",".join(f"{k}:{s}:{e}" for k, v in spans.items() for s, e in v)
    return {f"n_{k}": len(v) for k, v in spans.items()}, joined


def shingles(text, n=5):
    w = WORD.findall(text or "")
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def jaccard_classes(rows, t=0.8, n=5):
    """[(doc_id, text)] -> sorted [(doc_id, class_id, n_links)]."""
    sets = [shingles(x, n) for _, x in rows]
    par = list(range(len(rows)))

    def root(i):
        while par[i] != i:
            i = par[i]
        return i

    links = Counter()
    where = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in where[g])
        for j, c in common.items():
            if c >= t * (len(s) + len(sets[j]) - c):
                links[i] += 1
                links[j] += 1
                par[root(i)] = root(j)
        for g in s:
            where[g].append(i)
    best = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        best[r] = min((x for x in (best.get(r), d) if x is not None), default=None)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted(((d, best[root(i)], links[i]) for i, (d, _) in enumerate(rows)), key=key)


def substring(rows, size=20):
    """[(doc_id, text)] -> sorted [(doc_id, n_words, n_removed, kept_sha256)]."""
    first = {}
    order = lambda d: (d is not None, d or 0)
    words = [WORD.findall(x or "") for _, x in rows]
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - size + 1):
            g, at = tuple(w[i:i + size]), (order(d), i)
            first[g] = min(first.get(g, at), at)
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < (order(d), i):
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=lambda r: (order(r[0]), r[3]))


def vectors(rows, t=0.98):
    """[(vec_id, embedding, label)] -> sorted [(vec_id, n_links, component_id, kept)]."""
    ok = []
    for _, e, lab in rows:
        x = np.array([np.nan if v is None else v for v in e], float) if e is not None else np.array([np.nan])
        ok.append(x if lab is not None and len(x) and np.isfinite(x).all() and (x != 0).any() else None)
    par = list(range(len(rows)))

    def root(i):
        while par[i] != i:
            i = par[i]
        return i

    n = Counter()
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] is not None and ok[j] is not None and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j]):
                if ok[i] @ ok[j] / np.sqrt(ok[i] @ ok[i]) / np.sqrt(ok[j] @ ok[j]) >= t - 1e-12:
                    n[i] += 1
                    n[j] += 1
                    par[root(i)] = root(j)
    best = defaultdict(lambda: None)
    for i, r in enumerate(rows):
        best[root(i)] = min((x for x in (best[root(i)], r[0]) if x is not None), default=None)
    return sorted(((r[0], n[i], best[root(i)], r[0] == best[root(i)]) for i, r in enumerate(rows)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def warc(rows, min_bytes=0):
    by = defaultdict(list)
    for p, h in rows:
        by[(h or "").encode()].append(p)
    out = []
    for p, h in rows:
        b = (h or "").encode()
        top = max(by[b])
        revisit = len(b) >= min_bytes and p != top
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "revisit" if revisit else "response", top if revisit else None))
    return sorted(out)


def pieces(rows, encode, cap=2048):
    out = []
    for d, text in rows:
        ids = np.array([*encode(text or ""), 0], "<u4")
        head = (len(ids) - 1) % cap + 1
        at = [0, *range(head, len(ids) + 1, cap)]
        out += [(d, k, s, e - s, zlib.crc32(ids[s:e].tobytes())) for k, (s, e) in enumerate(zip(at, at[1:]))]
    return sorted(out)


def edits_inside(item, text):
    """Fewest edits of the item against any substring of the text."""
    prev = np.zeros(len(text) + 1, int)
    t = np.array(list(text)) if text else np.zeros(0, "U1")
    lanes = np.arange(len(text) + 1)
    for r, ch in enumerate(item):
        cur = np.empty(len(text) + 1, int)
        cur[0] = r + 1
        cur[1:] = np.minimum(prev[:-1] + (t != ch), prev[1:] + 1)
        prev = np.minimum.accumulate(cur - lanes) + lanes
    return int(prev.min())
