"""Operator 8 - benchmark decontamination by q-gram lemma filtering.

An item of m characters with at most k edits keeps at least m + 1 - (k + 1) q of
its q-grams, and they lie within k diagonals of each other. So, for each text:
its q-grams are looked up among the items' q-grams; hits are counted per item in
overlapping diagonal bands of width 2 (k + 1); a band whose distinct q-grams
reach the bound is a region; and every region is verified by an alignment that
is banded to it.

Characters are compared after lower-casing (where that keeps the length) and
with every white-space character as a space. Text spans are code points of the
whole text.

The items are the small side: at most ``BLOCK_CHARS`` characters of them are sent to
the executors at a time; a larger benchmark takes several passes over the
documents, each with one bounded block.

Defined results: null or empty texts and items match nothing; an item without a
letter or digit matches nothing; repeated items match under each id; repeated
documents are reported for each row. A row tells the best occurrence (fewest
edits, then leftmost) and the number of verified regions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mixed, place_of, small_batches, text_chunks, with_text

#: Parameters: q, edits per character, characters of items per pass.
Q, EDIT_RATE, BLOCK_CHARS = 12, 0.05, 2_000_000
_SPACES = [9, 10, 11, 12, 13, 0xA0, 0x2028, 0x2029]


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, folded and joined by zeros, and where each begins (and the end)."""
    low = [x if len(x) == len(t) else t for t in texts for x in (t.lower(),)]
    raw = "\0".join(low).encode("utf-32-le", "surrogatepass")
    c = np.frombuffer(raw, np.uint32).copy()
    c[np.isin(c, _SPACES)] = 32
    return c, np.cumsum([0] + [len(x) + 1 for x in low])


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit code of the q characters from each place."""
    h, out, width = mixed(c.astype(np.uint64) + np.uint64(1)), None, 0
    mult = 0x9E3779B97F4A7C15
    size, power = 1, mult
    while True:  # binary parts of q, each joined by powers of the multiplier
        if q & size:
            if out is None:
                out, width = h, size
            else:
                n = len(c) - width - size + 1
                if n <= 0:
                    return np.zeros(0, np.uint64)
                out = out[:n] * np.uint64(power) + h[width:width + n]
                width += size
        size *= 2
        if size > q:
            break
        if len(h) - size // 2 <= 0:
            return np.zeros(0, np.uint64)
        h = h[:-(size // 2)] * np.uint64(power) + h[size // 2:]
        power = power * power % (1 << 64)
    return mixed(out[:max(0, len(c) - q + 1)])


def budget(m: int, q: int, rate: float) -> tuple[int, int]:
    """Edits allowed for an item of m characters, and the q-grams that must be left (at least one)."""
    k = int(rate * m)
    while k and m + 1 - (k + 1) * q < 1:
        k -= 1
    return k, max(1, m + 1 - (k + 1) * q)


class Items:
    """The q-gram index of a block of benchmark items."""

    def __init__(self, ids: list[int], texts: list[str], q: int = Q, rate: float = EDIT_RATE):
        self.q, self.rate = q, rate
        chars, begins = folded(texts)
        chars = [chars[s:e - 1] for s, e in zip(begins, begins[1:])]
        use = [i for i, t in enumerate(texts) if any(x.isalnum() for x in t)]
        self.ids = [ids[i] for i in use]
        self.chars = [chars[i] for i in use]
        #: An item shorter than q is looked for with its whole length as q and no edits.
        sizes = [min(q, len(c)) for c in self.chars]
        self.by_q = {}
        for s in sorted(set(sizes)):
            code, item, pos = [], [], []
            for i, c in enumerate(self.chars):
                if sizes[i] == s:
                    g = grams(c, s)
                    code.append(g)
                    item.append(np.full(len(g), i))
                    pos.append(np.arange(len(g)))
            code, item, pos = map(np.concatenate, (code, item, pos))
            order = np.argsort(code, kind="stable")
            code, item, pos = code[order], item[order], pos[order]
            keys, first, n = np.unique(code, return_index=True, return_counts=True)
            bits = 1 << 22
            table = np.zeros(bits, bool)
            table[(keys >> np.uint64(42)).astype(np.int64)] = True
            self.by_q[s] = (keys, first, n, item, pos, table)
        limits = [budget(len(c), q, rate) if len(c) >= q else (0, 1) for c in self.chars]
        self.k = np.array([x[0] for x in limits], np.int64)
        self.need = np.array([x[1] for x in limits], np.int64)
        self.m = np.array([len(c) for c in self.chars], np.int64)

    def hits(self, c: np.ndarray, most: int = 1 << 20):
        """(next text place, place in the text, item, place in the item) of shared q-grams, in slices of the text
        that hold about ``most`` of them (one text place alone may hold more, at most the items' characters)."""
        found = []
        for s, (keys, first, n, item, pos, table) in self.by_q.items():
            g = grams(c, s)
            at = np.flatnonzero(table[(g >> np.uint64(42)).astype(np.int64)])
            k = np.searchsorted(keys, g[at])
            k[k == len(keys)] = 0
            ok = keys[k] == g[at]
            found.append((at[ok], k[ok], first, n, item, pos))
        every = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
        if not len(every):
            return
        order = np.argsort(every, kind="stable")
        total = np.cumsum(np.concatenate([f[3][f[1]] for f in found])[order])
        every = every[order]
        low = 0
        while low <= every[-1]:
            done = int(np.searchsorted(every, low))
            base = int(total[done - 1]) if done else 0
            cut = int(np.searchsorted(total, base + most, "right"))
            high = int(every[-1]) + 1 if cut >= len(every) else max(int(every[cut]), int(every[done]) + 1)
            out = []
            for at, k, first, n, item, pos in found:
                a, b = np.searchsorted(at, (low, high))
                # A text place meets every item place with the same q-gram.
                rep = n[k[a:b]]
                row = np.repeat(np.arange(b - a), rep)
                nth = np.arange(int(rep.sum())) - np.repeat(np.cumsum(rep) - rep, rep)
                src = first[k[a:b]][row] + nth
                out.append((at[a:b][row], item[src], pos[src]))
            yield (high, *(np.concatenate(x).astype(np.int64) for x in zip(*out)))
            low = high

    def regions(self, c: np.ndarray):
        """(item, first diagonal) of bands that hold enough distinct q-grams of the item.

        A band that ends before all later text places can reach it is settled and counted, so only
        the bands around the current place are held.
        """
        none = np.zeros(0, np.int64)
        held, out = (none, none, none), []
        longest = int(self.m.max()) if len(self.m) else 0
        for nxt, at, item, pos in self.hits(c):
            width = self.k[item] + 1
            band = (at - pos + (1 << 40)) // width
            cols = (np.concatenate((held[0], item, item)), np.concatenate((held[1], band, band - 1)), np.concatenate((held[2], pos, pos)))
            order = np.lexsort((cols[2], cols[1], cols[0]))
            it, bd, ps = (x[order] for x in cols)
            new = np.concatenate(([True], (it[1:] != it[:-1]) | (bd[1:] != bd[:-1]) | (ps[1:] != ps[:-1]))) if len(it) else np.zeros(0, bool)
            it, bd, ps = it[new], bd[new], ps[new]
            # Later hits lie on diagonals from nxt - longest on.
            open_ = (bd + 2) * (self.k[it] + 1) > nxt - longest + (1 << 40)
            self._settle(it[~open_], bd[~open_], out)
            held = it[open_], bd[open_], ps[open_]
        self._settle(held[0], held[1], out)
        return sorted(out)

    def _settle(self, it: np.ndarray, bd: np.ndarray, out: list):
        """Add the bands of distinct q-grams that hold enough of them."""
        if len(it):
            start = np.flatnonzero(np.concatenate(([True], (it[1:] != it[:-1]) | (bd[1:] != bd[:-1]))))
            keep = np.diff(np.append(start, len(it))) >= self.need[it[start]]
            i, b = it[start][keep], bd[start][keep]
            out.extend(zip(i.tolist(), (b * (self.k[i] + 1) - (1 << 40)).tolist()))

    def align(self, i: int, c: np.ndarray, low: int, first: int, last: int):
        """Best alignment of item i with c[first:last] on diagonals low .. low + 2 width - 1.

        Returns (edits, start, end) with start and end as places in c, or None.
        Row r of the band holds the text places low + r - 1 + (0 .. width).
        """
        item, k = self.chars[i], int(self.k[i])
        w = 2 * (k + 1) + 1
        s, e = max(first, low), min(last, low + w - 1 + len(item))
        if len(item) <= e - s:  # an occurrence without edits needs no table
            raw, want = c[s:e].tobytes(), item.tobytes()
            at = raw.find(want)
            while at >= 0 and at % 4:
                at = raw.find(want, at + 1)
            if at >= 0:
                return 0, s + at // 4, s + at // 4 + len(item)
        big = 1 << 20
        lanes = np.arange(w)
        col = low + lanes  # text length consumed before row 0
        inside = (col >= first) & (col <= last)
        cost = np.where(inside, 0, big)
        begin = np.where(inside, col, -1)
        for r in range(len(item)):
            col = low + r + 1 + lanes
            j = col - 1
            ok = (j >= first) & (j < last)
            match = np.zeros(w, np.int64)
            match[ok] = c[j[ok]] != item[r]
            match[~ok] = big
            stay = cost + match
            up = np.append(cost[1:], big) + 1  # the item's character is missing in the text
            best = np.where(stay <= up, stay, up)
            src = np.where(stay <= up, begin, np.append(begin[1:], -1))
            best[(col < first) | (col > last)] = big
            # Extra text characters: cheapest way from the left, one each.
            run = np.minimum.accumulate(best - lanes)
            left = run + lanes
            from_ = np.maximum.accumulate(np.where(best - lanes == run, lanes, 0))
            take = left < best
            src = np.where(take, src[from_], src)
            cost, begin = np.where(take, left, best), src
        e = int(cost.argmin())
        if cost[e] > k:
            return None
        return int(cost[e]), int(begin[e]), int(low + len(item) + e)

    def find(self, texts: list[str]):
        """(text, item, edits, start, end, regions) of every item found in a text."""
        c, begins = folded(texts)
        best: dict[tuple[int, int], list] = {}
        for i, low in self.regions(c):
            w, m = 2 * (int(self.k[i]) + 1), int(self.m[i])
            doc = int(np.searchsorted(begins, max(0, low + w // 2 + m // 2), "right")) - 1
            for d in {doc, *(int(x) for x in np.searchsorted(begins, [max(0, low), max(0, low + m + w)], "right") - 1)}:
                if not 0 <= d < len(texts):
                    continue
                first, last = int(begins[d]), int(begins[d + 1]) - 1
                if (got := self.align(i, c, low, first, last)) is None:
                    continue
                edits, s, e = got
                row = best.setdefault((d, i), [edits, s - first, e - first, set()])
                row[3].add((s - first) // max(1, m))
                if (edits, s - first) < (row[0], row[1]):
                    row[:3] = [edits, s - first, e - first]
        return [(d, i, *v[:3], len(v[3])) for (d, i), v in sorted(best.items())]


def _blocks(benchmark: DataFrame, block_chars: int):
    """Blocks of items (ids, texts), each of bounded size, in order of id."""
    ids, texts, n = [], [], 0
    for r in benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text").toLocalIterator():
        ids.append(r[0])
        texts.append(r[1])
        n += len(r[1])
        if n >= block_chars:
            yield ids, texts
            ids, texts, n = [], [], 0
    if ids:
        yield ids, texts


LEAKS = "doc_id long, item_id long, edits long, start long, end long, regions long"


def find_leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document row and item found in it."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text").where(F.length("text") > 0)
    out = None
    for ids, texts in _blocks(benchmark, block_chars):
        sent = spark.sparkContext.broadcast((ids, texts))

        def run(it, sent=sent):
            items = Items(*sent.value, q, rate)
            for b, chunk in text_chunks(it, "text", 1 << 20):
                docs_ = b.column("doc_id").to_pylist()
                found = items.find(chunk) if items.ids else []
                yield {"doc_id": [docs_[x[0]] for x in found], "item_id": [items.ids[x[1]] for x in found],
                       **{n: [x[k] for x in found] for k, n in ((2, "edits"), (3, "start"), (4, "end"), (5, "regions"))}}

        part = map_arrow(rows, run, LEAKS)
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], LEAKS)


def mark_leaks(docs: DataFrame, benchmark: DataFrame, flag: str, q: int = Q, rate: float = EDIT_RATE,
               block_chars: int = BLOCK_CHARS, text: str = "text") -> DataFrame:
    """``docs`` with a column ``flag``: does the row's text hold an item? No shuffle, one pass per block."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BooleanType, StructType

    import pyarrow as pa

    spark = docs.sparkSession
    small_batches(spark)
    # The row travels as one column, so that its columns may have any names.
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.lit(False).alias("bad"))
    at = place_of(docs, text)
    schema = StructType([*out.schema.fields[:-1]]).add("bad", BooleanType())
    for ids, texts in _blocks(benchmark, block_chars):
        sent = spark.sparkContext.broadcast((ids, texts))

        def run(it, sent=sent):
            items = Items(*sent.value, q, rate)
            target = to_arrow_schema(schema)
            for b, chunk in text_chunks(with_text(it, "row", at), "text", 1 << 20):
                bad = np.array(b.column("bad").to_pylist(), bool)
                for x in items.find(chunk) if items.ids else []:
                    bad[x[0]] = True
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(bad)], schema=target)

        out = out.mapInArrow(run, schema)
    return out.select("row.*", F.col("bad").alias(flag))


def op8_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs, benchmark)
