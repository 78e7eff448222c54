"""Operator 9 - substring deduplication by super-k-mer partitioning.

A window is ``size`` consecutive words of one document. Its minimiser is the
smallest hash among its ``SEED_WORDS``-word grams. Consecutive windows with the
same minimiser travel as one packed string to the minimiser's bucket, where a
sort by window hash brings equal windows together and their words are compared,
so that the count is exact. Every window but the first of its kind (by doc_id,
then start) covers words to remove.

Before the shuffle each task keeps one copy of equal packed strings of a text
chunk: the others are already known to repeat an earlier window. A passage that
a third of the documents share thus sends one string per chunk, not per copy.
Packed strings of a chunk and bucket are one compressed row.

A first pass weighs the buckets. One of more than ``HOT_BYTES`` packed bytes (the
strings around a passage that very many documents share have its minimiser, but
differ at their ends) is split: its strings become single windows, of which each
chunk keeps one copy, and these are dealt by their own hash over as many parts as
the bucket's bytes ask for. Equal windows meet in one part, so the count stays exact.
The list of such buckets is sent to the tasks; it has at most ``MAX_LIST`` entries, as
the limit is at least that share of all bytes.

Defined results: null text has no words; documents shorter than a window lose
nothing; a null doc_id comes before all others; rows with the same doc_id are
ordered by the start alone, and windows with the same doc_id and start do not
remove each other. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, map_arrow, mixed, n_parts, sorted_groups, stored, text_chunks

WINDOW, SEED_WORDS = 20, 3
#: Windows in one packed string, bytes of text of a chunk, bytes of packed strings of a bucket.
MAX_RUN, CHUNK, BUCKET_BYTES = 256, 1 << 21, 8 << 20
#: Packed bytes beyond which a bucket is split, and the most buckets that can be.
HOT_BYTES, MAX_LIST = 4 * BUCKET_BYTES, 1_000_000
NULL_ID = -(1 << 63)


def _rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent 64-bit code of n consecutive hashes, by doubling."""
    mult, size, power = 0x9E3779B97F4A7C15, 1, 0x9E3779B97F4A7C15
    out, width, part = None, 0, h
    while True:
        if n & size:
            if out is None:
                out, width = part, size
            else:
                m = max(0, len(h) - width - size + 1)
                out = out[:m] * np.uint64(power) + part[width:width + m]
                width += size
        if 2 * size > n:
            return mixed(out[:max(0, len(h) - n + 1)])
        m = max(0, len(part) - size)
        part = part[:m] * np.uint64(power) + part[size:size + m]
        size, power = 2 * size, power * power % (1 << 64)


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:len(x) - width], x[width:])
        width *= 2
    if width < n and len(x) > n - width:
        x = np.minimum(x[:len(x) - (n - width)], x[n - width:])
    return x


def packed(w: Words) -> tuple[bytes, np.ndarray]:
    """The words joined by one space each, and where each begins there (and the end + 1)."""
    size = w.end - w.start
    begin = np.concatenate(([0], np.cumsum(size + 1)))
    out = np.full(int(begin[-1]), 32, np.uint8)
    pos = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[pos + np.repeat(begin[:-1], size)] = w.buf[pos + np.repeat(w.start, size)]
    return out.tobytes(), begin


def super_kmers(w: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window (a word index), number of windows and minimiser of every packed string."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    seed = min(SEED_WORDS, size)
    n = len(w.start)
    if n < size:
        return none
    least = _sliding_min(_rolling(w.hashes(), seed), size - seed + 1)
    at = np.flatnonzero(w.doc[:n - size + 1] == w.doc[size - 1:])
    if not len(at):
        return none
    least = least[at]
    cut = np.concatenate(([True], (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | (w.doc[at[1:]] != w.doc[at[:-1]])))
    first = np.flatnonzero(cut)
    run = np.diff(np.append(first, len(at)))
    parts = -(-run // MAX_RUN)
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    src = np.repeat(first, parts) + nth * MAX_RUN
    return at[src], np.minimum(np.repeat(run, parts) - nth * MAX_RUN, MAX_RUN), least[src]


ROWS = "bucket int, sub int, doc binary, key binary, start binary, n binary, size binary, words binary"


class Sender:
    """Collects rows of ROWS: the packed strings of a bucket's part, or repeated windows (bucket -1)."""

    def __init__(self):
        self._press = zstandard.ZstdCompressor(level=3)
        self.out = {c.split()[0]: [] for c in ROWS.split(", ")}

    def repeats(self, doc, key, start, n):
        """Known repeats: results already, spread over all tasks by their first text's hash."""
        self.add(-1, int(key[0]) & 0x7FFFFFFF, doc, key, start, n, [])

    def add(self, bucket: int, sub: int, doc, key, start, n, words: list[bytes]):
        row = (bucket, sub, *(self._press.compress(v.astype("<i8").tobytes()) for v in (doc, key, start, n)),
               self._press.compress(np.array([len(x) for x in words], "<i8").tobytes()), self._press.compress(b"\n".join(words)))
        for c, v in zip(self.out.values(), row):
            c.append(v)


def _places(t) -> list[np.ndarray]:
    """doc, key, start and n of the packed strings of a table's rows."""
    unpack = zstandard.ZstdDecompressor()
    return [np.concatenate([np.frombuffer(unpack.decompress(x), "<i8") for x in t.column(c).to_pylist()])
            for c in ("doc", "key", "start", "n")]


def _strings(t) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor()
    return [x for b in t.column("words").to_pylist() for x in unpack.decompress(b).split(b"\n")]


def _firsts(words: list[bytes], where: list[tuple]) -> tuple[np.ndarray, list[int]]:
    """Which items stay (the first by place of each string), and which others are known repeats.

    ``where``: (doc, start, key). Of items at the same place those of the same text are one; another
    text with the same id stays too, as it loses the same words once the string starts earlier elsewhere.
    """
    leader: dict[bytes, int] = {}
    keep = np.ones(len(words), bool)
    again = []
    for i, x in enumerate(words):
        j = leader.setdefault(x, i)
        if j == i:
            continue
        if where[i][:2] < where[j][:2]:
            leader[x] = i
            keep[j] = False
            again.append(j)
        elif where[i][:2] > where[j][:2]:
            keep[i] = False
            again.append(i)
        else:
            keep[i] = where[i] != where[j]
    return keep, again


def _weigh(size: int, buckets: int):
    """Packed bytes of each bucket; equal strings of a chunk (by the codes of their ends) count once."""

    def run(it):
        for _, texts in text_chunks(it, "text", CHUNK):
            w = Words(texts)
            first, n, least = super_kmers(w, size)
            if not len(first):
                continue
            code = _rolling(w.hashes(), size)
            same = mixed(code[first] ^ mixed(code[first + n - 1] + n.astype(np.uint64)))
            at = np.unique(same, return_index=True)[1]
            home, place = np.unique((least[at] % np.uint64(buckets)).astype(np.int64), return_inverse=True)
            begin = np.concatenate(([0], np.cumsum(w.end - w.start + 1)))
            raw = begin[first[at] + n[at] + size - 1] - begin[first[at]]
            yield {"bucket": home, "raw": np.bincount(place, weights=raw).astype(np.int64)}

    return run


def _hot_buckets(rows: DataFrame, size: int, buckets: int, bucket_bytes: int, hot_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets to split (sorted) and into how many parts each."""
    weight = stored(map_arrow(rows, _weigh(size, buckets), "bucket long, raw long").groupBy("bucket").agg(F.sum("raw").alias("raw")),
                    "bucket-bytes")
    limit = max(hot_bytes, (weight.agg(F.sum("raw")).first()[0] or 0) // MAX_LIST)
    hot = weight.where(F.col("raw") > limit).orderBy("bucket").collect()  # fewer than MAX_LIST rows: see limit
    return np.array([r[0] for r in hot], np.int64), np.array([-(-r[1] // bucket_bytes) for r in hot], np.int64)


def _emit(size: int, buckets: int, hot):
    def run(it):
        hot_bucket, parts = hot.value
        for b, texts in text_chunks(it, "text", CHUNK):
            ids = [NULL_ID if x is None else x for x in b.column("doc_id").to_pylist()]
            keys = b.column("key").to_numpy(zero_copy_only=False)
            order = sorted(range(len(ids)), key=ids.__getitem__)
            ids, keys, texts = np.array(ids, np.int64)[order], keys[order], [texts[i] for i in order]
            w = Words(texts)
            first, n, least = super_kmers(w, size)
            if not len(first):
                continue
            doc = w.doc[first]
            start = first - w.first[doc]
            raw, begin = packed(w)
            words = [raw[s:e] for s, e in zip(begin[first].tolist(), (begin[first + n + size - 1] - 1).tolist())]
            keep, again = _firsts(words, list(zip(ids[doc].tolist(), start.tolist(), keys[doc].tolist())))
            sender = Sender()
            if again:
                sender.repeats(ids[doc[again]], keys[doc[again]], start[again], n[again])
            at = np.flatnonzero(keep)
            home = (least[at] % np.uint64(buckets)).astype(np.int64)
            sort = np.argsort(home, kind="stable")
            at, home = at[sort], home[sort]
            cuts = np.flatnonzero(np.concatenate(([True], home[1:] != home[:-1], [True])))
            for s, e in zip(cuts, cuts[1:]):
                part, bucket = at[s:e], int(home[s])
                row = ids[doc[part]], keys[doc[part]], start[part]
                k = int(np.searchsorted(hot_bucket, bucket))
                if k < len(hot_bucket) and hot_bucket[k] == bucket:
                    _send_windows(sender, bucket, int(parts[k]), *row, [words[i] for i in part.tolist()], size)
                else:
                    sender.add(bucket, 0, *row, n[part], [words[i] for i in part.tolist()])
            yield sender.out

    return run


def _send_windows(sender: Sender, bucket: int, parts: int, doc, key, start, text: list[bytes], size: int):
    """The packed strings of a hot bucket as single windows, dealt over ``parts`` by their code."""
    w, code, at, src = _windows(text, size)
    place = start[src] + at - w.first[src]
    words = [w.data[s:e] for s, e in zip(w.start[at].tolist(), w.end[at + size - 1].tolist())]
    keep, again = _firsts(words, list(zip(doc[src].tolist(), place.tolist(), key[src].tolist())))
    if again:
        sender.repeats(doc[src[again]], key[src[again]], place[again], np.ones(len(again), np.int64))
    k = np.flatnonzero(keep)
    sub = 1 + (code[k] % np.uint64(parts)).astype(np.int64)
    for x in np.unique(sub).tolist():
        one = k[sub == x]
        sender.add(bucket, x, doc[src[one]], key[src[one]], place[one], np.ones(len(one), np.int64), [words[i] for i in one.tolist()])


def _windows(text: list[bytes], size: int):
    """The words of packed strings, and code, first word and string of every window."""
    w = Words([t.decode() for t in text])
    if len(w.start) < size:
        return w, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(w.doc[:len(w.start) - size + 1] == w.doc[size - 1:])
    return w, _rolling(w.hashes(), size)[at], at, w.doc[at]


def _ranges(doc, key, start, n):
    """Rows of repeated windows: first window and number, joined where they follow each other."""
    order = np.lexsort((start, key, doc))
    doc, key, start, n = doc[order], key[order], start[order], n[order]
    if not len(doc):
        return {"doc_id": doc, "key": key, "start": start, "n": n}
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (start[1:] != start[:-1] + n[:-1])))
    at = np.flatnonzero(new)
    return {"doc_id": doc[at], "key": key[at], "start": start[at], "n": np.add.reduceat(n, at)}


def _repeats(doc: np.ndarray, key: np.ndarray, start: np.ndarray, n: np.ndarray, text: list[bytes], size: int):
    """Repeated windows of one bucket."""
    w, code, at, src = _windows(text, size)
    place = start[src] + at - w.first[src]
    owner = doc[src]
    order = np.argsort(code, kind="stable")
    c = code[order]
    tie = np.concatenate(([False], c[1:] == c[:-1]))
    near = np.flatnonzero(tie | np.append(tie[1:], False))
    if not len(near):
        return None
    cand = order[near]
    cand = cand[np.lexsort((place[cand], owner[cand], code[cand]))]
    lo, hi = w.start[at[cand]].tolist(), w.end[at[cand] + size - 1].tolist()
    raw = w.data
    same = np.concatenate(([False], code[cand][1:] == code[cand][:-1])).tolist()
    where = list(zip(owner[cand].tolist(), place[cand].tolist()))
    hit = np.zeros(len(cand), bool)
    seen: dict[bytes, tuple] = {}
    for i, tied in enumerate(same):
        x = raw[lo[i]:hi[i]]
        if not tied:
            seen = {x: where[i]}
        elif seen.setdefault(x, where[i]) < where[i]:
            hit[i] = True
    got = cand[hit]
    return owner[got], key[src[got]], place[got], np.ones(len(got), np.int64)


def repeated_windows(docs: DataFrame, size: int = WINDOW, bucket_bytes: int = BUCKET_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``(doc_id, key, start, n)``, stored: n windows from word ``start`` on that also start earlier elsewhere.

    ``key`` is a hash of the text, so that rows with the same doc_id keep apart.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = n_parts(spark)
    buckets = int(max(parts, 3 * total // bucket_bytes + 1))
    hot = spark.sparkContext.broadcast(_hot_buckets(rows, size, buckets, bucket_bytes, hot_bytes))
    sent = map_arrow(rows, _emit(size, buckets, hot), ROWS)
    spread = F.when((F.col("sub") > 0) | (F.col("bucket") < 0), F.xxhash64("bucket", "sub")).otherwise(F.col("bucket"))
    dealt = (sent.withColumn("at", F.pmod(spread, F.lit(parts)).cast("int")).repartition(parts, "at")
             .sortWithinPartitions("bucket", "sub").drop("at"))

    def run(it):
        for t in sorted_groups(it, ["bucket", "sub"]):
            cols = _places(t)
            if t.column("bucket")[0].as_py() >= 0:
                cols = _repeats(*cols, _strings(t), size)
            if cols is not None:
                yield _ranges(*cols)

    return stored(map_arrow(dealt, run, "doc_id long, key long, start long, n long"), "windows")


def dedup_substrings(docs: DataFrame, size: int = WINDOW, with_text: bool = True, bucket_bytes: int = BUCKET_BYTES,
                     hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Per document: n_words, n_removed, kept_sha256 and, if asked for, the kept text."""
    found = repeated_windows(docs, size, bucket_bytes, hot_bytes)
    per_doc = (found.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list(F.struct("start", "n"))).alias("runs")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), "text",
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    joined = rows.join(per_doc, (F.coalesce("doc", F.lit(NULL_ID)) == F.col("doc_id")) & (F.col("hash") == F.col("key")), "left")
    joined = joined.select("doc", "text", F.col("runs.start").alias("starts"), F.col("runs.n").alias("ns"))

    def run(it):
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept_text"] * with_text]
        for b, texts in text_chunks(it, "text", CHUNK):
            out = {c: [] for c in names}
            for doc, text, starts, ns in zip(b.column("doc").to_pylist(), texts, b.column("starts").to_pylist(), b.column("ns").to_pylist()):
                words = text.encode().split()
                total, kept = len(words), words
                if starts:
                    cover = np.zeros(total + 1, np.int64)
                    s = np.array(starts)
                    np.add.at(cover, s, 1)
                    np.add.at(cover, s + np.array(ns) + size - 1, -1)
                    keep = np.cumsum(cover)[:total] == 0
                    kept = [words[i] for i in np.flatnonzero(keep).tolist()]
                line = b" ".join(kept)
                row = [doc, total, total - len(kept), hashlib.sha256(line).hexdigest(), *[line.decode()] * with_text]
                for c, v in zip(names, row):
                    out[c].append(v)
            yield out

    return map_arrow(joined, run, "doc_id long, n_words long, n_removed long, kept_sha256 string"
                     + ", kept_text string" * with_text)


def op9_query(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs, with_text=False)
