"""Operator 3 - language-model scoring with Katz backoff.

The model: bigram and unigram counts of the training documents, discounted by
Good-Turing for counts up to ``K``, and a backoff weight per context that makes
every distribution sum to one over the vocabulary and one unknown word:

    P(w | h) = d(c) c(h, w) / c(h)          if the bigram was seen
             = alpha(h) P(w)                otherwise
    P(w)     = d(c) c(w) / N                if the word was seen
             = what the discounts left      otherwise (the unknown word)

A distribution whose discounts leave nothing (every count is above ``K``) gets one
more in its denominator. Discounts outside (0, 1) fall back to (c - 1/2) / c.

Words are lower-cased (A-Z only) and kept as 64-bit hashes, successors of a context
as 48 bits of theirs. Every text ends with one end token; the context of its first
word is a start mark.

Nothing of the size of the vocabulary is broadcast or collected. Documents are
grouped into chunks once (a stored table). Chunks send their distinct words to hash
buckets, which count them, write the unigram table and answer with the counts.
Then chunks send their distinct bigrams to the buckets of the contexts, in ``rounds``
shares so that less is on disk at a time; a bucket counts them, writes the bigram table
(a row per context) and answers each chunk with the counts of its bigrams and, for the
contexts of its unseen ones, with what alpha needs. A context's own count is that of
its word (every word has a successor; the start mark has one per text). Only the counts
of counts, a few numbers, pass through the driver; a last step goes through the chunks'
texts once more and puts everything in. Documents are never sent: a bigram costs a
chunk one entry however often it occurs there.

The successors of a context that occurs ``HOT`` times or more are dealt by their hash
over so many parts that a part stands for about ``HOT`` occurrences at most; each part
goes to a bucket of its own and has its own row in the bigram table. What alpha needs of such
a context is summed over the parts in a small aggregate and joined to the chunks that hold it.

Defined results: null text is empty and scores its end token; a null doc_id is
training text; repeated rows count and are scored each; without training text every
probability is one (score 0).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, drop_stored, map_arrow, mixed, n_parts, sorted_groups, stored, text_chunks

#: Parameters: counts that are discounted, bytes of text of a chunk, bytes of text per bucket and round, rounds,
#: occurrences of a context (in all documents) from which its successors are dealt over several buckets.
K, CHUNK, BUCKET_BYTES, ROUNDS, HOT = 5, 1 << 21, 8 << 20, 2, 1 << 17
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
LOW48 = np.uint64((1 << 48) - 1)


# ------------------------------------------------------------------ the model's numbers

def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing discount of counts 1..K (index 0 unused) from n[c], the number of events with count c."""
    out = np.array([1.0] + [(c - 0.5) / c for c in range(1, K + 1)])
    if min(n[1:K + 2], default=0) > 0:
        a = (K + 1) * n[K + 1] / n[1]
        if a < 1:
            d = np.array([((c + 1) * n[c + 1] / (c * n[c]) - a) / (1 - a) for c in range(1, K + 1)])
            if ((d > 0) & (d < 1)).all():
                out[1:] = d
    return out


class Unigrams:
    """P(w) by count, from the total and the counts of counts."""

    def __init__(self, total: int, distinct: int, n: list[int]):
        self.total, self.distinct, self.d = total, distinct, discounts(n)
        left = sum((1 - self.d[c]) * c * n[c] for c in range(1, K + 1))
        self.denominator = total if left > 0 else total + 1
        self.unknown = (left if left > 0 else 1.0) / self.denominator if total else 1.0

    def p(self, c: np.ndarray) -> np.ndarray:
        c = c.astype(np.float64)
        d = np.where(c <= K, self.d[np.minimum(c, K).astype(np.int64)], 1.0)
        return np.where(c > 0, d * c / max(self.denominator, 1), self.unknown)


def log_alpha(d: np.ndarray, c_h: np.ndarray, m: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """log10 of the backoff weight: c_h tokens after the context, m[c - 1] successors with count c,
    ``lower`` the unigram mass of its successors. An unknown context has weight one."""
    left = sum((1 - d[c]) * c * m[c - 1] for c in range(1, K + 1))
    share = np.where(left > 0, left / np.maximum(c_h, 1), 1 / (c_h + 1.0))
    return np.where(c_h > 0, np.log10(share / (1 - lower)), 0.0)


# ------------------------------------------------------------------ packing of arrays

def squeeze(a: np.ndarray, keep: int | None = None) -> bytes:
    """Compressed byte planes of an array (the low ``keep`` bytes of each item)."""
    width = a.dtype.itemsize
    planes = a.astype(a.dtype.newbyteorder("<")).view(np.uint8).reshape(-1, width).T[:keep or width]
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expand(raw: bytes, dtype: str, keep: int | None = None) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(keep or width, -1)
    out = np.zeros((flat.shape[1], width), np.uint8)
    out[:, :keep or width] = flat.T
    return out.view(dtype).ravel()


# ------------------------------------------------------------------ chunks

def _chunks(docs: DataFrame, held) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(held, F.lit(False)).alias("held"))

    def run(it):
        press = zstandard.ZstdCompressor(level=3)
        for b, texts in text_chunks(it, "text", CHUNK):
            parts = [t.encode() for t in texts]
            yield {"chunk": [uuid.uuid4().int >> 65], "doc_id": [b.column("doc_id").to_pylist()],
                   "held": [b.column("held").to_pylist()], "size": [[len(p) for p in parts]],
                   "text": [press.compress(b"".join(parts))]}

    return map_arrow(rows, run, "chunk long, doc_id array<long>, held array<boolean>, size array<int>, text binary")


class Tokens:
    """The tokens of a chunk: ``token`` and ``doc`` of each, and the distinct ones (sorted, with inverse)."""

    def __init__(self, size: list[int], text: bytes, held: list[bool]):
        raw = zstandard.ZstdDecompressor().decompress(text)
        at = np.cumsum([0, *size])
        w = Words([raw[s:e].decode() for s, e in zip(at[:-1].tolist(), at[1:].tolist())], lower=True)
        self.token = np.insert(w.hashes(), w.first[1:], END)
        self.begin = w.first[:-1] + np.arange(len(size))
        self.n = np.diff(w.first) + 1
        self.doc = np.repeat(np.arange(len(size)), self.n)
        self.held = np.array(held, bool)
        self.distinct, self.inverse = np.unique(self.token, return_inverse=True)

    def by_bucket(self, buckets: int):
        """Order of the distinct tokens by bucket, and the cuts between buckets."""
        home = (self.distinct % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[order], np.arange(buckets + 1))
        return order, cuts


def _rows_of(it, *cols):
    for b in it:
        yield from zip(*(b.column(c).to_pylist() for c in cols))


def _send_words(buckets: int):
    def run(it):
        for chunk, held, size, text in _rows_of(it, "chunk", "held", "size", "text"):
            t = Tokens(size, text, held)
            every = np.bincount(t.inverse, minlength=len(t.distinct)).astype(np.uint32)
            train = np.bincount(t.inverse[~t.held[t.doc]], minlength=len(t.distinct)).astype(np.uint32)
            order, cuts = t.by_bucket(buckets)
            use = [x for x in range(buckets) if cuts[x + 1] > cuts[x]]
            parts = [order[cuts[x]:cuts[x + 1]] for x in use]
            yield {"bucket": use, "chunk": [chunk] * len(use), "a": [squeeze(t.distinct[p]) for p in parts],
                   "b": [squeeze(train[p]) for p in parts], "o": [squeeze(every[p] - train[p]) for p in parts]}

    return run


def _count_words(hot: int):
    """Unigram rows (kind 0) and answers to the chunks (kind 1): training counts and numbers of parts."""

    def run(it):
        for g in sorted_groups(it, ["bucket"]):
            words = [expand(x, "<u8") for x in g.column("a").to_pylist()]
            token, inverse = np.unique(np.concatenate(words), return_inverse=True)
            n, other = (np.concatenate([expand(x, "<u4") for x in g.column(k).to_pylist()]) for k in ("b", "o"))
            c = np.bincount(inverse, weights=n, minlength=len(token)).astype(np.int64)
            every = c + np.bincount(inverse, weights=other, minlength=len(token)).astype(np.int64)
            seen = np.flatnonzero(c)
            bucket = g.column("bucket")[0].as_py()
            yield {"kind": np.zeros(len(seen), np.int32), "bucket": np.full(len(seen), bucket), "token": token[seen].view(np.int64),
                   "c": c[seen]}
            chunks = g.column("chunk").to_pylist()
            of = np.split(inverse, np.cumsum([len(w) for w in words])[:-1])
            k = len(chunks)
            yield {"kind": np.ones(k, np.int32), "bucket": np.full(k, bucket), "chunk": chunks,
                   "answer": [squeeze(c[i].astype(np.uint32)) for i in of],
                   "parts": [squeeze((1 + every[i] // hot).astype(np.uint32)) for i in of]}

    return run


ANNOTATED = ("chunk long, doc_id array<long>, held array<boolean>, size array<int>, text binary, counts binary, "
             "parts binary, hot array<long>, n_tokens array<long>, n_known array<long>, base array<double>")


def _annotate(buckets: int, uni: Unigrams):
    """Chunks with the training count and number of parts of each distinct token, the contexts in several parts,
    and the base score of each document."""

    def run(it):
        for chunk, ids, held, size, text, answers in _rows_of(it, "chunk", "doc_id", "held", "size", "text", "answers"):
            t = Tokens(size, text, held)
            order, _ = t.by_bucket(buckets)
            answers = sorted(answers, key=lambda x: x["bucket"])
            c, parts = np.zeros((2, len(t.distinct)), np.uint32)
            c[order] = np.concatenate([expand(x["answer"], "<u4") for x in answers])
            parts[order] = np.concatenate([expand(x["parts"], "<u4") for x in answers])
            hot = np.where(t.distinct == END, START, t.distinct)[(parts > 1) & (c > 0)]
            each = np.log10((c + 0.5) / (uni.total + 0.5 * (uni.distinct + 1)))[t.inverse]
            yield {"chunk": [chunk], "doc_id": [ids], "held": [held], "size": [size], "text": [text], "counts": [squeeze(c)],
                   "parts": [squeeze(parts)], "hot": [hot.view(np.int64)], "n_tokens": [t.n], "n_known": [np.add.reduceat((c > 0)[t.inverse].astype(np.int64), t.begin)],
                   "base": [np.add.reduceat(each, t.begin)]}

    return run


# ------------------------------------------------------------------ bigrams

class Pairs:
    """The distinct bigrams of a chunk: indices of their contexts (the last one: the start mark) and words in its distinct tokens,
    ``of`` the bigram of each token. ``sent`` lists those that are sent, in order of ``key`` (round and bucket) and
    context: a context that was never seen in training needs no answer."""

    def __init__(self, t: Tokens, counts: bytes, parts: bytes, buckets: int, rounds: int):
        c, n_parts_ = expand(counts, "<u4").astype(np.int64), expand(parts, "<u4").astype(np.uint64)
        k = len(t.distinct)
        start = int(np.searchsorted(t.distinct, END))  # as many first words as ends
        ctx = np.empty(len(t.token), np.int64)
        ctx[1:] = t.inverse[:-1]
        ctx[t.begin] = k
        code, self.of = np.unique(ctx * (k + 1) + t.inverse, return_inverse=True)
        self.ctx, self.word = np.divmod(code, k + 1)
        self.head, self.c_head = np.append(t.distinct, START), np.append(c, c[start])
        self.parts = np.append(n_parts_, n_parts_[start])
        self.c_word = c[self.word]
        part = mixed(t.distinct[self.word]) % self.parts[self.ctx]
        place = mixed(self.head[self.ctx] + part * np.uint64(0xD6E8FEB86659FD93))
        r = np.uint64(rounds)
        self.key = (place % r * np.uint64(buckets) + place // r % np.uint64(buckets)).astype(np.int64)
        sent = np.flatnonzero(self.c_head[self.ctx] > 0)
        self.sent = sent[np.argsort(self.key[sent], kind="stable")]

    def heads(self, at: np.ndarray) -> np.ndarray:
        """Where a context, or another bucket, begins in ``at``."""
        if not len(at):
            return np.zeros(0, np.int64)
        return np.flatnonzero(np.concatenate(([True], (np.diff(self.ctx[at]) != 0) | (np.diff(self.key[at]) != 0))))


SENT = "bucket int, chunk long, ctx binary, split binary, n_succ binary, succ binary, c binary, n binary"


def _send_bigrams(buckets: int, rounds: int, turn: int):
    def run(it):
        for chunk, held, size, text, counts, parts in _rows_of(it, "chunk", "held", "size", "text", "counts", "parts"):
            t = Tokens(size, text, held)
            p = Pairs(t, counts, parts, buckets, rounds)
            train = np.bincount(p.of[~t.held[t.doc]], minlength=len(p.ctx)).astype(np.uint32)
            cuts = np.searchsorted(p.key[p.sent], np.arange(turn * buckets, (turn + 1) * buckets + 1))
            out = {x.split()[0]: [] for x in SENT.split(", ")}
            for x in range(buckets):
                at = p.sent[cuts[x]:cuts[x + 1]]
                if not len(at):
                    continue
                first = p.heads(at)
                ctx = p.ctx[at][first]
                row = (x, chunk, squeeze(p.head[ctx]), squeeze((p.parts[ctx] > 1).astype(np.uint8)),
                       squeeze(np.diff(np.append(first, len(at))).astype(np.uint32)), squeeze(t.distinct[p.word[at]] & LOW48, 6),
                       squeeze(p.c_word[at].astype(np.uint32)), squeeze(train[at]))
                for k, v in zip(out, row):
                    out[k].append(v)
            yield out

    return run


ANSWERS = ("kind int, turn int, bucket int, chunk long, context long, c_h long, lower double, successors array<long>, "
           "counts array<int>, n array<long>, seen binary, above binary, classes binary, lowers binary")


def _count_bigrams(uni: Unigrams, turn: int):
    """Per bucket: the bigram table (kind 0), counts of counts (1), the answers to the chunks (2) and the sums
    of the parts of frequent contexts (3)."""

    def run(it):
        for g in sorted_groups(it, ["bucket"]):
            col = lambda name, dtype, keep=None: [expand(x, dtype, keep) for x in g.column(name).to_pylist()]
            heads = col("ctx", "<u8")
            of_head = np.cumsum([0] + [len(x) for x in heads])
            n_succ, split = np.concatenate(col("n_succ", "<u4")).astype(np.int64), np.concatenate(col("split", "u1")).astype(bool)
            words = col("succ", "<u8", 6)
            of_pair = np.cumsum([0] + [len(x) for x in words])
            w, cw, n = np.concatenate(words), np.concatenate(col("c", "<u4")), np.concatenate(col("n", "<u4"))
            ctx = np.repeat(np.concatenate(heads), n_succ)
            order = np.lexsort((w, ctx))
            cs, ws = ctx[order], w[order]
            new_h = np.concatenate(([True], cs[1:] != cs[:-1]))
            new = new_h | np.concatenate(([True], ws[1:] != ws[:-1]))
            pid = np.empty(len(ctx), np.int64)
            pid[order] = np.cumsum(new) - 1
            at = np.flatnonzero(new)
            hid = np.cumsum(new_h)[at] - 1  # the context of each distinct bigram
            c = np.bincount(pid, weights=n, minlength=len(at)).astype(np.int64)
            lower_w = uni.p(cw[order][at])
            heads_at = np.flatnonzero(new_h)
            k = len(heads_at)
            c_h = np.bincount(hid, weights=c, minlength=k).astype(np.int64)
            lower = np.bincount(hid, weights=np.where(c > 0, lower_w, 0.0), minlength=k)
            m = np.stack([np.bincount(hid[c == x], minlength=k) for x in range(1, K + 1)])
            known = np.flatnonzero(c_h)
            succ = np.flatnonzero(c)
            contexts = cs[heads_at].view(np.int64)
            offsets = np.concatenate(([0], np.cumsum(np.bincount(hid[succ], minlength=k)[known]))).astype(np.int32)
            as_list = lambda v, t: pa.ListArray.from_arrays(pa.array(offsets), pa.array(v, t))
            yield dict(kind=np.zeros(len(known), np.int32), context=contexts[known], c_h=c_h[known], lower=lower[known],
                       successors=as_list(ws[at][succ].view(np.int64), pa.int64()), counts=as_list(c[succ], pa.int32()))
            yield dict(kind=[1], n=[[0] + [int((c == x).sum()) for x in range(1, K + 2)]])
            first = np.cumsum(n_succ) - n_succ
            head = hid[pid[first]]  # the context of each head that was sent
            cut = np.zeros(k, bool)
            cut[head] = split
            cut = np.flatnonzero(cut)
            if len(cut):
                yield dict(kind=np.full(len(cut), 3, np.int32), context=contexts[cut], lower=lower[cut], n=m.T[cut].tolist())
            # Counts of every bigram; of contexts in one part whether all counts are above K, and with unseen bigrams the sums.
            co = c[pid].astype(np.uint32)
            above = (m.sum(axis=0) == 0)[head]
            wanted = (np.minimum.reduceat(co, first) == 0) & ~split
            rows = []
            for s, e, hs, he in zip(of_pair[:-1], of_pair[1:], of_head[:-1], of_head[1:]):
                x = head[hs:he][wanted[hs:he]]
                rows.append((squeeze(co[s:e]), np.packbits(above[hs:he]).tobytes(), squeeze(m[:, x].astype(np.uint32).ravel()), squeeze(lower[x])))
            bucket, j = g.column("bucket")[0].as_py(), len(rows)
            yield dict(kind=[2] * j, turn=[turn] * j, bucket=[bucket] * j, chunk=g.column("chunk").to_pylist(),
                       **{name: [r[i] for r in rows] for i, name in enumerate(("seen", "above", "classes", "lowers"))})

    return run


def _scores(uni: Unigrams, d: np.ndarray, buckets: int, rounds: int):
    log_d = np.log10(d)

    def run(it):
        for ids, held, size, text, counts, parts, n_tokens, n_known, base, answers, sums in _rows_of(
                it, "doc_id", "held", "size", "text", "counts", "parts", "n_tokens", "n_known", "base", "answers", "sums"):
            t = Tokens(size, text, held)
            p = Pairs(t, counts, parts, buckets, rounds)
            each = np.log10(uni.p(p.c_word))
            if len(p.sent):
                answers = sorted(answers, key=lambda a: (a["turn"], a["bucket"]))
                c = np.concatenate([expand(a["seen"], "<u4") for a in answers]).astype(np.int64)
                first = p.heads(p.sent)
                n_succ = np.diff(np.append(first, len(c)))
                ctx = p.ctx[p.sent][first]
                split = p.parts[ctx] > 1
                # Heads per answer: those of each bucket.
                n_heads = np.unique(p.key[p.sent][first], return_counts=True)[1]
                above = np.concatenate([np.unpackbits(np.frombuffer(a["above"], np.uint8), count=n) for a, n in zip(answers, n_heads)]).astype(bool)
                wanted = (np.minimum.reduceat(c, first) == 0) & ~split
                m, lower = np.zeros((K, len(ctx))), np.zeros(len(ctx))
                m[:, wanted] = np.concatenate([expand(a["classes"], "<u4").reshape(K, -1) for a in answers], axis=1)
                lower[wanted] = np.concatenate([expand(a["lowers"], "<f8") for a in answers])
                if split.any():
                    sums = sorted(sums, key=lambda x: x["context"])
                    at = np.searchsorted(np.array([x["context"] for x in sums]), p.head[ctx[split]].view(np.int64))
                    m[:, split] = np.array([x["n"] for x in sums], float)[at].T
                    lower[split] = np.array([x["lower"] for x in sums])[at]
                    above[split] = m[:, split].sum(axis=0) == 0
                c_h = p.c_head[ctx]
                whole = np.repeat(np.log10(c_h + above), n_succ)
                unseen = c == 0
                alpha = np.zeros(len(ctx))
                need = np.logical_or.reduceat(unseen, first)
                alpha[need] = log_alpha(d, c_h[need], m[:, need], lower[need])
                seen = np.log10(np.maximum(c, 1)) + np.where(c <= K, log_d[np.minimum(c, K)], 0.0) - whole
                each[p.sent] = np.where(unseen, np.repeat(alpha, n_succ) + each[p.sent], seen)
            n = len(ids)
            yield {"doc_id": ids, "held_out": held, "n_tokens": n_tokens, "n_known": n_known,
                   "train_tokens": np.full(n, uni.total), "base_score": np.array(base, float),
                   "score": np.add.reduceat(each[p.of], t.begin)}

    return run


def _dealt(df: DataFrame, parts: int) -> DataFrame:
    return (df.withColumn("at", F.pmod("bucket", F.lit(parts))).repartition(parts, "at")
            .sortWithinPartitions("bucket", "chunk").drop("at"))


class Model:
    """The stored tables and numbers of a fitted model."""

    def __init__(self, unigrams: DataFrame, bigrams: DataFrame, uni: Unigrams, d: np.ndarray):
        self.unigrams, self.bigrams, self.uni, self.d = unigrams, bigrams, uni, d


def katz_scores(docs: DataFrame, held, rounds: int = ROUNDS, bucket_bytes: int = BUCKET_BYTES,
                hot: int = HOT) -> tuple[DataFrame, Model]:
    """Scores of all documents by the model of those that are not ``held``, and the model."""
    spark = docs.sparkSession
    chunks = stored(_chunks(docs, held), "lm-chunks")
    total = chunks.agg(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    parts = n_parts(spark)
    buckets = int(total // bucket_bytes + 1)
    parts = min(parts, buckets) if buckets < parts else parts

    sent = map_arrow(chunks, _send_words(buckets), "bucket int, chunk long, a binary, b binary, o binary")
    words = stored(map_arrow(_dealt(sent, parts), _count_words(hot),
                             "kind int, bucket int, chunk long, token long, c long, answer binary, parts binary"), "lm-words", ["kind"])
    unigrams = words.where("kind = 0").select("bucket", "token", "c")
    n, distinct, *low = unigrams.agg(F.sum("c"), F.count(F.lit(1)), *[F.sum((F.col("c") == x).cast("long")) for x in range(1, K + 2)]).first()
    uni = Unigrams(n or 0, distinct, [0, *[x or 0 for x in low]])
    answers = words.where("kind = 1").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "answer", "parts")).alias("answers"))
    noted = stored(map_arrow(chunks.join(answers, "chunk"), _annotate(buckets, uni), ANNOTATED), "lm-annotated")
    drop_stored(chunks)

    results = None
    per_round = max(1, -(-buckets // rounds))
    for turn in range(rounds):
        sent = map_arrow(noted.select("chunk", "held", "size", "text", "counts", "parts"), _send_bigrams(per_round, rounds, turn), SENT)
        part = stored(map_arrow(_dealt(sent, min(parts, per_round)), _count_bigrams(uni, turn), ANSWERS), "lm-bigrams", ["kind"])
        results = part if results is None else results.unionByName(part)
    counts = [r[0] or 0 for r in results.where("kind = 1").select(F.posexplode("n")).groupBy("pos").agg(F.sum("col").alias("s"))
              .orderBy("pos").select("s").collect()] or [0] * (K + 2)
    model = Model(unigrams, results.where("kind = 0").select("context", "c_h", "lower", "successors", "counts"), uni, discounts(counts))
    per_chunk = (results.where("kind = 2").groupBy("chunk")
                 .agg(F.collect_list(F.struct("turn", "bucket", "seen", "above", "classes", "lowers")).alias("answers")))
    # Contexts in several parts: at most one in ``hot`` tokens is one.
    sums = (results.where("kind = 3").groupBy("context")
            .agg(F.sum("lower").alias("lower"), F.array(*[F.sum(F.col("n")[i]) for i in range(K)]).alias("n")))
    asked = noted.select("chunk", F.explode("hot").alias("context")).join(sums, "context")
    asked = asked.groupBy("chunk").agg(F.collect_list(F.struct("context", "lower", "n")).alias("sums"))
    docs_of = noted.drop("hot").join(per_chunk, "chunk", "left").join(asked, "chunk", "left")
    scored = map_arrow(docs_of, _scores(uni, model.d, per_round, rounds),
                       "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored, model


def op3_query(docs: DataFrame) -> DataFrame:
    """Training documents: those whose crc32 of the id as text, modulo 5, is not 1."""
    return katz_scores(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 1)[0]
