"""Operator 3 against a plain version; every distribution sums to one."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_paths import MID
from pyspark.sql import functions as F
from test_operators_small import DOC, ODD, docs_of

from surveyframe.llm import katz
from brute import WORD


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 5 == 1


class Plain:
    def __init__(self, rows):
        self.uni, self.bi = Counter(), defaultdict(Counter)
        for d, t in rows:
            if not held(d):
                seq = self.tokens(t)
                self.uni.update(seq)
                for h, w in zip([0, *seq], seq):
                    self.bi[h][w] += 1
        self.n = sum(self.uni.values())
        n1 = Counter(self.uni.values())
        n2 = Counter(c for x in self.bi.values() for c in x.values())
        self.d1, self.d2 = (katz.discounts([0] + [n[i] for i in range(1, 7)]) for n in (n1, n2))

    @staticmethod
    def tokens(t):
        return [*WORD.findall(lower(t or "")), 1]

    def disc(self, d, c):
        return d[c] * c if c <= katz.K else c

    def dist(self, counts, d):
        total = sum(counts.values())
        mass = {w: self.disc(d, c) for w, c in counts.items()}
        left = total - sum(mass.values())
        if not any(c <= katz.K for c in counts.values()):
            total, left = total + 1, 1
        return {w: x / total for w, x in mass.items()}, left / total

    def fit(self):
        self.p1, self.unknown = self.dist(self.uni, self.d1) if self.n else ({}, 1.0)
        self.cond = {}
        for h, c in self.bi.items():
            p, left = self.dist(c, self.d2)
            self.cond[h] = p, left / (1 - sum(self.p1[w] for w in p))
        return self

    def p(self, h, w):
        lower_p = self.p1.get(w, self.unknown)
        if h not in self.cond:
            return lower_p
        seen, alpha = self.cond[h]
        return seen[w] if w in seen else alpha * lower_p

    def score(self, t):
        seq = self.tokens(t)
        return sum(np.log10(self.p(h, w)) for h, w in zip([0, *seq], seq))


def check(spark, df, rows, **kw):
    plain = Plain(rows).fit()
    for h in list(plain.cond)[:40]:
        vocabulary = [*plain.p1, None]
        assert sum(plain.p(h, w) for w in vocabulary) == pytest.approx(1)
    scored, model = katz.katz_scores(df, F.crc32(F.col("doc_id").cast("string")) % 5 == 1, **kw)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in scored.collect()),
                 key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    want = []
    for d, t in rows:
        seq = plain.tokens(t)
        base = sum(np.log10((plain.uni[w] + 0.5) / (plain.n + 0.5 * (len(plain.uni) + 1))) for w in seq)
        want.append((d, held(d), len(seq), sum(plain.uni[w] > 0 for w in seq), plain.n, base, plain.score(t)))
    want.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for k in (5, 6):
        np.testing.assert_allclose([r[k] for r in got], [r[k] for r in want], rtol=1e-9, atol=1e-9)
    return plain, model, got


def test_tables(spark):
    df = spark.read.parquet(f"{MID}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    plain, model, got = check(spark, df, rows, bucket_bytes=200_000)
    assert model.unigrams.count() == len(plain.uni)
    assert model.bigrams.agg(F.sum(F.size("successors"))).first()[0] == sum(map(len, plain.bi.values()))
    out = [r for r in got if r[1]]
    assert sum(r[6] for r in out) > sum(r[5] for r in out)


def test_awkward(spark):
    rows = [*ODD, *[(100 + i, "a b c A B") for i in range(40)], (200, "Ä a\x1cb"), (201, "never seen words here")]
    check(spark, docs_of(spark, rows), rows)


def test_without_training_text(spark):
    ids = [i for i in range(200) if held(i)][:3]
    rows = [(i, "x y") for i in ids]
    _, _, got = check(spark, docs_of(spark, rows), rows)
    assert all(r[6] == 0 for r in got)
    assert katz.op3_query(spark.createDataFrame([], DOC)).collect() == []


def test_frequent_contexts_are_dealt_over_buckets(spark):
    """The successors of a context that holds a third of all tokens, and of the start mark, lie in several bounded rows."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"the w{x} v{x % 7}" for x in rng.integers(0, 400, 30))) for i in range(120)]
    plain, model, _ = check(spark, docs_of(spark, rows), rows, bucket_bytes=4000, hot=200)
    parts = model.bigrams.groupBy("context").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.size("successors")).alias("n"), F.max(F.size("successors")).alias("most")).collect()
    the = max(parts, key=lambda r: r.n)
    assert the.n == len(plain.bi["the"]) and the.rows > 8 and the.most < the.n / 5
    assert sum(r.n for r in parts) == sum(map(len, plain.bi.values()))
    everywhere = [(i, "the the the a the the b") for i in range(60)]
    check(spark, docs_of(spark, everywhere), everywhere, bucket_bytes=500, hot=3)
    check(spark, docs_of(spark, ODD), ODD, bucket_bytes=4000, hot=1)
