"""Every operator's query against a plain version, on the small tables and on awkward rows."""

import hashlib
import random

import numpy as np
import pytest
from brute import (edits_inside, jaccard_classes, pieces, pii_base, shingles, substring, vectors, warc)
from llm_paths import MID

from surveyframe.llm import chat, decontam, embeddings, langid, packing, pii, setjoin, substring as sub
from surveyframe.llm import warc as W

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOC)


@pytest.fixture(scope="module")
def mid(spark):
    return spark.read.parquet(f"{MID}/documents.parquet")


@pytest.fixture(scope="module")
def mid_rows(mid):
    return [(r.doc_id, r.text) for r in mid.select("doc_id", "text").collect()]


NEAR = [f"t{i}" for i in range(200)]
ODD = [(1, None), (2, ""), (3, "a"), (4, "a"), (5, "one two three"), (6, "one two three"), (7, LONG), (8, LONG + " z"),
       (None, LONG), (9, " \t\n"), (7, LONG), (10, " ".join(NEAR)), (11, " ".join(NEAR[:100] + ["q"] + NEAR[101:])),
       (12, " ".join(NEAR[:50] + ["q"] + NEAR[51:])), (13, "b " * 3000), (14, "b\n" * 50), (15, "é ñ 漢字 \U0001f600 " * 9)]


# ---- 1
def check_pii(spark, rows):
    got = {(r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.op1_query(docs_of(spark, rows)).collect()}
    want = set()
    for d, t in rows:
        n, joined = pii_base(t)
        want.add((d, hashlib.sha256(joined.encode()).hexdigest(), n["n_email"], n["n_ip"], n["n_card"], n["n_phone"]))
    assert got == want


def test_pii_tables(spark, mid_rows):
    check_pii(spark, mid_rows)


def test_pii_awkward(spark):
    rnd = random.Random(5)
    rows = [*ODD, (100, "a@b.c_d@e.f x@y z@w.. q@r.s.t-u.v"), (101, "1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.1 1.2.3"),
            (102, "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111"), (103, "+1 (555) 010-9999. +12 +1 2 +1-23456789012345678"),
            (104, "DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 ssn 123-45-6789 or 123-45-6789"), (105, "a" * 5_000),
            (106, "1" * 10_000), (107, "+1 " + " " * 5_000), (108, "x@a.b " * 3000), (109, "\U0001f600é a@b.c +4912345678")]
    rows += [(200 + i, "".join(rnd.choice("a1@. -+()9\n") for _ in range(400))) for i in range(150)]
    check_pii(spark, rows)
    spans = {r.doc_id: r.spans for r in pii.op1_query(docs_of(spark, rows)).collect()}
    assert spans[104].endswith("iban:0:27,iban:28:50,ssn:55:66")  # the second number has no context word beside it


def test_pii_time_follows_the_text(spark):
    rows = [(1, "a" * 2_000_000), (2, "1" * 2_000_000), (3, "+1 " + " " * 2_000_000), (4, "x@a.b " * 40_000), (5, "a." * 500_000 + "@")]
    got = {r.doc_id: r.n_email for r in pii.op1_query(docs_of(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 40_000, 5: 0}


def test_redaction_masks_every_span_and_leaves_clean_texts(spark):
    rows = [(1, "write to a.b@c.org or +49 30 1234567, ok"), (2, "nothing here 12"), (3, None), (4, "1.2.3.4 4111 1111 1111 1111")]
    got = {r.doc_id: r.text for r in pii.redact(docs_of(spark, rows)).collect()}
    assert got[1] == "write to [EMAIL] or [PHONE], ok" and got[2] == "nothing here 12" and got[3] is None
    assert not any(c.isdigit() for c in got[4].replace("4 4111", "").split("]")[0])


def test_pii_plan_is_one_projection(spark, mid):
    p = pii.op1_query(mid)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p and "Python" not in p and "Arrow" not in p


# ---- 2
def check_classes(spark, rows, **kw):
    got = setjoin.jaccard_classes(docs_of(spark, rows), **kw).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == jaccard_classes(rows)


def test_classes_tables(spark, mid_rows):
    check_classes(spark, mid_rows)


def test_classes_awkward(spark):
    check_classes(spark, ODD)


def test_classes_large_near_group_in_many_blocks(spark):
    rnd = random.Random(3)
    base = [f"v{i}" for i in range(220)]
    rows = []
    for d in range(260):
        w = list(base)
        for _ in range(rnd.randrange(5)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10 ** 6)}"
        rows.append((d, " ".join(w)))
    check_classes(spark, rows, leaf=16, levels=3, block_shingles=4000)


def test_recall_at_the_last_level():
    """Pairs at the threshold that meet only at the last level, walked down the fixed tree."""
    rng = np.random.default_rng(11)
    pairs, size = 20000, setjoin.SKETCH
    a = rng.integers(0, 2 ** 32, (pairs, size), dtype=np.uint64)
    b = np.where(rng.random((pairs, size)) < setjoin.THRESHOLD, a, rng.integers(0, 2 ** 32, (pairs, size), dtype=np.uint64))
    root, pos = setjoin.roots()
    path, other = (setjoin._child(root[None, :], pos[None, :], x[:, pos]) for x in (a, b))
    who, k = np.nonzero(path == other)
    path = path[who, k]
    for _ in range(setjoin.LEVELS - 1):
        at, pos_ = np.concatenate([np.stack(np.nonzero(setjoin._chosen(path[s:s + 4096], 1 / (setjoin.THRESHOLD * size)))) + [[s], [0]]
                                   for s in range(0, len(path), 4096)], axis=1)
        one, two = (setjoin._child(path[at], pos_, x[who[at], pos_] & np.uint64(255)) for x in (a, b))
        who, path = who[at][one == two], one[one == two]
    lost = 1 - len(np.unique(who)) / pairs
    assert lost <= 1 - setjoin.RECALL + 3 * (0.005 / pairs) ** 0.5
    assert setjoin.miss(pos) <= 1 - setjoin.RECALL
    assert abs(lost - setjoin.miss(pos)) < 0.0016
    # The first fifteen roots, seven of them empty, that were used before.
    assert setjoin.miss(pos[:12]) > 0.012


def test_keep_one(spark):
    docs = docs_of(spark, [r for r in ODD if r[0] is not None]).withColumnRenamed("source", "uid").withColumnRenamed("lang", "n")
    out = setjoin.keep_one(docs)
    assert out.dtypes == docs.dtypes
    kept = {r.doc_id for r in out.collect()}
    assert {1, 2, 3, 5, 7, 9, 10} <= kept and not {4, 6, 8, 11, 12} & kept


# ---- 4
def test_chat(spark):
    conv = "conv_id long, turn long, role string, text string"
    texts = ["", None, "a\\b\\\\", "<s></s>\n", "[INST] [/INST]\n\\a", "<<SYS>>\n\n<</SYS>>\n", "<role>x</role></turn>\n", "< [ \\ </", "é\U0001f600"]
    roles = ["system", "user", "assistant", "tool", None, "<role>", "\\"]
    rnd = random.Random(1)
    rows = [(c, t, rnd.choice(roles), rnd.choice(texts)) for c in range(60) for t in range(rnd.randrange(1, 9))] + [(None, None, "user", "x")]
    rows += [(5000, t, ["user", "assistant"][t % 2], f"turn {t}") for t in range(5000)]
    got = {r.conv_id: r for r in chat.op4_query(spark.createDataFrame(rows, conv)).collect()}
    groups = {}
    for c, t, r, x in [*rows, (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]:
        groups.setdefault(c, []).append((t, r or "", x or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort(key=lambda x: (x[0] is not None, x))
        want = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), want)
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[5000].valid and got[-1].valid


# ---- 5
def test_packing(spark, mid_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = [r for r in mid_rows + [(d + 10 ** 6, t) for d, t in ODD if d is not None] + [
        (5 * 10 ** 6 + i, t) for i, t in enumerate(["a  b", " a", "a ", "a \n b", "\x1c a\x1d b", "a  b", "a b c", "don't it's", "<|endoftext|> x"])]]
    got = packing.op5_query(docs_of(spark, rows)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces(rows, lambda t: tok.encode(t, add_special_tokens=False).ids)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(seqs) <= 1.02 * total / 2048 + 2


def test_plan_places_every_piece():
    rnd = random.Random(2)
    for _ in range(40):
        counts = {rnd.randrange(1, 33): rnd.randrange(1, 9) for _ in range(rnd.randrange(1, 20))}
        fill, seen = {}, {}
        for length, rank, n, first, offset in packing.plan_bins(counts, 32):
            for k in range(n):
                fill.setdefault(first + k, []).append((offset, length))
                seen.setdefault(length, []).append(rank + k)
        assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in counts.items()}
        for b in fill.values():
            at = 0
            for o, n in sorted(b):
                assert o == at
                at += n
            assert at <= 32
            assert sum(3 * n > 32 for _, n in b) <= 2


# ---- 6
def test_langid(spark, mid):
    out = {r.doc_id: r for r in langid.op6_query(mid).collect()}
    truth = {r.doc_id: r.lang for r in mid.collect()}
    held = [d for d, r in out.items() if r.held_out]
    assert len(out) == len(truth) and len(held) > 100
    assert sum(out[d].lang_pred == truth[d] for d in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values())


def test_langid_awkward(spark):
    got = {(r.doc_id, r.lang_pred, r.score) for r in langid.op6_query(docs_of(spark, [(1, None), (2, ""), (3, "12 !"), (4, "hello"), (5, "漢")])).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)} <= got and len(got) == 5
    none = docs_of(spark, [(1, "abc")]).selectExpr("doc_id", "text", "cast(null as string) lang", "1 lang_pred")
    assert langid.op6_query(none).first().lang_pred == "und"


# ---- 7
@pytest.mark.parametrize("least", [0, 3])
def test_warc(spark, least):
    rows = [(i, h) for i, h in enumerate([None, "", "a", "abc", "abc", "é" * 10, "é" * 10, "é" * 10, "x\r\n\r\ny" * 1000])]
    rows += [(100 + i, "hot") for i in range(500)] + [(1000, "z" * 3_000_000)]
    df = spark.createDataFrame([(p, f"http://h/{p}\r\nx", h) for p, h in rows], "page_id long, url string, html string").repartition(7)
    got = sorted(tuple(r) for r in W.op7_query(df, least).collect())
    assert got == warc(rows, least)


def test_warc_tables_and_payloads(spark):
    pages = spark.read.parquet(f"{MID}/pages.parquet")
    rows = [(r.page_id, r.html) for r in pages.collect()]
    assert sorted(tuple(r) for r in W.op7_query(pages).collect()) == warc(rows)
    from surveyframe.llm.common import work_dir

    folder = work_dir(spark, "warc")
    back = W.read_archives(W.write_archives(W.plan_records(pages), folder, 1 << 16), folder)
    whole = {r.page_id: bytes(r.payload).decode() for r in back.collect() if r.record_type == "response"}
    assert whole == {p: h for p, h in rows if p in whole} and len(whole) > 200


def test_warc_reader_rejects_damage():
    raw = W.record("response", "1", "u", W.digest(b"abc"), 3, b"abc", None)
    assert W.parse(raw)[1] == b"abc"
    with pytest.raises(ValueError):
        W.parse(raw.replace(b"abc\r\n", b"abd\r\n"))
    with pytest.raises(ValueError):
        W.parse(raw[:-2])


# ---- 8
def test_leaks(spark, mid):
    bench = spark.read.parquet(f"{MID}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    rows = {r.doc_id: r.text for r in mid.collect()}
    got = {(r.doc_id, r.item_id): r for r in decontam.op8_query(mid, bench).collect()}
    exact = {(d, i) for d, t in rows.items() for i, x in items.items() if x in t}
    assert exact <= set(got) and len(exact) > 5
    for (d, i), r in got.items():
        k = decontam.budget(len(items[i]), decontam.Q, decontam.EDIT_RATE)[0]
        assert edits_inside(items[i].lower().replace("\n", " "), rows[d].lower().replace("\n", " ")) == r.edits <= k


def test_leaks_edited_and_awkward(spark):
    rnd = random.Random(7)
    words = [f"{rnd.choice('abcdefgh')}{rnd.randrange(10 ** 4)}" for _ in range(400)]
    item = " ".join(words[:40])
    edited = list(item)
    for k in range(0, 5):
        edited[20 + 35 * k] = "#"
    cut = item[:60] + item[63:]
    more = item[:90] + "xyz" + item[90:]
    far = "".join("#" if i % 6 == 0 else c for i, c in enumerate(item))
    pre = " ".join(words[100:300])
    rows = [(1, pre + item + pre), (2, "".join(edited)), (3, pre + cut), (4, more + pre), (5, far), (6, pre), (7, None), (8, ""),
            (9, item.upper()), (10, LONG + item.replace(" ", "\n")), (1, item)]
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "  !"), (5, item), (6, "tiny")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.edits) for r in decontam.op8_query(docs_of(spark, rows), bench).collect())
    want = sorted((d, i, e) for i in (1, 5) for d, e in ((1, 0), (1, 0), (2, 5), (3, 3), (4, 3), (9, 0), (10, 0)))
    assert got == want
    small = decontam.find_leaks(docs_of(spark, rows), bench, block_chars=10).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in small) == want
    marked = {(r.doc_id, r.bad) for r in decontam.mark_leaks(docs_of(spark, rows), bench, "bad").collect()}
    assert {d for d, b in marked if b} == {1, 2, 3, 4, 9, 10}


# ---- 9
def check_substring(spark, rows, size=20):
    got = sub.dedup_substrings(docs_of(spark, rows).repartition(5), size, False).collect()
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in got), key=order) == sorted(substring(rows, size), key=order)


def test_substring_tables(spark, mid_rows):
    check_substring(spark, mid_rows)


def test_substring_awkward(spark):
    check_substring(spark, ODD)
    rnd = random.Random(4)
    rows = [(rnd.randrange(80), " ".join(rnd.choice("ab") for _ in range(rnd.randrange(40)))) for _ in range(80)]
    check_substring(spark, rows, 5)
    check_substring(spark, rows, 2)


def test_substring_hot_buckets_are_split(spark):
    rnd = random.Random(6)
    hot = " ".join(f"h{i}" for i in range(30))
    rows = [(d, " ".join([*(f"a{rnd.randrange(50)}" for _ in range(rnd.randrange(12))), hot, f"z{rnd.randrange(20)}"])) for d in range(300)]
    rows += [ODD[i] for i in (6, 7, 10)] + [(None, hot), (5, hot), (5, hot)]
    want = sorted(map(str, substring(rows, 20)))
    for limits in ((1 << 12, 1 << 13), (1 << 9, 1)):
        got = sub.dedup_substrings(docs_of(spark, rows).repartition(5), 20, False, *limits).collect()
        assert sorted(str(tuple(r)) for r in got) == want


# ---- 10
def test_vectors(spark):
    df = spark.read.parquet(f"{MID}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = sorted(tuple(r) for r in embeddings.op10_query(df).collect())
    assert got == vectors(rows)


@pytest.mark.parametrize("block", [8, 64])
def test_vectors_awkward(spark, block):
    rnd = np.random.default_rng(1)
    rows = []
    for i in range(300):
        base = np.eye(6)[i % 6] + (0.12 if i % 3 else 0.4) * rnd.normal(size=6) * rnd.random()
        rows.append((i, (base * 10.0 ** rnd.integers(-3, 3)).tolist(), i % 2))
    rows += [(400, None, 1), (401, [0.0] * 6, 1), (402, [float("nan")] * 6, 1), (403, [None] + [1.0] * 5, 1), (404, rows[0][1], None),
             (405, [], 1), (406, [1.0, 2.0], 1), (406, [1.0, 2.0], 1), (407, [float("inf")] * 6, 1), (None, rows[0][1], 0)]
    rows += [(500 + i, rows[0][1], 0) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embeddings.near_duplicates(df, max_pivots=16, block=block).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[1])) == vectors(rows)


def test_empty_tables(spark):
    d = docs_of(spark, [])
    v = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    c = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    p = spark.createDataFrame([], "page_id long, url string, html string")
    b = spark.createDataFrame([], "item_id long, text string")
    for out in (pii.op1_query(d), setjoin.op2_query(d), packing.op5_query(d), langid.op6_query(d), W.op7_query(p),
                decontam.op8_query(d, b), sub.op9_query(d), embeddings.op10_query(v)):
        assert out.collect() == []
    assert [r.conv_id for r in chat.op4_query(c).collect()] == [-1]


def test_shingles_definition():
    assert len(shingles("a b c d e f")) == 2 and len(setjoin.shingle_sets(["a b c d e f"])[0]) == 2
