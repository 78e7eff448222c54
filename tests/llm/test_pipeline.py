"""The corpus pipeline stage by stage and whole, and inputs that once gave wrong results."""

import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from brute import edits_inside, jaccard_classes, warc
from llm_paths import SMALL
from pyspark.sql import functions as F

import corpus_pipeline as P
from surveyframe.llm import decontam, langid, packing, pii, setjoin, substring
from surveyframe.llm import warc as W
from surveyframe.llm.common import work_dir

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n, vocabulary):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(vocabulary) for _ in range(n))


EN = ["the", "thing", "other", "ation", "which", "shorter", "inking", "house", "water", "within"]
DE = ["schloss", "keitung", "über", "einheit", "straße", "wortlich", "zwischen", "nicht", "heiter", "vögel"]
ITEM = " ".join(f"question{i} about{i * 7 % 13}" for i in range(30))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with everything that a stage decides on, some awkward rows, and a benchmark."""
    rows = [(i, words(i, 60, EN if i % 2 else DE), "en" if i % 2 else "de") for i in range(1, 81)]
    base = words(500, 120, EN)
    rows += [(100, base, "en"), (101, base, "en"), (102, base + " tail", "en"), (101, base, "en")]
    rows += [(110, words(7, 30, EN) + " " + ITEM + " " + words(8, 30, EN), "en"), (111, ITEM.upper(), "en")]
    rows += [(120, words(9, 40, EN) + " write to some.one@mail.org now", "en"), (130, "漢字漢字漢字", None), (131, None, None), (132, "", "en"),
             (133, "12 34 ...", "en"), (None, words(10, 50, DE), "de"), (140, words(11, 5000, DE), "de")]
    df = spark.createDataFrame([(d, t, lang, "s", None if t is None else len(t)) for d, t, lang in rows], DOC)
    folder = str(tmp_path_factory.mktemp("corpus"))
    df.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, df


def ids(df):
    return sorted((r.doc_id if r.doc_id is not None else -1 for r in df.select("doc_id").collect()))


def test_stages_against_plain_versions(spark, corpus):
    folder, df = corpus
    rows = {(r.doc_id, r.text) for r in df.collect()}
    kept = P.language_id(spark, df, folder)
    assert kept.columns == df.columns
    gone = {d for d, _ in rows} - {r.doc_id for r in kept.collect()}
    assert gone == {130, 131, 132, 133}  # nothing in common with a label's texts, or no letter

    joined = P.ngram_join(spark, kept, folder)
    assert joined.columns == df.columns
    source = [(r.doc_id, r.text) for r in kept.collect()]
    classes = jaccard_classes(source)
    assert len(ids(joined)) == len({c[1] for c in classes}) and 102 not in ids(joined) and ids(joined).count(101) == 0

    clean = P.decontaminate(spark, joined, folder)
    assert clean.columns == df.columns
    assert set(ids(joined)) - set(ids(clean)) == {110} | ({111} & set(ids(joined)) - set(ids(clean)))
    leaking = {d for d, t in rows if t and ITEM in t}
    assert leaking.isdisjoint(ids(clean))

    masked = P.mask_pii(spark, clean, folder)
    assert masked.columns == df.columns and ids(masked) == ids(clean)
    one = masked.where("doc_id = 120").first()
    assert one.text.endswith("write to [EMAIL] now") and one.n_chars == len(one.text)
    before = {r.doc_id: r.text for r in clean.collect()}
    assert all(r.text == before[r.doc_id] for r in masked.collect() if r.doc_id != 120)

    packed = P.best_fit_packing(spark, masked, folder).collect()
    per = {}
    for r in packed:
        per.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in x) <= 2048 and [o for o, _ in sorted(x)] == [sum(n for _, n in sorted(x)[:i]) for i in range(len(x))]
               for x in per.values())
    assert {r.doc_id for r in packed} == {r.doc_id for r in masked.collect()}
    whole = {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in P.run(spark, folder).collect()}
    assert whole == {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed}


def test_stages_on_an_empty_table_and_clashing_columns(spark, corpus, tmp_path):
    folder, df = corpus
    empty = df.limit(0)
    wide = df.withColumn("uid", F.lit(1)).withColumn("row", F.lit("r")).withColumn("score", F.lit(2.0)).withColumn("a.b", F.lit(3))
    wide = wide.withColumn("pii", F.lit(4)).withColumn("rep", F.lit(5)).withColumn("orig", F.lit(6))
    for name, stage in P.STAGES:
        assert stage(spark, empty, folder).count() == 0, name
        if name != "best_fit_packing":
            assert stage(spark, wide, folder).columns == wide.columns, name
            assert stage(spark, wide, folder).count() > 80, name
        else:
            assert stage(spark, wide, folder).count() > 80


def test_equal_places_of_one_id_do_not_depend_on_the_partitioning(spark, tmp_path):
    p = words(1, 400, [f"w{i}" for i in range(5000)])
    rows = [(1, p), (2, p + " x1 x2"), (2, p + " y1 y2")]
    for cut in ([[0], [1, 2]], [[0, 1, 2]], [[0, 1], [2]], [[1, 2], [0]]):
        folder = str(tmp_path / "-".join("".join(map(str, x)) for x in cut))
        for part in cut:
            spark.createDataFrame([rows[i] for i in part], "doc_id long, text string").coalesce(1).write.mode("append").parquet(folder)
        got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring.op9_query(spark.read.parquet(folder)).collect())
        assert got == [(1, 400, 0), (2, 402, 400), (2, 402, 400)], cut


def test_every_language_is_learned_and_ids_may_be_null(spark):
    rnd = random.Random(1)
    rows = []
    for k in range(70):
        letters = [chr(0x4E00 + 40 * k + i) for i in range(8)]  # a script of its own
        rows += [(None if k % 2 else 1000 * k + i, "".join(rnd.choice(letters) for _ in range(30)) + str(i), f"l{k:02}", "s", 30) for i in range(6)]
    docs = spark.createDataFrame(rows, DOC)
    got = langid.predict(docs, langid.fit(docs)).collect()
    assert all(r.lang_pred == r.lang for r in got) and len({r.lang_pred for r in got}) == 70


def test_language_scores_are_those_of_plain_kernel_ridge(spark):
    rows = [(i, words(i, 12, EN if i % 2 else DE), "en" if i % 2 else "de", "s", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, DOC)
    model = langid.fit(docs)
    h = {(r.text, r.h) for r in docs.select("text", F.xxhash64("doc_id", "text").alias("h")).collect()}
    train = [t for t, _ in sorted(h, key=lambda x: x[1])]
    lang = {r[1]: r[2] for r in rows}

    def grams(t):
        t = t.lower()
        return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    marks = [t for name in ("de", "en") for t in [x for x in train if lang[x] == name][:64]]
    known = set().union(*[grams(t) for t in marks])
    unit = lambda t: (grams(t) & known, np.sqrt(max(len(grams(t) & known), 1)))
    kernel = lambda a, b: len(unit(a)[0] & unit(b)[0]) / unit(a)[1] / unit(b)[1]
    k = np.array([[kernel(a, b) for b in marks] for a in marks])
    val, vec = np.linalg.eigh(k)
    keep = val > 1e-6 * val.max()
    white = vec[:, keep] / np.sqrt(val[keep])
    x = np.array([[kernel(a, b) for b in marks] for a in train]) @ white
    y = np.array([[1.0 if lang[t] == n else -1.0 for n in ("de", "en")] for t in train])
    coef = np.linalg.solve(x.T @ x + langid.RIDGE * len(x) * np.eye(x.shape[1]), x.T @ (y - y.mean(axis=0)))
    probe = [words(900 + i, 9, EN + DE[:i % 5]) for i in range(12)] + ["漢字"]
    want = np.array([[kernel(a, b) for b in marks] for a in probe]) @ white @ coef + y.mean(axis=0)
    assert np.allclose(model.margins(probe), want, atol=1e-4)
    got = langid.predict(spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(probe)], DOC), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == [("de", "en")[i] for i in want.argmax(axis=1)]


def test_decontamination_of_a_repetitive_text_takes_bounded_memory():
    items = decontam.Items([1], ["ab " * 100], decontam.Q, decontam.EDIT_RATE)
    peak = []
    for n in (20_000, 160_000):
        tracemalloc.start()
        found = items.find(["ab " * (n // 3)])
        peak.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert found
    assert peak[1] < 2 * peak[0] + (64 << 20)


def test_edited_items_are_found_whatever_the_slices(spark):
    rnd = random.Random(6)
    item = words(3, 60, EN + DE)
    items = decontam.Items([1], [item], decontam.Q, decontam.EDIT_RATE)
    for i in range(30):
        t = list(item)
        for _ in range(i % 6):
            t[rnd.randrange(len(t))] = rnd.choice("xyz")
        text = words(i, 50, DE) + " " + "".join(t) + " " + words(i + 1, 50, EN)
        assert bool(items.find([text])) == (edits_inside(item, text) <= items.k[0]), i
    big = words(1, 400, EN) + " " + item
    whole = items.find([big])
    few = decontam.Items.hits
    try:
        decontam.Items.hits = lambda self, c, most=16: few(self, c, most)
        assert items.find([big]) == whole
    finally:
        decontam.Items.hits = few


def test_warc_is_read_in_as_many_tasks_as_archives(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i % 7}</p>") for i in range(200)], "page_id long, url string, html string").repartition(9)
    folder = work_dir(spark, "warc")
    listing = W.write_archives(W.plan_records(pages, hot_rows=20), folder, archive_bytes=512)
    assert listing.count() > 9
    back = W.read_archives(listing, folder)
    parts = back.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > listing.count() // 2
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back.collect())
    assert got == warc([(i, f"<p>{i % 7}</p>") for i in range(200)])


def test_added_tokens_of_the_tokenizer_become_their_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "plain words here")], "doc_id long, text string")
    got = {r.doc_id: r.length for r in packing.op5_query(docs).collect()}
    assert got == {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in ((1, "a <|endoftext|> b"), (2, "plain words here"))}
    assert 50256 in tok.encode("a <|endoftext|> b", add_special_tokens=False).ids


def test_filter_of_ids_splits_without_loss(spark):
    rows = spark.range(5000).select(F.col("id").alias("uid"), F.lit("t").alias("x"))
    ids_ = spark.range(0, 5000, 7).select(F.col("id").alias("uid"))
    for blocks in (1 << 21, 4):
        maybe, never = setjoin.split_by_ids(rows, ids_, blocks)
        a, b = {r.uid for r in maybe.collect()}, {r.uid for r in never.collect()}
        assert a | b == set(range(5000)) and not a & b and set(range(0, 5000, 7)) <= a
        assert blocks == 4 or len(a) < 1000
