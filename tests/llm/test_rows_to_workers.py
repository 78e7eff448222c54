"""Whole rows go to Python workers in small batches, each text once."""

import re

import pyarrow as pa
import pytest

import corpus_pipeline as P
from surveyframe.llm import decontam, setjoin
from surveyframe.llm.common import BATCH_BYTES, BATCH_SETTING

ITEM = "which harbour keeps the seven lanterns burning while the tide is out"


@pytest.fixture
def unset(spark):
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.unset(BATCH_SETTING)
    yield
    spark.conf.unset(BATCH_SETTING)
    if before is not None:
        spark.conf.set(BATCH_SETTING, before)


def docs(spark):
    # The text is not the second column, and other columns have names that the operators use themselves.
    rows = [(f"the water within the house {i} is still" if i % 2 else f"das schloss zwischen {i} straßen über der einheit", i,
             "en" if i % 2 else "de", "x", 1.0, True) for i in range(1, 31)]
    rows += [(f"so {ITEM} again", 31, "en", "y", 2.0, None), (None, 32, None, None, None, None), ("漢字", 33, None, "z", None, False)]
    return spark.createDataFrame(rows, "Text string, doc_id long, lang string, `a.b` string, score double, row boolean")


def test_batches_are_small_and_a_set_size_stays(spark, unset):
    def count_rows(it):
        for b in it:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    wide = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) t")
    for use in (lambda d: decontam.mark_leaks(d, spark.createDataFrame([(1, ITEM)], "item_id long, text string"), "bad"),
                setjoin.keep_one, lambda d: P.language_id(spark, d, "")):
        spark.conf.unset(BATCH_SETTING)
        use(docs(spark).withColumnRenamed("Text", "text"))
        assert spark.conf.get(BATCH_SETTING) == BATCH_BYTES
        assert max(r.n for r in wide.mapInArrow(count_rows, "n long").collect()) <= 500
    spark.conf.set(BATCH_SETTING, "9m")
    decontam.mark_leaks(docs(spark), spark.createDataFrame([(1, ITEM)], "item_id long, text string"), "bad", text="Text")
    assert spark.conf.get(BATCH_SETTING) == "9m"


def test_a_text_is_sent_once_and_rows_keep_their_columns(spark, unset):
    d = docs(spark)
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    marked = decontam.mark_leaks(d, bench, "bad", text="text")
    assert re.search(r"MapInArrow run\(row#\d+, bad#\d+\)", marked._jdf.queryExecution().analyzed().toString())
    assert marked.columns == [*d.columns, "bad"]
    rows = {r.doc_id: r for r in d.collect()}
    got = {r.doc_id: r for r in marked.collect()}
    assert [i for i, r in got.items() if r.bad] == [31] and all(tuple(got[i])[:-1] == tuple(rows[i]) for i in rows)

    kept = P.language_id(spark, d, "")
    assert kept.dtypes == d.dtypes
    sent = kept._jdf.queryExecution().analyzed().toString()
    assert "struct(doc_id" in sent and "struct(Text" not in sent
    got = {r.doc_id: tuple(r) for r in kept.collect()}
    assert set(got) == set(range(1, 32)) and all(got[i] == tuple(rows[i]) for i in got)

    joined = setjoin.keep_one(d)
    assert joined.dtypes == d.dtypes and {r.doc_id: tuple(r) for r in joined.collect()} == {i: tuple(r) for i, r in rows.items()}
