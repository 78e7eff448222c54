"""A corpus pipeline: language ID, n-gram Jaccard join, benchmark decontamination, PII, packing.

Every stage is ``f(spark, docs, sf_dir) -> DataFrame``; its rows are written as
Parquet and reread as the next stage's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyframe.llm import decontam, langid, packing, pii, setjoin
from surveyframe.llm.common import drop_stored, place_of, small_batches, stored

#: A document goes when its language is ``und`` or its score is not this far above that of a text which shares nothing
#: with any landmark of the fitted model.
LANG_MARGIN = 0.01


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null and empty texts and texts without letters go."""
    train = docs.where(~F.coalesce(langid.held_out(4, 2), F.lit(False)))
    small_batches(spark)
    at = place_of(docs, "text")
    rest = [f"`{c}`" for c in docs.columns[:at] + docs.columns[at + 1:]]
    named = docs.select(F.struct(*rest).alias("row"), "text")
    model = langid.fit(train.select("doc_id", "text", "lang"))
    least = model.nothing + LANG_MARGIN if model else 0.0
    kept = langid.predict(named, model).where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return kept.select(*[f"row.{c}" for c in rest[:at]], F.col("text").alias(docs.columns[at]), *[f"row.{c}" for c in rest[at:]])


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies (five-word shingles, Jaccard of 0.8 or more)."""
    return setjoin.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.mark_leaks(docs, benchmark, "__leak").where("not __leak").drop("__leak")


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found personal data replaced by its kind; ``n_chars`` follows changed texts."""
    out = pii.redact(docs.withColumn("__before", F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col("__before"))
    return (out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*[f"`{c}`" for c in docs.columns]))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 2048."""
    return packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("ngram_join", ngram_join), ("decontamination", decontaminate),
          ("pii", mask_pii), ("best_fit_packing", best_fit_packing)]

#: Min-hashing, edit distances and tokenizers are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
            if before is not None:
                drop_stored(before)
            before = docs
    return docs
