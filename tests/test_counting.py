"""Counting on codes, and quantiles in a fixed number of scans."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from surveyframe.operators import coded, freq, profile, stats
from surveyframe.plans import analyses as A
from surveyframe.plans.consolidate import survey, survey_counts
from surveyframe.plans.queries import QUERIES, TEXT
from surveyframe.sources.raw import raw_from_dir

LABELS = [c for c in TEXT if c.endswith("_desc")]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("fn, labels", [
    (A.qa3_sexo, ["sexo_desc"]), (A.qa1_uf_top, ["uf_desc"]), (A.qa5_escolaridade, ["escolaridade_desc"]),
    (A.qa8_ocupacao_informed, ["PosicaoOcupacao_desc"]), (A.qb1_symptom_prevalence, A.SYMPTOM_COLS),
    (A.qb3_hosp_among_care, [*A.SYMPTOM_COLS, "ProcurouAtendimento_desc", "InternadoHospital_desc"]),
    (A.qc2_away_all_top5, ["AfastadoTrabalho_desc"])])
def test_counted_rows_give_the_same_tables(spark, fn, labels):
    assert rows(fn(survey_counts(spark, SF_SMALL, labels))) == rows(fn(survey(spark, SF_SMALL, only=labels)))


def test_label_counts_equal_counts_of_labels(spark):
    raw = raw_from_dir(spark, SF_SMALL)
    got = coded.label_counts(raw, LABELS, [("ano", F.col("Ano").cast("string"))])
    want = freq.multi_value_counts(survey(spark, SF_SMALL, only=LABELS), LABELS, with_pct=False)
    assert sorted(rows(got.where("measure <> 'ano'"))) == sorted(rows(want))
    assert rows(got.where("measure = 'ano'")) == [("ano", "2020", raw.count())]
    assert rows(profile.summary_of_counts(got.where("measure <> 'ano'").withColumnRenamed("measure", "column"))) == rows(
        profile.describe_categorical(survey(spark, SF_SMALL, only=LABELS)))


def test_codes_that_fall_on_one_label_are_added_up(spark):
    raw = raw_from_dir(spark, SF_SMALL).withColumn("A003", F.when(F.col("A003") == 1, F.lit(77)).otherwise(F.lit(None).cast("long")))
    got = rows(freq.value_counts(coded.counted_labels(raw, coded_dims(spark), ["sexo_desc"]), "sexo_desc"))
    assert got == [("Não Informado", raw.count())]
    assert rows(coded.label_counts(raw, ["sexo_desc"])) == [("sexo_desc", "Não Informado", raw.count())]
    assert rows(coded.label_counts(raw.limit(0), ["sexo_desc"])) == []


def coded_dims(spark):
    from surveyframe.sources.dims import all_dims

    return all_dims(spark)


@pytest.mark.parametrize("name", ["freq_sexo", "freq_uf_top15", "freq_auxilio", "symptom_prevalence", "describe_categorical", "first_look_top15"])
def test_no_join_below_the_first_aggregation(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    last_join = max(i for i, x in enumerate(lines) if "Join" in x and "code" in x or "Join Left" in x)
    scans = [i for i, x in enumerate(lines) if "Relation" in x]
    assert scans and any("Aggregate" in x for x in lines[last_join:scans[-1]]), plan


# ---- quantiles

def counting(spark, df, seen):
    """The frame, with every row that is read from it counted."""
    @F.udf("double")
    def look(x):
        seen.add(1)
        return x

    look = look.asNondeterministic()  # evaluated once a row and scan
    return df.select(*[look(c).alias(c) for c in df.columns])


@pytest.mark.parametrize("few", [0, 50_000])
def test_three_scans_whatever_the_values(spark, few):
    rnd = np.random.default_rng(5)
    n = 20_000
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(rnd.normal(size=n), rnd.integers(0, 5, n), np.exp(rnd.normal(size=n) * 9))],
                               "a double, b double, c double").repartition(7)
    df = df.checkpoint() if spark.sparkContext.getCheckpointDir() else stats.checkpointed(df)
    seen = spark.sparkContext.accumulator(0)
    old, stats.FEW = stats.FEW, few
    try:
        got = {r.column: r for r in stats.describe_numeric(counting(spark, df, seen), ["a"], decimals=None).collect()}
        assert seen.value == 3 * n
        stats.boxplot_stats(counting(spark, df, seen), "a").collect()
        assert seen.value == 6 * n
    finally:
        stats.FEW = old
    want = np.quantile(np.array([r.a for r in df.collect()]), [0.25, 0.5, 0.75])
    assert np.allclose([got["a"].q25, got["a"].q50, got["a"].q75], want, rtol=1e-12)


@pytest.mark.parametrize("few, slack", [(0, 0.01), (0, 0.0), (50_000, 0.0)])
def test_quantiles_stay_exact_when_brackets_miss(spark, few, slack):
    rnd = np.random.default_rng(8)
    vals = np.concatenate((rnd.normal(size=30_000), [math.inf] * 40, [3.0] * 9000))
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(6)
    probs = [0.0, 0.001, 0.3, 0.5, 0.77, 0.9, 1.0]
    got = stats._quantile_values(df, ["x"], probs, 8, slack=slack, few=few)["x"]
    for g, w in zip(got, np.quantile(vals, probs)):
        assert math.isnan(w) or math.isclose(g, w, rel_tol=1e-12)


def test_describe_of_all_numeric_columns_matches_one_by_one(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_tax"]
    every = {r.column: r for r in stats.describe_numeric(li, cols).collect()}
    for c in cols:
        assert tuple(stats.describe(li, c).first()) == tuple(every[c])[1:]
