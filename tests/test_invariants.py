"""Invariants on the registered queries over the whole sf0.001 tables."""

import math

from pyspark.sql import functions as F

import __spark_entry__ as E
from surveyframe.plans.queries import QUERIES
from conftest import SF_SMALL
from surveyframe.plans.consolidate import survey

Q = QUERIES


def test_histogram_counts_sum_to_non_null_rows(spark):
    n = survey(spark, SF_SMALL, only=["Idade"]).where(F.col("Idade").isNotNull()).count()
    for name in ("hist_age_30", "hist_age_20"):
        rows = Q[name](spark, SF_SMALL).collect()
        assert sum(r.n for r in rows) == n
        assert all(math.isclose(a.hi, b.lo) for a, b in zip(rows, rows[1:]))


def test_shares_and_crosstab_rows_sum_to_100(spark):
    for name in ("freq_sexo", "freq_cor_raca", "freq_auxilio", "care_among_symptomatic", "hosp_among_care"):
        assert math.isclose(sum(r.pct for r in Q[name](spark, SF_SMALL).collect()), 100.0)
    for r in Q["crosstab_plan_care"](spark, SF_SMALL).collect():
        assert math.isclose(sum(v for k, v in r.asDict().items() if k != "PlanoSaude_desc"), 100.0)
    for r in Q["crosstab_income_hosp"](spark, SF_SMALL).collect():
        d = r.asDict()
        assert math.isclose(d["Sim, ficou internado"] + d["Não, não ficou internado"], 100.0)


def test_trend_rates_are_percentages(spark):
    for name in ("trend_symptoms", "trend_care", "trend_work_aid"):
        for r in Q[name](spark, SF_SMALL).collect():
            for k, v in r.asDict().items():
                if isinstance(v, float):
                    assert 0.0 <= v <= 100.0


def test_profile_bands_cover_care_seekers(spark):
    rows = Q["profile_care_seekers"](spark, SF_SMALL).collect()
    ages = sum(r.n for r in rows if r.dimensao == "faixa_etaria")
    sexes = sum(r.n for r in rows if r.dimensao == "sexo")
    df = survey(spark, SF_SMALL, only=["Febre_desc", "Tosse_desc", "DificuldadeRespirar_desc",
                                       "PerdaOlfatoPaladar_desc", "ProcurouAtendimento_desc", "Idade"])
    care = df.where("ProcurouAtendimento_desc = 'Sim' AND (Febre_desc = 'Sim' OR Tosse_desc = 'Sim' OR "
                    "DificuldadeRespirar_desc = 'Sim' OR PerdaOlfatoPaladar_desc = 'Sim')")
    assert sexes == care.count()
    assert ages == care.where("Idade BETWEEN 0 AND 120").count()
    assert len([r for r in rows if r.dimensao == "faixa_etaria"]) == 5


def test_decode_keeps_row_count_and_kpi_total(spark):
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert Q["kpi_row"](spark, SF_SMALL).first().respondentes == n
    assert sum(r.n for r in Q["survey_consolidated_counts"](spark, SF_SMALL).collect()) == n
