"""Every registered query plans without Python evaluation, cross/nested-loop joins or
sort-merge joins; survey queries plan only the decode joins they need."""

import pytest

import __spark_entry__ as E
from surveyframe.plans.queries import QUERIES
from conftest import SF_SMALL
from surveyframe.plans.inspect import plan_summary

QS = QUERIES
# queries whose first pass runs eagerly (bounded statistics) are still plannable
PLAN_ONLY = sorted(QS)


@pytest.mark.parametrize("name", PLAN_ONLY)
def test_plan_has_no_python_or_cross_joins(spark, name):
    s = plan_summary(QS[name](spark, SF_SMALL))
    assert s["forbidden"] == [], s
    assert s["sort_merge_joins"] == 0, s


def test_pruned_decode_join_counts(spark):
    assert plan_summary(QS["freq_ocupacao_informed"](spark, SF_SMALL))["broadcast_hash_joins"] == 1
    assert plan_summary(QS["trend_care"](spark, SF_SMALL))["broadcast_hash_joins"] == 5
    assert plan_summary(QS["survey_processed"](spark, SF_SMALL))["broadcast_hash_joins"] == 16


def test_labels_are_joined_after_the_ends_are_taken(spark):
    assert plan_summary(QS["completeness"](spark, SF_SMALL))["broadcast_hash_joins"] == 0
    plan = QS["sample_first_last"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("BroadcastHashJoin") < plan.index("TakeOrderedAndProject")


def test_hot_key_is_combined_map_side(spark):
    """One key holding a third of the rows: every aggregation is partial before
    its shuffle, so the hot key costs one row per task, and results are whole."""
    from pyspark.sql import functions as F
    from surveyframe.operators import freq, rates

    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 1000).cast("string")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit("Sim")).otherwise(F.lit("Não")).alias("a"))
    vc = freq.value_counts_pct(df, "k")
    rows = {r.k: r.n for r in vc.collect()}
    assert rows["hot"] == 10000 and sum(rows.values()) == 30000
    plan = vc._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    tr = rates.answer_rates(df, "k", ["a"])
    assert "partial_count" in tr._jdf.queryExecution().executedPlan().toString()
    assert {r.k: r.a for r in tr.collect()}["hot"] == 50.0


TOP_K = {"freq_uf_top15", "away_all_top5", "freq_nation_top15", "sample_first_last"}


@pytest.mark.parametrize("name", sorted(QS))
def test_no_row_caps_outside_top_k(spark, name):
    """Whole tables: no sampling anywhere; limits only where a top-k is the feature."""
    from surveyframe.plans.inspect import physical_plan

    p = physical_plan(QS[name](spark, SF_SMALL))
    assert "Sample" not in p
    capped = any(k in p for k in ("CollectLimit", "GlobalLimit", "TakeOrderedAndProject", "LocalLimit"))
    assert capped == (name in TOP_K), name


@pytest.mark.parametrize("name", sorted(QS))
def test_every_query_scans_the_given_tables(spark, name):
    from surveyframe.plans.inspect import physical_plan

    p = physical_plan(QS[name](spark, SF_SMALL))
    assert "FileScan parquet" in p and SF_SMALL in p, name
