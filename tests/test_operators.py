import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyframe.operators import distribution, filters, freq, profile, rates, stats

D5, D7, D9 = datetime.date(2020, 5, 1), datetime.date(2020, 7, 1), datetime.date(2020, 9, 1)


# ------------------------------------------------------------------ frequency

def test_value_counts_ties_null_and_pct(spark):
    # T4/T5: ties broken by label, NULL group included in counts and denominator
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "v string")
    rows = freq.value_counts_pct(df, "v").collect()
    assert [(r.v, r.n) for r in rows] == [("a", 2), ("b", 2), ("c", 1), (None, 1)]
    assert math.isclose(sum(r.pct for r in rows), 100.0)
    assert rows[0].pct == 2 * 100.0 / 6


def test_top_k_is_take_ordered(spark):
    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("v"))
    t = freq.top_k(df, "v", 3)
    assert [r.v for r in t.collect()] == ["0", "1", "2"]
    assert "TakeOrderedAndProject" in t._jdf.queryExecution().executedPlan().toString()


def test_ordered_counts_present_absent_fallback(spark):
    df = spark.createDataFrame([("b",), ("b",), ("z",), ("a",)], "v string")
    present = freq.ordered_counts(df, "v", ["a", "b", "c"]).collect()
    assert [(r.v, r.ord, r.n) for r in present] == [("a", 0, 1), ("b", 1, 2)]
    assert present[0].pct == 25.0  # percent of all rows, including the unlisted 'z'
    absent = freq.ordered_counts(df, "v", ["a", "b", "c"], keep_absent=True).collect()
    assert [(r.v, r.n, r.pct) for r in absent] == [("a", 1, 25.0), ("b", 2, 50.0), ("c", 0, 0.0)]
    none_listed = freq.ordered_counts(df, "v", ["x", "y"], fallback_observed=True).collect()
    assert [(r.v, r.ord) for r in none_listed] == [("b", None), ("a", None), ("z", None)]
    some_listed = freq.ordered_counts(df, "v", ["z", "y"], fallback_observed=True).collect()
    assert [(r.v, r.ord) for r in some_listed] == [("z", 0)]
    assert freq.ordered_counts(df.where("false"), "v", ["z"], fallback_observed=True).collect() == []


def test_answer_shares_lists_every_observed_answer(spark):
    df = spark.createDataFrame([("x", "S"), ("x", "S"), ("x", "W"), ("y", "N"), ("y", None), (None, "S")], "g string, a string")
    got = [(r.g, r.a, r.n, round(r.pct, 3)) for r in rates.answer_shares(df, "g", "a").collect()]
    assert got == [("x", "S", 2, 66.667), ("x", "W", 1, 33.333), ("y", "N", 1, 100.0)]


def test_code_table_of_unlikely_size_is_an_error(spark):
    from surveyframe.sources.dims import code_table

    with pytest.raises(ValueError):
        code_table(spark.range(20), max_rows=10)


def test_multi_value_counts_and_count_answers(spark):
    df = spark.createDataFrame([("Sim", "Não"), ("Sim", None), ("Não", "Sim")], "Febre_desc string, Tosse_desc string")
    m = {(r.measure, r.value): (r.n, r.pct) for r in freq.multi_value_counts(df, ["Febre_desc", "Tosse_desc"]).collect()}
    assert m[("Febre_desc", "Sim")] == (2, 2 * 100.0 / 3) and m[("Tosse_desc", None)][0] == 1
    c = [(r.measure, r.n) for r in freq.count_answers(df, ["Febre_desc", "Tosse_desc"]).collect()]
    assert c == [("Febre", 2), ("Tosse", 1)]


def test_weighted_totals(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", 4.0), ("a", 2.0)], "k string, w double")
    assert [(r.k, r.weighted_total) for r in freq.weighted_totals(df, "k", "w").collect()] == [("b", 4.0), ("a", 3.5)]


# ---------------------------------------------------------------------- rates

def test_answer_rates_trend_edge_cases(spark):
    # a month with no 'Sim' -> 0.0; a month with only NULL answers for one
    # measure -> 0.0 for it; NULL month dropped; all-NULL month dropped
    rows = [(D5, "Sim", "Sim"), (D5, "Não", "Não"), (D7, "Não", None), (D7, "Não", None),
            (None, "Sim", "Sim"), (D9, None, None)]
    df = spark.createDataFrame(rows, "m date, a string, b string")
    got = [(r.m, r.a, r.b) for r in rates.answer_rates(df, "m", ["a", "b"]).collect()]
    assert got == [(D5, 50.0, 50.0), (D7, 0.0, 0.0)]


def test_empty_input_rates_are_null_not_errors(spark):
    df = spark.createDataFrame([], "Febre_desc string, AuxilioEmergencial_desc string")
    r = rates.kpi_row(df).first()
    assert (r.respondentes, r.pct_febre, r.pct_auxilio) == (0, None, None)
    assert rates.answer_rates(df.withColumn("m", F.lit(None).cast("date")), "m", ["Febre_desc"]).count() == 0


def test_crosstab_rows_sum_to_100_and_drop_nulls(spark):
    df = spark.createDataFrame([("x", "S"), ("x", "N"), ("x", "N"), ("y", "S"), (None, "S"), ("y", None)],
                               "r string, c string")
    t = {r.r: (r.S, r.N) for r in rates.crosstab_pct(df, "r", "c", ["S", "N"]).collect()}
    assert t == {"x": (100 / 3, 200 / 3), "y": (100.0, 0.0)}
    o = [r.r for r in rates.crosstab_pct(df, "r", "c", ["S", "N"], row_order=["y", "x"]).collect()]
    assert o == ["y", "x"]


def test_survey_filter_month_label_and_all(spark):
    df = spark.createDataFrame([(D5, "Bahia", "Homem"), (D7, "Bahia", "Mulher"), (D7, "Acre", "Homem")],
                               "DataReferencia_Mes date, uf_desc string, sexo_desc string")
    assert filters.survey_filter(df, mes="Julho/2020").count() == 2
    assert filters.survey_filter(df, mes="2020-07-01", uf="Bahia").count() == 1
    assert filters.survey_filter(df, uf="Todos", sexo="Todos", mes="Todos").count() == 3
    assert filters.informed(spark.createDataFrame([("Não Informado",), (None,), ("x",)], "v string"), "v").count() == 2


# ---------------------------------------------------------------------- stats

def test_describe_small(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 10, None]], "x bigint")
    r = stats.describe(df, "x").first()
    assert (r["count"], r.mean, r.std, r["min"], r.q25, r.q50, r.q75, r["max"]) == \
        (5, 4.0, 3.535534, 1.0, 2.0, 3.0, 4.0, 10.0)


@pytest.mark.parametrize("hot", [False, True])
def test_exact_selection_matches_numpy(spark, hot):
    rng = np.random.default_rng(7)
    vals = rng.lognormal(3, 2, 5000)
    if hot:  # one value holds a third of all rows
        vals[: len(vals) // 3] = 42.0
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    # force the distributed-selection path with tiny limits (several refinement rounds)
    got = stats.quantiles(df, "x", probs, buckets=8).first()
    want = np.quantile(vals, probs)
    for g, w in zip(got, want):
        assert math.isclose(g, w, rel_tol=1e-12, abs_tol=1e-12)
    # and the built-in exact path agrees
    got2 = stats.quantiles(df, "x", probs).first()
    for g, w in zip(got2, want):
        assert math.isclose(g, w, rel_tol=1e-9)


def test_quantiles_empty_and_describe_numeric_big_path(spark):
    empty = spark.createDataFrame([], "x double")
    assert stats.quantiles(empty, "x", [0.5]).first()[0] is None
    df = spark.range(1000).select((F.col("id") * 1.5).alias("a"), (F.col("id") % 10).alias("b"))
    rows = {r.column: r for r in stats.describe_numeric(df, buckets=16).collect()}
    assert rows["a"].q50 == float(np.quantile(np.arange(1000) * 1.5, 0.5))
    assert rows["b"].q25 == float(np.quantile(np.arange(1000) % 10, 0.25))


def test_boxplot_whiskers_and_outliers(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100, -50]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    r = stats.boxplot_stats(df, "x").first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert (r.q1, r.q3) == (q1, q3)
    assert r.whisker_lo == min(v for v in vals if v >= lo) and r.whisker_hi == max(v for v in vals if v <= hi)
    assert (r.n_out_lo, r.n_out_hi) == (1, 1)


# --------------------------------------------------------------- distribution

def test_histogram_bins_and_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 2, 4, 6, 8, 10]], "x double")
    rows = distribution.histogram(df, "x", 5).collect()
    assert [r.n for r in rows] == [1, 1, 1, 1, 2]
    assert (rows[0].lo, rows[-1].hi) == (0.0, 10.0)
    np_counts, _ = np.histogram([0, 2, 4, 6, 8, 10], bins=5)
    assert [r.n for r in rows] == list(np_counts)


def test_histogram_all_equal_and_empty(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    rows = distribution.histogram(df, "x", 4).collect()
    assert [r.n for r in rows] == [0, 0, 2, 0] and (rows[0].lo, rows[-1].hi) == (2.5, 3.5)
    assert distribution.histogram(spark.createDataFrame([], "x double"), "x", 4).count() == 0


def test_kde_matches_brute_force(spark):
    vals = np.array([1, 1, 2, 3, 5, 8, 13, 21, 21, 21], dtype=float)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    rows = distribution.kde(df, "x", gridsize=50, decimals=None).collect()
    h = vals.std(ddof=1) * len(vals) ** (-0.2)
    grid = np.linspace(vals.min(), vals.max(), 50)
    want = np.exp(-0.5 * ((grid[:, None] - vals[None, :]) / h) ** 2).sum(1) / (len(vals) * h * math.sqrt(2 * math.pi))
    assert len(rows) == 50
    for r, w, g in zip(rows, want, grid):
        assert math.isclose(r.density, w, rel_tol=1e-9) and math.isclose(r.x, g, rel_tol=1e-12, abs_tol=1e-12)


def test_banded_counts_keep_empty_bands(spark):
    df = spark.createDataFrame([(5,), (17,), (70,), (None,)], "age bigint")
    rows = distribution.banded_counts(df, "age", [0, 17, 30, 45, 60, 120],
                                      ["a", "b", "c", "d", "e"]).collect()
    assert [(r.band, r.n) for r in rows] == [("a", 2), ("b", 0), ("c", 0), ("d", 0), ("e", 1)]


# -------------------------------------------------------------------- profile

def test_describe_categorical_ties_and_nulls(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", "x"), ("a", "x")], "u string, w string")
    rows = {r.column: r for r in profile.describe_categorical(df).collect()}
    assert (rows["u"]["count"], rows["u"].unique, rows["u"].top, rows["u"].freq) == (4, 2, "a", 2)
    assert (rows["w"]["count"], rows["w"].unique, rows["w"].top) == (2, 1, "x")


def test_completeness_and_head_tail(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "i bigint, s string")
    c = [(r.column, r.dtype, r.non_null) for r in profile.completeness(df).collect()]
    assert c == [("i", "bigint", 3), ("s", "string", 2)]
    ht = profile.head_tail(df, ["i", "s"], n=2).collect()
    assert [(r.part, r.pos, r.i) for r in ht] == [("head", 1, 1), ("head", 2, 2), ("tail", 1, 3), ("tail", 2, 2)]
    assert [r.v for r in profile.distinct_sorted(
        spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string"), "v").collect()] == ["a", "b"]


def test_weighted_shares(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("a", 4.0)], "k string, w double")
    got = [(r.k, r.n, r.pct) for r in freq.value_counts_pct(df, "k", weight="w").collect()]
    assert got == [("a", 5.0, 62.5), ("b", 3.0, 37.5)]


def test_group_shares_wide(spark):
    df = spark.createDataFrame([(D5, "Sim"), (D5, "Não"), (D7, "Não"), (None, "Sim"), (D9, None)],
                               "m date, a string")
    got = [(r.m, r.Sim, r["Não"], r.Outro) for r in rates.group_shares(df, "m", "a", ["Sim", "Não", "Outro"]).collect()]
    assert got == [(D5, 50.0, 50.0, 0.0), (D7, 0.0, 100.0, 0.0)]


def test_approx_quantiles_switch(spark):
    vals = np.arange(10000, dtype=float)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = stats.quantiles(df, "x", [0.5, 0.9], approx_accuracy=1000).first()
    assert abs(got[0] - 4999.5) <= 10000 / 1000 and abs(got[1] - 8999.1) <= 10000 / 1000


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    q = stats.quantiles(df, "x", [0.5]).first()[0]
    assert q == 2.0
    h = distribution.histogram(df, "x", 2).collect()
    assert [r.n for r in h] == [1, 1] and h[-1].hi == 3.0
    assert stats.boxplot_stats(df, "x").first().n == 2


def test_describe_skips_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    r = stats.describe(df, "x").first()
    assert (r["count"], r.mean, r.q50) == (2, 2.0, 2.0)


def test_weighted_rates_crosstab_kpi(spark):
    df = spark.createDataFrame([(D5, "Sim", "x", 3.0), (D5, "Não", "x", 1.0), (D5, None, "y", 5.0),
                                (D7, "Sim", "y", 2.0)], "m date, a string, r string, w double")
    got = {r.m: r.a for r in rates.answer_rates(df, "m", ["a"], weight="w").collect()}
    assert got == {D5: 75.0, D7: 100.0}
    ct = {r.r: (r.Sim, r["Não"]) for r in rates.crosstab_pct(df, "r", "a", ["Sim", "Não"], weight="w").collect()}
    assert ct == {"x": (75.0, 25.0), "y": (100.0, 0.0)}
    k = rates.kpi_row(df.withColumnRenamed("a", "Febre_desc").withColumn("AuxilioEmergencial_desc", F.lit("Sim")),
                      weight="w").first()
    assert (k.respondentes, k.pct_febre, k.pct_auxilio) == (4, 5.0 * 100 / 11, 100.0)
    # unweighted stays row-based
    assert rates.answer_rates(df, "m", ["a"]).collect()[0].a == 50.0
