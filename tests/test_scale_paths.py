"""Exact quantiles: one path for all sizes, on real data and on awkward distributions."""

import math

import duckdb
import numpy as np
import pytest

from conftest import SF_MID
from surveyframe.operators import stats

PROBS = [0.01, 0.25, 0.5, 0.75, 0.95, 0.99]


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF_MID}/lineitem.parquet")


def _duck(col):
    q = ", ".join(f"quantile_cont({col}, {p})" for p in PROBS)
    return duckdb.connect().execute(f"SELECT {q} FROM read_parquet('{SF_MID}/lineitem.parquet')").fetchone()


@pytest.mark.parametrize("col", ["l_extendedprice", "l_quantity", "l_discount"])
@pytest.mark.parametrize("buckets", [4, 32])
def test_quantiles_match_duckdb(spark, lineitem, col, buckets):
    got = stats.quantiles(lineitem, col, PROBS, buckets=buckets).first()
    for g, w in zip(got, _duck(col)):
        assert round(g, 6) == round(w, 6)


def test_results_do_not_depend_on_the_number_of_buckets(spark, lineitem):
    cols = ["l_extendedprice", "l_tax"]
    assert stats.describe_numeric(lineitem, cols).collect() == stats.describe_numeric(lineitem, cols, buckets=5).collect()
    assert stats.boxplot_stats(lineitem, "l_extendedprice").first() == stats.boxplot_stats(lineitem, "l_extendedprice", buckets=5).first()


@pytest.mark.parametrize("name", ["infinite", "hot", "decades", "one", "none"])
def test_awkward_distributions(spark, name):
    rnd = np.random.default_rng(1)
    vals = {"infinite": [-math.inf, math.inf, math.inf, *rnd.normal(size=500).tolist()],
            "hot": [7.0] * 400 + rnd.normal(size=800).tolist(),
            "decades": [float(10.0 ** e) for e in range(-300, 300)] * 2,
            "one": [5.0], "none": [None, math.nan]}[name]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
    got = stats.quantiles(df, "x", [0.0, 0.1, 0.5, 0.9, 0.999], buckets=8).first()
    keep = np.array([v for v in vals if v is not None and not math.isnan(v)])
    if not len(keep):
        assert all(g is None for g in got)
        return
    want = np.quantile(np.sort(keep), [0.0, 0.1, 0.5, 0.9, 0.999])
    for g, w in zip(got, want):
        assert math.isnan(w) or math.isclose(g, w, rel_tol=1e-9)


def test_no_values_in_one_partition(spark, lineitem):
    for df in (stats.describe_numeric(lineitem, ["l_extendedprice"]), stats.boxplot_stats(lineitem, "l_extendedprice")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "percentile" not in plan and "Window" not in plan and "ObjectHashAggregate" not in plan
