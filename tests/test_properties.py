"""Property tests: Spark operators against numpy/pandas on random data."""

import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from surveyframe.operators import distribution, freq, stats

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True, database=None,
                    suppress_health_check=list(HealthCheck))
floats = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(floats, min_size=1, max_size=300), st.lists(st.floats(0, 1), min_size=1, max_size=5))
def test_exact_quantiles_match_numpy(spark, vals, probs):
    # heavy duplicates make the selection path meet single-value ranges
    vals = vals + vals[: len(vals) // 2]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = stats.quantiles(df, "x", probs, buckets=4).first()
    want = np.quantile(np.array(vals), probs)
    for g, w in zip(got, want):
        assert math.isclose(g, w, rel_tol=1e-9, abs_tol=1e-6)


@SETTINGS
@given(st.lists(floats, min_size=1, max_size=300), st.integers(1, 40))
def test_histogram_counts_match_numpy(spark, vals, bins):
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = [r.n for r in distribution.histogram(df, "x", bins).collect()]
    want, _ = np.histogram(np.array(vals), bins=bins)
    assert got == want.tolist()


def test_histogram_counts_match_numpy_on_integers(spark):
    for top, bins in ((112, 50), (112, 100), (62, 30), (66, 30), (70, 30)):
        df = spark.range(top + 1).selectExpr("cast(id as double) x")
        got = [r.n for r in distribution.histogram(df, "x", bins).collect()]
        assert got == np.histogram(np.arange(top + 1.0), bins=bins)[0].tolist()


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "Não Informado"])), min_size=1, max_size=200))
def test_value_counts_pct_match_pandas(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r.v: (r.n, r.pct) for r in freq.value_counts_pct(df, "v").collect()}
    s = pd.Series(vals, dtype="object")
    counts = s.value_counts(dropna=False)
    for k, n in counts.items():
        key = None if k is None or (isinstance(k, float) and math.isnan(k)) else k
        assert got[key][0] == n
        assert math.isclose(got[key][1], n * 100.0 / len(vals))
    assert math.isclose(sum(p for _, p in got.values()), 100.0)
