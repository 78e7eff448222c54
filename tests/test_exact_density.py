"""Weighted totals that do not depend on the partitioning, and density curves of continuous columns."""

import math
import struct

import numpy as np
import pytest

from surveyframe.operators import distribution, freq
from surveyframe.operators.exact import exact_sums


def bits(x):
    return struct.pack(">d", x)


@pytest.fixture(scope="module")
def weights():
    rnd = np.random.default_rng(3)
    vals = rnd.lognormal(4, 3, 20_000) * rnd.choice([1, 1, 1, -1], 20_000)
    return [("ab"[i % 3 == 0], float(v)) for i, v in enumerate(vals)] + [("a", 2.0 ** -27), ("a", -(2.0 ** 40) - 0.25), ("b", 0.0)]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_sums_are_exact_over_any_partitioning(spark, weights, parts):
    df = spark.createDataFrame(weights, "k string, w double").repartition(parts)
    got = {r.k: r.s for r in exact_sums(df, ["k"], "w", "s").collect()}
    for k in "ab":
        want = math.fsum(w for g, w in weights if g == k)
        assert bits(got[k]) == bits(want)
    totals = {r.k: r.weighted_total for r in freq.weighted_totals(df, "k", "w").collect()}
    assert totals == got
    shares = {r.k: r.n for r in freq.value_counts_pct(df, "k", weight="w").collect()}
    assert shares == got


def test_sums_of_missing_huge_and_infinite_values(spark):
    rows = [("none", None), ("half", 0.5), ("half", None), ("huge", 1e300), ("huge", 2.5), ("inf", math.inf), ("inf", 1.0),
            ("both", math.inf), ("both", -math.inf), ("nan", math.nan), ("nan", 1.0), (None, 3.0), ("cancel", 1e16), ("cancel", 1.0), ("cancel", -1e16)]
    got = {r.k: r.s for r in exact_sums(spark.createDataFrame(rows, "k string, w double"), ["k"], "w", "s").collect()}
    assert got["none"] is None and got["half"] == 0.5 and got["huge"] == 1e300 and got["inf"] == math.inf
    assert math.isnan(got["both"]) and math.isnan(got["nan"]) and got[None] == 3.0 and got["cancel"] == 1.0
    assert exact_sums(spark.createDataFrame([], "k string, w double"), ["k"], "w", "s").collect() == []


def plain_density(vals, grid):
    vals = np.asarray(vals)
    h = vals.std(ddof=1) * len(vals) ** -0.2
    gx = vals.min() + np.arange(grid) * (vals.max() - vals.min()) / (grid - 1)
    return gx, np.exp(-0.5 * ((gx[:, None] - vals[None, :]) / h) ** 2).sum(1) / (len(vals) * h * math.sqrt(2 * math.pi))


@pytest.mark.parametrize("kind", ["normal", "skewed", "two far groups", "one outlier", "few values"])
def test_density_equals_the_plain_sum(spark, kind):
    rnd = np.random.default_rng(11)
    vals = {"normal": rnd.normal(size=4000), "skewed": rnd.lognormal(0, 2, 4000), "few values": rnd.integers(0, 4, 4000).astype(float),
            "two far groups": np.concatenate((rnd.normal(size=2000), rnd.normal(1e6, 1, 2000))),
            "one outlier": np.append(rnd.normal(size=3000), 1e9)}[kind]
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,), (math.nan,)], "v double")
    got = distribution.kde(df, "v", 200, decimals=None).collect()
    gx, want = plain_density(vals, 200)
    assert [r.i for r in got] == list(range(200))
    peak = want.max()
    assert max(abs(r.density - w) for r, w in zip(got, want)) <= 1e-13 * peak
    assert np.allclose([r.x for r in got], gx)


def test_density_of_counted_rows_and_without_spread(spark):
    vals = [1.0] * 5 + [2.5] * 3 + [9.0]
    each = spark.createDataFrame([(v,) for v in vals], "v double")
    counts = each.groupBy("v").count().withColumnRenamed("count", freq.COUNT)
    a, b = (distribution.kde(d, "v", 50, bins=10).collect() for d in (each, counts))
    assert a == b and len(a) == 50
    assert distribution.kde(each.where("v = 1"), "v").collect() == []
    assert distribution.kde(each.limit(0), "v").collect() == []


def test_no_row_is_spread_over_the_grid(spark):
    """The grid meets cells, and the rows below the aggregation of the cells are not multiplied."""
    df = spark.range(1000).selectExpr("sqrt(id) as v")
    plan = distribution.kde(df, "v")._jdf.queryExecution().optimizedPlan().toString()
    main = plan[plan.index("Generate explode"):]
    assert "Aggregate [cell" in main
