"""All analyses from one scan equal the analyses one by one."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from surveyframe.cli import ANALYSES
from surveyframe.operators import stats
from surveyframe.plans import analyses as A
from surveyframe.plans.consolidate import survey
from surveyframe.plans.together import COUNTS_BY, EACH_COLUMN, covering_sets, together
from surveyframe.session import scratch_folder
from surveyframe.sources.tables import read_consolidated, write_consolidated

EVERY = list(dict.fromkeys([*ANALYSES.values(), *COUNTS_BY, *EACH_COLUMN]))


@pytest.fixture(scope="module")
def table(spark):
    folder = tempfile.mkdtemp(prefix="sf-together-", dir="/tmp") + "/t"
    write_consolidated(survey(spark, SF_MID), folder)
    return read_consolidated(spark, folder)


def rows(df):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()]


@pytest.mark.parametrize("kept", [{}, {"uf": "Bahia", "sexo": "Mulher", "mes": "Julho/2020"}, {"mes": "Outubro/2020"}])
def test_every_analysis_gives_the_same_rows(table, kept):
    with together(table, EVERY, **kept) as results:
        assert list(results) == EVERY
        for fn in EVERY:
            one = A.dashboard_view(fn, table, **kept)
            assert results[fn].columns == one.columns, fn.__name__
            assert rows(results[fn]) == rows(one), fn.__name__


def test_null_columns_and_no_rows(spark, table):
    empty = table.limit(0)
    holes = table.limit(300).select(*[F.when(F.rand(1) < 0.5, F.col(c)).alias(c) for c in table.columns]).collect()
    holes = spark.createDataFrame(holes, table.schema)
    for df in (empty, holes):
        with together(df, EVERY) as results:
            for fn in EVERY:
                assert rows(results[fn]) == rows(fn(df)), fn.__name__


def test_values_beyond_the_drivers_share(table):
    few, stats.FEW = stats.FEW, 0
    try:
        with together(table, [A.qa7_income_quantiles, A.qa2_age_describe]) as results:
            got = [rows(r) for r in results.values()]
    finally:
        stats.FEW = few
    assert got == [rows(A.qa7_income_quantiles(table)), rows(A.qa2_age_describe(table))]


def test_one_scan_whatever_the_number_of_analyses(spark, table):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def look(x):
        seen.add(1)
        return x

    n = table.count()
    watched = table.withColumn("Febre_desc", look.asNondeterministic()("Febre_desc"))
    for fns in ([A.qk_kpi], [fn for fn in EVERY if fn in COUNTS_BY or fn in EACH_COLUMN]):
        before = seen.value
        with together(watched, fns) as results:
            for r in results.values():
                r.collect()
        assert seen.value - before == n


def test_scratch_goes_also_after_a_failure(spark, table):
    base = scratch_folder(spark).removeprefix("file:")
    with pytest.raises(ZeroDivisionError):
        with together(table, [A.qa3_sexo]):
            assert [f for f in os.listdir(base) if f.startswith("together-")]
            raise ZeroDivisionError
    assert not [f for f in os.listdir(base) if f.startswith("together-")]


def test_sets_held_by_others_are_left_out():
    assert covering_sets([("a",), ("a", "b"), ("c",), ("b", "a"), ("b", "c", "a")]) == [frozenset("abc")]
    assert covering_sets([("a",), ("b",)]) == [frozenset("a"), frozenset("b")]
