"""Every registered query against its DuckDB oracle on the smallest scale factor,
plus the driver entry point."""

import pytest

import __spark_entry__ as E
from surveyframe.plans.queries import QUERIES
from conftest import SF_SMALL
from oracle_check import compare, duck

QS = QUERIES
ORC = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QS) <= set(ORC)


@pytest.mark.parametrize("name", sorted(QS))
def test_query_matches_oracle(spark, con, name):
    status, msg = compare(spark, con, name, QS, ORC, SF_SMALL)
    assert status == "OK", msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["ProcurouAtendimento_desc", "n", "pct"]
