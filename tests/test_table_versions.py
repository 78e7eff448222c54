"""The stored table is replaced whole or not at all; single months without the others."""

import os
import subprocess
import sys
import tempfile
import textwrap

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from surveyframe.plans.consolidate import survey
from surveyframe.schema import MONTH_COLUMN as M
from surveyframe.sources import tables
from surveyframe.sources.tables import dashboard_scan, read_consolidated, replace_months, stored_months, write_consolidated


@pytest.fixture(scope="module")
def rows(spark):
    return survey(spark, SF_SMALL).persist()


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="sf-ver-", dir="/tmp") + "/t"


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_failed_write_leaves_the_old_table(spark, rows, path):
    write_consolidated(rows, path)
    before = files(path)
    bad = rows.withColumn("Idade", F.when(F.col("uf_desc") == "Acre", F.raise_error(F.lit("no"))).otherwise(F.col("Idade")).cast("long"))
    for write in (write_consolidated, replace_months):
        with pytest.raises(Exception):
            write(bad, path)
        assert files(path) == before and same(read_consolidated(spark, path), rows)


KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from surveyframe.session import get_spark
from surveyframe.plans.consolidate import survey
from surveyframe.sources import tables
spark = get_spark("local[2]", shuffle_partitions=2)
tables.publish_text = (lambda real: lambda s, f, t: os._exit(9) if "_versions" in f else real(s, f, t))(tables.publish_text)
tables.write_consolidated(survey(spark, {sf!r}).limit(100), {path!r})
"""


def test_killed_write_leaves_the_old_table(spark, rows, path):
    """The process ends after its files are written, before they are published."""
    write_consolidated(rows, path)
    code = textwrap.dedent(KILLED).format(root=ROOT, sf=SF_SMALL, path=path)
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=200).returncode == 9
    assert os.listdir(f"{path}/_data")
    assert same(read_consolidated(spark, path), rows)
    write_consolidated(rows.where("sexo_desc = 'Mulher'"), path)
    assert same(read_consolidated(spark, path), rows.where("sexo_desc = 'Mulher'"))


def test_one_month_is_replaced(spark, rows, path):
    write_consolidated(rows, path)
    before = files(path)
    july = rows.where(F.col(M) == "2020-07-01").where("sexo_desc = 'Homem'")
    replace_months(july, path)
    after = files(path)
    assert {f: after[f] for f in before} == before  # nothing touched
    assert same(read_consolidated(spark, path), rows.where(F.col(M) != "2020-07-01").unionByName(july))
    plan = dashboard_scan(spark, path, uf="Bahia", mes="Julho/2020")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(DataReferencia_Mes") == plan.count("FileScan") == 2
    assert plan.count("EqualTo(uf_desc,Bahia)") == 2

    replace_months(july.limit(0), path, months=["2020-09-01"])  # by nothing
    assert stored_months(spark, path) == ["2020-05-01", "2020-07-01"]
    with pytest.raises(ValueError):
        replace_months(july, path, months=["2020-05-01"])
    with pytest.raises(ValueError):
        replace_months(july.withColumn("new", F.lit(1)), path)
    assert same(read_consolidated(spark, path), rows.where(F.col(M) == "2020-05-01").unionByName(july))


def test_a_month_that_is_missing_and_an_empty_table(spark, rows, path):
    none = rows.limit(60).withColumn(M, F.when(F.col("sexo_desc") == "Homem", F.col(M)))
    none = spark.createDataFrame(none.collect(), none.schema)
    write_consolidated(none, path)
    assert same(read_consolidated(spark, path), none)
    replace_months(rows.where(F.col(M) == "2020-05-01"), path)
    assert read_consolidated(spark, path).where(F.col(M).isNull()).count() == none.where(F.col(M).isNull()).count()
    write_consolidated(rows.limit(0), path)
    assert read_consolidated(spark, path).columns == rows.columns and read_consolidated(spark, path).isEmpty()
    with pytest.raises(FileNotFoundError):
        read_consolidated(spark, path + "-none")


def test_old_versions_go_and_running_readers_finish(spark, rows, path):
    write_consolidated(rows, path)
    reader = read_consolidated(spark, path)
    write_consolidated(rows.where("sexo_desc = 'Mulher'"), path)
    assert same(reader, rows)  # the version before is still there
    for _ in range(3):
        write_consolidated(rows.where("sexo_desc = 'Homem'"), path)
    assert len(os.listdir(f"{path}/_data")) == tables.KEEP_VERSIONS
    assert not [f for f in os.listdir(path) if f.startswith(M)]
    assert same(read_consolidated(spark, path), rows.where("sexo_desc = 'Homem'"))


def test_of_two_writes_at_once_one_fails(spark, rows, path, monkeypatch):
    write_consolidated(rows, path)
    real = tables.publish_text

    def late(s, file, text):
        monkeypatch.setattr(tables, "publish_text", real)
        write_consolidated(rows.limit(5), path)  # the other one is first
        return real(s, file, text)

    monkeypatch.setattr(tables, "publish_text", late)
    with pytest.raises(RuntimeError, match="first"):
        write_consolidated(rows, path)
    assert read_consolidated(spark, path).count() == 5
    assert len(os.listdir(f"{path}/_data")) == 1


def test_a_plain_folder_is_a_table(spark, rows, path):
    rows.write.partitionBy(M).parquet(path)
    assert same(read_consolidated(spark, path), rows)
    replace_months(rows.where(F.col(M) == "2020-05-01").limit(3), path)
    assert read_consolidated(spark, path).where(F.col(M) == "2020-05-01").count() == 3
    assert same(read_consolidated(spark, path).where(F.col(M) != "2020-05-01"), rows.where(F.col(M) != "2020-05-01"))
