import datetime
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from surveyframe.operators.decode import decode
from surveyframe.plans.consolidate import consolidated, processed, read_consolidated, survey, write_consolidated
from surveyframe.schema import CONSOLIDATED_COLUMNS, NOT_INFORMED, PROCESSED_COLUMNS, RAW_COLUMNS, RAW_SCHEMA
from surveyframe.sources import dims as D
from surveyframe.sources.raw import land_raw, raw_from_dir, read_landed_raw, read_raw_csv, split_months

from conftest import SF_SMALL


def _raw_row(**kw):
    row = {n: None for n, _ in RAW_COLUMNS}
    row.update(Ano=2020, V1013=5)
    row.update(kw)
    return tuple(row[n] for n, _ in RAW_COLUMNS)


def test_dims_unique_and_declared(spark):
    for name in D.DIMS:
        df = D.dim_frame(spark, name)
        spec = D.DIMS[name]
        f = df.schema[spec.code_col]
        assert not f.nullable and f.metadata.get("comment")
        assert df.count() == df.select(spec.code_col).distinct().count() == len(D.DIM_ROWS[name])
    with pytest.raises(ValueError):
        D.dim_frame(spark, "sexo", rows=[(1, "a"), (1, "b")])


def test_decode_unmatched_null_and_padded(spark):
    # T3: NULL code and a code missing from the dim both give the default label;
    # the code column keeps the original value.  Income band joins as '07'.
    raw = spark.createDataFrame([
        _raw_row(UF=35, A003=2, B0011=1, C01011=7),
        _raw_row(UF=99, A003=None, B0011=7, C01011=10),
        _raw_row(UF=None, A003=1, B0011=None, C01011=None),
    ], RAW_SCHEMA)
    out = processed(spark, raw).collect()
    assert [r.uf_desc for r in out] == ["São Paulo", NOT_INFORMED, NOT_INFORMED]
    assert [r.UF_cod for r in out] == [35, 99, None]
    assert [r.sexo_desc for r in out] == ["Mulher", NOT_INFORMED, "Homem"]
    assert [r.Febre_desc for r in out] == ["Sim", NOT_INFORMED, NOT_INFORMED]
    assert [r.FaixaRendimento_cod_str for r in out] == ["07", "10", None]
    assert [r.FaixaRendimento_desc for r in out] == ["10.001 - 50.000", NOT_INFORMED, NOT_INFORMED]
    assert list(processed(spark, raw).columns) == PROCESSED_COLUMNS


def test_decode_keeps_rows_and_plan(spark):
    raw = raw_from_dir(spark, SF_SMALL)
    df = processed(spark, raw)
    assert df.count() == raw.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 16
    assert "SortMergeJoin" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # after execution the role-playing yes/no table (9 joins) is broadcast once, reused 8 times
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    final = final.split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 8


def test_decode_only_plans_needed_joins(spark):
    df = processed(spark, raw_from_dir(spark, SF_SMALL), only=["uf_desc", "Idade"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1
    assert df.columns == ["uf_desc", "Idade"]


def test_consolidated_union_rows_and_month(spark):
    raw = raw_from_dir(spark, SF_SMALL)
    months = split_months(raw)
    cons = consolidated(spark, months)
    assert cons.columns == CONSOLIDATED_COLUMNS
    assert cons.count() == sum(m.count() for m in months) == raw.count()
    got = {r[0]: r[1] for r in cons.groupBy("DataReferencia_Mes").agg(F.min("Mes_cod")).collect()}
    assert got == {datetime.date(2020, 5, 1): 5, datetime.date(2020, 7, 1): 7, datetime.date(2020, 9, 1): 9}


def test_partitioned_sink_roundtrip_and_pruning(spark):
    out = tempfile.mkdtemp(prefix="sf-cons-", dir="/tmp")
    df = survey(spark, SF_SMALL)
    write_consolidated(df, out + "/t")
    parts = sorted(p for p in os.listdir(out + "/t") if p.startswith("DataReferencia_Mes="))
    assert parts == ["DataReferencia_Mes=2020-05-01", "DataReferencia_Mes=2020-07-01",
                     "DataReferencia_Mes=2020-09-01"]
    back = read_consolidated(spark, out + "/t")
    assert back.count() == df.count()
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    q = back.where(F.col("DataReferencia_Mes") == F.lit("2020-07-01").cast("date")).where(F.col("uf_desc") == "Bahia")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DataReferencia_Mes" in plan
    assert "PushedFilters: [IsNotNull(uf_desc), EqualTo(uf_desc,Bahia)]" in plan


def test_csv_ingest_roundtrip_and_strict_casts(spark):
    raw = raw_from_dir(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="sf-csv-", dir="/tmp")
    # a wider extract: extra columns, codes written as text
    wide = raw.select(F.lit("x").alias("Extra1"), *[F.col(c).cast("string").alias(c) for c in raw.columns],
                      F.lit(1).alias("Extra2"))
    wide.write.option("header", True).csv(d + "/csv")
    back = read_raw_csv(spark, d + "/csv")
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in raw.schema]
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    land_raw(back, d + "/landed")
    assert read_landed_raw(spark, d + "/landed").count() == raw.count()

    # edge codes: '1.0' is a code, blank is NULL, 'x' must fail
    with open(d + "/edge.csv", "w") as fh:
        cols = [n for n, _ in RAW_COLUMNS]
        fh.write(",".join(cols) + "\n")
        fh.write(",".join("1.0" if c == "A003" else ("" if c == "UF" else "1") for c in cols) + "\n")
    r = read_raw_csv(spark, d + "/edge.csv").first()
    assert r.A003 == 1 and r.UF is None
    with open(d + "/bad.csv", "w") as fh:
        fh.write(",".join(cols) + "\n")
        fh.write(",".join("x" if c == "A003" else "1" for c in cols) + "\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, d + "/bad.csv").collect()


def test_dashboard_scan_prunes_and_cache(spark):
    from surveyframe.sources.tables import cached, dashboard_scan

    out = tempfile.mkdtemp(prefix="sf-dash-", dir="/tmp")
    write_consolidated(survey(spark, SF_SMALL), out + "/t")
    q = dashboard_scan(spark, out + "/t", uf="Bahia", sexo="Homem", mes="Setembro/2020")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DataReferencia_Mes" in plan and "EqualTo(uf_desc,Bahia)" in plan
    assert "RendimentoHabitual_Valor" not in plan  # pruned from ReadSchema
    with cached(q) as c:
        n = c.count()
        assert c.is_cached and c.count() == n
    assert not q.is_cached
    full = survey(spark, SF_SMALL)
    assert n == full.where("uf_desc = 'Bahia' AND sexo_desc = 'Homem' AND DataReferencia_Mes = DATE'2020-09-01'").count()


def test_dims_written_with_overwrite_and_reread(spark):
    d = tempfile.mkdtemp(prefix="sf-dims-", dir="/tmp")
    D.write_dims(spark, d)
    paths = D.write_dims(spark, d)  # a re-run replaces, never doubles
    for name, path in paths.items():
        back = D.read_dim(spark, path, name)
        assert back.count() == len(D.DIM_ROWS[name])
    assert D.bounded_broadcast(D.read_dim(spark, paths["uf"], "uf"), max_rows=5) is not None


def test_sink_clusters_rows_for_row_group_skipping(spark):
    import glob

    import pyarrow.parquet as pq

    out = tempfile.mkdtemp(prefix="sf-clu-", dir="/tmp")
    write_consolidated(survey(spark, SF_SMALL), out + "/t")
    for fn in glob.glob(out + "/t/*/*.parquet"):
        t = pq.read_table(fn, columns=["uf_desc", "sexo_desc"]).to_pylist()
        keys = [(r["uf_desc"], r["sexo_desc"]) for r in t]
        assert keys == sorted(keys)
