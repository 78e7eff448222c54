import os
import tempfile

from pyspark.sql import functions as F

from surveyframe import cli
from surveyframe.sources.raw import raw_from_dir, split_months

from conftest import SF_SMALL


def test_build_and_analyze(spark):
    d = tempfile.mkdtemp(prefix="sf-cli-", dir="/tmp")
    for i, m in enumerate(split_months(raw_from_dir(spark, SF_SMALL))):
        m.select([F.col(c).cast("string").alias(c) for c in m.columns]) \
         .coalesce(1).write.option("header", True).csv(f"{d}/csv/m{i}")
    assert cli.main(["build", "--csv", f"{d}/csv/m0", f"{d}/csv/m1", f"{d}/csv/m2", "--table", f"{d}/t"]) == 0
    assert spark.read.parquet(f"{d}/t").count() == raw_from_dir(spark, SF_SMALL).count()
    assert cli.main(["analyze", "--table", f"{d}/t", "--out", f"{d}/out"]) == 0
    assert sorted(p for p in os.listdir(f"{d}/out")) == sorted(cli.ANALYSES)
    care = spark.read.parquet(f"{d}/out/atendimento_sintomaticos")
    assert abs(sum(r.pct for r in care.collect()) - 100.0) < 1e-9

    # the dashboard's filters hold for every analysis; views along months keep all months
    assert cli.main(["analyze", "--table", f"{d}/t", "--out", f"{d}/one", "--uf", "Acre", "--mes", "Setembro/2020",
                     "--only", "sexo", "evolucao_sintomas"]) == 0
    kept = spark.read.parquet(f"{d}/t").where("uf_desc = 'Acre' and DataReferencia_Mes = date'2020-09-01'").count()
    assert kept > 0
    assert spark.read.parquet(f"{d}/one/sexo").agg(F.sum("n")).first()[0] == kept
    months = spark.read.parquet(f"{d}/t").where("uf_desc = 'Acre'").select("DataReferencia_Mes").distinct().count()
    assert months == 3
    assert spark.read.parquet(f"{d}/one/evolucao_sintomas").count() == months
    assert cli.main(["analyze", "--table", f"{d}/t", "--out", f"{d}/none", "--mes", "Outubro/2020", "--only", "sexo"]) == 0
    assert spark.read.parquet(f"{d}/none/sexo").count() == 0
