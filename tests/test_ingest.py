"""Extracts with differing headers, through glob, list and CLI; landing keeps other years; unknown labels."""

import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from surveyframe import cli
from surveyframe.operators.filters import survey_filter
from surveyframe.schema import RAW_COLUMNS
from surveyframe.sources.raw import land_raw, raw_from_dir, read_landed_raw, read_raw_csv

NAMES = [n for n, _ in RAW_COLUMNS]


def extract(folder, name, columns, **values):
    row = {"Ano": "2020", "V1013": "5", "V1032": "1.5", "UF": "29", "A002": "40", "A003": "1"} | values
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(",".join(columns) + "\n" + ",".join(row.get(c, "") for c in columns) + "\n")


@pytest.fixture
def folder():
    d = tempfile.mkdtemp(prefix="sf-ingest-", dir="/tmp")
    extract(d + "/csv", "a.csv", NAMES, V1013="5")
    extract(d + "/csv", "b.csv", ["extra", *reversed(NAMES)], V1013="7", extra="999", UF="35")
    extract(d + "/csv", "c.csv", [*NAMES[:3], "x1", *NAMES[3:], "x2"], V1013="9", x1="88", UF="11")
    return d


def rows(df):
    return sorted((r.Ano, r.V1013, r.UF, r.A002) for r in df.collect())


WANT = [(2020, 5, 29, 40), (2020, 7, 35, 40), (2020, 9, 11, 40)]


def test_each_file_is_read_by_its_own_header(spark, folder):
    assert rows(read_raw_csv(spark, folder + "/csv/*.csv")) == WANT
    assert rows(read_raw_csv(spark, folder + "/csv")) == WANT
    assert rows(read_raw_csv(spark, [f"{folder}/csv/{x}.csv" for x in "cab"])) == WANT


def test_the_number_of_jobs_does_not_follow_the_number_of_files(spark, folder):
    sc, jobs = spark.sparkContext, []
    for n in (120, 300):
        for i in range(n):
            extract(f"{folder}/many{n}", f"{i:03d}.csv", [NAMES, ["extra", *NAMES], NAMES[::-1]][i % 3], extra="7", UF="29")
        sc.setJobGroup(f"headers-{n}", "headers")
        df = read_raw_csv(spark, f"{folder}/many{n}")
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"headers-{n}")))
        sc.setJobGroup("other", "other")
        assert df.where("UF = 29 and A002 = 40").count() == n
    # a few for each of the three headers, listing included
    assert jobs[0] == jobs[1] <= 9, jobs


def test_compressed_blank_and_empty_files(spark, folder):
    with open(f"{folder}/csv/a.csv") as f:
        text = f.read()
    os.makedirs(f"{folder}/odd")
    with gzip.open(f"{folder}/odd/z.csv.gz", "wt") as f:
        f.write(text)
    for name, content in [("blank.csv", "\n\n" + text), ("empty.csv", ""), ("header.csv", text.splitlines()[0] + "\n")]:
        with open(f"{folder}/odd/{name}", "w") as f:
            f.write(content)
    assert rows(read_raw_csv(spark, f"{folder}/odd")) == [WANT[0]] * 2
    os.makedirs(f"{folder}/none")
    open(f"{folder}/none/empty.csv", "w").close()
    with pytest.raises(ValueError, match="no CSV file"):
        read_raw_csv(spark, f"{folder}/none")


def test_cli_build_with_differing_headers(spark, folder):
    assert cli.main(["build", "--csv", folder + "/csv/*.csv", "--table", folder + "/t"]) == 0
    got = spark.read.parquet(folder + "/t").groupBy("DataReferencia_Mes").count().collect()
    assert sorted((str(r[0]), r[1]) for r in got) == [("2020-05-01", 1), ("2020-07-01", 1), ("2020-09-01", 1)]


def test_missing_column_names_the_file(spark, folder):
    extract(folder + "/bad", "d.csv", NAMES[1:])
    with pytest.raises(ValueError, match="d.csv"):
        read_raw_csv(spark, folder + "/bad")


def test_landing_keeps_other_years(spark, folder):
    raw = raw_from_dir(spark, SF_SMALL).where("V1013 = 5").limit(50).persist()
    land_raw(raw, folder + "/landed")
    land_raw(raw.withColumn("Ano", F.lit(2021).cast("long")), folder + "/landed")
    got = {r[0]: r[1] for r in read_landed_raw(spark, folder + "/landed").groupBy("Ano").count().collect()}
    assert got == {2020: 50, 2021: 50}


def test_unknown_month_label_matches_no_row(survey_small):
    assert survey_filter(survey_small, mes="Outubro/2020").count() == 0
    assert survey_filter(survey_small, mes="Julho/2020").count() > 0
