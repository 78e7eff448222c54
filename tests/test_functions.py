import datetime

from pyspark.sql import functions as F

from surveyframe.functions import columns as C
from surveyframe.schema import AGE_BAND_EDGES, AGE_BAND_LABELS, MONTH_LABELS


def test_two_valued_compare(spark):
    # T1: NULL compares False for ==, True for != (pandas semantics), never NULL
    df = spark.createDataFrame([("Sim",), ("Não",), (None,)], "a string")
    rows = df.select(C.is_answer("a").alias("eq"), C.is_not_answer("a", "Não").alias("ne")).collect()
    assert [r.eq for r in rows] == [True, False, False]
    assert [r.ne for r in rows] == [True, False, True]


def test_any_answer_null_in_one_column(spark):
    df = spark.createDataFrame([(None, "Sim"), (None, None), ("Não", None)], "a string, b string")
    assert [r[0] for r in df.select(C.any_answer(["a", "b"])).collect()] == [True, False, False]


def test_zero_pad_null_stays_null(spark):
    # T2: format_string alone would print 'null'
    df = spark.createDataFrame([(3,), (10,), (None,)], "c bigint")
    assert [r[0] for r in df.select(C.zero_pad("c")).collect()] == ["03", "10", None]


def test_month_start(spark):
    df = spark.createDataFrame([(2020, 5), (2020, 9), (None, 7)], "y bigint, m bigint")
    got = [r[0] for r in df.select(C.month_start("y", "m")).collect()]
    assert got == [datetime.date(2020, 5, 1), datetime.date(2020, 9, 1), None]


def test_age_bands_boundaries(spark):
    # T10: 0 and 17 -> first band, 17.5 and 18 -> second, outside and NULL -> NULL
    vals = [0.0, 17.0, 17.5, 18.0, 30.0, 31.0, 120.0, 121.0, -1.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(C.cut("x", AGE_BAND_EDGES, AGE_BAND_LABELS)).collect()]
    assert got == ["0-17 Anos", "0-17 Anos", "18-30 Anos", "18-30 Anos", "18-30 Anos", "31-45 Anos",
                   "61+ Anos", None, None, None]


def test_label_map_and_reverse(spark):
    df = spark.createDataFrame([("2020-05-01",), ("2021-01-01",), ("Julho/2020",)], "k string")
    got = df.select(C.label_map("k", MONTH_LABELS).alias("a"), C.reverse_label("k", MONTH_LABELS).alias("b")).collect()
    assert [r.a for r in got] == ["Maio/2020", "2021-01-01", "Julho/2020"]
    assert [r.b for r in got] == ["2020-05-01", "2021-01-01", "2020-07-01"]


def test_lenient_parsing(spark):
    df = spark.createDataFrame([("12.5", "2024-01-05"), ("click", "2024-01-32"), (None, "2024-01-00")],
                               "n string, d string")
    got = df.select(C.lenient_number("n").alias("n"), C.lenient_date("d").alias("d")).collect()
    assert [r.n for r in got] == [12.5, None, None]
    assert [r.d for r in got] == [datetime.date(2024, 1, 5), None, None]


def test_pct_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 4), (0, 0)], "a bigint, b bigint")
    assert [r[0] for r in df.select(C.pct("a", "b")).collect()] == [25.0, None]


def test_month_label_and_measure_name(spark):
    df = spark.createDataFrame([(datetime.date(2020, 7, 1), "Febre_desc")], "d date, c string")
    r = df.select(C.month_label("d").alias("a"), C.month_label("d", "MM/yy").alias("b"),
                  C.measure_name("c").alias("m"), C.pct_text(F.lit(12.345)).alias("t")).first()
    assert (r.a, r.b, r.m, r.t) == ("2020-07", "07/20", "Febre", "12.35%")


def test_strict_date_raises_and_date_key(spark):
    import pytest

    ok = spark.createDataFrame([("2020-07-01",)], "d string")
    r = ok.select(C.strict_date("d").alias("d")).first()
    assert r.d == datetime.date(2020, 7, 1)
    assert ok.select(C.date_key(C.strict_date("d"))).first()[0] == "2020-07-01"
    bad = spark.createDataFrame([("2020-13-45",)], "d string")
    with pytest.raises(Exception):
        bad.select(C.strict_date("d")).collect()
