"""Registered queries: name -> f(spark, sf_dir) -> DataFrame.

Survey queries run on the synthetic survey derived from the whole ``lineitem``
table (decode + consolidate, only the columns each analysis reads); the
generic-operator queries run on the driver's other tables directly.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import lenient_date, lenient_number, month_start, zero_pad
from ..operators import coded, distribution, filters, freq, profile, rates, stats
from ..operators.decode import decode, label
from ..schema import CONSOLIDATED_COLUMNS, DASHBOARD_COLUMNS, INCOME_BAND_ORDER, MONTH_COLUMN, PROCESSED_COLUMNS
from ..sources.dims import all_dims, bounded_broadcast, dim_sizes
from ..sources.raw import raw_from_dir, stack
from . import analyses as A
from .consolidate import consolidated, survey, survey_counts

Query = Callable[[SparkSession, str], DataFrame]
M = MONTH_COLUMN
SYM = A.SYMPTOM_COLS


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _on_survey(fn, cols: list[str]) -> Query:
    return lambda spark, sf_dir: fn(survey(spark, sf_dir, only=cols))


def _on_counts(fn, labels: list[str]) -> Query:
    """An analysis of frequencies: rows are counted on codes, the combinations that occur are decoded."""
    return lambda spark, sf_dir: fn(survey_counts(spark, sf_dir, labels))


def portable(df: DataFrame) -> DataFrame:
    """Final projection of a registered result into engine-neutral types.

    Dates become ISO text ('2020-05-01', as the dashboard's loader does) and
    decimals become doubles, so a result compares identically whether it is
    read through Arrow, pandas or rows.  The library itself keeps DATE and
    DECIMAL(38,9); only registered outputs are projected.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast(T.DoubleType())
        cols.append(c.alias(f.name))
    return df.select(cols)


# ------------------------------------------------------ decode / consolidate

def survey_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q0: all months decoded into the 37 processed columns."""
    return decode(raw_from_dir(spark, sf_dir), all_dims(spark), dim_rows=dim_sizes())


def survey_consolidated_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: raw months stacked, decoded once, month date added, counted per month and UF.

    The fixture holds every month in one table, so it is read once as a single
    source (splitting it into three filtered reads would triple the scan); the
    N-source union is exercised by the CLI build from three monthly extracts,
    and the unit tests.
    """
    df = consolidated(spark, [raw_from_dir(spark, sf_dir)], only=[M, "uf_desc", "Idade", "Peso_Amostral"])
    return (df.groupBy(M, "uf_desc")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("Idade").alias("soma_idade"),
                 F.round(F.sum("Peso_Amostral"), 2).alias("soma_peso"))
            .orderBy(M, "uf_desc"))


def stacked_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 over two real inputs: customers and suppliers stacked by column name, per nation and source."""
    def source(name: str, prefix: str) -> DataFrame:
        t = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        return t.select(F.lit(name).alias("source"), F.col(f"{prefix}_nationkey").alias("nationkey"),
                        F.col(f"{prefix}_acctbal").cast("double").alias("acctbal"))

    suppliers = source("supplier", "s").select("acctbal", "source", "nationkey")  # another column order
    return (stack([source("customer", "c"), suppliers]).groupBy("source", "nationkey")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("acctbal"), 2).alias("acctbal"))
            .orderBy("source", "nationkey"))


def scan_pruned_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + F8: dashboard projection under UF, sex and month filters."""
    df = survey(spark, sf_dir, only=DASHBOARD_COLUMNS)
    return filters.survey_filter(df, uf="São Paulo", sexo="Mulher", mes="Julho/2020")


def kpi_row_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = survey(spark, sf_dir, only=[M, "uf_desc", "sexo_desc", "Febre_desc", "AuxilioEmergencial_desc"])
    return A.qk_kpi(df, uf="Bahia", sexo="Homem", mes="2020-09-01")


def trend_work_aid_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the trend view under UF/sex filters ignores the month filter."""
    df = survey(spark, sf_dir, only=[M, "uf_desc", "sexo_desc", "Trabalhou_desc", "AuxilioEmergencial_desc"])
    return A.qd3_trend_work_aid(filters.survey_filter(df, uf="Minas Gerais", sexo="Mulher"))


def freq_sexo_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frequency view under the dashboard's filters."""
    df = survey(spark, sf_dir, only=[M, "uf_desc", "sexo_desc"])
    return A.dashboard_view(A.qa3_sexo, df, uf="Bahia", mes="Setembro/2020")


def hist_age_20_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A histogram under the dashboard's filters; its bounds are those of the kept rows."""
    df = survey(spark, sf_dir, only=[M, "uf_desc", "sexo_desc", "Idade"])
    kept = filters.survey_filter(df, uf="São Paulo", sexo="Mulher", mes="Julho/2020")
    return A.qa2_age_hist(kept, 20)


def freq_rendimento_all_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6: every band of the order, those that no informed row has with 0."""
    df = filters.informed(survey_counts(spark, sf_dir, ["FaixaRendimento_desc"]), "FaixaRendimento_desc")
    return freq.ordered_counts(df, "FaixaRendimento_desc", INCOME_BAND_ORDER, keep_absent=True)


def first_look_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: the most frequent values of seven columns, counted on codes."""
    month = month_start(F.col("Ano"), F.col("V1013")).cast("string")
    labels = [c for c in A.FIRST_LOOK if c != M]
    return A.most_frequent(coded.label_counts(raw_from_dir(spark, sf_dir), labels, [(M, month)]))


def describe_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 over all labels and the income band's code, counted on codes."""
    band = zero_pad(F.col("C01011").cast("bigint"))
    counts = coded.label_counts(raw_from_dir(spark, sf_dir), [c for c in TEXT if c.endswith("_desc")], [("FaixaRendimento_cod_str", band)])
    return profile.summary_of_counts(counts.where("value is not null").withColumnRenamed("measure", "column"))


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15 on codes: labels have a default and are never NULL, so none is joined."""
    codes = [c for c in CONSOLIDATED_COLUMNS if not c.endswith("_desc")]
    return profile.completeness(survey(spark, sf_dir, only=codes), survey(spark, sf_dir).schema)


def sample_first_last(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    """L2: the ends are taken on codes, as every label follows from the code before it; only they are decoded."""
    codes = [c for c in CONSOLIDATED_COLUMNS if not c.endswith("_desc")]
    ends = profile.head_tail(survey(spark, sf_dir, only=codes), codes, n)
    return (label(ends, all_dims(spark), list(PROCESSED_COLUMNS), dim_sizes(), extra=[M, "part", "pos"])
            .select(*CONSOLIDATED_COLUMNS, "part", "pos"))


# ---------------------------------------------------- generic operators reuse

def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, P11 over events: lenient number and date parsing of text columns."""
    ev = _t(spark, sf_dir, "events")
    num_txt = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("event_id").cast("string"))
    day = F.lpad((F.col("event_id") % 40).cast("string"), 2, "0")
    date_txt = F.concat(F.lit("2024-01-"), day)
    return ev.select("event_id", num_txt.alias("num_txt"), lenient_number(num_txt).alias("num"),
                     date_txt.alias("date_txt"), lenient_date(date_txt).alias("dt"))


def freq_nation_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _t(spark, sf_dir, "customer").select("c_nationkey")
    nation = bounded_broadcast(_t(spark, sf_dir, "nation").select("n_nationkey", "n_name"), max_rows=10_000)
    joined = cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"], "left").select("n_name")
    return freq.top_k(joined, "n_name", 15)


def crosstab_priority_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    return rates.crosstab_pct(o, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


def crosstab_priority_status_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 over the observed answers, none listed by hand."""
    return rates.answer_shares(_t(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")


def freq_priority_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6: none of the listed categories occurs, so the observed ones are shown."""
    return freq.ordered_counts(_t(spark, sf_dir, "orders"), "o_orderpriority", ["HIGH", "LOW"], fallback_observed=True)


def trend_event_error_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events").select(F.to_date("ts").alias("dia"), "event_type")
    return rates.answer_rates(ev, "dia", ["event_type"], ["pct_error"], answer="error")


def hist_totalprice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.histogram(_t(spark, sf_dir, "orders"), "o_totalprice", 50)


def kde_extendedprice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A18 on a column of almost as many values as rows."""
    return distribution.kde(_t(spark, sf_dir, "lineitem"), "l_extendedprice", 200, bins=30)


def box_extendedprice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.boxplot_stats(_t(spark, sf_dir, "lineitem"), "l_extendedprice")


def describe_extendedprice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.describe_numeric(_t(spark, sf_dir, "lineitem"),
                                  ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


# --------------------------------------------------------------------- table

INCOME = ["RendimentoHabitual_Valor"]
# numeric and text columns of the consolidated table, in table order; the decimal
# income is summarised with the numeric columns, explicitly (as double)
NUMERIC = [c for c in CONSOLIDATED_COLUMNS
           if c.endswith("_cod") or c in ("Ano", "Peso_Amostral", "Idade", "RendimentoHabitual_Valor")]
TEXT = [c for c in CONSOLIDATED_COLUMNS if c.endswith("_desc") or c == "FaixaRendimento_cod_str"]

_QUERIES: dict[str, Query] = {
    # decode, consolidate, pruned scan
    "survey_processed": survey_processed,
    "survey_consolidated_counts": survey_consolidated_counts,
    "scan_pruned_filtered": scan_pruned_filtered,
    # profile / frequency family
    "first_look_top15": first_look_top15,
    "freq_uf_top15": _on_counts(A.qa1_uf_top, ["uf_desc"]),
    "freq_sexo": _on_counts(A.qa3_sexo, ["sexo_desc"]),
    "freq_cor_raca": _on_counts(A.qa4_cor_raca, ["cor_raca_desc"]),
    "freq_escolaridade_ordered": _on_counts(A.qa5_escolaridade, ["escolaridade_desc"]),
    "freq_rendimento_ordered": _on_counts(A.qa6_rendimento, ["FaixaRendimento_desc"]),
    "freq_ocupacao_informed": _on_counts(A.qa8_ocupacao_informed, ["PosicaoOcupacao_desc"]),
    "freq_trabalhou": _on_counts(A.qc1_trabalhou, ["Trabalhou_desc"]),
    "away_yes_no": _on_counts(A.qc2_away_yes_no, ["AfastadoTrabalho_desc"]),
    "away_all_top5": _on_counts(A.qc2_away_all_top5, ["AfastadoTrabalho_desc"]),
    "away_active_not_working": _on_survey(A.qc21_away_active_not_working,
                                          ["Idade", "Trabalhou_desc", "AfastadoTrabalho_desc"]),
    "ocupacao_weighted": _on_survey(A.qc3_ocupacao_weighted, ["PosicaoOcupacao_desc", "Peso_Amostral"]),
    "freq_rendimento_informed": _on_counts(A.qc4_rendimento_informed, ["FaixaRendimento_desc"]),
    "freq_auxilio": _on_counts(A.qc5_auxilio, ["AuxilioEmergencial_desc"]),
    # clinical
    "symptom_prevalence": _on_counts(A.qb1_symptom_prevalence, SYM),
    "care_among_symptomatic": _on_counts(A.qb2_care_among_symptomatic, SYM + ["ProcurouAtendimento_desc"]),
    "hosp_among_care": _on_counts(A.qb3_hosp_among_care,
                                  SYM + ["ProcurouAtendimento_desc", "InternadoHospital_desc"]),
    "crosstab_plan_care": _on_survey(A.qb4_plan_x_care, SYM + ["PlanoSaude_desc", "ProcurouAtendimento_desc"]),
    # trends
    "trend_symptoms": _on_survey(A.qd1_trend_symptoms, [M] + SYM),
    "trend_care": _on_survey(A.qd2_trend_care, [M] + SYM + ["ProcurouAtendimento_desc"]),
    "trend_work_aid": _on_survey(A.qd3_trend_work_aid, [M, "Trabalhou_desc", "AuxilioEmergencial_desc"]),
    "trend_work_aid_filtered": trend_work_aid_filtered,
    "month_fever_answer_shares": _on_survey(A.qd_month_answer_shares, [M, "Febre_desc"]),
    # profiles of care seekers
    "profile_care_seekers": _on_survey(A.qe1_profile_care_seekers,
                                       SYM + ["ProcurouAtendimento_desc", "Idade", "sexo_desc", "escolaridade_desc"]),
    "symptoms_of_care_seekers": _on_survey(A.qe2_symptoms_of_care_seekers, SYM + ["ProcurouAtendimento_desc"]),
    "crosstab_income_hosp": _on_survey(A.qe3_income_x_hosp, SYM + ["ProcurouAtendimento_desc",
                                                                   "InternadoHospital_desc",
                                                                   "FaixaRendimento_desc"]),
    # distributions
    "describe_age": _on_survey(A.qa2_age_describe, ["Idade"]),
    "hist_age_30": _on_survey(A.qa2_age_hist, ["Idade"]),
    "hist_age_20": _on_survey(lambda df: A.qa2_age_hist(df, 20), ["Idade"]),
    "kde_age": _on_survey(A.qa2_age_kde, ["Idade"]),
    "box_age": _on_survey(A.qa2_age_box, ["Idade"]),
    "describe_income": _on_survey(A.qa7_income_describe, INCOME),
    "hist_income_100": _on_survey(A.qa7_income_hist, INCOME),
    "quantiles_income": _on_survey(A.qa7_income_quantiles, INCOME),
    "box_income": _on_survey(A.qa7_income_box, INCOME),
    # table profiles
    "describe_numeric_all": lambda spark, sf: stats.describe_numeric(survey(spark, sf, only=NUMERIC), NUMERIC),
    "describe_categorical": describe_categorical,
    "completeness": completeness,
    "sample_first_last": sample_first_last,
    # observed answers, absent categories, shares before the filter, dashboard filters
    "freq_rendimento_all_bands": freq_rendimento_all_bands,
    "freq_priority_fallback": freq_priority_fallback,
    "crosstab_priority_status_long": crosstab_priority_status_long,
    "month_fever_answers_long": _on_survey(lambda df: rates.answer_shares(df, M, "Febre_desc"), [M, "Febre_desc"]),
    "trabalhou_yes_no": _on_counts(A.qc1_trabalhou_yes_no, ["Trabalhou_desc"]),
    "away_active_yes_no": _on_survey(A.qc21_away_active_yes_no, ["Idade", "Trabalhou_desc", "AfastadoTrabalho_desc"]),
    "freq_sexo_filtered": freq_sexo_filtered,
    "hist_age_20_filtered": hist_age_20_filtered,
    # dashboard
    "kpi_row": _on_survey(A.qk_kpi, ["Febre_desc", "AuxilioEmergencial_desc"]),
    "kpi_row_filtered": kpi_row_filtered,
    "kpi_row_text": _on_survey(A.qk_kpi_text, ["Febre_desc", "AuxilioEmergencial_desc"]),
    "filter_options": _on_survey(A.qo_filter_options, [M, "uf_desc", "sexo_desc"]),
    "month_labels": _on_survey(A.month_labels, [M]),
    # generic operators on the driver's own tables
    "stacked_accounts": stacked_accounts,
    "lenient_casts": lenient_casts,
    "freq_nation_top15": freq_nation_top15,
    "crosstab_priority_status": crosstab_priority_status,
    "trend_event_error_daily": trend_event_error_daily,
    "hist_totalprice": hist_totalprice,
    "kde_extendedprice": kde_extendedprice,
    "box_extendedprice": box_extendedprice,
    "describe_lineitem": describe_extendedprice,
}

QUERIES: dict[str, Query] = {
    name: (lambda fn: lambda spark, sf_dir: portable(fn(spark, sf_dir)))(fn) for name, fn in _QUERIES.items()
}
