"""Named analyses over the consolidated survey frame: ``f(df) -> DataFrame``.

Each function is a lazy plan; nothing runs until the caller acts on it (the
exact-quantile analyses run bounded statistics passes first).  On the stored
table, column pruning keeps every read to the columns an analysis uses; on raw
data, ``plans.consolidate.survey(..., only=...)`` decodes just those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import cut, date_key, label_map, month_label, pct, pct_text
from ..operators import distribution, filters, freq, profile, rates, stats
from ..operators.exact import exact_sums
from ..schema import (AGE_BAND_EDGES, AGE_BAND_LABELS, DIM_ROWS,
                      EDUCATION_ORDER, HOSPITAL_YES_NO, INCOME_BAND_INFORMED_ORDER,
                      INCOME_BAND_ORDER, MONTH_COLUMN, MONTH_LABELS, NO, NOT_INFORMED,
                      SYMPTOMS, YES)

SYMPTOM_COLS = list(SYMPTOMS.values())
SYMPTOM_NAMES = ["febre", "tosse", "dificuldade_respirar", "perda_olfato_paladar"]
ANSWERS = [label for _, label in DIM_ROWS["sim_nao_sabe_ignorado"]] + [NOT_INFORMED]
SEX_LABELS = [label for _, label in DIM_ROWS["sexo"]] + [NOT_INFORMED]
M = MONTH_COLUMN


FIRST_LOOK = ["uf_desc", "sexo_desc", "escolaridade_desc", "FaixaRendimento_desc", M, "Febre_desc", "ProcurouAtendimento_desc"]


# ------------------------------------------------------------- A: profile

def q2_first_look(df: DataFrame, k: int = 15) -> DataFrame:
    """Top-15 frequency of seven key columns (NULL group included), one scan."""
    return most_frequent(freq.multi_value_counts(df, FIRST_LOOK, with_pct=False), k)


def most_frequent(t: DataFrame, k: int = 15) -> DataFrame:
    """The k most frequent values of each measure, from (measure, value, n)."""
    rk = F.row_number().over(Window.partitionBy("measure").orderBy(F.desc("n"), F.asc_nulls_last("value")))
    return t.withColumn("rk", rk).where(F.col("rk") <= k).select("measure", "value", "n", "rk")


def qa1_uf_top(df: DataFrame, k: int = 15) -> DataFrame:
    return freq.top_k(df, "uf_desc", k)


def qa2_age_describe(df: DataFrame) -> DataFrame:
    return stats.describe(df, "Idade")


def qa2_age_hist(df: DataFrame, bins: int = 30) -> DataFrame:
    return distribution.histogram(df, "Idade", bins)


def qa2_age_kde(df: DataFrame, bins: int = 30) -> DataFrame:
    return distribution.kde(df, "Idade", 200, bins=bins)


def qa2_age_box(df: DataFrame) -> DataFrame:
    return stats.boxplot_stats(df, "Idade")


def qa3_sexo(df: DataFrame) -> DataFrame:
    return freq.value_counts_pct(df, "sexo_desc")


def qa4_cor_raca(df: DataFrame) -> DataFrame:
    return freq.value_counts_pct(df, "cor_raca_desc")


def qa5_escolaridade(df: DataFrame) -> DataFrame:
    return freq.ordered_counts(df, "escolaridade_desc", EDUCATION_ORDER)


def qa6_rendimento(df: DataFrame) -> DataFrame:
    return freq.ordered_counts(df, "FaixaRendimento_desc", INCOME_BAND_ORDER)


def _income(df: DataFrame) -> DataFrame:
    # lenient numeric parse of the decimal income; unparseable/NULL dropped
    return df.select(F.col("RendimentoHabitual_Valor").try_cast(T.DoubleType()).alias("renda"), *freq.counted(df)) \
             .where(F.col("renda").isNotNull())


def qa7_income_describe(df: DataFrame) -> DataFrame:
    return stats.describe(_income(df), "renda")


def qa7_income_hist(df: DataFrame, bins: int = 100) -> DataFrame:
    return distribution.histogram(_income(df), "renda", bins)


def qa7_income_quantiles(df: DataFrame, threshold: float = 20000.0) -> DataFrame:
    return stats.quantile_report(_income(df), "renda", [0.95, 0.99], ["p95", "p99"], threshold)


def qa7_income_box(df: DataFrame) -> DataFrame:
    return stats.boxplot_stats(_income(df), "renda")


def qa8_ocupacao_informed(df: DataFrame) -> DataFrame:
    return freq.value_counts(filters.informed(df, "PosicaoOcupacao_desc"), "PosicaoOcupacao_desc")


# ------------------------------------------------------------- B: clinical

def qb1_symptom_prevalence(df: DataFrame) -> DataFrame:
    return freq.multi_value_counts(df, SYMPTOM_COLS, list(SYMPTOMS.keys()), "sintoma", "resposta")


def qb2_care_among_symptomatic(df: DataFrame) -> DataFrame:
    return freq.value_counts_pct(filters.symptomatic(df), "ProcurouAtendimento_desc")


def qb3_hosp_among_care(df: DataFrame) -> DataFrame:
    return freq.value_counts_pct(filters.sought_care(filters.symptomatic(df)), "InternadoHospital_desc")


def qb4_plan_x_care(df: DataFrame) -> DataFrame:
    return rates.crosstab_pct(filters.symptomatic(df), "PlanoSaude_desc", "ProcurouAtendimento_desc", ANSWERS)


# ------------------------------------------------------------- C: economy

def qc1_trabalhou(df: DataFrame) -> DataFrame:
    return freq.value_counts_pct(df, "Trabalhou_desc").where(F.col("n") > 0)


def qc1_trabalhou_yes_no(df: DataFrame) -> DataFrame:
    """Shares over all answers, of which only Yes and No are shown."""
    return filters.isin(freq.value_counts_pct(df, "Trabalhou_desc"), "Trabalhou_desc", [YES, NO])


def qc2_away_yes_no(df: DataFrame) -> DataFrame:
    return freq.value_counts_pct(filters.isin(df, "AfastadoTrabalho_desc", [YES, NO]), "AfastadoTrabalho_desc")


def qc2_away_all_top5(df: DataFrame) -> DataFrame:
    return freq.top_k(df, "AfastadoTrabalho_desc", 5, with_pct=False)


def qc21_away_active_not_working(df: DataFrame) -> DataFrame:
    return freq.value_counts_pct(filters.active_not_working(df), "AfastadoTrabalho_desc")


def qc21_away_active_yes_no(df: DataFrame) -> DataFrame:
    """The Yes and No shares of the series above, still of all its answers."""
    return filters.isin(qc21_away_active_not_working(df), "AfastadoTrabalho_desc", [YES, NO])


def qc3_ocupacao_weighted(df: DataFrame) -> DataFrame:
    """Informed occupations: count, percent and weighted population (one aggregation)."""
    col = "PosicaoOcupacao_desc"
    base = filters.informed(df, col)
    g = exact_sums(base, [col], "Peso_Amostral", "populacao_estimada", F.count(F.lit(1)).alias("n"))
    return (g.select(col, "n", freq.share_of_total(g).alias("pct"), "populacao_estimada")
            .orderBy(F.desc("populacao_estimada"), F.asc(col)))


def qc4_rendimento_informed(df: DataFrame) -> DataFrame:
    return freq.ordered_counts(filters.informed(df, "FaixaRendimento_desc"), "FaixaRendimento_desc",
                               INCOME_BAND_INFORMED_ORDER)


def qc5_auxilio(df: DataFrame) -> DataFrame:
    return freq.value_counts_pct(df, "AuxilioEmergencial_desc")


# ------------------------------------------------------------- D: trends

def qd1_trend_symptoms(df: DataFrame) -> DataFrame:
    return rates.answer_rates(df, M, SYMPTOM_COLS, SYMPTOM_NAMES).withColumn("mes", month_label(M))


def qd2_trend_care(df: DataFrame) -> DataFrame:
    return (rates.answer_rates(filters.symptomatic(df), M, ["ProcurouAtendimento_desc"], ["procurou_atendimento"])
            .withColumn("mes", month_label(M)))


def qd3_trend_work_aid(df: DataFrame) -> DataFrame:
    return (rates.answer_rates(df, M, ["Trabalhou_desc", "AuxilioEmergencial_desc"], ["trabalhou", "auxilio"])
            .withColumn("mes", month_label(M, "MM/yy")))


def qd_month_answer_shares(df: DataFrame, col: str = "Febre_desc") -> DataFrame:
    """Per month, the percent of every answer of one question (wide, absent -> 0)."""
    return rates.group_shares(df, M, col, ANSWERS)


# ------------------------------------------------------------- E: profiles

def qe1_profile_care_seekers(df: DataFrame) -> DataFrame:
    """Age band (all bands, zeros kept), sex and education of symptomatic care seekers.

    One scan and one global aggregation: a conditional count per category of
    each dimension (the categories are the code-table labels plus the default,
    so the domain is known).  Age bands keep empty bands; education keeps the
    present categories in domain order; sex keeps the present categories,
    most frequent first.
    """
    base = filters.sought_care(filters.symptomatic(df))
    band = cut(F.col("Idade"), AGE_BAND_EDGES, AGE_BAND_LABELS)
    dims = [("faixa_etaria", band, AGE_BAND_LABELS),
            ("sexo", F.col("sexo_desc"), SEX_LABELS),
            ("escolaridade", F.col("escolaridade_desc"), EDUCATION_ORDER)]
    aggs, structs = [], []
    for d, expr, labels in dims:
        for i, v in enumerate(labels):
            aggs.append(freq.rows_where(base, expr == F.lit(v)).alias(f"__{d}_{i}"))
            structs.append(F.struct(F.lit(d).alias("dimensao"), F.lit(v).alias("categoria"),
                                    F.lit(i).alias("ord"), F.col(f"__{d}_{i}").alias("n")))
    rows = base.agg(*aggs).select(F.inline(F.array(*structs)))
    sexw = Window.partitionBy("dimensao").orderBy(F.desc("n"), F.asc("categoria"))  # <= 3 rows
    ages = rows.where(F.col("dimensao") == "faixa_etaria")
    edu = rows.where((F.col("dimensao") == "escolaridade") & (F.col("n") > 0))
    sex = (rows.where((F.col("dimensao") == "sexo") & (F.col("n") > 0))
           .withColumn("ord", (F.row_number().over(sexw) - 1).cast(T.IntegerType())))
    return (ages.unionByName(sex).unionByName(edu)
            .select("dimensao", "categoria", F.col("ord").cast(T.IntegerType()).alias("ord"),
                    F.col("n").cast(T.LongType()).alias("n"))
            .orderBy("dimensao", "ord"))


def qe2_symptoms_of_care_seekers(df: DataFrame) -> DataFrame:
    return freq.count_answers(filters.sought_care(df), SYMPTOM_COLS, YES, "sintoma", "contagem_sim")


def qe3_income_x_hosp(df: DataFrame) -> DataFrame:
    base = filters.informed(
        filters.isin(filters.sought_care(filters.symptomatic(df)), "InternadoHospital_desc", HOSPITAL_YES_NO),
        "FaixaRendimento_desc")
    return rates.crosstab_pct(base, "FaixaRendimento_desc", "InternadoHospital_desc", HOSPITAL_YES_NO,
                              row_order=INCOME_BAND_INFORMED_ORDER)


# ------------------------------------------------------------- dashboard

def dashboard_view(fn, df: DataFrame, uf=None, sexo=None, mes=None) -> DataFrame:
    """Any analysis under the dashboard's filters.

    Views along months ignore the month filter; option lists ignore all filters.
    """
    return fn(filters.survey_filter(df, **filters_of(fn, uf, sexo, mes)))


def filters_of(fn, uf=None, sexo=None, mes=None) -> dict:
    """Those of the dashboard's filters that hold for an analysis."""
    if fn in (qo_filter_options, month_labels):
        return {"uf": None, "sexo": None, "mes": None}
    along_months = fn in (qd1_trend_symptoms, qd2_trend_care, qd3_trend_work_aid, qd_month_answer_shares)
    return {"uf": uf, "sexo": sexo, "mes": None if along_months else mes}


def qk_kpi(df: DataFrame, uf=None, sexo=None, mes=None) -> DataFrame:
    return rates.kpi_row(filters.survey_filter(df, uf=uf, sexo=sexo, mes=mes))


def qk_kpi_text(df: DataFrame, uf=None, sexo=None, mes=None) -> DataFrame:
    """The KPI row as display text: '60,000', '4.9%', '45.5%'."""
    k = qk_kpi(df, uf=uf, sexo=sexo, mes=mes)
    return k.select(F.format_number("respondentes", 0).alias("respondentes"),
                    pct_text(F.col("pct_febre"), 1).alias("pct_febre"),
                    pct_text(F.col("pct_auxilio"), 1).alias("pct_auxilio"))


def qo_filter_options(df: DataFrame) -> DataFrame:
    """Option lists of the month, UF and sex filters -> (filtro, valor, rotulo)."""
    month_key = date_key(F.col(M))
    long = df.select(F.explode(F.array(
        F.struct(F.lit("mes").alias("filtro"), month_key.alias("valor")),
        F.struct(F.lit("uf").alias("filtro"), F.col("uf_desc").alias("valor")),
        F.struct(F.lit("sexo").alias("filtro"), F.col("sexo_desc").alias("valor")),
    )).alias("__s")).select("__s.*").where(F.col("valor").isNotNull()).distinct()
    rotulo = F.when(F.col("filtro") == "mes", label_map(F.col("valor"), MONTH_LABELS)).otherwise(F.col("valor"))
    return long.select("filtro", "valor", rotulo.alias("rotulo")).orderBy("filtro", "valor")


def month_labels(df: DataFrame) -> DataFrame:
    """Distinct months with key, display label and short labels."""
    months = profile.distinct_sorted(df, M)
    return months.select(M, date_key(M).alias("chave"), label_map(date_key(M), MONTH_LABELS).alias("rotulo"),
                         month_label(M).alias("ano_mes"), month_label(M, "MM/yy").alias("mes_curto"))
