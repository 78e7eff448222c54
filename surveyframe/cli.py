"""Command line: build the analytic table from monthly extracts, run the analyses.

    python -m surveyframe.cli build  --csv 'extracts/*.csv' --table /shared/survey
    python -m surveyframe.cli build  --csv extracts/july.csv --table /shared/survey --replace
    python -m surveyframe.cli analyze --table /shared/survey --out /shared/reports [--only name ...] [--uf Bahia] [--mes Julho/2020]
    python -m surveyframe.cli kpi --table /shared/survey --uf Bahia --mes Setembro/2020

``build`` lands the extracts, decodes all months in one pass and writes the
month-partitioned table.  ``analyze`` counts for all analyses in one scan of that
table (``plans.together``; one more for the weighted totals) and writes every
result as Parquet under ``--out/<name>``.
"""

from __future__ import annotations

import argparse
import sys

from .plans import analyses as A
from .plans.consolidate import consolidated
from .plans.together import at_once, together
from .session import get_spark
from .sources.raw import read_raw_csv
from .sources.tables import dashboard_scan, read_consolidated, replace_months, write_consolidated

ANALYSES = {
    "first_look_top15": A.q2_first_look,
    "uf_top15": A.qa1_uf_top,
    "age_describe": A.qa2_age_describe,
    "age_hist_30": A.qa2_age_hist,
    "age_kde": A.qa2_age_kde,
    "age_box": A.qa2_age_box,
    "sexo": A.qa3_sexo,
    "cor_raca": A.qa4_cor_raca,
    "escolaridade": A.qa5_escolaridade,
    "rendimento_faixa": A.qa6_rendimento,
    "rendimento_describe": A.qa7_income_describe,
    "rendimento_hist_100": A.qa7_income_hist,
    "rendimento_quantis": A.qa7_income_quantiles,
    "rendimento_box": A.qa7_income_box,
    "ocupacao_informada": A.qa8_ocupacao_informed,
    "sintomas": A.qb1_symptom_prevalence,
    "atendimento_sintomaticos": A.qb2_care_among_symptomatic,
    "internacao_atendidos": A.qb3_hosp_among_care,
    "plano_x_atendimento": A.qb4_plan_x_care,
    "trabalhou": A.qc1_trabalhou,
    "afastado_sim_nao": A.qc2_away_yes_no,
    "afastado_top5": A.qc2_away_all_top5,
    "afastado_idade_ativa": A.qc21_away_active_not_working,
    "ocupacao_populacao": A.qc3_ocupacao_weighted,
    "rendimento_informado": A.qc4_rendimento_informed,
    "auxilio": A.qc5_auxilio,
    "evolucao_sintomas": A.qd1_trend_symptoms,
    "evolucao_atendimento": A.qd2_trend_care,
    "evolucao_trabalho_auxilio": A.qd3_trend_work_aid,
    "perfil_atendidos": A.qe1_profile_care_seekers,
    "sintomas_atendidos": A.qe2_symptoms_of_care_seekers,
    "rendimento_x_internacao": A.qe3_income_x_hosp,
    "kpi": A.qk_kpi,
    "opcoes_filtro": A.qo_filter_options,
    "meses": A.month_labels,
}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="surveyframe")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--csv", nargs="+", required=True, help="monthly extract files or globs")
    b.add_argument("--table", required=True)
    b.add_argument("--sep", default=",")
    b.add_argument("--replace", action="store_true", help="replace only the months of the extracts, keep the others")
    a = sub.add_parser("analyze")
    a.add_argument("--table", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--only", nargs="*")
    k = sub.add_parser("kpi")
    k.add_argument("--table", required=True)
    for p in (a, k):
        p.add_argument("--uf")
        p.add_argument("--sexo")
        p.add_argument("--mes", help="month key or label; views along months ignore it")
    args = ap.parse_args(argv)

    spark = get_spark()
    if args.cmd == "build":
        months = [read_raw_csv(spark, p, sep=args.sep) for p in args.csv]
        write = replace_months if args.replace else write_consolidated
        write(consolidated(spark, months), args.table)
    elif args.cmd == "analyze":
        df = read_consolidated(spark, args.table)
        names = args.only or list(ANALYSES)
        with together(df, [ANALYSES[n] for n in names], uf=args.uf, sexo=args.sexo, mes=args.mes) as results:
            at_once(lambda name: results[ANALYSES[name]].write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}"), names)
    else:
        A.qk_kpi(dashboard_scan(spark, args.table, uf=args.uf, sexo=args.sexo, mes=args.mes)).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
