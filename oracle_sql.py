"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the query definitions, not from the DataFrame code: labels are
decoded with CASE expressions instead of joins, shares with window sums,
quantiles with ``quantile_cont``.  Tables ``lineitem``, ``orders``, ``events``,
``customer``, ``nation`` are the driver's pre-registered views.
"""

from __future__ import annotations

from surveyframe.schema import (AGE_BAND_EDGES, AGE_BAND_LABELS, CONSOLIDATED_COLUMNS, DASHBOARD_COLUMNS,
                                DIM_ROWS, EDUCATION_ORDER, HOSPITAL_YES_NO, INCOME_BAND_INFORMED_ORDER,
                                INCOME_BAND_ORDER, MONTH_LABELS, PROCESSED_COLUMNS, YES)
from surveyframe.sources.raw import fixture_sql

NI = "'Não Informado'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(expr: str, rows: list[tuple]) -> str:
    whens = " ".join(f"WHEN {q(k) if isinstance(k, str) else k} THEN {q(v)}" for k, v in rows)
    return f"CASE {expr} {whens} ELSE {NI} END"


YN = DIM_ROWS["sim_nao_sabe_ignorado"]

RAW_CTE = f"""raw AS (
  SELECT CAST(Ano AS BIGINT) AS Ano, CAST(V1013 AS BIGINT) AS V1013, CAST(V1032 AS DOUBLE) AS V1032,
         CAST(UF AS BIGINT) AS UF, CAST(A002 AS BIGINT) AS A002, CAST(A003 AS BIGINT) AS A003,
         CAST(A004 AS BIGINT) AS A004, CAST(A005 AS BIGINT) AS A005, CAST(B0011 AS BIGINT) AS B0011,
         CAST(B0012 AS BIGINT) AS B0012, CAST(B0014 AS BIGINT) AS B0014, CAST(B00111 AS BIGINT) AS B00111,
         CAST(B002 AS BIGINT) AS B002, CAST(B005 AS BIGINT) AS B005, CAST(B007 AS BIGINT) AS B007,
         CAST(C001 AS BIGINT) AS C001, CAST(C002 AS BIGINT) AS C002, CAST(C007 AS BIGINT) AS C007,
         CAST(C01011 AS BIGINT) AS C01011, CAST(C01012 AS DECIMAL(38,9)) AS C01012, CAST(D0051 AS BIGINT) AS D0051
  FROM ({fixture_sql('lineitem')}) f
)"""

SURVEY_CTE = f"""survey AS (
  SELECT Ano, V1013 AS Mes_cod, V1032 AS Peso_Amostral,
    UF AS UF_cod, {_case('UF', DIM_ROWS['uf'])} AS uf_desc,
    A002 AS Idade,
    A003 AS Sexo_cod, {_case('A003', DIM_ROWS['sexo'])} AS sexo_desc,
    A004 AS CorRaca_cod, {_case('A004', DIM_ROWS['cor_raca'])} AS cor_raca_desc,
    A005 AS Escolaridade_cod, {_case('A005', DIM_ROWS['escolaridade'])} AS escolaridade_desc,
    B0011 AS Febre_cod, {_case('B0011', YN)} AS Febre_desc,
    B0012 AS Tosse_cod, {_case('B0012', YN)} AS Tosse_desc,
    B0014 AS DificuldadeRespirar_cod, {_case('B0014', YN)} AS DificuldadeRespirar_desc,
    B00111 AS PerdaOlfatoPaladar_cod, {_case('B00111', YN)} AS PerdaOlfatoPaladar_desc,
    B002 AS ProcurouAtendimento_cod, {_case('B002', YN)} AS ProcurouAtendimento_desc,
    B005 AS InternadoHospital_cod, {_case('B005', DIM_ROWS['internado_hospital'])} AS InternadoHospital_desc,
    B007 AS PlanoSaude_cod, {_case('B007', YN)} AS PlanoSaude_desc,
    C001 AS Trabalhou_cod, {_case('C001', YN)} AS Trabalhou_desc,
    C002 AS AfastadoTrabalho_cod, {_case('C002', YN)} AS AfastadoTrabalho_desc,
    C007 AS PosicaoOcupacao_cod, {_case('C007', DIM_ROWS['posicao_ocupacao'])} AS PosicaoOcupacao_desc,
    CASE WHEN C01011 IS NULL THEN NULL ELSE printf('%02d', C01011) END AS FaixaRendimento_cod_str,
    {_case("printf('%02d', C01011)", DIM_ROWS['faixa_rendimento'])} AS FaixaRendimento_desc,
    C01012 AS RendimentoHabitual_Valor,
    D0051 AS AuxilioEmergencial_cod, {_case('D0051', YN)} AS AuxilioEmergencial_desc,
    make_date(Ano, V1013, 1) AS DataReferencia_Mes
  FROM raw
)"""

PRE = f"WITH {RAW_CTE},\n{SURVEY_CTE}"

SYMPTOMATIC = ("(Febre_desc = 'Sim' OR Tosse_desc = 'Sim' OR DificuldadeRespirar_desc = 'Sim' "
               "OR PerdaOlfatoPaladar_desc = 'Sim')")
D = "CAST({} AS DOUBLE)"


def pctx(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) * 100.0 / CAST(NULLIF({den}, 0) AS DOUBLE)"


def freq_pct(col: str, where: str = "TRUE", extra_pre: str = PRE, src: str = "survey") -> str:
    return f"""{extra_pre}
SELECT {col}, n, {pctx('n', 'SUM(n) OVER ()')} AS pct
FROM (SELECT {col}, COUNT(*) AS n FROM {src} WHERE {where} GROUP BY {col}) t"""


def values_table(name: str, items: list[str]) -> str:
    rows = ", ".join(f"({q(v)}, {i})" for i, v in enumerate(items))
    return f"(SELECT col0 AS {name}, CAST(col1 AS INTEGER) AS ord FROM (VALUES {rows}) v(col0, col1))"


def ordered(col: str, order: list[str], where: str = "TRUE") -> str:
    return f"""{PRE},
c AS (SELECT {col}, n, {pctx('n', 'SUM(n) OVER ()')} AS pct
      FROM (SELECT {col}, COUNT(*) AS n FROM survey WHERE {where} GROUP BY {col}) t)
SELECT c.{col}, o.ord, c.n, c.pct FROM c JOIN {values_table(col, order)} o USING ({col})"""


def rates_by_month(where: str, cols: list[tuple[str, str]], mes_fmt: str) -> str:
    sel = ", ".join(
        f"COALESCE({pctx(f'count_if({c} = {q(YES)})', f'COUNT({c})')}, 0.0) AS {nm}" for c, nm in cols)
    dens = " + ".join(f"COUNT({c})" for c, _ in cols)
    return f"""{PRE}
SELECT DataReferencia_Mes, {sel}, strftime(DataReferencia_Mes, '{mes_fmt}') AS mes
FROM survey WHERE ({where}) AND DataReferencia_Mes IS NOT NULL
GROUP BY DataReferencia_Mes HAVING {dens} > 0"""


def num(expr: str, src: str, where: str = "TRUE") -> str:
    return f"x AS (SELECT CAST({expr} AS DOUBLE) AS x FROM {src} WHERE ({where}) AND ({expr}) IS NOT NULL)"


def hist(pre: str, xcte: str, bins: int) -> str:
    """Counts between explicit edges (mn + k * step, the last one the maximum), by range join."""
    return f"""{pre}{',' if pre else 'WITH'} {xcte},
b AS (SELECT CASE WHEN MIN(x) = MAX(x) THEN MIN(x) - 0.5 ELSE MIN(x) END AS mn,
             CASE WHEN MIN(x) = MAX(x) THEN MAX(x) + 0.5 ELSE MAX(x) END AS mx FROM x),
e AS (SELECT CAST(range AS INTEGER) AS bin, range * ((mx - mn) / {bins}) + mn AS lo,
             CASE WHEN range = {bins - 1} THEN mx ELSE (range + 1) * ((mx - mn) / {bins}) + mn END AS hi
      FROM range({bins}) CROSS JOIN b WHERE mn IS NOT NULL),
v AS (SELECT x, COUNT(*) AS c FROM x GROUP BY x)
SELECT e.bin, e.lo, e.hi, CAST(COALESCE(SUM(v.c), 0) AS BIGINT) AS n
FROM e LEFT JOIN v ON v.x >= e.lo AND (v.x < e.hi OR (e.bin = {bins - 1} AND v.x <= e.hi))
GROUP BY e.bin, e.lo, e.hi"""


def box(pre: str, xcte: str) -> str:
    return f"""{pre}{',' if pre else 'WITH'} {xcte},
qq AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3 FROM x)
SELECT COUNT(*) AS n, ROUND(ANY_VALUE(q1), 6) AS q1, ROUND(ANY_VALUE(med), 6) AS median, ROUND(ANY_VALUE(q3), 6) AS q3,
  MIN(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END) AS whisker_lo,
  MAX(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_hi,
  CAST(count_if(x < q1 - 1.5 * (q3 - q1)) AS BIGINT) AS n_out_lo,
  CAST(count_if(x > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_out_hi
FROM x CROSS JOIN qq"""


def kde(pre: str, xcte: str, bins: int) -> str:
    """Every distinct value against every one of 200 grid points, Scott's bandwidth."""
    return f"""{pre}{',' if pre else 'WITH'} {xcte},
st AS (SELECT COUNT(*) AS n, STDDEV_SAMP(x) AS sd, MIN(x) AS mn, MAX(x) AS mx FROM x),
p AS (SELECT n, mn, mx, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM st),
vc AS (SELECT x, COUNT(*) AS c FROM x GROUP BY x),
g AS (SELECT CAST(range AS INTEGER) AS i FROM range(200)),
k AS (SELECT g.i, SUM(vc.c * exp(-0.5 * ((p.mn + g.i * ((p.mx - p.mn) / 199) - vc.x) / p.h)
                                        * ((p.mn + g.i * ((p.mx - p.mn) / 199) - vc.x) / p.h))) AS s
      FROM g CROSS JOIN vc CROSS JOIN p GROUP BY g.i)
SELECT k.i, ROUND(p.mn + k.i * ((p.mx - p.mn) / 199), 9) AS x,
       ROUND(k.s / (CAST(p.n AS DOUBLE) * p.h * sqrt(2 * pi())), 9) AS density,
       ROUND(k.s / (CAST(p.n AS DOUBLE) * p.h * sqrt(2 * pi())) * CAST(p.n AS DOUBLE) * (p.mx - p.mn) / {bins}, 6)
         AS count_density
FROM k CROSS JOIN p WHERE p.h > 0"""


def describe_one(col: str, src: str, label: str | None = None, expr: str | None = None) -> str:
    e = expr or col
    head = f"{q(label)} AS \"column\", " if label else ""
    return f"""SELECT {head}COUNT({e}) AS "count", ROUND(AVG(CAST({e} AS DOUBLE)), 6) AS mean,
  ROUND(STDDEV_SAMP(CAST({e} AS DOUBLE)), 6) AS std, CAST(MIN({e}) AS DOUBLE) AS "min",
  ROUND(CAST(quantile_cont(CAST({e} AS DOUBLE), 0.25) AS DOUBLE), 6) AS q25,
  ROUND(CAST(quantile_cont(CAST({e} AS DOUBLE), 0.5) AS DOUBLE), 6) AS q50,
  ROUND(CAST(quantile_cont(CAST({e} AS DOUBLE), 0.75) AS DOUBLE), 6) AS q75,
  CAST(MAX({e}) AS DOUBLE) AS "max" FROM {src}"""


NUMERIC_COLS = [c for c in PROCESSED_COLUMNS
                if c.endswith("_cod") or c in ("Ano", "Peso_Amostral", "Idade", "RendimentoHabitual_Valor")]
STRING_COLS = [c for c in CONSOLIDATED_COLUMNS if c.endswith("_desc")] + ["FaixaRendimento_cod_str"]
DTYPES = {c: "bigint" for c in CONSOLIDATED_COLUMNS}
DTYPES.update({c: "string" for c in STRING_COLS})
DTYPES.update({"Peso_Amostral": "double", "RendimentoHabitual_Valor": "decimal(38,9)",
               "DataReferencia_Mes": "date"})

AGE_BAND = "CASE " + " ".join(
    f"WHEN Idade {'>=' if i == 0 else '>'} {AGE_BAND_EDGES[i]} AND Idade <= {AGE_BAND_EDGES[i + 1]} "
    f"THEN {q(lab)}" for i, lab in enumerate(AGE_BAND_LABELS)) + " END"

ORDER_ALL_ASC = ", ".join(f"{c} ASC NULLS FIRST" for c in CONSOLIDATED_COLUMNS)
ORDER_ALL_DESC = ", ".join(f"{c} DESC NULLS LAST" for c in CONSOLIDATED_COLUMNS)
ALLC = ", ".join(CONSOLIDATED_COLUMNS)

MONTH_CASE = "CASE valor " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in MONTH_LABELS.items()) + " ELSE valor END"

ANSWERS = [v for _, v in YN] + ["Não Informado"]


def crosstab(row: str, col: str, values: list[str], where: str) -> str:
    sel = ", ".join(f"{pctx(f'count_if({col} = {q(v)})', 'COUNT(*)')} AS \"{v}\"" for v in values)
    return f"SELECT {row}, {sel} FROM survey WHERE ({where}) AND {row} IS NOT NULL AND {col} IS NOT NULL GROUP BY {row}"


ORACLE: dict[str, str] = {
    "survey_processed": f"{PRE}\nSELECT {', '.join(PROCESSED_COLUMNS)} FROM survey",
    "survey_consolidated_counts": f"""{PRE}
SELECT DataReferencia_Mes, uf_desc, COUNT(*) AS n, CAST(SUM(Idade) AS BIGINT) AS soma_idade,
       ROUND(SUM(Peso_Amostral), 2) AS soma_peso
FROM survey GROUP BY DataReferencia_Mes, uf_desc""",
    "scan_pruned_filtered": f"""{PRE}
SELECT {', '.join(DASHBOARD_COLUMNS)} FROM survey
WHERE uf_desc = 'São Paulo' AND sexo_desc = 'Mulher' AND DataReferencia_Mes = DATE '2020-07-01'""",
    "first_look_top15": f"""{PRE},
s AS (
  SELECT 'uf_desc' AS measure, uf_desc AS value FROM survey UNION ALL
  SELECT 'sexo_desc', sexo_desc FROM survey UNION ALL
  SELECT 'escolaridade_desc', escolaridade_desc FROM survey UNION ALL
  SELECT 'FaixaRendimento_desc', FaixaRendimento_desc FROM survey UNION ALL
  SELECT 'DataReferencia_Mes', CAST(DataReferencia_Mes AS VARCHAR) FROM survey UNION ALL
  SELECT 'Febre_desc', Febre_desc FROM survey UNION ALL
  SELECT 'ProcurouAtendimento_desc', ProcurouAtendimento_desc FROM survey),
c AS (SELECT measure, value, COUNT(*) AS n FROM s GROUP BY measure, value),
r AS (SELECT measure, value, n,
        CAST(ROW_NUMBER() OVER (PARTITION BY measure ORDER BY n DESC, value ASC NULLS LAST) AS INTEGER) AS rk FROM c)
SELECT measure, value, n, rk FROM r WHERE rk <= 15""",
    "freq_uf_top15": freq_pct("uf_desc") + "\nORDER BY n DESC, uf_desc LIMIT 15",
    "freq_sexo": freq_pct("sexo_desc"),
    "freq_cor_raca": freq_pct("cor_raca_desc"),
    "freq_escolaridade_ordered": ordered("escolaridade_desc", EDUCATION_ORDER),
    "freq_rendimento_ordered": ordered("FaixaRendimento_desc", INCOME_BAND_ORDER),
    "freq_ocupacao_informed": f"""{PRE}
SELECT PosicaoOcupacao_desc, COUNT(*) AS n FROM survey
WHERE PosicaoOcupacao_desc IS DISTINCT FROM 'Não Informado' GROUP BY PosicaoOcupacao_desc""",
    "freq_trabalhou": freq_pct("Trabalhou_desc"),
    "away_yes_no": freq_pct("AfastadoTrabalho_desc", "AfastadoTrabalho_desc IN ('Sim', 'Não')"),
    "away_all_top5": f"""{PRE}
SELECT AfastadoTrabalho_desc, COUNT(*) AS n FROM survey GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5""",
    "away_active_not_working": freq_pct("AfastadoTrabalho_desc", "Idade >= 14 AND Trabalhou_desc = 'Não'"),
    "ocupacao_weighted": f"""{PRE}
SELECT PosicaoOcupacao_desc, n, {pctx('n', 'SUM(n) OVER ()')} AS pct, CAST(w AS DOUBLE) / pow(2.0, 80) AS populacao_estimada
FROM (SELECT PosicaoOcupacao_desc, COUNT(*) AS n, SUM(CAST(Peso_Amostral * pow(2.0, 80) AS HUGEINT)) AS w FROM survey
      WHERE PosicaoOcupacao_desc IS DISTINCT FROM 'Não Informado' GROUP BY 1) t""",
    "freq_rendimento_informed": ordered("FaixaRendimento_desc", INCOME_BAND_INFORMED_ORDER,
                                        "FaixaRendimento_desc IS DISTINCT FROM 'Não Informado'"),
    "freq_auxilio": freq_pct("AuxilioEmergencial_desc"),
    "symptom_prevalence": f"""{PRE},
s AS (SELECT 'Febre' AS sintoma, Febre_desc AS resposta FROM survey UNION ALL
      SELECT 'Tosse', Tosse_desc FROM survey UNION ALL
      SELECT 'Dificuldade para Respirar', DificuldadeRespirar_desc FROM survey UNION ALL
      SELECT 'Perda de Olfato/Paladar', PerdaOlfatoPaladar_desc FROM survey),
c AS (SELECT sintoma, resposta, COUNT(*) AS n FROM s GROUP BY 1, 2)
SELECT sintoma, resposta, n, {pctx('n', 'SUM(n) OVER (PARTITION BY sintoma)')} AS pct FROM c""",
    "care_among_symptomatic": freq_pct("ProcurouAtendimento_desc", SYMPTOMATIC),
    "hosp_among_care": freq_pct("InternadoHospital_desc", SYMPTOMATIC + " AND ProcurouAtendimento_desc = 'Sim'"),
    "crosstab_plan_care": f"{PRE}\n" + crosstab("PlanoSaude_desc", "ProcurouAtendimento_desc", ANSWERS, SYMPTOMATIC),
    "trend_symptoms": rates_by_month("TRUE", [("Febre_desc", "febre"), ("Tosse_desc", "tosse"),
                                              ("DificuldadeRespirar_desc", "dificuldade_respirar"),
                                              ("PerdaOlfatoPaladar_desc", "perda_olfato_paladar")], "%Y-%m"),
    "trend_care": rates_by_month(SYMPTOMATIC, [("ProcurouAtendimento_desc", "procurou_atendimento")], "%Y-%m"),
    "trend_work_aid": rates_by_month("TRUE", [("Trabalhou_desc", "trabalhou"),
                                              ("AuxilioEmergencial_desc", "auxilio")], "%m/%y"),
    "trend_work_aid_filtered": rates_by_month("uf_desc = 'Minas Gerais' AND sexo_desc = 'Mulher'",
                                              [("Trabalhou_desc", "trabalhou"),
                                               ("AuxilioEmergencial_desc", "auxilio")], "%m/%y"),
    "month_fever_answer_shares": f"""{PRE}
SELECT DataReferencia_Mes, {', '.join(f'{pctx(f"count_if(Febre_desc = {q(v)})", "COUNT(Febre_desc)")} AS "{v}"' for v in ANSWERS)}
FROM survey WHERE DataReferencia_Mes IS NOT NULL GROUP BY DataReferencia_Mes HAVING COUNT(Febre_desc) > 0""",
    "profile_care_seekers": f"""{PRE},
base AS (SELECT * FROM survey WHERE {SYMPTOMATIC} AND ProcurouAtendimento_desc = 'Sim'),
ages AS (SELECT {AGE_BAND} AS categoria, COUNT(*) AS n FROM base GROUP BY 1),
sexo AS (SELECT sexo_desc AS categoria, COUNT(*) AS n FROM base GROUP BY 1),
edu AS (SELECT escolaridade_desc AS categoria, COUNT(*) AS n FROM base GROUP BY 1)
SELECT 'faixa_etaria' AS dimensao, o.categoria, o.ord, COALESCE(a.n, 0) AS n
FROM {values_table('categoria', AGE_BAND_LABELS)} o LEFT JOIN ages a ON a.categoria = o.categoria
UNION ALL
SELECT 'sexo', categoria, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, categoria) - 1 AS INTEGER), n
FROM sexo WHERE categoria IS NOT NULL
UNION ALL
SELECT 'escolaridade', e.categoria, o.ord, e.n FROM edu e JOIN {values_table('categoria', EDUCATION_ORDER)} o
  ON e.categoria = o.categoria""",
    "symptoms_of_care_seekers": f"""{PRE},
b AS (SELECT * FROM survey WHERE ProcurouAtendimento_desc = 'Sim')
SELECT 'Febre' AS sintoma, CAST(count_if(Febre_desc = 'Sim') AS BIGINT) AS contagem_sim FROM b UNION ALL
SELECT 'Tosse', CAST(count_if(Tosse_desc = 'Sim') AS BIGINT) FROM b UNION ALL
SELECT 'DificuldadeRespirar', CAST(count_if(DificuldadeRespirar_desc = 'Sim') AS BIGINT) FROM b UNION ALL
SELECT 'PerdaOlfatoPaladar', CAST(count_if(PerdaOlfatoPaladar_desc = 'Sim') AS BIGINT) FROM b""",
    "crosstab_income_hosp": f"""{PRE},
t AS ({crosstab('FaixaRendimento_desc', 'InternadoHospital_desc', HOSPITAL_YES_NO,
                SYMPTOMATIC + " AND ProcurouAtendimento_desc = 'Sim' AND InternadoHospital_desc IN ("
                + ", ".join(q(v) for v in HOSPITAL_YES_NO) + ") AND FaixaRendimento_desc IS DISTINCT FROM 'Não Informado'")})
SELECT t.*, o.ord FROM t JOIN {values_table('FaixaRendimento_desc', INCOME_BAND_INFORMED_ORDER)} o
  USING (FaixaRendimento_desc)""",
    "describe_age": f"{PRE}\n" + describe_one("Idade", "survey"),
    "hist_age_30": hist(PRE, num("Idade", "survey"), 30),
    "hist_age_20": hist(PRE, num("Idade", "survey"), 20),
    "kde_age": kde(PRE, num("Idade", "survey"), 30),
    "kde_extendedprice": kde("", num("l_extendedprice", "lineitem"), 30),
    "box_age": box(PRE, num("Idade", "survey")),
    "describe_income": f"{PRE}, {num('TRY_CAST(RendimentoHabitual_Valor AS DOUBLE)', 'survey')}\n"
                       + describe_one("x", "x"),
    "hist_income_100": hist(PRE, num("TRY_CAST(RendimentoHabitual_Valor AS DOUBLE)", "survey"), 100),
    "quantiles_income": f"""{PRE}, {num('TRY_CAST(RendimentoHabitual_Valor AS DOUBLE)', 'survey')}
SELECT ROUND(quantile_cont(x, 0.95), 6) AS p95, ROUND(quantile_cont(x, 0.99), 6) AS p99,
       CAST(count_if(x > 20000.0) AS BIGINT) AS n_above, COUNT(x) AS n FROM x""",
    "box_income": box(PRE, num("TRY_CAST(RendimentoHabitual_Valor AS DOUBLE)", "survey")),
    "describe_numeric_all": f"{PRE}\n" + "\nUNION ALL\n".join(describe_one(c, "survey", c) for c in NUMERIC_COLS),
    "describe_categorical": f"""{PRE},
s AS ({' UNION ALL '.join(f"SELECT {q(c)} AS col, CAST({c} AS VARCHAR) AS value FROM survey" for c in STRING_COLS)}),
vc AS (SELECT col, value, COUNT(*) AS n FROM s WHERE value IS NOT NULL GROUP BY col, value),
r AS (SELECT col, value, n, ROW_NUMBER() OVER (PARTITION BY col ORDER BY n DESC, value) AS rk,
             SUM(n) OVER (PARTITION BY col) AS cnt, COUNT(*) OVER (PARTITION BY col) AS uniq FROM vc)
SELECT col AS "column", CAST(cnt AS BIGINT) AS "count", CAST(uniq AS BIGINT) AS "unique", value AS top, n AS freq
FROM r WHERE rk = 1""",
    "completeness": f"{PRE}\n" + "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS position, {q(c)} AS \"column\", {q(DTYPES[c])} AS dtype, "
        f"COUNT({c}) AS non_null FROM survey" for i, c in enumerate(CONSOLIDATED_COLUMNS)),
    "sample_first_last": f"""{PRE},
h AS (SELECT {ALLC} FROM survey ORDER BY {ORDER_ALL_ASC} LIMIT 5),
t AS (SELECT {ALLC} FROM survey ORDER BY {ORDER_ALL_DESC} LIMIT 5)
SELECT *, 'head' AS part, CAST(ROW_NUMBER() OVER (ORDER BY {ORDER_ALL_ASC}) AS INTEGER) AS pos FROM h
UNION ALL
SELECT *, 'tail' AS part, CAST(ROW_NUMBER() OVER (ORDER BY {ORDER_ALL_DESC}) AS INTEGER) AS pos FROM t""",
    "kpi_row": f"""{PRE}
SELECT COUNT(*) AS respondentes, {pctx("count_if(Febre_desc = 'Sim')", 'COUNT(*)')} AS pct_febre,
       {pctx("count_if(AuxilioEmergencial_desc = 'Sim')", 'COUNT(*)')} AS pct_auxilio FROM survey""",
    "kpi_row_filtered": f"""{PRE}
SELECT COUNT(*) AS respondentes, {pctx("count_if(Febre_desc = 'Sim')", 'COUNT(*)')} AS pct_febre,
       {pctx("count_if(AuxilioEmergencial_desc = 'Sim')", 'COUNT(*)')} AS pct_auxilio FROM survey
WHERE uf_desc = 'Bahia' AND sexo_desc = 'Homem' AND DataReferencia_Mes = DATE '2020-09-01'""",
    "kpi_row_text": f"""{PRE}
SELECT format('{{:,}}', COUNT(*)) AS respondentes,
       printf('%.1f%%', {pctx("count_if(Febre_desc = 'Sim')", 'COUNT(*)')}) AS pct_febre,
       printf('%.1f%%', {pctx("count_if(AuxilioEmergencial_desc = 'Sim')", 'COUNT(*)')}) AS pct_auxilio FROM survey""",
    "filter_options": f"""{PRE},
o AS (SELECT DISTINCT 'mes' AS filtro, strftime(DataReferencia_Mes, '%Y-%m-%d') AS valor FROM survey
      WHERE DataReferencia_Mes IS NOT NULL
      UNION SELECT DISTINCT 'uf', uf_desc FROM survey WHERE uf_desc IS NOT NULL
      UNION SELECT DISTINCT 'sexo', sexo_desc FROM survey WHERE sexo_desc IS NOT NULL)
SELECT filtro, valor, CASE WHEN filtro = 'mes' THEN {MONTH_CASE} ELSE valor END AS rotulo FROM o""",
    "month_labels": f"""{PRE}
SELECT DISTINCT DataReferencia_Mes, strftime(DataReferencia_Mes, '%Y-%m-%d') AS chave,
  CASE strftime(DataReferencia_Mes, '%Y-%m-%d') {' '.join(f'WHEN {q(k)} THEN {q(v)}' for k, v in MONTH_LABELS.items())}
    ELSE strftime(DataReferencia_Mes, '%Y-%m-%d') END AS rotulo,
  strftime(DataReferencia_Mes, '%Y-%m') AS ano_mes, strftime(DataReferencia_Mes, '%m/%y') AS mes_curto
FROM survey WHERE DataReferencia_Mes IS NOT NULL""",
    "lenient_casts": """
SELECT event_id, num_txt, TRY_CAST(num_txt AS DOUBLE) AS num, date_txt, TRY_CAST(date_txt AS DATE) AS dt
FROM (SELECT event_id,
        CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS num_txt,
        '2024-01-' || lpad(CAST(event_id % 40 AS VARCHAR), 2, '0') AS date_txt FROM events) t""",
    "freq_nation_top15": """
SELECT n_name, n, CAST(n AS DOUBLE) * 100.0 / CAST(SUM(n) OVER () AS DOUBLE) AS pct
FROM (SELECT n.n_name, COUNT(*) AS n FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
      GROUP BY n.n_name) t
ORDER BY n DESC, n_name NULLS LAST LIMIT 15""",
    "crosstab_priority_status": """
SELECT o_orderpriority,
  CAST(count_if(o_orderstatus = 'F') AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE) AS "F",
  CAST(count_if(o_orderstatus = 'O') AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE) AS "O",
  CAST(count_if(o_orderstatus = 'P') AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE) AS "P"
FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY o_orderpriority""",
    "trend_event_error_daily": """
SELECT CAST(ts AS DATE) AS dia,
  COALESCE(CAST(count_if(event_type = 'error') AS DOUBLE) * 100.0 / CAST(NULLIF(COUNT(event_type), 0) AS DOUBLE), 0.0)
    AS pct_error
FROM events WHERE ts IS NOT NULL GROUP BY 1 HAVING COUNT(event_type) > 0""",
    "hist_totalprice": hist("", num("o_totalprice", "orders"), 50),
    "box_extendedprice": box("", num("l_extendedprice", "lineitem")),
    "describe_lineitem": "\nUNION ALL\n".join(describe_one(c, "lineitem", c)
                                              for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
}


def portable(sql: str, dates: list[str] = (), decimals: list[str] = ()) -> str:
    """Same final projection as the registered Spark results: ISO date text, decimals as double."""
    rep = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates] + [f"CAST({c} AS DOUBLE) AS {c}" for c in decimals]
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM (\n{sql}\n) portable_t" if rep else sql


ORACLE["stacked_accounts"] = """SELECT source, nationkey, COUNT(*) AS n, ROUND(SUM(acctbal), 2) AS acctbal FROM (
  SELECT 'customer' AS source, c_nationkey AS nationkey, CAST(c_acctbal AS DOUBLE) AS acctbal FROM customer
  UNION ALL SELECT 'supplier', s_nationkey, CAST(s_acctbal AS DOUBLE) FROM supplier) t
GROUP BY source, nationkey"""


def long_shares(pre: str, src: str, group: str, col: str) -> str:
    return f"""{pre}
SELECT {group}, {col}, n, {pctx('n', f'SUM(n) OVER (PARTITION BY {group})')} AS pct
FROM (SELECT {group}, {col}, COUNT(*) AS n FROM {src} WHERE {group} IS NOT NULL AND {col} IS NOT NULL GROUP BY ALL) t"""


ORACLE.update({
    "freq_rendimento_all_bands": f"""{PRE},
c AS (SELECT FaixaRendimento_desc, n, {pctx('n', 'SUM(n) OVER ()')} AS pct FROM (
        SELECT FaixaRendimento_desc, COUNT(*) AS n FROM survey
        WHERE FaixaRendimento_desc IS DISTINCT FROM 'Não Informado' GROUP BY 1) t)
SELECT o.FaixaRendimento_desc, o.ord, COALESCE(c.n, 0) AS n, COALESCE(c.pct, 0.0) AS pct
FROM {values_table('FaixaRendimento_desc', INCOME_BAND_ORDER)} o LEFT JOIN c ON c.FaixaRendimento_desc = o.FaixaRendimento_desc""",
    "freq_priority_fallback": f"""
SELECT o_orderpriority, CAST(NULL AS INTEGER) AS ord, n, {pctx('n', 'SUM(n) OVER ()')} AS pct
FROM (SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1) t""",
    "crosstab_priority_status_long": long_shares("", "orders", "o_orderpriority", "o_orderstatus"),
    "month_fever_answers_long": long_shares(PRE, "survey", "DataReferencia_Mes", "Febre_desc"),
    "trabalhou_yes_no": f"SELECT * FROM ({freq_pct('Trabalhou_desc')}) s WHERE Trabalhou_desc IN ('Sim', 'Não')",
    "away_active_yes_no": f"""SELECT * FROM (
{freq_pct('AfastadoTrabalho_desc', "Idade >= 14 AND Trabalhou_desc = 'Não'")}
) s WHERE AfastadoTrabalho_desc IN ('Sim', 'Não')""",
    "freq_sexo_filtered": freq_pct("sexo_desc", "uf_desc = 'Bahia' AND DataReferencia_Mes = DATE '2020-09-01'"),
    "hist_age_20_filtered": hist(PRE, num("Idade", "survey", "uf_desc = 'São Paulo' AND sexo_desc = 'Mulher' "
                                          "AND DataReferencia_Mes = DATE '2020-07-01'"), 20),
})

_M = "DataReferencia_Mes"
for _name, _dates, _decimals in [
    ("survey_processed", [], ["RendimentoHabitual_Valor"]),
    ("survey_consolidated_counts", [_M], []),
    ("scan_pruned_filtered", [_M], []),
    ("trend_symptoms", [_M], []),
    ("trend_care", [_M], []),
    ("trend_work_aid", [_M], []),
    ("trend_work_aid_filtered", [_M], []),
    ("month_fever_answer_shares", [_M], []),
    ("month_fever_answers_long", [_M], []),
    ("sample_first_last", [_M], ["RendimentoHabitual_Valor"]),
    ("month_labels", [_M], []),
    ("lenient_casts", ["dt"], []),
    ("trend_event_error_daily", ["dia"], []),
]:
    ORACLE[_name] = portable(ORACLE[_name], _dates, _decimals)
