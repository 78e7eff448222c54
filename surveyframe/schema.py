"""Schemas, fixed label values and the data-driven decode table.

Everything under "Fixed values" must equal the survey's published code
lists and the analysis labels, so that decoded labels, category orders and
band edges give the same answers as the original analyses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values
# --------------------------------------------------------------------------

NOT_INFORMED = "Não Informado"
YES = "Sim"
NO = "Não"

# Domain tables: code -> label, in the published order.
DIM_ROWS: dict[str, list[tuple]] = {
    "uf": [
        (11, "Rondônia"), (12, "Acre"), (13, "Amazonas"), (14, "Roraima"), (15, "Pará"),
        (16, "Amapá"), (17, "Tocantins"), (21, "Maranhão"), (22, "Piauí"), (23, "Ceará"),
        (24, "Rio Grande do Norte"), (25, "Paraíba"), (26, "Pernambuco"), (27, "Alagoas"),
        (28, "Sergipe"), (29, "Bahia"), (31, "Minas Gerais"), (32, "Espírito Santo"),
        (33, "Rio de Janeiro"), (35, "São Paulo"), (41, "Paraná"), (42, "Santa Catarina"),
        (43, "Rio Grande do Sul"), (50, "Mato Grosso do Sul"), (51, "Mato Grosso"),
        (52, "Goiás"), (53, "Distrito Federal"),
    ],
    "sexo": [(1, "Homem"), (2, "Mulher")],
    "cor_raca": [
        (1, "Branca"), (2, "Preta"), (3, "Amarela"), (4, "Parda"), (5, "Indígena"), (9, "Ignorado"),
    ],
    "escolaridade": [
        (1, "Sem instrução"),
        (2, "Fundamental incompleto"),
        (3, "Fundamental completa"),
        (4, "Médio incompleto"),
        (5, "Médio completo"),
        (6, "Superior incompleto"),
        (7, "Superior completo"),
        (8, "Pós-graduação, mestrado ou doutorado"),
    ],
    "faixa_rendimento": [
        ("00", "0 - 100"),
        ("01", "101 - 300"),
        ("02", "301 - 600"),
        ("03", "601 - 800"),
        ("04", "801 - 1.600"),
        ("05", "1.601 - 3.000"),
        ("06", "3.001 - 10.000"),
        ("07", "10.001 - 50.000"),
        ("08", "50.001 - 100.000"),
        ("09", "Mais de 100.000"),
    ],
    "internado_hospital": [
        (1, "Sim, ficou internado"),
        (2, "Não, não ficou internado"),
        (3, "Não foi atendido"),
        (9, "Ignorado"),
    ],
    "posicao_ocupacao": [
        (1, "Trabalhador doméstico (empregado doméstico, cuidados, babá)"),
        (2, "Militar do exercito, marinha ou aeronáutica"),
        (3, "Policial militar ou bombeiro militar"),
        (4, "Empregado do setor privado"),
        (5, "Empregado do setor público (inclusive empresas de economia mista)"),
        (6, "Empregador"),
        (7, "Conta própria"),
        (8, "Trabalhador familiar não remunerado em ajuda a membro do domicílio ou parente"),
        (9, "Estava fora do mercado de trabalho (fazia apenas afazeres domésticos, cuidados de pessoas ou produção para próprio consumo)"),
    ],
    "sim_nao_sabe_ignorado": [(1, "Sim"), (2, "Não"), (3, "Não sabe"), (9, "Ignorado")],
}

# Category orders used by the ordered summaries (domain order, not alphabetic).
EDUCATION_ORDER = [label for _, label in DIM_ROWS["escolaridade"]] + [NOT_INFORMED]
INCOME_BAND_ORDER = [label for _, label in DIM_ROWS["faixa_rendimento"]] + [NOT_INFORMED]
INCOME_BAND_INFORMED_ORDER = [label for _, label in DIM_ROWS["faixa_rendimento"]]

# Age bands: edges and labels; first interval closed on both sides, the rest (a, b].
AGE_BAND_EDGES = [0, 17, 30, 45, 60, 120]
AGE_BAND_LABELS = ["0-17 Anos", "18-30 Anos", "31-45 Anos", "46-60 Anos", "61+ Anos"]

# The four main symptoms: display name -> decoded column.
SYMPTOMS = {
    "Febre": "Febre_desc",
    "Tosse": "Tosse_desc",
    "Dificuldade para Respirar": "DificuldadeRespirar_desc",
    "Perda de Olfato/Paladar": "PerdaOlfatoPaladar_desc",
}

# Month key -> display label for the month filter.
MONTH_LABELS = {
    "2020-05-01": "Maio/2020",
    "2020-07-01": "Julho/2020",
    "2020-09-01": "Setembro/2020",
}

# Hospital outcomes kept by the income x hospitalisation table.
HOSPITAL_YES_NO = ["Sim, ficou internado", "Não, não ficou internado"]

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

INCOME_DECIMAL = T.DecimalType(38, 9)

RAW_COLUMNS: list[tuple[str, T.DataType]] = [
    ("Ano", T.LongType()),
    ("V1013", T.LongType()),
    ("V1032", T.DoubleType()),
    ("UF", T.LongType()),
    ("A002", T.LongType()),
    ("A003", T.LongType()),
    ("A004", T.LongType()),
    ("A005", T.LongType()),
    ("B0011", T.LongType()),
    ("B0012", T.LongType()),
    ("B0014", T.LongType()),
    ("B00111", T.LongType()),
    ("B002", T.LongType()),
    ("B005", T.LongType()),
    ("B007", T.LongType()),
    ("C001", T.LongType()),
    ("C002", T.LongType()),
    ("C007", T.LongType()),
    ("C01011", T.LongType()),
    ("C01012", INCOME_DECIMAL),
    ("D0051", T.LongType()),
]
RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_COLUMNS])

MONTH_COLUMN = "DataReferencia_Mes"


@dataclass(frozen=True)
class DimSpec:
    """A code table: key column, label column, key type and descriptions."""

    name: str
    code_col: str
    desc_col: str
    code_type: T.DataType
    code_comment: str
    desc_comment: str


DIMS: dict[str, DimSpec] = {
    "uf": DimSpec("uf", "uf_cod", "uf_desc", T.LongType(),
                  "Código da Unidade da Federação", "Nome da Unidade da Federação"),
    "sexo": DimSpec("sexo", "sexo_cod", "sexo_desc", T.LongType(),
                    "Código do Sexo", "Descrição do Sexo"),
    "cor_raca": DimSpec("cor_raca", "cor_raca_cod", "cor_raca_desc", T.LongType(),
                        "Código da Cor ou Raça", "Descrição da Cor ou Raça"),
    "escolaridade": DimSpec("escolaridade", "escolaridade_cod", "escolaridade_desc", T.LongType(),
                            "Código da Escolaridade", "Descrição da Escolaridade"),
    "faixa_rendimento": DimSpec("faixa_rendimento", "faixa_rend_cod", "faixa_rend_desc", T.StringType(),
                                "Código da Faixa de Rendimento ('00'-'09')",
                                "Descrição da Faixa de Rendimento"),
    "internado_hospital": DimSpec("internado_hospital", "internado_cod", "internado_desc", T.LongType(),
                                  "Código de internação", "Descrição de internação"),
    "posicao_ocupacao": DimSpec("posicao_ocupacao", "pos_ocup_cod", "pos_ocup_desc", T.LongType(),
                                "Código da Posição na Ocupação", "Descrição da Posição na Ocupação"),
    "sim_nao_sabe_ignorado": DimSpec("sim_nao_sabe_ignorado", "resposta_cod", "resposta_desc", T.LongType(),
                                     "Código da resposta", "Descrição da resposta"),
}


@dataclass(frozen=True)
class Question:
    """One decoded question: raw column -> (code column, label column) via a dim.

    ``padded`` marks the income band, whose code is joined as two-digit text.
    """

    raw: str
    code_out: str
    desc_out: str
    dim: str
    padded: bool = False


# The 16 decoded questions, in output order.
QUESTIONS: list[Question] = [
    Question("UF", "UF_cod", "uf_desc", "uf"),
    Question("A003", "Sexo_cod", "sexo_desc", "sexo"),
    Question("A004", "CorRaca_cod", "cor_raca_desc", "cor_raca"),
    Question("A005", "Escolaridade_cod", "escolaridade_desc", "escolaridade"),
    Question("B0011", "Febre_cod", "Febre_desc", "sim_nao_sabe_ignorado"),
    Question("B0012", "Tosse_cod", "Tosse_desc", "sim_nao_sabe_ignorado"),
    Question("B0014", "DificuldadeRespirar_cod", "DificuldadeRespirar_desc", "sim_nao_sabe_ignorado"),
    Question("B00111", "PerdaOlfatoPaladar_cod", "PerdaOlfatoPaladar_desc", "sim_nao_sabe_ignorado"),
    Question("B002", "ProcurouAtendimento_cod", "ProcurouAtendimento_desc", "sim_nao_sabe_ignorado"),
    Question("B005", "InternadoHospital_cod", "InternadoHospital_desc", "internado_hospital"),
    Question("B007", "PlanoSaude_cod", "PlanoSaude_desc", "sim_nao_sabe_ignorado"),
    Question("C001", "Trabalhou_cod", "Trabalhou_desc", "sim_nao_sabe_ignorado"),
    Question("C002", "AfastadoTrabalho_cod", "AfastadoTrabalho_desc", "sim_nao_sabe_ignorado"),
    Question("C007", "PosicaoOcupacao_cod", "PosicaoOcupacao_desc", "posicao_ocupacao"),
    Question("C01011", "FaixaRendimento_cod_str", "FaixaRendimento_desc", "faixa_rendimento", padded=True),
    Question("D0051", "AuxilioEmergencial_cod", "AuxilioEmergencial_desc", "sim_nao_sabe_ignorado"),
]

# Output column order of a processed month (37 columns).
PROCESSED_COLUMNS: list[str] = [
    "Ano", "Mes_cod", "Peso_Amostral",
    "UF_cod", "uf_desc", "Idade",
    "Sexo_cod", "sexo_desc", "CorRaca_cod", "cor_raca_desc",
    "Escolaridade_cod", "escolaridade_desc",
    "Febre_cod", "Febre_desc", "Tosse_cod", "Tosse_desc",
    "DificuldadeRespirar_cod", "DificuldadeRespirar_desc",
    "PerdaOlfatoPaladar_cod", "PerdaOlfatoPaladar_desc",
    "ProcurouAtendimento_cod", "ProcurouAtendimento_desc",
    "InternadoHospital_cod", "InternadoHospital_desc",
    "PlanoSaude_cod", "PlanoSaude_desc",
    "Trabalhou_cod", "Trabalhou_desc",
    "AfastadoTrabalho_cod", "AfastadoTrabalho_desc",
    "PosicaoOcupacao_cod", "PosicaoOcupacao_desc",
    "FaixaRendimento_cod_str", "FaixaRendimento_desc",
    "RendimentoHabitual_Valor",
    "AuxilioEmergencial_cod", "AuxilioEmergencial_desc",
]
CONSOLIDATED_COLUMNS: list[str] = PROCESSED_COLUMNS + [MONTH_COLUMN]

# Pass-through columns: output name -> (raw column, type).
PASSTHROUGH: dict[str, tuple[str, T.DataType]] = {
    "Ano": ("Ano", T.LongType()),
    "Mes_cod": ("V1013", T.LongType()),
    "Peso_Amostral": ("V1032", T.DoubleType()),
    "Idade": ("A002", T.LongType()),
    "RendimentoHabitual_Valor": ("C01012", INCOME_DECIMAL),
}

# The dashboard's 14-column projection.
DASHBOARD_COLUMNS: list[str] = [
    "uf_desc", "Idade", "sexo_desc", "escolaridade_desc", "FaixaRendimento_desc",
    "Febre_desc", "Tosse_desc", "DificuldadeRespirar_desc", "PerdaOlfatoPaladar_desc",
    "ProcurouAtendimento_desc", "InternadoHospital_desc", "Trabalhou_desc",
    "AuxilioEmergencial_desc", MONTH_COLUMN,
]
