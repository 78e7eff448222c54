"""Row filters.  All predicates are built-in ``Column`` expressions, so Catalyst
pushes them into the Parquet scan (``PushedFilters``) or prunes month partitions
(``PartitionFilters``) when the input is the stored consolidated table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_answer, is_answer, is_not_answer
from ..schema import MONTH_COLUMN, MONTH_LABELS, NO, NOT_INFORMED, SYMPTOMS, YES

ALL = "Todos"

#: A frame with this column has the answer of ``symptomatic`` in it.
SYMPTOMATIC = "__symptomatic"


def equals(df: DataFrame, col: str, value) -> DataFrame:
    """Rows where ``col`` equals ``value`` (NULL never matches)."""
    return df.where(is_answer(col, value))


def isin(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def informed(df: DataFrame, col: str, sentinel: str = NOT_INFORMED) -> DataFrame:
    """Drop the 'not informed' category; NULL is kept, as pandas ``!=`` keeps it."""
    return df.where(is_not_answer(col, sentinel))


def drop_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def symptomatic(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """People who answered 'Sim' to at least one of the main symptoms."""
    if cols is None and SYMPTOMATIC in df.columns:
        return df.where(SYMPTOMATIC)
    return df.where(any_answer(list(cols or SYMPTOMS.values()), YES))


def sought_care(df: DataFrame) -> DataFrame:
    return equals(df, "ProcurouAtendimento_desc", YES)


def active_not_working(df: DataFrame, min_age: int = 14) -> DataFrame:
    """Working-age people who did not work last week (NULL age drops)."""
    return df.where((F.col("Idade") >= min_age) & is_answer("Trabalhou_desc", NO))


def survey_filter(df: DataFrame, uf: str | None = None, sexo: str | None = None,
                  mes: str | None = None) -> DataFrame:
    """Optional dashboard filters; ``None`` or 'Todos' means no filter.

    ``mes`` accepts the month key ('2020-07-01') or its display label
    ('Julho/2020').  On the stored table the month predicate prunes partitions.
    """
    cond = None

    def add(c):
        nonlocal cond
        cond = c if cond is None else cond & c

    if mes not in (None, ALL):
        key = next((k for k, v in MONTH_LABELS.items() if v == mes), mes)
        add(F.col(MONTH_COLUMN) == F.lit(key).try_cast("date"))  # an unknown label matches no row
    if uf not in (None, ALL):
        add(F.col("uf_desc") == F.lit(uf))
    if sexo not in (None, ALL):
        add(F.col("sexo_desc") == F.lit(sexo))
    return df if cond is None else df.where(cond)

