"""Batch build: raw months -> decoded -> consolidated analytic table.

Months are stacked **before** decoding, so N months cost one decode (16
broadcast joins) instead of N.  The consolidated table is written as Parquet
partitioned by month: month filters become partition pruning, and a partitioned
write needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import month_start
from ..schema import CONSOLIDATED_COLUMNS, MONTH_COLUMN, PROCESSED_COLUMNS
from ..operators.coded import counted_labels
from ..operators.decode import decode
from ..sources.dims import all_dims, dim_sizes
from ..sources.raw import raw_from_dir, stack
from ..sources.tables import read_consolidated, write_consolidated  # noqa: F401  (re-exported)


def processed(spark: SparkSession, raw: DataFrame, only: list[str] | None = None) -> DataFrame:
    """One processed month (or any stack of months): the 37 decoded columns."""
    return decode(raw, all_dims(spark), only=only, dim_rows=dim_sizes())


def consolidated(spark: SparkSession, raw_months: list[DataFrame],
                 only: list[str] | None = None) -> DataFrame:
    """Stack N raw months, decode once, add the first-of-month date.

    ``only`` restricts the output to the columns a caller needs (the month
    column is always available when requested); unrequested labels are never
    joined.
    """
    raw = stack(raw_months)
    want = list(CONSOLIDATED_COLUMNS) if only is None else list(only)
    need_month = MONTH_COLUMN in want
    proc_cols = [c for c in want if c in PROCESSED_COLUMNS]
    # the month needs Ano and Mes_cod; derive it from the raw columns before decode
    if need_month:
        raw = raw.withColumn(MONTH_COLUMN, month_start(F.col("Ano"), F.col("V1013")))
    df = decode(raw, all_dims(spark), only=proc_cols, dim_rows=dim_sizes(),
                extra=[MONTH_COLUMN] if need_month else None)
    return df.select([F.col(c) for c in want])


def survey(spark: SparkSession, sf_dir: str, only: list[str] | None = None) -> DataFrame:
    """Consolidated survey over the synthetic raw rows derived from ``lineitem``."""
    return consolidated(spark, [raw_from_dir(spark, sf_dir)], only=only)


def survey_counts(spark: SparkSession, sf_dir: str, labels: list[str]) -> DataFrame:
    """The survey's labels, counted on codes and decoded after; frequency operators take it like the survey itself."""
    return counted_labels(raw_from_dir(spark, sf_dir), all_dims(spark), labels, dim_sizes())
