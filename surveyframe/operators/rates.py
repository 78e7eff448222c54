"""Rates per group, monthly trends, contingency tables and KPI rows.

All of them are conditional aggregation: one ``groupBy`` with one
``count_if``/``count`` pair per measure, so K series cost one scan and one
(partial-aggregated, tiny) shuffle, never K scans plus a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import is_answer, pct
from ..schema import YES
from ..sources.dims import inline_table
from .freq import rows_of, rows_where


def _num(df: DataFrame, cond: Column, weight: str | None) -> Column:
    """Rows (or total weight) meeting ``cond``."""
    if weight is None:
        return rows_where(df, cond)
    return F.coalesce(F.sum(F.when(cond, F.col(weight).cast(T.DoubleType()))), F.lit(0.0))


def _den(df: DataFrame, col: Column, weight: str | None) -> Column:
    """Rows (or total weight) where ``col`` is not NULL."""
    return _num(df, col.isNotNull(), weight)


def answer_rates(df: DataFrame, group: str, cols: list[str], names: list[str] | None = None,
                 answer: str = YES, weight: str | None = None) -> DataFrame:
    """Percent of non-null answers equal to ``answer``, per group, one column each.

    Rows with a NULL group are dropped (grouped value counts drop them); a
    group appears when at least one measure has a non-null answer in it, and
    a measure with no such answer in a group is 0.0 (full-outer alignment of
    the per-measure series, missing -> 0).  With ``weight`` the rates are
    population-weighted (sums of the weight instead of row counts).
    """
    names = names or cols
    aggs, dens = [], []
    for c, nm in zip(cols, names):
        num, den = f"__num_{nm}", f"__den_{nm}"
        aggs += [_num(df, is_answer(c, answer), weight).alias(num), _den(df, F.col(c), weight).alias(den)]
        dens.append(den)
    g = df.where(F.col(group).isNotNull()).groupBy(group).agg(*aggs)
    g = g.where(sum((F.col(d) for d in dens[1:]), F.col(dens[0])) > 0)
    out = [F.col(group)] + [F.coalesce(pct(F.col(f"__num_{nm}"), F.col(f"__den_{nm}")), F.lit(0.0)).alias(nm)
                            for nm in names]
    return g.select(out).orderBy(group)


def group_shares(df: DataFrame, group: str, col: str, values: list[str]) -> DataFrame:
    """Per-group percent of each listed value, wide (pivot with a fixed list).

    Denominator: rows of the group with a non-null ``col``; absent -> 0.0.
    """
    base = df.where(F.col(group).isNotNull())
    aggs = [rows_where(df, F.col(col) == F.lit(v)).alias(f"__n{i}") for i, v in enumerate(values)]
    g = base.groupBy(group).agg(_den(df, F.col(col), None).alias("__den"), *aggs).where(F.col("__den") > 0)
    return g.select([F.col(group)] + [pct(F.col(f"__n{i}"), F.col("__den")).alias(v)
                                      for i, v in enumerate(values)]).orderBy(group)


def answer_shares(df: DataFrame, group: str, col: str, weight: str | None = None) -> DataFrame:
    """Percent of **every observed** answer within its group, long -> (group, col, n, pct).

    Rows where either is NULL are dropped; the percents of a group sum to 100.
    The group totals are summed over the aggregated rows, one per (group, answer).
    """
    base = df.where(F.col(group).isNotNull() & F.col(col).isNotNull())
    counts = base.groupBy(group, col).agg(_num(df, F.lit(True), weight).alias("n"))
    total = F.sum("n").over(Window.partitionBy(group))
    return (counts.select(group, col, "n", pct(F.col("n"), total).alias("pct"))
            .orderBy(F.asc(group), F.desc("n"), F.asc(col)))


def crosstab_pct(df: DataFrame, row: str, col: str, col_values: list[str],
                 row_order: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """Row-normalised contingency table in percent -> (row, <one column per value>).

    Rows where either variable is NULL are dropped first (as crosstab does);
    the row total counts every remaining row, so the listed columns sum to 100
    when ``col_values`` covers the column's domain.  With ``row_order`` the
    rows are restricted to, and sorted by, that order (an ``ord`` column).
    ``weight`` gives population-weighted row percentages.
    """
    base = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    aggs = [_num(df, F.col(col) == F.lit(v), weight).alias(f"__n{i}") for i, v in enumerate(col_values)]
    g = base.groupBy(row).agg(_num(df, F.lit(True), weight).alias("__tot"), *aggs)
    cols = [F.col(row)] + [pct(F.col(f"__n{i}"), F.col("__tot")).alias(v) for i, v in enumerate(col_values)]
    if row_order is None:
        return g.select(cols).orderBy(row)
    order_df = F.broadcast(inline_table(
        df.sparkSession, [(v, i) for i, v in enumerate(row_order)],
        T.StructType([T.StructField(row, T.StringType()), T.StructField("ord", T.IntegerType())])))
    return g.join(order_df, row, "inner").select(cols + [F.col("ord")]).orderBy("ord")


def kpi_row(df: DataFrame, fever: str = "Febre_desc", aid: str = "AuxilioEmergencial_desc",
            weight: str | None = None) -> DataFrame:
    """Respondents, % fever 'Sim', % aid 'Sim' in one global aggregation.

    An empty input gives 0 respondents and NULL rates (no division error).
    With ``weight`` the rates are population-weighted (respondents stays a
    row count).
    """
    total = _num(df, F.lit(True), weight)
    return df.agg(
        rows_of(df).alias("respondentes"),
        pct(_num(df, is_answer(fever, YES), weight), total).alias("pct_febre"),
        pct(_num(df, is_answer(aid, YES), weight), total).alias("pct_auxilio"),
    ).select(F.col("respondentes").cast(T.LongType()), "pct_febre", "pct_auxilio")
