"""Frequency tables: counts, shares, ordered categories, weighted totals, top-k.

Every table is one scan: ``groupBy(...).count()`` aggregates partially inside
each task (a key holding a third of the rows costs nothing extra).  The total
behind a share is a scalar subquery over the **same aggregation**: Spark reuses
the aggregation's shuffle for it (``ReusedExchange``), so the input is read
once, and the division runs in every partition - no single-partition window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import is_answer, measure_name, pct
from ..sources.dims import inline_table
from .exact import exact_sums


#: A frame with this column stands for a longer one: each of its rows for so many equal rows.
COUNT = "__n"


def counted(df: DataFrame) -> list[str]:
    """The count column, where the frame has one: what a projection has to keep."""
    return [COUNT] if COUNT in df.columns else []


def rows_of(df: DataFrame) -> Column:
    """The number of rows of a group, also where rows are counted already."""
    return F.coalesce(F.sum(COUNT), F.lit(0)) if COUNT in df.columns else F.count(F.lit(1))


def rows_where(df: DataFrame, cond: Column) -> Column:
    """The number of a group's rows that meet ``cond``, also where rows are counted already."""
    return F.coalesce(F.sum(F.when(cond, F.col(COUNT))), F.lit(0)) if COUNT in df.columns else F.count_if(cond)


def _ordered(df: DataFrame, key: str, count_col: str = "n") -> DataFrame:
    # most frequent first; ties broken by the label (NULL label last)
    return df.orderBy(F.desc(count_col), F.asc_nulls_last(key))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count per value, NULL group included, most frequent first -> (col, n)."""
    return _ordered(df.groupBy(col).agg(rows_of(df).alias("n")), col)


def share_of_total(counts: DataFrame, n: str = "n") -> Column:
    """``n`` as a percent of its column total, the total being a scalar subquery.

    The subquery also touches every other column of ``counts``, so column
    pruning cannot make its aggregation differ from the main one: Spark then
    reuses the main aggregation's shuffle and the input is scanned once.
    """
    keep = [F.count(F.col(c)).alias(f"__k{i}") for i, c in enumerate(counts.columns) if c != n]
    total = counts.agg(F.struct(F.sum(n).alias("t"), *keep)).scalar()
    return pct(F.col(n), total.getField("t"))


def value_counts_pct(df: DataFrame, col: str, weight: str | None = None) -> DataFrame:
    """Count and percent of all rows (NULL group included) -> (col, n, pct).

    With ``weight`` the measure is the sum of that column (a population
    estimate) instead of the row count, and the percent is of the weight total.
    """
    counts = exact_sums(df, [col], weight, "n") if weight else df.groupBy(col).agg(rows_of(df).alias("n"))
    return _ordered(counts.select(col, "n", share_of_total(counts).alias("pct")), col)


def top_k(df: DataFrame, col: str, k: int = 5, with_pct: bool = True) -> DataFrame:
    """The k most frequent values (ties by label); a top-k, not a full sort."""
    base = value_counts_pct(df, col) if with_pct else value_counts(df, col)
    return base.limit(k)


def multi_value_counts(df: DataFrame, cols: list[str], names: list[str] | None = None,
                       measure: str = "measure", value: str = "value", with_pct: bool = True) -> DataFrame:
    """Frequency table of several columns in one scan -> (measure, value, n[, pct]).

    The columns are unpivoted first, so one aggregation covers all of them;
    the percent is within each measure (all rows, NULL included).
    """
    names = names or cols
    stacked = df.select(*counted(df), F.explode(F.array(*[
        F.struct(F.lit(nm).alias(measure), F.col(c).cast(T.StringType()).alias(value))
        for nm, c in zip(names, cols)])).alias("__s")).select(*counted(df), "__s.*")
    counts = stacked.groupBy(measure, value).agg(rows_of(stacked).alias("n"))
    if not with_pct:
        return counts.orderBy(F.asc(measure), F.desc("n"), F.asc_nulls_last(value))
    # one total per measure: a few rows, joined back by broadcast (bounded by len(cols))
    totals = counts.groupBy(measure).agg(F.sum("n").alias("__tot"))
    return (counts.join(F.broadcast(totals), measure)
            .select(measure, value, "n", pct(F.col("n"), F.col("__tot")).alias("pct"))
            .orderBy(F.asc(measure), F.desc("n"), F.asc_nulls_last(value)))


def ordered_counts(df: DataFrame, col: str, order: list[str], keep_absent: bool = False,
                   fallback_observed: bool = False) -> DataFrame:
    """Counts and percents aligned to a domain order -> (col, ord, n, pct).

    Percents are of all rows.  By default only categories that occur and are
    in ``order`` are kept (reindex to the present categories); ``keep_absent``
    emits every listed category, absent ones with 0.  ``fallback_observed``
    keeps the observed categories (most frequent first, ``ord`` NULL) when none
    is listed.
    """
    order_df = F.broadcast(inline_table(
        df.sparkSession, [(v, i) for i, v in enumerate(order)],
        T.StructType([T.StructField(col, T.StringType()), T.StructField("ord", T.IntegerType())])))
    counts = value_counts_pct(df, col)
    if keep_absent:
        # counts restricted to the listed categories hold at most len(order) rows
        # (one per category), so that side is the broadcast one
        present = counts.join(order_df, col, "inner").select(col, "n", "pct")
        out = (order_df.join(F.broadcast(present), col, "left")
               .select(col, "ord", F.coalesce("n", F.lit(0)).cast(T.LongType()).alias("n"),
                       F.coalesce("pct", F.lit(0.0)).alias("pct")))
        return out.orderBy("ord")
    joined = counts.join(order_df, col, "left")
    if fallback_observed:
        # the number of listed rows is a scalar subquery over the same aggregation
        listed = joined.agg(F.struct(F.count("ord").alias("c"), F.count("n").alias("k"))).scalar().getField("c")
        joined = joined.where(F.col("ord").isNotNull() | (listed == 0))
    else:
        joined = joined.where(F.col("ord").isNotNull())
    return joined.select(col, "ord", "n", "pct").orderBy("ord", F.desc("n"), F.asc_nulls_last(col))


def weighted_totals(df: DataFrame, col: str, weight: str, alias: str = "weighted_total",
                    decimals: int | None = None) -> DataFrame:
    """Exact sum of a weight per category, whatever the partitioning, largest first -> (col, weighted_total)."""
    sums = exact_sums(df, [col], weight, alias)
    if decimals is not None:
        sums = sums.withColumn(alias, F.round(alias, decimals))
    return sums.orderBy(F.desc(alias), F.asc_nulls_last(col))


def count_answers(df: DataFrame, cols: list[str], answer: str = "Sim",
                  measure: str = "measure", alias: str = "n") -> DataFrame:
    """How many rows answered ``answer`` in each column, most first.

    One aggregation with one conditional count per column, then unpivot;
    the measure name is the column name without its '_desc' suffix.
    """
    agg = df.agg(*[rows_where(df, is_answer(c, answer)).alias(c) for c in cols])
    long = agg.unpivot([], cols, "__col", alias)
    return (long.select(measure_name(F.col("__col")).alias(measure), F.col(alias).cast(T.LongType()).alias(alias))
            .orderBy(F.desc(alias), F.asc(measure)))
