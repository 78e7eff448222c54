"""Table profiles: categorical summaries, completeness, distinct values, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def describe_categorical(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, unique, top, freq per text column -> one row per column.

    One scan: the columns are unpivoted and counted per (column, value), then
    aggregated again per column.  The top value is ``min(struct(-n, value))``
    - the most frequent, ties broken by the smaller value - an ordinary
    aggregate, so both levels aggregate partially inside each task and no task
    ever holds all values of a column.  NULLs count toward neither count,
    unique nor top.
    """
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast(T.StringType()).alias("value")) for c in cols
    ])).alias("__s")).select("__s.*").where(F.col("value").isNotNull())
    return summary_of_counts(stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def summary_of_counts(vc: DataFrame) -> DataFrame:
    """count, unique, top, freq per column from counts per (column, value, n)."""
    per_col = vc.groupBy("column").agg(
        F.sum("n").cast(T.LongType()).alias("count"),
        F.count(F.lit(1)).cast(T.LongType()).alias("unique"),
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("value"))).alias("__top"))
    return per_col.select("column", "count", "unique", F.col("__top.value").alias("top"),
                          (-F.col("__top.neg_n")).alias("freq")).orderBy("column")


def completeness(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Per column: position, type and non-null count (one aggregation).

    ``schema`` describes a wider table than ``df``: columns that ``df`` lacks are
    filled by a default there and never NULL, so their count is the row count
    and nothing has to compute them.
    """
    fields = (schema or df.schema).fields
    agg = df.agg(*[F.count(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(1)).alias(f"__c{i}")
                   for i, f in enumerate(fields)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("dtype"), F.col(f"__c{i}").alias("non_null"))
        for i, f in enumerate(fields)]))).orderBy("position")


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values in ascending order (filter option lists)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def head_tail(df: DataFrame, order_cols: list[str], n: int = 5) -> DataFrame:
    """First and last ``n`` rows under an explicit total order -> + (part, pos).

    Both ends are top-k (``TakeOrderedAndProject``): each task keeps n rows,
    nothing is fully sorted.
    """
    asc = [F.col(c).asc_nulls_first() for c in order_cols]
    desc = [F.col(c).desc_nulls_last() for c in order_cols]
    first = df.orderBy(*asc).limit(n)
    last = df.orderBy(*desc).limit(n)
    wa = Window.orderBy(*asc)
    wd = Window.orderBy(*desc)
    return (first.withColumn("part", F.lit("head")).withColumn("pos", F.row_number().over(wa))
            .unionByName(last.withColumn("part", F.lit("tail")).withColumn("pos", F.row_number().over(wd))))
