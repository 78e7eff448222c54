"""Counting on codes: aggregate first, decode the few rows that are left.

Two shapes. ``counted_labels`` counts every combination of some questions' codes and
decodes the combinations, so that any frequency operator can go on with the result
(column ``freq.COUNT`` holds the numbers). ``label_counts`` counts each question for
itself, for tables of many questions whose combinations would be as many as the rows.

Codes that fall on one label (NULL and unmatched ones on the default label) are added up
by the aggregation that follows the decode. No join lies below the first aggregation; a
code that a third of the rows share is one row per task there.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import default_label
from ..schema import DIM_ROWS, QUESTIONS
from ..sources.dims import code_table, inline_table
from .decode import code_expr, label
from .freq import COUNT

_BY_LABEL = {q.desc_out: q for q in QUESTIONS}


def counted_labels(raw: DataFrame, dims: Mapping[str, DataFrame], labels: list[str], dim_rows: dict[str, int] | None = None) -> DataFrame:
    """One row per combination of codes that occurs: its labels and, in ``COUNT``, its rows."""
    codes = [code_expr(_BY_LABEL[c]).alias(_BY_LABEL[c].code_out) for c in labels]
    counts = raw.groupBy(*codes).agg(F.count(F.lit(1)).alias(COUNT))
    return label(counts, dims, list(labels), dim_rows, extra=[COUNT])


def label_counts(raw: DataFrame, labels: list[str], texts: list[tuple[str, Column]] = ()) -> DataFrame:
    """(measure, value, n): how often each label occurs, question by question, in one scan.

    ``texts``: further measures by name whose value is the text itself (NULL stays NULL).
    """
    parts = [(name, code_expr(_BY_LABEL[name]).cast("string"), True) for name in labels] + [(name, c, False) for name, c in texts]
    cells = [F.struct(F.lit(i).alias("m"), c.alias("code")) for i, (_, c, _) in enumerate(parts)]
    counts = raw.select(F.explode(F.array(*cells)).alias("c")).groupBy("c.m", "c.code").agg(F.count(F.lit(1)).alias("n"))
    rows = [(i, str(code), text) for i, (name, _, coded) in enumerate(parts) if coded for code, text in DIM_ROWS[_BY_LABEL[name].dim]]
    fields = [T.StructField("m", T.IntegerType()), T.StructField("code", T.StringType()), T.StructField("text", T.StringType())]
    table = code_table(inline_table(raw.sparkSession, rows, T.StructType(fields)), known_rows=len(rows))
    names = F.array(*[F.lit(name) for name, _, _ in parts])
    value = F.when(F.col("m") < len(labels), default_label(F.col("text"))).otherwise(F.col("code"))
    return (counts.join(table, ["m", "code"], "left").select(F.get(names, F.col("m")).alias("measure"), value.alias("value"), "n")
            .groupBy("measure", "value").agg(F.sum("n").alias("n")))
