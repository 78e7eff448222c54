"""Decode coded answers into labels with left joins to broadcast code tables.

One join per question, driven by ``schema.QUESTIONS``.  Every code table is
small and proven so (row count known from its literal rows, or checked), so
each join is a ``BroadcastHashJoin`` probed inside the scan's codegen stage:
no shuffle, and the row count never changes because codes are unique.

``only=`` decodes just the questions a caller needs: a join whose label is not
used is not planned at all, so a two-column analysis does two hash probes per
row instead of sixteen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import default_label, zero_pad
from ..schema import DIMS, PASSTHROUGH, PROCESSED_COLUMNS, QUESTIONS, Question
from ..sources.dims import code_table


def code_expr(q: Question) -> Column:
    """The question's code as the code tables hold it."""
    raw = F.col(q.raw).cast(T.LongType())
    return zero_pad(raw) if q.padded else raw


def decode(raw: DataFrame, dims: Mapping[str, DataFrame], only: list[str] | None = None,
           dim_rows: dict[str, int] | None = None, extra: list[str] | None = None) -> DataFrame:
    """Raw rows -> processed rows (the 37 output columns, or the subset ``only``).

    ``dims`` maps a code-table name to its DataFrame; ``dim_rows`` gives known
    row counts (inline tables) so no counting job is needed before broadcasting.
    ``extra`` names raw columns to carry through unchanged (e.g. the month).
    """
    wanted = list(PROCESSED_COLUMNS) if only is None else [c for c in PROCESSED_COLUMNS if c in set(only)]
    unknown = set(only or []) - set(PROCESSED_COLUMNS)
    if unknown:
        raise ValueError(f"unknown processed columns: {sorted(unknown)}")
    questions = [q for q in QUESTIONS if q.code_out in wanted or q.desc_out in wanted]

    # codes (cast / padded) plus pass-through columns, one narrow projection
    cols = [F.col(r).cast(t).alias(name) for name, (r, t) in PASSTHROUGH.items() if name in wanted]
    cols += [code_expr(q).alias(q.code_out) for q in questions]
    cols += [F.col(c) for c in (extra or [])]
    return label(raw.select(cols), dims, wanted, dim_rows, extra)


def label(coded: DataFrame, dims: Mapping[str, DataFrame], wanted: list[str],
          dim_rows: dict[str, int] | None = None, extra: list[str] | None = None) -> DataFrame:
    """Rows with processed codes -> the columns ``wanted`` (labels joined) and ``extra``.

    Also used after a top-k or an aggregation, where only a few rows need labels.
    """
    dim_rows = dim_rows or {}
    needs_label = [q for q in QUESTIONS if q.desc_out in wanted]

    # 1) one left join per label.  A code table that serves several questions
    #    (role-playing dimension) is joined under a query alias, not re-projected,
    #    so all its joins share one broadcast (ReusedExchange).
    broadcast_cache: dict[str, DataFrame] = {}
    df = coded.alias("__raw")
    for q in needs_label:
        spec = DIMS[q.dim]
        if q.dim not in broadcast_cache:
            broadcast_cache[q.dim] = code_table(dims[q.dim], known_rows=dim_rows.get(q.dim))
        a = f"__d_{q.code_out}"
        d = broadcast_cache[q.dim].alias(a)
        df = df.join(d, F.col(f"__raw.{q.code_out}") == F.col(f"{a}.{spec.code_col}"), "left")

    # 2) default label for NULL and unmatched codes, final column order
    out = []
    for name in wanted:
        q = next((q for q in needs_label if q.desc_out == name), None)
        if q:
            out.append(default_label(F.col(f"__d_{q.code_out}.{DIMS[q.dim].desc_col}")).alias(name))
        else:
            out.append(F.col(f"__raw.{name}").alias(name))
    return df.select(out + [F.col(f"__raw.{c}").alias(c) for c in (extra or [])])
