"""Scalar column functions (all built-in expressions, codegen-friendly, no UDFs)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import NOT_INFORMED, YES


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default_label(label: str | Column, default: str = NOT_INFORMED) -> Column:
    """Label for a missing code or an unmatched code (COALESCE to a default)."""
    return F.coalesce(_c(label), F.lit(default))


def zero_pad(code: str | Column, width: int = 2) -> Column:
    """Zero-padded code text; NULL stays NULL (format_string alone gives 'null')."""
    c = _c(code).cast(T.LongType())
    return F.when(c.isNotNull(), F.format_string(f"%0{width}d", c))


def month_start(year: str | Column, month: str | Column) -> Column:
    """Year and month integers -> first day of that month (DATE)."""
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), F.lit(1))


def lenient_date(text: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse text as a date; unparseable or impossible dates become NULL."""
    return F.try_to_date(_c(text).cast("string"), fmt)


def strict_date(text: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse text as a date; bad input raises (ANSI)."""
    return F.to_date(_c(text).cast("string"), fmt)


def date_key(d: str | Column) -> Column:
    """DATE -> ISO text key ('2020-05-01')."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def lenient_number(text: str | Column) -> Column:
    """Text/decimal -> DOUBLE; anything unparseable becomes NULL."""
    return _c(text).try_cast(T.DoubleType())


def is_answer(c: str | Column, answer: str = YES) -> Column:
    """Two-valued equality: NULL compares False, never NULL."""
    return _c(c).eqNullSafe(F.lit(answer))


def is_not_answer(c: str | Column, answer: str = NOT_INFORMED) -> Column:
    """Two-valued inequality: NULL compares True (pandas ``!=`` semantics)."""
    return ~_c(c).eqNullSafe(F.lit(answer))


def any_answer(cols: list[str | Column], answer: str = YES) -> Column:
    """True when any column equals ``answer``; never NULL."""
    return reduce(or_, [is_answer(c, answer) for c in cols])


def cut(value: str | Column, edges: list[float], labels: list[str],
        include_lowest: bool = True) -> Column:
    """Bin a number into labelled right-closed intervals (a, b].

    With ``include_lowest`` the first interval is closed on the left too.
    Values outside the edges, and NULL, give NULL.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    v = _c(value)
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = ((v >= lo) if (i == 0 and include_lowest) else (v > lo)) & (v <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def label_map(value: str | Column, mapping: dict[str, str], fallback_self: bool = True) -> Column:
    """Map a value through a fixed dict; unmapped values fall back to themselves."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    looked = F.try_element_at(m, _c(value).cast("string"))
    return F.coalesce(looked, _c(value).cast("string")) if fallback_self else looked


def reverse_label(value: str | Column, mapping: dict[str, str]) -> Column:
    """Label -> key for a fixed dict; unknown labels fall back to themselves."""
    return label_map(value, {v: k for k, v in mapping.items()})


def month_label(d: str | Column, fmt: str = "yyyy-MM") -> Column:
    """Month text for a date ('2020-05', or 'MM/yy' for short axis labels)."""
    return F.date_format(_c(d), fmt)


def pct(part: str | Column, whole: str | Column) -> Column:
    """part * 100 / whole as DOUBLE; NULL (not an error) when whole is 0/NULL."""
    return F.try_divide(_c(part).cast(T.DoubleType()) * F.lit(100.0), _c(whole).cast(T.DoubleType()))


def pct_text(p: str | Column, decimals: int = 2) -> Column:
    """'12.34%' style text for a percentage."""
    return F.format_string(f"%.{decimals}f%%", _c(p))


def measure_name(col_name: str | Column, suffix: str = "_desc") -> Column:
    """Column name -> measure name ('Febre_desc' -> 'Febre')."""
    return F.regexp_replace(_c(col_name), f"{suffix}$", "")
