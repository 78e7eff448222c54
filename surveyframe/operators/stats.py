"""Numeric summaries (describe), exact quantiles, boxplot statistics.

Exact quantiles in two scans of the source
------------------------------------------
All columns together, whatever their size and distribution.

1. One aggregation: the number of values and a mergeable KLL sketch per column, merged in
   two stages. Around every wanted rank the sketch gives a bracket of values, ``SLACK`` of
   the rows to either side, more than twice the sketch's error bound.
2. One partial aggregation counts the values below, between and inside the brackets;
   only those inside keep their value. This small table is checkpointed.

The rest works on that table. Exact counts tell in which bracket a rank lies; should a
sketch ever miss its bound, the rank lies outside, and the scan is repeated with wider
brackets. Up to ``FEW`` distinct values are picked on the driver; more go on by splitters: a
sketch per range gives ``BUCKETS`` of them, counts between them settle a rank or leave about
1 / BUCKETS of the values. The sketches only place boundaries: counts are exact, so is the
result, and a hot value is one row of the table.

Both scans run while the result's DataFrame is built (``describe*``, ``quantile*``,
``boxplot_stats``); the quantiles enter the result as literals, and the result itself is
one more scan, for the moments or the whiskers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .freq import COUNT, counted, rows_of, rows_where

#: Splitters of a range per round, and groups in which partial sketches are merged first.
BUCKETS = 32
MERGE_GROUPS = 64
#: Size of the first sketches (rank error about 0.45 %), share of the rows on either side of a rank that its bracket
#: takes in, and distinct values inside the brackets that the driver may hold.
SKETCH_K, SLACK, FEW = 1024, 0.01, 50_000


def _x(df: DataFrame, col: str) -> DataFrame:
    """The column as non-missing doubles (NULL and NaN are missing, as in pandas)."""
    return df.select(F.col(col).cast(T.DoubleType()).alias("x"), *counted(df)).where(
        F.col("x").isNotNull() & ~F.isnan("x"))


def sample_std(x: DataFrame) -> Column:
    """Sample standard deviation of the column ``x``, also where rows are counted already; NULL below two rows."""
    if not counted(x):
        return F.stddev_samp("x")
    mean = x.agg(F.try_divide(F.sum(F.col("x") * F.col(COUNT)), F.sum(COUNT).cast(T.DoubleType()))).scalar()
    squares = F.sum(F.col(COUNT) * (F.col("x") - mean) * (F.col("x") - mean))
    return F.sqrt(F.try_divide(squares, (rows_of(x) - 1).cast(T.DoubleType())))


def _positions(n: int, probs: list[float]) -> list[tuple[int, int, float]]:
    """(lower rank, upper rank, fraction) per probability, 0-based, linear method."""
    out = []
    for p in probs:
        h = p * (n - 1)
        k = math.floor(h)
        out.append((k, min(k + 1, n - 1), h - k))
    return out


def _sketched(xs: DataFrame, cols: list[str]) -> list[tuple[int, bytes | None]]:
    """Number of values and merged sketch of every column, one scan."""
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    part = xs.groupBy(group.alias("__g")).agg(
        *[F.kll_sketch_agg_double(F.col(f"`{c}`"), SKETCH_K).alias(f"__k{i}") for i, c in enumerate(cols)],
        *[F.count(F.col(f"`{c}`")).alias(f"__n{i}") for i, c in enumerate(cols)])
    row = part.agg(*[F.kll_merge_agg_double(f"__k{i}", SKETCH_K).alias(f"__k{i}") for i in range(len(cols))],
                   *[F.sum(f"__n{i}").alias(f"__n{i}") for i in range(len(cols))]).first()
    return [(row[f"__n{i}"] or 0, row[f"__k{i}"]) for i in range(len(cols))]


def _brackets(spark, sketch: bytes, n: int, ranks: list[tuple[int, int]], slack: float) -> list[tuple[float, float]]:
    """Disjoint ascending value ranges that hold the rank pairs, unless the sketch is off by more than ``slack``."""
    probs = [min(1.0, max(0.0, p)) for k, k2 in ranks for p in (k / n - slack, (k2 + 1) / n + slack)]
    q = spark.range(1).select(F.kll_sketch_get_quantile_double(F.lit(bytearray(sketch)), F.array(*[F.lit(p) for p in probs]))).first()[0]
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(zip(q[::2], q[1::2])):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _zone(x: Column, brackets: list[tuple[float, float]]) -> Column:
    """2j below bracket j (and above the one before), 2j + 1 inside it; NULL above the last one."""
    out = F.when(x.isNull() | (x > F.lit(brackets[-1][1])), F.lit(None).cast("int"))
    for j, (lo, hi) in enumerate(brackets):
        out = out.when(x < F.lit(lo), F.lit(2 * j)).when(x <= F.lit(hi), F.lit(2 * j + 1))
    return out


def _kept_values(xs: DataFrame, brackets: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """(col, zone, x, n): counts per zone, x only inside brackets; one scan, then checkpointed."""
    def cell(i: int, c: str) -> Column:
        x, z = F.col(f"`{c}`"), _zone(F.col(f"`{c}`"), brackets[c])
        inside = F.when(z % 2 == 1, x)
        return F.struct(F.lit(i).alias("col"), z.alias("zone"), inside.alias("x"))

    cells = [cell(i, c) for i, c in enumerate(brackets)]
    one = xs.select(cells[0].alias("c")) if len(cells) == 1 else xs.select(F.explode(F.array(*cells)).alias("c"))
    counts = one.select("c.*").where("zone is not null").groupBy("col", "zone", "x").agg(F.count(F.lit(1)).alias("n"))
    return checkpointed(counts)


def _inside(rg: tuple) -> Column:
    """x where it belongs to the range (col, zone) and lies strictly between the bounds, else NULL."""
    (col, zone), lo, hi = rg
    x = F.col("x")
    cond = (F.col("col") == col) & (F.col("zone") == zone)
    if lo is not None:
        cond = cond & (x > F.lit(lo))
    if hi is not None:
        cond = cond & (x < F.lit(hi))
    return F.when(cond, x)


def _splitters(kept: DataFrame, ranges: list[tuple], buckets: int) -> list[list[float]]:
    """Distinct ascending sketch quantiles of every range (its minimum and maximum included)."""
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    part = kept.groupBy(group.alias("__g")).agg(
        *[F.kll_sketch_agg_double(_inside(rg)).alias(f"__k{i}") for i, rg in enumerate(ranges)])
    probs = F.array(*[F.lit(j / buckets) for j in range(buckets + 1)])
    row = part.agg(*[F.kll_merge_agg_double(f"__k{i}").alias(f"__k{i}") for i in range(len(ranges))]).select(
        *[F.kll_sketch_get_quantile_double(f"__k{i}", probs).alias(f"__q{i}") for i in range(len(ranges))]).first()
    return [sorted(set(row[i])) for i in range(len(ranges))]


def _bucket(x: Column, s: list[float], lo: int, hi: int) -> Column:
    """2j where x equals splitter j, 2j + 1 between splitters j and j + 1 (binary search)."""
    if lo == hi:
        return F.when(x == F.lit(s[lo]), F.lit(2 * lo)).otherwise(F.lit(2 * lo + 1))
    mid = (lo + hi + 1) // 2
    return F.when(x < F.lit(s[mid]), _bucket(x, s, lo, mid - 1)).otherwise(_bucket(x, s, mid, hi))


def _by_splitters(kept: DataFrame, wanted: dict[tuple, list[int]], buckets: int) -> dict[tuple, float]:
    """{(cell, rank): value} of 0-based ranks inside each cell (col, zone) of the checkpointed table."""
    found: dict[tuple, float] = {}
    todo = {(cell, None, None): (0, ranks) for cell, ranks in wanted.items()}
    while todo:
        ranges = list(todo)
        splits = _splitters(kept, ranges, buckets)
        cells = F.array_compact(F.array(*[
            F.when(_inside(rg).isNotNull(), F.struct(F.lit(i).alias("r"), _bucket(F.col("x"), s, 0, len(s) - 1).alias("b")))
            for i, (rg, s) in enumerate(zip(ranges, splits))]))
        counts: dict[int, list] = {}
        for row in (kept.select("n", F.explode(cells).alias("c")).groupBy("c.r", "c.b").agg(F.sum("n").alias("n"))
                    .collect()):  # at most 2 * BUCKETS + 1 rows per range
            counts.setdefault(row["r"], []).append((row["b"], row["n"]))
        nxt: dict[tuple, tuple[int, list[int]]] = {}
        for i, (rg, s) in enumerate(zip(ranges, splits)):
            below, ranks = todo[rg]
            for b, n in sorted(counts.get(i, [])):
                here = [r for r in ranks if below <= r < below + n]
                if here and b % 2 == 0:
                    found.update({(rg[0], r): s[b // 2] for r in here})
                elif here:
                    nxt[(rg[0], s[b // 2], s[b // 2 + 1])] = (below, here)
                below += n
        todo = nxt
    return found


def _on_driver(kept: DataFrame, wanted: dict[tuple, list[int]]) -> dict[tuple, float]:
    """As ``_by_splitters`` for at most FEW rows inside brackets."""
    values: dict[tuple, list[tuple[float, int]]] = {}
    for r in kept.where(F.col("x").isNotNull()).collect():
        values.setdefault((r["col"], r["zone"]), []).append((r["x"], r["n"]))
    found = {}
    for cell, ranks in wanted.items():
        below, todo = 0, sorted(ranks)
        for x, n in sorted(values[cell]):
            while todo and todo[0] < below + n:
                found[cell, todo.pop(0)] = x
            below += n
    return found


def _values_at(xs: DataFrame, sketches: dict[str, tuple[int, bytes]], pairs: dict[str, list[tuple[int, int]]], buckets: int,
               slack: float | None = None, few: int | None = None) -> dict[tuple[str, int], float]:
    """The values at the 0-based ranks (in pairs of neighbours) of the sorted non-missing values of each column."""
    slack, few = SLACK if slack is None else slack, FEW if few is None else few
    out: dict[tuple[str, int], float] = {}
    while pairs:
        cols = list(pairs)
        brackets = {c: _brackets(xs.sparkSession, sketches[c][1], sketches[c][0], pairs[c], slack) for c in cols}
        kept = _kept_values(xs, brackets)
        sums = {(r["col"], r["zone"]): (r["n"], r["rows"]) for r in kept.groupBy("col", "zone").agg(
            F.sum("n").alias("n"), F.count("x").alias("rows")).collect()}  # a few rows per column
        wanted: dict[tuple, list[int]] = {}
        where: dict[tuple, tuple] = {}
        again: dict[str, list[tuple[int, int]]] = {}
        for i, c in enumerate(cols):
            for pair in pairs[c]:
                for r in set(pair):
                    below = 0
                    for z in range(2 * len(brackets[c])):
                        n = sums.get((i, z), (0, 0))[0]
                        if below <= r < below + n and z % 2:
                            where[c, r] = ((i, z), r - below)
                        below += n
                if any((c, r) not in where for r in pair):
                    again.setdefault(c, []).append(pair)
        for cell, r in set(where.values()):
            wanted.setdefault(cell, []).append(r)
        rows = sum(sums[cell][1] for cell in sums if cell[1] % 2)
        found = _on_driver(kept, wanted) if rows <= few else _by_splitters(kept, wanted, buckets)
        out.update({k: found[v] for k, v in where.items()})
        pairs, slack = again, max(4 * slack, SLACK)
    return out


def _quantile_values(xs: DataFrame, cols: list[str], probs: list[float], buckets: int, **kw) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles of each column (None where it has no value)."""
    if counted(xs):
        return {"x": _counted_quantiles(xs, probs, buckets)}
    sketches = dict(zip(cols, _sketched(xs, cols)))
    pos = {c: _positions(n, probs) for c, (n, _) in sketches.items() if n}
    at = _values_at(xs, sketches, {c: [p[:2] for p in ps] for c, ps in pos.items()}, buckets, **kw)

    return {c: [_between(at[c, k], at[c, k2], frac) for k, k2, frac in pos[c]] if c in pos else [None] * len(probs) for c in cols}


def _between(lo: float, hi: float, frac: float) -> float:
    return lo if lo == hi or not frac else lo + (hi - lo) * frac


def _counted_quantiles(x: DataFrame, probs: list[float], buckets: int) -> list[float | None]:
    """Quantiles of values that are counted already: all of them stand for the inside of one bracket."""
    cell = (0, 1)
    kept = x.groupBy("x").agg(F.sum(COUNT).alias("n")).select(F.lit(cell[0]).alias("col"), F.lit(cell[1]).alias("zone"), "x", "n")
    n, rows = kept.agg(F.sum("n"), F.count("x")).first()
    if not n:
        return [None] * len(probs)
    pos = _positions(n, probs)
    wanted = {cell: sorted({r for k, k2, _ in pos for r in (k, k2)})}
    found = _on_driver(kept, wanted) if rows <= FEW else _by_splitters(checkpointed(kept), wanted, buckets)
    return [_between(found[cell, k], found[cell, k2], frac) for k, k2, frac in pos]


def _double(v: float | None) -> Column:
    return F.lit(v).cast(T.DoubleType())


def _rounded(decimals: int | None):
    return (lambda c: F.round(c, decimals)) if decimals is not None else (lambda c: c)


def quantiles(df: DataFrame, col: str, probs: list[float], names: list[str] | None = None,
              buckets: int = BUCKETS, approx_accuracy: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles of one column -> one row, one column per prob.

    ``approx_accuracy`` switches to one-pass ``percentile_approx`` (rank error
    at most n / accuracy) for callers who prefer speed over exactness.
    """
    names = names or [f"q{i}" for i in range(len(probs))]
    x = _x(df, col)
    if approx_accuracy:
        arr = x.agg(F.percentile_approx("x", [float(p) for p in probs], approx_accuracy).alias("__q"))
        return arr.select([F.col("__q")[i].alias(nm) for i, nm in enumerate(names)])
    q = _quantile_values(x, ["x"], probs, buckets)["x"]
    return df.sparkSession.range(1).select([_double(v).alias(nm) for v, nm in zip(q, names)])


def describe(df: DataFrame, col: str, decimals: int | None = 6, **kw) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max of one column (one row)."""
    if counted(df):
        return _describe_counted(df, col, decimals, **kw)
    return describe_numeric(df, [col], decimals=decimals, **kw).drop("column")


def _describe_counted(df: DataFrame, col: str, decimals: int | None, buckets: int = BUCKETS) -> DataFrame:
    x = _x(df, col)
    q = _counted_quantiles(x, [0.25, 0.5, 0.75], buckets)
    r = _rounded(decimals)
    mean = F.try_divide(F.sum(F.col("x") * F.col(COUNT)), F.sum(COUNT).cast(T.DoubleType()))
    out = x.agg(rows_of(x).alias("count"), mean.alias("mean"), sample_std(x).alias("std"), F.min("x").alias("min"), F.max("x").alias("max"))
    return out.select("count", r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"), "min",
                      *[r(_double(v)).alias(nm) for v, nm in zip(q, ("q25", "q50", "q75"))], "max")


def describe_numeric(df: DataFrame, cols: list[str] | None = None, decimals: int | None = 6,
                     buckets: int = BUCKETS) -> DataFrame:
    """Numeric summary of many columns: one row per column.

    One aggregation has the moments of every column; the exact quartiles of all
    columns come from the same scans.  Without ``cols``, every integral/floating column.
    """
    if cols is None:
        cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.IntegralType, T.FloatType, T.DoubleType))]
    # NaN is missing, as in pandas
    xs = df.select([F.nanvl(F.col(c).cast(T.DoubleType()), F.lit(None).cast(T.DoubleType())).alias(c)
                    for c in cols])
    q = _quantile_values(xs, cols, [0.25, 0.5, 0.75], buckets)
    r = _rounded(decimals)
    one = xs.agg(*[F.struct(
        F.lit(c).alias("column"), F.count(c).cast(T.LongType()).alias("count"),
        r(F.avg(c)).alias("mean"), r(F.stddev_samp(c)).alias("std"), F.min(c).alias("min"),
        *[r(_double(v)).alias(nm) for v, nm in zip(q[c], ("q25", "q50", "q75"))], F.max(c).alias("max"),
    ).alias(f"__m{i}") for i, c in enumerate(cols)])
    return one.select(F.inline(F.array(*[F.col(f"__m{i}") for i in range(len(cols))]))).orderBy("column")


def quantile_report(df: DataFrame, col: str, probs: list[float], names: list[str],
                    threshold: float, decimals: int | None = 6, buckets: int = BUCKETS) -> DataFrame:
    """Quantiles plus a count above a threshold, one row (non-null values only)."""
    x = _x(df, col)
    q = _quantile_values(x, ["x"], probs, buckets)["x"]
    r = _rounded(decimals)
    return x.agg(*[r(F.max(_double(v))).alias(nm) if v is None else F.first(r(_double(v))).alias(nm) for v, nm in zip(q, names)],
                 rows_where(x, F.col("x") > F.lit(threshold)).alias("n_above"), rows_of(x).alias("n"))


def boxplot_stats(df: DataFrame, col: str, whis: float = 1.5, decimals: int | None = 6,
                  buckets: int = BUCKETS) -> DataFrame:
    """Quartiles, whiskers (furthest values within whis x IQR) and outlier counts.

    The fences are literals by then, so whiskers and outliers are one partial aggregation.
    """
    x = _x(df, col)
    quartiles = _quantile_values(x, ["x"], [0.25, 0.5, 0.75], buckets)["x"]
    r = _rounded(decimals)
    q1, med, q3 = (_double(v) for v in quartiles)
    iqr = q3 - q1
    lo_f, hi_f = q1 - F.lit(whis) * iqr, q3 + F.lit(whis) * iqr
    v = F.col("x")
    out = x.agg(
        rows_of(x).alias("n"), F.min(F.when(v >= lo_f, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi_f, v)).alias("whisker_hi"),
        rows_where(x, v < lo_f).alias("n_out_lo"), rows_where(x, v > hi_f).alias("n_out_hi"))
    return out.select("n", r(q1).alias("q1"), r(med).alias("median"), r(q3).alias("q3"), "whisker_lo", "whisker_hi",
                      "n_out_lo", "n_out_hi")
