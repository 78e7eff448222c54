"""Histograms, kernel density curves and counts per labelled band.

Bounds (min/max/std/n) come from one struct-valued scalar subquery: one extra
pruned column scan with partial aggregation, executed once and inlined as
constants, so the binning or kernel pass stays inside one codegen stage with a
tiny final shuffle (``bins`` or ``gridsize`` groups).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import cut
from .freq import counted, ordered_counts, rows_of
from .stats import sample_std


def _x(df: DataFrame, col: str) -> DataFrame:
    """The column as non-missing doubles (NULL and NaN are missing, as in pandas)."""
    return df.select(F.col(col).cast(T.DoubleType()).alias("x"), *counted(df)).where(
        F.col("x").isNotNull() & ~F.isnan("x"))


#: The kernel is left out beyond so many bandwidths; values are gathered in cells, so many to a bandwidth;
#: a cell is described by so many moments.
REACH, CELLS, TERMS = 8.6, 8, 12


def _hermite(terms: int) -> list[list[float]]:
    """Coefficients, lowest power first, of the polynomials He_k with exp(ut - tt/2) = sum of He_k(u) t^k / k!."""
    rows = [[1.0], [0.0, 1.0]]
    while len(rows) < terms:
        k, last, before = len(rows) - 1, rows[-1], rows[-2]
        rows.append([(last[j - 1] if j else 0.0) - (k * before[j] if j < len(before) else 0.0) for j in range(k + 2)])
    return rows[:terms]


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over [min, max] -> (bin, lo, hi, n), empty bins kept.

    Bins are [lo, hi) except the last, which is closed; when min == max the
    range is widened by 0.5 on each side (as numpy does).  A value's bin follows
    from its distance to the minimum and is then moved by one where rounding put
    it on the wrong side of an edge.  NULLs are ignored.
    """
    x = _x(df, col)
    b = x.agg(F.struct(F.min("x").alias("mn"), F.max("x").alias("mx"))).scalar()
    mn0, mx0 = b.getField("mn"), b.getField("mx")
    same = mn0 == mx0
    mn = F.when(same, mn0 - F.lit(0.5)).otherwise(mn0)
    mx = F.when(same, mx0 + F.lit(0.5)).otherwise(mx0)
    step = (mx - mn) / F.lit(float(bins))

    def edge(k):  # the last edge is the maximum itself
        return F.when(k == F.lit(bins), mx).otherwise(k * step + mn)

    guess = F.least(F.floor((F.col("x") - mn) / (mx - mn) * F.lit(bins)), F.lit(bins - 1)).cast(T.IntegerType())
    moved = (F.when(F.col("x") < edge(F.col("g")), F.col("g") - 1)
             .when((F.col("x") >= edge(F.col("g") + 1)) & (F.col("g") != bins - 1), F.col("g") + 1)
             .otherwise(F.col("g")))
    binned = x.select("x", *counted(df), guess.alias("g")).select(moved.alias("bin"), *counted(df))
    counts = binned.groupBy("bin").agg(rows_of(df).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast(T.IntegerType()).alias("bin"))
    lo, hi = edge(F.col("bin")), edge(F.col("bin") + 1)
    # both sides hold at most ``bins`` rows by construction
    return (frame.join(F.broadcast(counts), "bin", "left")
            .select("bin", lo.alias("lo"), hi.alias("hi"), F.coalesce("n", F.lit(0)).cast(T.LongType()).alias("n"))
            .where(mn.isNotNull())
            .orderBy("bin"))


def kde(df: DataFrame, col: str, gridsize: int = 200, bins: int | None = None,
        decimals: int | None = 9) -> DataFrame:
    """Gaussian kernel density on an even grid over [min, max] -> (i, x, density[, count_density]).

    Bandwidth is Scott's rule: sample std x n^(-1/5).  Rows are gathered in cells of an eighth of the
    bandwidth h, each described by its first ``TERMS`` moments around its centre c: one partial aggregation,
    whose groups follow the width of the data and not its distinct values.  A cell acts on the grid points
    within ``REACH`` bandwidths only, by the expansion (u = (g - c) / h, t = (x - c) / h, |t| <= 1/16)

        exp(-(u - t)^2 / 2) = exp(-u^2 / 2) * sum over k of He_k(u) t^k / k!

    Error, as a share of one value's peak: the terms left out are below 1.09 * sum over k >= 12 of
    16^-k / sqrt(k!) < 2e-19 (Cramer's bound on He_k), the points left out below exp(-8.53^2 / 2) < 2e-16.
    With ``bins`` the density is also scaled to histogram counts (density x n x bin width).  No spread, no rows.
    """
    x = _x(df, col)
    st = x.agg(F.struct(rows_of(x).alias("n"), sample_std(x).alias("sd"),
                        F.min("x").alias("mn"), F.max("x").alias("mx"))).scalar()
    n, sd, mn, mx = (st.getField(c) for c in ("n", "sd", "mn", "mx"))
    h = F.when(sd > 0, sd * F.pow(n.cast(T.DoubleType()), F.lit(-0.2)))
    step = (mx - mn) / F.lit(gridsize - 1)

    centre = mn + (F.col("cell") + F.lit(0.5)) * h / F.lit(CELLS)
    placed = x.select("x", *counted(df), F.floor((F.col("x") - mn) / h * F.lit(CELLS)).alias("cell")).where(F.col("cell").isNotNull())
    t = placed.select("cell", *counted(df), ((F.col("x") - centre) / h).alias("t"))
    weight = F.col(counted(df)[0]) if counted(df) else F.lit(1)
    powers, p = [], weight.cast(T.DoubleType())
    for _ in range(TERMS):
        powers.append(p)
        p = p * F.col("t")
    cells = t.groupBy("cell").agg(*[F.sum(p).alias(f"m{k}") for k, p in enumerate(powers)])

    he = _hermite(TERMS)
    poly = [sum((F.col(f"m{k}") * F.lit(he[k][j] / math.factorial(k)) for k in range(j, TERMS) if he[k][j]), F.lit(0.0)).alias(f"b{j}")
            for j in range(TERMS)]
    first = F.greatest(F.lit(0), F.ceil((F.col("c") - F.lit(REACH) * h - mn) / step)).cast(T.IntegerType())
    last = F.least(F.lit(gridsize - 1), F.floor((F.col("c") + F.lit(REACH) * h - mn) / step)).cast(T.IntegerType())
    near = F.explode(F.when(first <= last, F.sequence(first, last))).alias("i")
    pts = cells.select(centre.alias("c"), *poly).select("*", near)
    u = ((mn + F.col("i") * step) - F.col("c")) / h
    value = F.col(f"b{TERMS - 1}")
    for j in range(TERMS - 2, -1, -1):
        value = value * F.col("u") + F.col(f"b{j}")
    sums = (pts.withColumn("u", u).groupBy("i")
            .agg(F.sum(F.exp(F.lit(-0.5) * F.col("u") * F.col("u")) * value).alias("__s")))  # at most gridsize rows

    grid = df.sparkSession.range(gridsize).select(F.col("id").cast(T.IntegerType()).alias("i"))
    norm = F.lit(1.0) / (n.cast(T.DoubleType()) * h * F.sqrt(F.lit(2.0 * 3.141592653589793)))
    d = F.coalesce("__s", F.lit(0.0)) * norm
    r = (lambda c: F.round(c, decimals)) if decimals is not None else (lambda c: c)
    cols = [F.col("i"), r(mn + F.col("i") * step).alias("x"), r(d).alias("density")]
    if bins:
        cd = d * n.cast(T.DoubleType()) * (mx - mn) / F.lit(bins)
        cols.append((F.round(cd, 6) if decimals is not None else cd).alias("count_density"))
    return grid.join(F.broadcast(sums), "i", "left").where(h.isNotNull()).select(cols).orderBy("i")


def banded_counts(df: DataFrame, col: str, edges: list[float], labels: list[str],
                  alias: str = "band") -> DataFrame:
    """Count per labelled interval in band order, zero rows for empty bands -> (band, ord, n, pct)."""
    banded = df.select(cut(F.col(col), edges, labels).alias(alias))
    return ordered_counts(banded, alias, labels, keep_absent=True)
