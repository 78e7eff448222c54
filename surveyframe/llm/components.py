"""Connected components by alternating large-star and small-star steps on written edge tables.

Nothing but a count per round reaches the driver. A vertex with many edges is
only ever a join key (its minimum is one row), never a collected list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def _is_stars(e: DataFrame) -> bool:
    """Has every upper end one lower end, which is no upper end itself? Then the lower ends are the components' smallest nodes."""
    ends = e.select(F.col("a").alias("v"), F.lit(1).alias("ups"), F.lit(0).alias("downs")).union(e.select("b", F.lit(0), F.lit(1)))
    return not (ends.groupBy("v").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs")).where("ups + downs > 1 and ups > 0")
                .agg(F.count(F.lit(1))).first()[0])


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    j = down.join(least, "a")
    return (j.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .union(least.select("a", F.col("m").alias("b"))).distinct())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, comp)`` for every node of an edge, ``comp`` the smallest node reachable.

    Ends when the edges are stars: every node then points at its root. Self
    loops and repeated edges are allowed; no edges give no rows.
    """
    cur = stored(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
                 .where("a is not null and b is not null and a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _is_stars(cur):
        nxt = stored(_small_star(_large_star(cur)), "edges")
        drop_stored(cur)
        cur = nxt
    return (cur.select(F.col("a").alias("node"), F.col("b").alias("comp"))
            .union(cur.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()))
