"""Operator 10 - near-duplicate vectors by an exact metric range join.

Vectors become unit vectors: cosine >= t means Euclidean distance <= eps. Pivots
split space into cells (nearest pivot). A vector is also sent to every other
cell that may hold a partner: the distance to the plane between the two pivots
is at most eps, and, by the triangle inequality, the distance to the cell's pivot is
at most the cell's radius plus eps. Each cell then joins on its own: its own
vectors against all it got, so each direction of a link is counted once, at home.

Equal vectors of a label are one row with a number of copies. Large cells are cut
into blocks of ``BLOCK`` rows by hash, so no task holds an unbounded cell. Pivots come
from a bounded sample: they only place the cell borders, the result is the same
for any pivots.

Defined results: vectors that are null, zero or hold a null or non-finite component,
and null labels, link with nothing; vectors of different lengths neither. Repeated
rows link with each other. component_id is the smallest vec_id (null ids last).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, sorted_groups, star_labels, stored
from .components import connected_components

COSINE = 0.98
#: Parameters: rows in one block of a cell, pivots at most, vectors the pivots are chosen from, slack for rounding.
BLOCK, MAX_PIVOTS, PIVOT_SAMPLE, SLACK = 4096, 128, 2048, 1e-7


def _matrix(col) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<f8").reshape(len(col), -1)


def _encode(df: DataFrame) -> DataFrame:
    """(vec_id, label, dim, vec): vec is the unit vector, null where the row links with nothing."""
    rows = df.select(F.col("vec_id").cast("long"), F.col("label").cast("string"),
                     F.col("embedding").cast("array<double>").alias("e"))

    def run(it):
        for b in it:
            out = []
            for e, label in zip(b.column("e"), b.column("label").to_pylist()):
                v = None
                if e.is_valid and label is not None and e.values.null_count == 0 and len(e.values):
                    x = e.values.to_numpy()
                    big = np.abs(x).max() if np.isfinite(x).all() else 0.0
                    if big > 0:
                        x = x / big  # keeps the norm of very large or small components in range
                        v = (x / np.sqrt(x @ x)).astype("<f8").tobytes()
                out.append(v)
            yield {"vec_id": b.column("vec_id"), "label": b.column("label"),
                   "dim": [0 if v is None else len(v) // 8 for v in out], "vec": out}

    return map_arrow(rows, run, "vec_id long, label string, dim int, vec binary")


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first pivots of the sample."""
    picked = [0]
    d = np.linalg.norm(sample - sample[0], axis=1)
    while len(picked) < min(n, len(sample)) and d.max() > 1e-9:
        k = int(d.argmax())
        picked.append(k)
        d = np.minimum(d, np.linalg.norm(sample - sample[k], axis=1))
    return sample[picked]


def _place(vecs: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    def run(it):
        for b in it:
            if not b.num_rows:
                continue
            dim = b.column("dim").to_numpy()
            cell, dist = np.zeros(len(dim), np.int64), np.zeros(len(dim))
            for k in np.unique(dim):
                at = np.flatnonzero(dim == k)
                d = _distances(_matrix(b.column("vec").take(pa.array(at))), pivots[int(k)])
                cell[at] = d.argmin(axis=1)
                dist[at] = d.min(axis=1)
            yield {c: b.column(c) for c in ("uid", "label", "dim", "vec", "copies")} | {"cell": cell, "dist": dist}

    return map_arrow(vecs, run, "uid long, label string, dim int, vec binary, copies long, cell int, dist double")


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (x @ p.T)))


def _replicate(placed: DataFrame, pivots: dict[int, np.ndarray], radius: dict, eps: float) -> DataFrame:
    """A row per cell that a vector takes part in; ``home`` marks its own."""

    def run(it):
        for b in it:
            if not b.num_rows:
                continue
            dim, home = b.column("dim").to_numpy(), b.column("cell").to_numpy()
            rows, cells = [], []
            for k in np.unique(dim):
                p = pivots[int(k)]
                at = np.flatnonzero(dim == k)
                d = _distances(_matrix(b.column("vec").take(pa.array(at))), p)
                own = d[np.arange(len(at)), home[at]]
                apart = np.maximum(_distances(p, p)[home[at]], 1e-12)
                border = (d ** 2 - own[:, None] ** 2) / (2 * apart)
                reach = np.array([radius.get((int(k), c), -10.0) for c in range(len(p))])
                take = (border <= eps + SLACK) & (d <= reach[None, :] + eps + SLACK)
                take[np.arange(len(at)), home[at]] = True
                r, c = np.nonzero(take)
                rows.append(at[r])
                cells.append(c)
            rows, cells = np.concatenate(rows), np.concatenate(cells)
            for s in range(0, len(rows), 8192):
                r, c = rows[s:s + 8192], cells[s:s + 8192]
                t = pa.array(r)
                yield {x: b.column(x).take(t) for x in ("uid", "label", "dim", "vec", "copies")} | {
                    "cell": c, "home": home[r] == c}

    return map_arrow(placed, run, "uid long, label string, dim int, vec binary, copies long, cell int, home boolean")


def links(vecs: DataFrame, cosine: float = COSINE, max_pivots: int = MAX_PIVOTS, block: int = BLOCK) -> DataFrame:
    """``(uid, n, root)``: links counted with copies, and a linked uid that stands for a part of its component.

    ``vecs``: stored distinct unit vectors (uid, label, dim, vec, copies).
    """
    spark = vecs.sparkSession
    eps = float(np.sqrt(2 - 2 * cosine))
    total = vecs.count()
    n_pivots = int(min(max_pivots, max(1, total // block)))
    pivots = {}
    for (k,) in vecs.select("dim").distinct().collect():
        rows = vecs.where(F.col("dim") == k).select("vec", F.xxhash64("vec").alias("h")).orderBy("h", "vec").limit(PIVOT_SAMPLE)
        pivots[k] = choose_pivots(np.array([np.frombuffer(r[0], "<f8") for r in rows.collect()]), n_pivots)
    placed = _place(vecs, pivots)
    radius = {(r[0], r[1]): r[2] for r in placed.groupBy("dim", "cell").agg(F.max("dist")).collect()}
    cells = stored(_replicate(placed, pivots, radius, eps), "cells")
    key = ["label", "dim", "cell"]
    size = cells.groupBy(*key).agg(F.ceil(F.sum(F.col("home").cast("int")) / block).cast("int").alias("own_blocks"),
                                   F.ceil(F.count(F.lit(1)) / block).cast("int").alias("all_blocks")).where("own_blocks > 0")
    j = cells.join(size, key)
    h = F.xxhash64("uid")
    own = (j.where("home").withColumn("i", F.pmod(h, "own_blocks").cast("int"))
           .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1))).withColumn("side", F.lit(0)))
    all_ = (j.withColumn("j", F.pmod(h, "all_blocks").cast("int"))
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("own_blocks") - 1))).withColumn("side", F.lit(1)))
    cols = [*key, "i", "j", "side", "uid", "vec", "copies"]
    group = [*key, "i", "j"]
    dealt = own.select(*cols).union(all_.select(*cols)).repartition(*group).sortWithinPartitions(*group, "side", "uid")

    def run(it):
        for t in sorted_groups(it, group):
            side = t.column("side").to_numpy()
            uid, copies = t.column("uid").to_numpy(), t.column("copies").to_numpy()
            na = int((side == 0).sum())
            if na == 0 or na == len(side):
                continue
            x = _matrix(t.column("vec").combine_chunks())
            a, b = x[:na], x[na:]
            count, li, lj = np.zeros(na, np.int64), [], []
            for s in range(0, na, 512):
                near = a[s:s + 512] @ b.T >= cosine
                near &= uid[s:s + 512][:na - s, None] != uid[na:][None, :]
                count[s:s + 512] = near @ copies[na:]
                r, c = np.nonzero(near)
                li.append(r + s)
                lj.append(c + na)
            both, same = np.unique(uid, return_inverse=True)
            lab = star_labels(len(both), same[np.concatenate(li)], same[np.concatenate(lj)])
            tied = np.flatnonzero(lab != np.arange(len(both)))
            yield {"uid": np.concatenate((uid[:na], both[tied])), "n": np.concatenate((count, np.zeros(len(tied), np.int64))),
                   "root": np.concatenate((uid[:na], both[lab[tied]]))}

    return map_arrow(dealt, run, "uid long, n long, root long")


def near_duplicates(df: DataFrame, cosine: float = COSINE, max_pivots: int = MAX_PIVOTS, block: int = BLOCK) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = stored(_encode(df).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    key = ["label", "vec"]
    groups = (rows.where("vec is not null").groupBy(*key)
              .agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("dim").alias("dim")))
    groups = stored(groups, "distinct-vectors")
    found = stored(links(groups.withColumnRenamed("rep", "uid"), cosine, max_pivots, block), "vector-links")
    comp = connected_components(found.where("uid <> root"), "uid", "root")
    n = found.groupBy("uid").agg(F.sum("n").alias("n"))
    reps = (groups.join(n, groups["rep"] == n["uid"], "left").drop("uid")
            .join(comp, F.col("rep") == F.col("node"), "left")
            .select(*key, "rep", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("comp", "rep").alias("comp")))
    out = rows.alias("r").join(reps.alias("g"), [F.col("r.label") == F.col("g.label"), F.col("r.vec") == F.col("g.vec")], "left")
    out = out.select("vec_id", F.coalesce("comp", "uid").alias("comp"),
                     F.coalesce(F.col("n") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"))
    out = stored(out, "vector-components")
    least = out.groupBy("comp").agg(F.min("vec_id").alias("component_id"))
    return (out.join(least, "comp").select("vec_id", "n_links", "component_id",
                                           F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")))


def op10_query(df: DataFrame) -> DataFrame:
    return near_duplicates(df)
