"""Operator 2 - n-gram Jaccard join by chosen paths.

Texts become sets of word shingles; equal sets are one node with a number of
copies. Sets are embedded as ``SKETCH`` min-hash tokens. In every run the tree of
chosen paths is walked level by level: a node of the tree samples each token
position with probability 1 / (threshold * SKETCH) and splits its sets by the
token there, so two sets that share a fraction ``threshold`` of their tokens are
expected to stay together in one child. The first ``FIRST`` levels of a set follow
from its sketch alone and are walked where it is made. Buckets of at most ``LEAF``
sets are compared by brute force; larger ones are split further. A bucket that is
still larger at the last level holds sets that share many sampled tokens and is
taken as one group of candidates. The number of runs follows from the positions
that the runs' roots, which are fixed, really sample: as many as the target recall
needs at the last level and ``FIRST_MISS`` where buckets are first compared.

Candidates are only that: the sets that hang together by them are compared
exactly, in blocks of bounded size, each pair once. So every reported link has a Jaccard
similarity of at least the threshold, and links between sets that met only
through others are found as well.

Copies are never expanded into pairs: the links of a document are summed from
links between distinct sets, weighted by copies.

Defined results: a text of fewer than ``n`` words is one shingle of all its words;
null text or a text without words has no shingle and links with nothing; repeated
rows are copies of each other; a class is named by its smallest doc_id (null if all
its ids are null). Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType

from .common import Words, drop_stored, map_arrow, mixed, place_of, small_batches, sorted_groups, star_labels, stored, text_chunks, with_text
from .components import connected_components
from .substring import _rolling

NGRAM, THRESHOLD, RECALL = 5, 0.8, 0.995
#: Parameters: tokens of a sketch, levels, sets of a brute-force bucket, shingles of an exact block.
SKETCH, LEVELS, LEAF, BLOCK_SHINGLES = 128, 4, 256, 1 << 19
#: The level whose buckets are compared first: sets that merely share one line are mostly apart by then, so the rows of
#: buckets stay in proportion to the input. Chance that a pair at the threshold has not met there in any run.
FIRST, FIRST_MISS = 2, 1e-6
#: Standard deviations by which a sketch may underestimate a pair's similarity.
MARGIN = 4.0


def shingle_sets(texts: list[str], n: int = NGRAM) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = Words(texts)
    h = w.hashes()
    g = _rolling(h, n) if len(h) >= n else np.zeros(0, np.uint64)
    out = []
    for s, e in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if e - s >= n:
            out.append(np.unique(g[s:e - n + 1]))
        elif e > s:
            out.append(np.unique(_rolling(h[s:e], e - s) ^ np.uint64(e - s)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


_SEEDS = mixed(np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Min-hash tokens (32 bits each) of a set, position by position."""
    best = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(shingles), 2048):
        x = shingles[s:s + 2048]
        best = np.minimum(best, ((x[None, :] ^ _SEEDS[:, None]) * np.uint64(0xBF58476D1CE4E5B9)).min(axis=1))
    return (mixed(best) >> np.uint64(32)).astype("<u4")


def _sketched(docs: DataFrame, n: int, threshold: float, recall: float, levels: int) -> DataFrame:
    """Every row with its set's size, two 64-bit signatures, its paths down to the first compared level and 8 bits of each
    token of its sketch; ``orig`` holds the row's own columns."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("orig"), F.col("doc_id").cast("long").alias("doc_id"))
    schema = StructType([rows.schema["orig"], *StructType.fromDDL(
        "doc_id long, n long, sig_a long, sig_b long, paths array<long>, sk8 binary").fields])
    at = place_of(docs, "text")
    small_batches(docs.sparkSession)
    root, pos = roots(recall, levels, threshold)
    depth = min(FIRST, levels)

    def run(it):
        for b, texts in text_chunks(with_text(it, "orig", at)):
            sets = shingle_sets(texts, n)
            some = [i for i, s in enumerate(sets) if len(s)]
            sk = np.stack([sketch(sets[i]) for i in some]) if some else np.zeros((0, SKETCH), "<u4")
            row, path = first_paths(sk, root, pos, threshold, depth)
            low = sk.astype(np.uint8)
            sk8 = [b""] * len(sets)
            for i, x in zip(some, low):
                sk8[i] = x.tobytes()
            each = np.zeros(len(sets) + 1, np.int64)
            each[np.array(some, np.int64) + 1] = np.bincount(row, minlength=len(some))
            yield {"orig": b.column("orig"), "doc_id": b.column("doc_id"), "n": [len(s) for s in sets],
                   "sig_a": [int(s.sum(dtype=np.uint64).astype(np.int64)) for s in sets],
                   "sig_b": [int(mixed(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets],
                   "paths": pa.ListArray.from_arrays(pa.array(np.cumsum(each), pa.int32()), pa.array(path.view(np.int64))),
                   "sk8": sk8}

    return map_arrow(rows, run, schema)


def _chosen(path: np.ndarray, probability: float) -> np.ndarray:
    """(paths x SKETCH) which positions each path of the tree samples."""
    x = mixed(path[:, None] ^ (_SEEDS[None, :] * np.uint64(0x100000001B3)))
    return (x >> np.uint64(11)).astype(np.float64) / 2 ** 53 < probability


def miss(pos: np.ndarray, levels: int = LEVELS, threshold: float = THRESHOLD) -> float:
    """Probability that a pair at the threshold never meets at the last level when the roots sample the positions ``pos``.

    Given the number of positions where the pair's sketches agree, every set of so many positions is equally likely and
    each node below the roots samples anew; the numbers are averaged with their binomial probabilities.
    """
    agree = np.arange(SKETCH + 1)
    q = np.ones(SKETCH + 1)
    for _ in range(levels - 1):  # a child of the root stays together down to the last level
        q = 1 - (1 - q / (threshold * SKETCH)) ** agree
    # ways[a, k]: sets of k positions, each weighted by the misses of its sampled positions at a agreements.
    ways = np.zeros((SKETCH + 1, SKETCH + 1))
    ways[:, 0] = 1
    for times in np.bincount(pos, minlength=SKETCH):
        ways[:, 1:] = ways[:, 1:] + ways[:, :-1] * ((1 - q) ** times)[:, None]
    chance = [math.comb(SKETCH, a) * threshold ** a * (1 - threshold) ** (SKETCH - a) for a in range(SKETCH + 1)]
    return sum(chance[a] * ways[a, a] / math.comb(SKETCH, a) for a in range(SKETCH + 1))


def roots(recall: float = RECALL, levels: int = LEVELS, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """(root, position) of every first-level path: as many runs as the target recall needs at the last level and
    ``FIRST_MISS`` at the first compared one. A run whose root samples nothing is no run."""
    root, pos, i = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    while not len(pos) or miss(pos, levels, threshold) > 1 - recall or miss(pos, min(FIRST, levels), threshold) > FIRST_MISS:
        i += 1
        r = mixed(np.array([i], np.uint64) * np.uint64(0xA0761D6478BD642F))
        p = np.nonzero(_chosen(r, 1 / (threshold * SKETCH)))[1]
        root, pos = np.append(root, np.repeat(r, len(p))), np.append(pos, p)
    return root, pos


def _child(path: np.ndarray, pos: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The path below ``path`` of a set with ``token`` at the sampled position."""
    return mixed(path * np.uint64(0x9E3779B97F4A7C15) + pos.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                 + mixed(token.astype(np.uint64)))


def first_paths(sk: np.ndarray, root: np.ndarray, pos: np.ndarray, threshold: float, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, path), in order of rows, of the sketches ``sk`` after ``depth`` levels of every run."""
    path = _child(root[None, :], pos[None, :], sk[:, pos]).ravel()
    row = np.repeat(np.arange(len(sk)), len(pos))
    for _ in range(depth - 1):
        row, path = _below(path, row, sk, threshold)
    return row, path


def _below(path: np.ndarray, row: np.ndarray, sk: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, path) one level below the paths of rows of ``sk``."""
    rows, paths = [row[:0]], [path[:0]]
    for s in range(0, len(path), 2048):
        p, r = path[s:s + 2048], row[s:s + 2048]
        at, pos = np.nonzero(_chosen(p, 1 / (threshold * SKETCH)))
        rows.append(r[at])
        paths.append(_child(p[at], pos, sk[r[at], pos]))
    return np.concatenate(rows), np.concatenate(paths)


def _children(df: DataFrame, threshold: float) -> DataFrame:
    """(path, uid, sk8) of the next level from those of one: what is still large is split well enough by 8 bits of a token."""
    def run(it):
        for b in it:
            for s in range(0, b.num_rows, 4096):
                part = b.slice(s, 4096)
                raw = part.column("sk8")
                sk = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(-1, SKETCH)
                row, path = _below(part.column("path").to_numpy().view(np.uint64), np.arange(part.num_rows), sk, threshold)
                at = pa.array(row)
                yield {"path": path.view(np.int64), "uid": part.column("uid").take(at), "sk8": raw.take(at)}

    return map_arrow(df, run, "path long, uid long, sk8 binary")


def _leaf_links(leaves: DataFrame, least: int) -> DataFrame:
    """Candidate links (a, b) of small buckets: rows of a bucket are compared by 4 bits of each token of their sketches
    (equal tokens stay equal, so no pair is lost by it)."""
    dealt = leaves.repartition("path").sortWithinPartitions("path", "uid")

    def compare(path, uid, sk):
        order_links = []
        i = np.arange(len(path) - 1)
        d = 1
        while len(i):
            i = i[i + d < len(path)]
            i = i[path[i] == path[i + d]]
            if len(i):
                near = np.zeros(len(i), bool)
                for s in range(0, len(i), 8192):
                    k = i[s:s + 8192]
                    x = sk[k] ^ sk[k + d]
                    near[s:s + 8192] = ((x & 15) == 0).sum(axis=1) + ((x & 240) == 0).sum(axis=1) >= least
                order_links.append(np.stack((i[near], i[near] + d)))
            d += 1
        if not order_links:
            return None
        a, b = np.concatenate(order_links, axis=1)
        lab = star_labels(len(path), a, b)
        k = np.flatnonzero(lab != np.arange(len(path)))
        return {"a": uid[k], "b": uid[lab[k]]}

    def run(it):
        held: list = []
        for b in it:
            if not b.num_rows:
                continue
            held.append((b.column("path").to_numpy(), b.column("uid").to_numpy(),
                         np.frombuffer(b"".join(b.column("sk4").to_pylist()), np.uint8).reshape(-1, SKETCH // 2)))
            path, uid, sk = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(path, path[-1], "left")) if len(path) else 0
            held = [(path[cut:], uid[cut:], sk[cut:])]  # the last bucket may go on
            if cut and (got := compare(path[:cut], uid[:cut], sk[:cut])):
                yield got
        if held and (got := compare(*held[0])):
            yield got

    return map_arrow(dealt, run, "a long, b long")


def candidates(reps: DataFrame, threshold: float, leaf: int, levels: int) -> tuple[DataFrame, list[DataFrame]]:
    """Candidate links between stored distinct sets (uid, paths, sk8), and the stored tables behind them."""
    sd = math.sqrt(threshold * (1 - threshold) / SKETCH)
    least = math.floor(SKETCH * (threshold - MARGIN * sd))
    front, edges, used = reps.select(F.explode("paths").alias("path"), "uid"), None, []
    for level in range(min(FIRST, levels), levels + 1):
        size = front.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("least")).where("n > 1")
        met = front.join(size, "path")
        if not used:  # only sets that meet others need their sketches, which then go down with them
            met = met.join(reps.select("uid", "sk8"), "uid")
        met = stored(met.select("path", "uid", "sk8", "n", "least"), "buckets")
        used.append(met)
        small, big = met.where(F.col("n") <= leaf), met.where(F.col("n") > leaf)
        links = _leaf_links(small.select("path", "uid", _half_bytes(F.col("sk8")).alias("sk4")), least)
        if level == levels:
            links = links.union(big.select(F.col("uid").alias("a"), F.col("least").alias("b")).where("a <> b"))
        edges = links if edges is None else edges.union(links)
        if level == levels or big.isEmpty():
            break
        front = stored(_children(big.select("path", "uid", "sk8"), threshold), "paths")
        used.append(front)
    return edges, used


#: Blocks of 64 bits of a filter of row ids at most (16 MB), and bits set for an id.
FILTER_BLOCKS, FILTER_BITS = 1 << 21, 4


def _id_bits(uid: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    h = mixed(uid.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    bits = np.zeros(len(h), np.uint64)
    for j in range(FILTER_BITS):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * j)) & np.uint64(63))
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), bits


def split_by_ids(rows: DataFrame, ids: DataFrame, most_blocks: int = FILTER_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """``rows`` (with a column ``uid``) in two: those that may have one of the uids of the stored ``ids``, and
    those that have none.

    A broadcast Bloom filter of bounded size decides, so that large rows need not meet the ids in a shuffle;
    beyond about four ids a block more rows count as possible ones, none is lost.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    blocks = int(min(most_blocks, max(64, ids.count() // 2)))

    def mark(it):
        for b in it:
            at, bits = _id_bits(b.column("uid").to_numpy(), blocks)
            yield {"at": at, "bits": bits.view(np.int64)}

    t = map_arrow(ids.select("uid"), mark, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(blocks, np.uint64)
    table[t.column("at").to_numpy()] = t.column("bits").to_numpy().view(np.uint64)
    sent = rows.sparkSession.sparkContext.broadcast(table)
    schema = StructType([*rows.schema.fields]).add("__maybe", BooleanType())

    def probe(it):
        target = to_arrow_schema(schema)
        for b in it:
            for s in range(0, b.num_rows, 512):  # small batches on the way back: the rows hold whole texts
                part = b.slice(s, 512)
                at, bits = _id_bits(part.column("uid").to_numpy(), blocks)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array((sent.value[at] & bits) == bits)], schema=target)

    marked = rows.mapInArrow(probe, schema)
    return marked.where("__maybe").drop("__maybe"), marked.where("not __maybe").drop("__maybe")


def _half_bytes(sk8):
    """4 bits of each token, two tokens a byte."""
    return F.unhex(F.regexp_replace(F.hex(sk8), ".(.)", "$1"))


def _exact(members: DataFrame, threshold: float, n: int) -> DataFrame:
    """``(uid, n, root, whole)`` from (comp, uid, copies, blocks, text): exact links inside each candidate group,
    whose sets are dealt over ``blocks`` blocks; a group of one block is ``whole``, its roots are its classes."""

    def as_sets(it):
        for b, texts in text_chunks(it):
            sets = shingle_sets(texts, n)
            yield {c: b.column(c) for c in ("comp", "uid", "copies", "blocks")} | {
                "size": [len(s) for s in sets], "s": [s.astype("<u8").tobytes() for s in sets]}

    sets = map_arrow(members, as_sets, "comp long, uid long, copies long, blocks int, size long, s binary")
    j = sets.withColumn("own", F.pmod(F.xxhash64("uid"), "blocks").cast("int"))
    pairs = j.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = pairs.select("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "uid", "copies", "size", "s",
                        (F.col("blocks") == 1).alias("whole"))
    group = ["comp", "i", "j"]
    dealt = rows.repartition(*group).sortWithinPartitions(*group, "size", "uid")

    def run(it):
        out: dict = {"uid": [], "n": [], "root": [], "whole": []}
        rows_out = 0
        for t in sorted_groups(it, group):
            uid, copies, size = (t.column(c).to_numpy() for c in ("uid", "copies", "size"))
            if len(uid) > 1:
                own, i, k = t.column("own").to_numpy(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
                count, lab = _block_links(t.column("s").to_pylist(), size, copies, own, i == k, threshold)
                out["uid"].append(uid)
                out["n"].append(count)
                out["root"].append(uid[lab])
                out["whole"].append(t.column("whole").to_numpy())
                rows_out += len(uid)
            if rows_out > 8192:
                yield {c: np.concatenate(v) for c, v in out.items()}
                out, rows_out = {"uid": [], "n": [], "root": [], "whole": []}, 0
        if rows_out:
            yield {c: np.concatenate(v) for c, v in out.items()}

    return map_arrow(dealt, run, "uid long, n long, root long, whole boolean")


def _block_links(raw: list[bytes], size: np.ndarray, copies: np.ndarray, own: np.ndarray, diagonal: bool, threshold: float):
    """Weighted links of each set and component labels; the sets come in order of size."""
    flat = np.frombuffer(b"".join(raw), "<u8")
    _, code = np.unique(flat, return_inverse=True)
    code = code.astype(np.int32)
    offset = np.concatenate(([0], np.cumsum(size)))
    mark = np.zeros(int(code.max()) + 1, np.uint8)
    count, li, lj = np.zeros(len(size), np.int64), [], []
    for a in range(len(size) - 1):
        # Only sets of at most size / threshold can reach the threshold; they follow in order of size.
        hi = int(np.searchsorted(size, size[a] / threshold + 1e-9, "right"))
        if hi <= a + 1:
            continue
        mine = code[offset[a]:offset[a + 1]]
        mark[mine] = 1
        common = np.add.reduceat(mark[code[offset[a + 1]:offset[hi]]], offset[a + 1:hi] - offset[a + 1], dtype=np.int64)
        mark[mine] = 0
        near = common >= threshold * (size[a] + size[a + 1:hi] - common) - 1e-9
        if not diagonal:
            near &= own[a + 1:hi] != own[a]
        b = np.flatnonzero(near) + a + 1
        if len(b):
            count[a] += copies[b].sum()
            count[b] += copies[a]
            li.append(np.full(len(b), a))
            lj.append(b)
    if not li:
        return count, np.arange(len(size))
    return count, star_labels(len(size), np.concatenate(li), np.concatenate(lj))


def _classes(docs: DataFrame, threshold: float, n: int, recall: float, leaf: int, levels: int,
             block_shingles: int) -> tuple[DataFrame, DataFrame]:
    """The stored rows (uid, orig, ...) and (class_uid, uid, doc_id, n_links, class_id) for each of them."""
    rows = stored(_sketched(docs, n, threshold, recall, levels).withColumn("uid", F.monotonically_increasing_id()), "sketches")
    sig = ["n", "sig_a", "sig_b"]
    groups = stored(rows.where("n > 0").groupBy(*sig).agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("copies")), "equal-sets")
    reps = stored(rows.join(groups.select("rep", "copies"), F.col("uid") == F.col("rep")).select("uid", "copies", "n", "paths", "sk8"),
                  "distinct-sets")
    edges, used = candidates(reps, threshold, leaf, levels)
    comp = stored(connected_components(edges), "candidate-groups")
    for t in used:
        drop_stored(t)
    # Blocks follow from the sets' sizes, so that each set is sent once, and to its blocks only.
    sized = comp.join(reps.select("uid", "copies", "n"), F.col("node") == F.col("uid")).select("comp", "uid", "copies", "n")
    blocks = sized.groupBy("comp").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("blocks"))
    members = stored(sized.join(blocks, "comp").select("comp", "uid", "copies", "blocks"), "members")
    for t in (comp, reps):
        drop_stored(t)
    texts, _ = split_by_ids(rows.select("uid", F.col("orig.text").alias("text")), members)
    found = stored(_exact(texts.join(members, "uid").select("comp", "uid", "copies", "blocks", "text"), threshold, n), "exact-links")
    drop_stored(members)
    exact = (connected_components(found.where("not whole and uid <> root"), "uid", "root")
             .union(found.where("whole").select("uid", "root")))
    counts = found.groupBy("uid").agg(F.sum("n").alias("linked"))
    per_rep = (groups.join(counts, F.col("rep") == F.col("uid"), "left").drop("uid")
               .join(exact, F.col("rep") == F.col("node"), "left")
               .select(*sig, F.coalesce("comp", "rep").alias("class_uid"),
                       (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    ids = rows.select("uid", "doc_id", *sig).join(per_rep, sig, "left")
    ids = stored(ids.select("uid", "doc_id", F.coalesce("class_uid", "uid").alias("class_uid"),
                            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "classes")
    for t in (groups, found):
        drop_stored(t)
    name = ids.groupBy("class_uid").agg(F.min("doc_id").alias("class_id"))
    return rows, ids.join(name, "class_uid")


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM, recall: float = RECALL,
                    leaf: int = LEAF, levels: int = LEVELS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document row: doc_id, class_id (smallest doc_id of its class), n_links (other
    rows whose similarity is at the threshold or above)."""
    return _classes(docs.select("doc_id", "text"), threshold, n, recall, leaf, levels, block_shingles)[1].select(
        "doc_id", "class_id", "n_links")


def op2_query(docs: DataFrame) -> DataFrame:
    return jaccard_classes(docs)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM, recall: float = RECALL, leaf: int = LEAF,
             levels: int = LEVELS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``docs``, one of each class: that with the smallest doc_id (null ids last).

    Of equal rows one stays; texts without words are each a class of their own and stay.
    """
    rows, classes = _classes(docs, threshold, n, recall, leaf, levels, block_shingles)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    first = classes.groupBy("class_uid").agg(F.min(order).alias("f")).select(F.col("f.uid").alias("uid"))
    leave = stored(classes.select("uid").join(first, "uid", "left_anti"), "leaving")
    # Most rows stay: only those that a filter of the leaving ids does not rule out meet them in a join.
    maybe, stay = split_by_ids(rows.select("uid", "orig"), leave)
    return stay.unionByName(maybe.join(leave, "uid", "left_anti")).select("orig.*")
