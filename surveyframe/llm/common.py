"""Shared helpers: written intermediate tables, bounded text chunks, sorted groups."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step handles at a time (a longer text comes alone).
CHUNK_BYTES = 1 << 20

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared ``spark.checkpoint.dir``.

    Only where the session has no such setting (tests) a scratch folder is made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; a cluster needs a shared folder")
        base = tempfile.mkdtemp(prefix="sf-work-")
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    This cuts the lineage at a table that outlives executors; the shuffle files
    behind it are released as soon as the table is complete.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    old = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        w = df.write.option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    finally:
        spark.conf.set(CLEANUP, old)
    out = spark.read.schema(df.schema).parquet(path)
    return out


def drop_stored(df: DataFrame) -> None:
    """Remove the files of a table made by :func:`stored` that nothing reads any more."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for d in {os.path.dirname(f) for f in df.inputFiles()}:
        p = hadoop(d)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Bytes of rows in an Arrow batch to a Python worker, for operators that send whole rows. Spark's 64 MB (or 10,000 rows)
#: are held at once by the executor and by the worker of every task.
BATCH_BYTES, BATCH_SETTING = "4m", "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let the session send small Arrow batches from now on, unless it has a size set."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def with_text(batches: Iterator[pa.RecordBatch], row: str, at: int) -> Iterator[pa.RecordBatch]:
    """The batches with field ``at`` of their struct column ``row`` as a column ``text``, so that it is sent once."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, b.column(row).field(at)], names=[*b.schema.names, "text"])


def place_of(df: DataFrame, name: str) -> int:
    """Index of a column, names compared as Spark does."""
    return [c.lower() for c in df.columns].index(name.lower())


def n_parts(spark: SparkSession, at_least: int = 1) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), at_least)


# ---------------------------------------------------------------- inside tasks

def text_chunks(batches: Iterator[pa.RecordBatch], col: str = "text",
                budget: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches whose texts (null: empty) hold about ``budget`` bytes at most."""
    for b in batches:
        if b.num_rows == 0:
            continue
        arr = pc.fill_null(b.column(col), "")
        ends = np.cumsum(pc.binary_length(arr).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        i = 0
        while i < b.num_rows:
            base = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, base + budget, "right")))
            yield b.slice(i, j - i), arr.slice(i, j - i).to_pylist()
            i = j


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table per run of equal ``keys`` in a stream that is sorted by them."""
    pending: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if b.num_rows == 0:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            if s == e:
                continue
            key = tuple(c[s] for c in cols)
            if pending and key != last:
                yield pa.Table.from_batches(pending)
                pending = []
            last = key
            pending.append(b.slice(s, e - s))
    if pending:
        yield pa.Table.from_batches(pending)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the result."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts, by vector operations.

    ``start``/``end``: byte spans in ``data`` (the texts joined by newlines);
    ``doc``: index of the text; ``first``: index of each text's first word, with
    the number of words at the end.
    """

    def __init__(self, texts: list[str], lower: bool = False, only_spaces: bool = False):
        parts = [t.encode() for t in texts]
        raw = (b" " if only_spaces else b"\n").join(parts)
        buf = np.frombuffer(raw, np.uint8)
        if lower:
            buf = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)
            raw = buf.tobytes()
        self.data = raw
        self.buf = buf
        if len(buf):
            space = buf == 32
            if not only_spaces:
                space |= (buf >= 9) & (buf <= 13)
            edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
            self.start = np.flatnonzero(edge == -1)
            self.end = np.flatnonzero(edge == 1)
        else:
            self.start = self.end = np.zeros(0, np.int64)
        begins = np.cumsum([0] + [len(p) + 1 for p in parts])
        self.first = np.searchsorted(self.start, begins).astype(np.int64)
        self.first[-1] = len(self.start)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        power = np.full(int(size.max()), np.uint64(0x9E3779B97F4A7C15 + 2 * seed), np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        total = int(size.sum())
        offset = np.cumsum(size) - size
        pos = np.arange(total) - np.repeat(offset, size)
        chars = self.buf[pos + np.repeat(self.start, size)].astype(np.uint64) + np.uint64(1 + seed)
        h = np.add.reduceat(mixed(chars * np.uint64(0x100000001B3)) * power[pos], offset)
        return mixed(h + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def star_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Connected components of ``n`` nodes under links (i, j): each node's smallest index."""
    lab = np.arange(n)
    while True:
        a, b = lab[i], lab[j]
        differ = a != b
        if not differ.any():
            return lab
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(lab, np.maximum(a, b), np.minimum(a, b))
        while True:
            nxt = lab[lab]
            if (nxt == lab).all():
                break
            lab = nxt


def arrow_schema(df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(df_schema) if isinstance(df_schema, str) else df_schema)


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose function yields dicts of columns, cast to ``schema``; columns left out are null."""
    target = arrow_schema(schema)

    def column(cols, f, n):
        v = cols.get(f.name)
        if v is None:
            return pa.nulls(n, f.type)
        return v.cast(f.type) if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, type=f.type)

    def run(it):
        for cols in fn(it):
            n = len(next(iter(cols.values())))
            yield pa.RecordBatch.from_arrays([column(cols, f, n) for f in target], schema=target)

    return df.mapInArrow(run, schema)
