"""The stored analytic table: partitioned sink, full scan, dashboard scan, cache."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.filters import survey_filter
from ..schema import CONSOLIDATED_COLUMNS, DASHBOARD_COLUMNS, MONTH_COLUMN
from .files import delete_folder, names_in, publish_text, read_text


CLUSTER_BY = ("uf_desc", "sexo_desc")


#: Published versions that stay readable when a new one is written (readers of the one before may be running).
KEEP_VERSIONS = 2


def write_consolidated(df: DataFrame, path: str, max_records_per_file: int = 5_000_000,
                       cluster_by: tuple[str, ...] = CLUSTER_BY) -> None:
    """CREATE OR REPLACE as a month-partitioned Parquet table, all or nothing.

    The rows are written beside the version in force; a new version file, which one rename makes
    visible when all of them are there, names the folders to read. Readers (``read_consolidated``,
    ``dashboard_scan``) see the old table or the new one, and a write that fails or is killed
    leaves the old one as it was. Of two writes at once, one fails and changes nothing.

    A partitioned write needs no shuffle: each task writes the months it
    holds; ``maxRecordsPerFile`` bounds file size at scale.  Each task sorts
    its rows by month (which the partitioned writer needs anyway) and then by
    the dashboard's filter columns, so every row group covers a narrow range of
    UF/sex values and the pushed-down filters skip most row groups.
    """
    _publish(df, path, max_records_per_file, cluster_by, lambda old, new: new)


def replace_months(df: DataFrame, path: str, months: list[str] | None = None, max_records_per_file: int = 5_000_000,
                   cluster_by: tuple[str, ...] = CLUSTER_BY) -> None:
    """Put ``df`` in place of the months it holds, all or nothing; files of other months are not touched.

    ``months``: first days ('2020-07-01') that are replaced, also by nothing where ``df`` has no rows of them;
    ``df`` may hold no others. A table that does not exist yet starts with ``df``.
    """
    def merged(old: dict[str, str], new: dict[str, str]) -> dict[str, str]:
        if months is not None and set(new) - set(months):
            raise ValueError(f"rows of other months: {sorted(set(new) - set(months))}")
        gone = set(new) if months is None else set(months)
        return {**{m: d for m, d in old.items() if m not in gone}, **new}

    _publish(df, path, max_records_per_file, cluster_by, merged)


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names_in(spark, f"{path}/_versions") if n.endswith(".json") and n[0] != ".")


def _version(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(read_text(spark, f"{path}/_versions/{number:010d}.json"))


def _months_in(spark: SparkSession, folder: str) -> list[str]:
    return [n.split("=", 1)[1] for n in names_in(spark, folder) if n.startswith(f"{MONTH_COLUMN}=")]


def _in_force(spark: SparkSession, path: str) -> dict | None:
    """{"schema", "months": {month: folder below the table}} of the newest version; None without a table.

    A finished Parquet folder without versions is a table whose months all lie in its root, ``""``.
    """
    numbers = _versions(spark, path)
    if numbers:
        return _version(spark, path, numbers[-1])
    if "_SUCCESS" not in names_in(spark, path):
        return None
    months = _months_in(spark, path)
    return {"schema": spark.read.parquet(path).schema.jsonValue() if months else None, "months": {m: "" for m in months}}


def _publish(df: DataFrame, path: str, max_records_per_file: int, cluster_by: tuple[str, ...],
             months_of: Callable[[dict[str, str], dict[str, str]], dict[str, str]]) -> None:
    spark, path = df.sparkSession, path.rstrip("/")
    numbers = _versions(spark, path)
    number = numbers[-1] + 1 if numbers else 1
    old = _in_force(spark, path) or {"months": {}}
    columns = [c for c in df.columns if c != MONTH_COLUMN] + [MONTH_COLUMN]
    schema = T.StructType([df.schema[c] for c in columns])
    # the first write of a new table takes its root, every other one a folder of its own
    part = "" if not names_in(spark, path) and publish_text(spark, f"{path}/_root", "") else f"_data/{number}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/{part}".rstrip("/")
    keys = [MONTH_COLUMN] + [c for c in cluster_by if c in columns]
    try:
        (df.select(columns).sortWithinPartitions(*keys).write.mode("append")
           .option("maxRecordsPerFile", max_records_per_file).partitionBy(MONTH_COLUMN).parquet(folder))
        months = months_of(old["months"], {m: part for m in _months_in(spark, folder)})
        if set(months.values()) - {part} and T.StructType.fromJson(old["schema"]).simpleString() != schema.simpleString():
            raise ValueError("months can only be replaced by rows with the table's own columns")
        text = json.dumps({"schema": schema.jsonValue(), "months": months}, ensure_ascii=False)
        if not publish_text(spark, f"{path}/_versions/{number:010d}.json", text):
            raise RuntimeError(f"another write published version {number} of {path} first; nothing was changed")
    except BaseException:
        _delete_data(spark, path, part)
        raise
    _drop_old(spark, path)


def _delete_data(spark: SparkSession, path: str, part: str) -> None:
    if part:
        delete_folder(spark, f"{path}/{part}")
    else:
        for n in ["_SUCCESS", *[f"{MONTH_COLUMN}={m}" for m in _months_in(spark, path)]]:
            delete_folder(spark, f"{path}/{n}")


def _drop_old(spark: SparkSession, path: str) -> None:
    """Delete versions beyond KEEP_VERSIONS, and data that only they used. Folders of writes still running stay."""
    numbers = _versions(spark, path)
    gone, kept = numbers[:-KEEP_VERSIONS], numbers[-KEEP_VERSIONS:]
    used = {d for n in kept for d in _version(spark, path, n)["months"].values()}
    for n in gone:
        for part in set(_version(spark, path, n)["months"].values()) - used:
            _delete_data(spark, path, part)
        delete_folder(spark, f"{path}/_versions/{n:010d}.json")


def stored_months(spark: SparkSession, path: str) -> list[str]:
    """The months of the table in force, from its version file alone."""
    return sorted((_in_force(spark, path.rstrip("/")) or {"months": {}})["months"])


def read_consolidated(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of the version in force, columns in canonical order.

    A scan per write that is in force (one, but for replaced months) over the folders of its months, with month
    filters as ``PartitionFilters``. The schema comes from the version file; no Parquet file is opened to infer it.
    """
    path = path.rstrip("/")
    version = _in_force(spark, path)
    if version is None:
        raise FileNotFoundError(f"no finished table at {path}")
    schema = T.StructType.fromJson(version["schema"]) if version["schema"] else None
    if not version["months"]:
        return spark.createDataFrame([], schema).select(CONSOLIDATED_COLUMNS)
    scans = []
    for part in sorted(set(version["months"].values())):
        base = f"{path}/{part}".rstrip("/")
        months = sorted(m for m, p in version["months"].items() if p == part)
        scans.append(spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{MONTH_COLUMN}={m}" for m in months]))
    return reduce(DataFrame.unionByName, scans).select(CONSOLIDATED_COLUMNS)


def dashboard_scan(spark: SparkSession, path: str, uf: str | None = None, sexo: str | None = None,
                   mes: str | None = None) -> DataFrame:
    """The dashboard's 14-column read with optional filters.

    Column pruning gives ``ReadSchema`` with the 13 stored columns, the month
    filter becomes ``PartitionFilters`` (whole months skipped), UF and sex
    become ``PushedFilters`` (row groups skipped by their statistics).
    """
    return survey_filter(read_consolidated(spark, path).select(DASHBOARD_COLUMNS), uf=uf, sexo=sexo, mes=mes)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep ``df`` materialised while several analyses run on it, then release it.

    Cached blocks lost with an executor are recomputed from lineage.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
