"""Domain (code) tables and size-checked broadcasting.

The code tables are declared tables: a NOT NULL code with a described label.
They are written with overwrite (never appended), and their codes are checked
unique so that every decode join keeps the row count.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DIM_ROWS, DIMS, DimSpec

# A code table larger than this is not a code table; never broadcast it blindly.
MAX_DIM_ROWS = 10_000


def dim_schema(spec: DimSpec) -> T.StructType:
    return T.StructType([
        T.StructField(spec.code_col, spec.code_type, nullable=False,
                      metadata={"comment": spec.code_comment}),
        T.StructField(spec.desc_col, T.StringType(), nullable=True,
                      metadata={"comment": spec.desc_comment}),
    ])


def _check_unique(name: str, rows: list[tuple]) -> None:
    codes = [r[0] for r in rows]
    if any(c is None for c in codes):
        raise ValueError(f"dim {name}: NULL code")
    if len(set(codes)) != len(codes):
        raise ValueError(f"dim {name}: duplicate codes would fan out the decode joins")


def inline_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Literal rows as a JVM-side table (``VALUES``-like), no Python RDD behind it."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    # literal codes are non-null, so the declared NOT NULL holds by construction
    df = spark.range(1).select(F.inline(F.array(*structs)))
    return df.select([F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema.fields])


def dim_frame(spark: SparkSession, name: str, rows: list[tuple] | None = None) -> DataFrame:
    """One code table as a DataFrame (inline literal rows, declared schema)."""
    spec = DIMS[name]
    rows = DIM_ROWS[name] if rows is None else rows
    _check_unique(name, rows)
    return inline_table(spark, rows, dim_schema(spec))


class DimTables(Mapping):
    """The code tables of one session, built on first use and then reused."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = dim_frame(self._spark, name)
        return self._built[name]

    def __iter__(self):
        return iter(DIMS)

    def __len__(self) -> int:
        return len(DIMS)


def all_dims(spark: SparkSession) -> DimTables:
    """Code tables keyed by name; lazily built, cached on the session object."""
    cache = getattr(spark, "_surveyframe_dims", None)
    if cache is None:
        cache = DimTables(spark)
        spark._surveyframe_dims = cache
    return cache


def write_dims(spark: SparkSession, base_path: str) -> dict[str, str]:
    """Write every code table with overwrite, so a re-run never doubles it."""
    out = {}
    for name in DIMS:
        df = dim_frame(spark, name)
        path = f"{base_path.rstrip('/')}/dim_{name}"
        df.coalesce(1).write.mode("overwrite").parquet(path)
        out[name] = path
    return out


def read_dim(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a stored code table and re-check it (unique codes, bounded size)."""
    spec = DIMS[name]
    df = spark.read.schema(dim_schema(spec)).parquet(path)
    dup = (df.groupBy(spec.code_col).count().where("count > 1").limit(1).count())
    if dup:
        raise ValueError(f"dim {name}: duplicate codes in {path}")
    return df


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_DIM_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its row count is proven to be <= ``max_rows``.

    For inline tables the count is known on the driver; otherwise a bounded
    ``limit(max_rows + 1).count()`` proves it. Larger inputs are returned
    unhinted, so the planner shuffles (sort-merge or AQE's choice) instead.
    """
    n = known_rows if known_rows is not None else df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def code_table(df: DataFrame, known_rows: int | None = None, max_rows: int = MAX_DIM_ROWS) -> DataFrame:
    """``df`` for a broadcast join; a code table of more than ``max_rows`` rows is a data fault."""
    n = known_rows if known_rows is not None else df.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"a code table may have at most {max_rows} rows")
    return F.broadcast(df)


@lru_cache(maxsize=None)
def dim_sizes() -> dict[str, int]:
    return {k: len(v) for k, v in DIM_ROWS.items()}
