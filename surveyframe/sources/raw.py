"""Raw monthly microdata: CSV ingest, Parquet landing, and the synthetic fixture.

Real inputs are monthly CSV extracts with a header and many more columns than
the 21 the decode uses.  Columns are selected **by name** (a 21-field schema
would be applied by position to the wider file), blank text becomes NULL, and
every column is cast strictly: a malformed code is an error, not a NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import INCOME_DECIMAL, RAW_COLUMNS
from .files import first_lines

# Synthetic survey over the driver's ``lineitem`` (see FIXTURES.md §4).  Pure
# integer arithmetic, so the same text runs in Spark SQL and in DuckDB.
FIXTURE_SQL = """
WITH l0 AS (
  SELECT
    2020 AS Ano,
    5+2*((l_orderkey*5+l_linenumber)%3) AS V1013,
    l_extendedprice/100 AS V1032,
    CASE WHEN l_suppkey%28<7 THEN 11+l_suppkey%28 WHEN l_suppkey%28<16 THEN 14+l_suppkey%28 WHEN l_suppkey%28<19 THEN 15+l_suppkey%28 WHEN l_suppkey%28=19 THEN 35 WHEN l_suppkey%28<23 THEN 21+l_suppkey%28 WHEN l_suppkey%28<27 THEN 27+l_suppkey%28 ELSE 99 END AS UF,
    CASE WHEN (l_orderkey+l_partkey)%41=0 THEN NULL ELSE l_partkey%113 END AS A002,
    1+(l_partkey+l_suppkey)%2 AS A003,
    CASE (l_orderkey+l_partkey)%7 WHEN 5 THEN 9 WHEN 6 THEN NULL ELSE 1+(l_orderkey+l_partkey)%7 END AS A004,
    1+(l_partkey+l_linenumber)%8 AS A005,
    CASE (l_orderkey*3+l_partkey*7+l_linenumber)%20 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 9 WHEN 3 THEN NULL WHEN 4 THEN 7 ELSE 2 END AS B0011,
    CASE (l_orderkey*7+l_partkey*3+l_linenumber)%20 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 9 WHEN 3 THEN NULL WHEN 4 THEN 7 ELSE 2 END AS B0012,
    CASE (l_orderkey*9+l_partkey*11+l_linenumber)%20 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 9 WHEN 3 THEN NULL WHEN 4 THEN 7 ELSE 2 END AS B0014,
    CASE (l_orderkey*11+l_partkey*13+l_linenumber)%20 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 9 WHEN 3 THEN NULL WHEN 4 THEN 7 ELSE 2 END AS B00111,
    CASE (l_orderkey+3*l_suppkey)%9 WHEN 0 THEN 9 WHEN 1 THEN NULL ELSE 1+(l_orderkey+3*l_suppkey)%2 END AS B007,
    CASE (l_orderkey+l_linenumber)%11 WHEN 0 THEN 9 ELSE 1+(l_orderkey+l_linenumber)%2 END AS D0051,
    l_quantity AS q,
    (l_orderkey*17+l_partkey*29+l_suppkey*7+CAST(l_quantity AS BIGINT)*3)%101 AS m
  FROM {lineitem}
), l1 AS (
  SELECT *,
    CASE WHEN B0011=1 OR B0012=1 OR B0014=1 OR B00111=1 THEN CASE WHEN m<30 THEN 1 WHEN m<95 THEN 2 ELSE 9 END ELSE NULL END AS B002,
    CASE WHEN A002>=14 THEN CASE WHEN m%2=0 THEN 1 ELSE 2 END ELSE NULL END AS C001
  FROM l0
)
SELECT *,
    CASE WHEN B002=1 THEN CASE WHEN m%10<2 THEN 1 WHEN m%10<8 THEN 2 WHEN m%10=8 THEN 3 ELSE 9 END ELSE NULL END AS B005,
    CASE WHEN C001=2 THEN CASE WHEN m%4=1 THEN 1 ELSE 2 END ELSE NULL END AS C002,
    CASE WHEN C001=1 THEN 1+m%9 ELSE NULL END AS C007,
    CASE WHEN C001=1 AND m%7<>0 THEN m%11 ELSE NULL END AS C01011,
    CASE WHEN C001=1 AND m%7<>0 THEN CAST(q*500 AS DECIMAL(38,9)) ELSE NULL END AS C01012
FROM l1
"""


def fixture_sql(lineitem: str = "lineitem") -> str:
    """The fixture text with the lineitem relation name filled in."""
    return FIXTURE_SQL.replace("{lineitem}", lineitem)


def _typed(df: DataFrame) -> DataFrame:
    """Keep exactly the 21 raw columns, in order, with their declared types."""
    return df.select([F.col(n).cast(t).alias(n) for n, t in RAW_COLUMNS])


LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]


def raw_from_lineitem(spark: SparkSession, lineitem: DataFrame) -> DataFrame:
    """The synthetic raw survey (all months in one frame) derived from lineitem."""
    return _typed(spark.sql(FIXTURE_SQL, lineitem=lineitem.select(LINEITEM_COLUMNS)))


def raw_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return raw_from_lineitem(spark, lineitem)


def split_months(raw: DataFrame, months=(5, 7, 9)) -> list[DataFrame]:
    """Emulate one raw table per month from a stacked raw frame."""
    return [raw.where(F.col("V1013") == m) for m in months]


# ---------------------------------------------------------------- CSV ingest

def strict_text(c: Column, t: T.DataType, name: str) -> Column:
    """Text -> declared type; blank -> NULL; bad text raises (ANSI casts)."""
    s = F.nullif(F.trim(c), F.lit(""))
    if isinstance(t, T.LongType):
        # Codes may be written '1' or '1.0'; a fractional code is an error.
        d = s.cast(T.DecimalType(38, 9))
        return (F.when(d.isNull(), F.lit(None).cast(T.LongType()))
                .when(d != F.floor(d), F.raise_error(F.concat(F.lit(f"non-integral code in {name}: "), s)))
                .otherwise(d.cast(T.LongType())))
    if isinstance(t, T.DecimalType):
        return s.cast(INCOME_DECIMAL)
    return s.cast(t)


def csv_files(spark: SparkSession, paths: list[str] | str) -> list[str]:
    """The files behind paths, folders and globs, listed by Spark (any file system), in order."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).inputFiles()
    return sorted(f for f in found if not f.rsplit("/", 1)[-1].startswith(("_", ".")))


def read_raw_csv(spark: SparkSession, paths: list[str] | str, sep: str = ",",
                 encoding: str = "UTF-8") -> DataFrame:
    """Read monthly CSV extracts (header row, any extra columns) as typed raw rows.

    Every file is read by its own header - extracts differ in their columns and
    order, and Spark would apply the first header to all of them by position.
    The first lines of all files are looked at first, without a Spark job; files with
    the same one are read together, so that the number of jobs follows the number of
    different headers. A header is one line; a file without any line has no rows.
    """
    reader = (spark.read.option("sep", sep).option("encoding", encoding).option("inferSchema", False))
    files = csv_files(spark, paths)
    by_header: dict[str, list[str]] = {}
    for f, line in zip(files, first_lines(spark, files, encoding)):
        if line is not None:
            by_header.setdefault(line, []).append(f)
    if not by_header:
        raise ValueError(f"no CSV file under {paths}")
    frames = []
    for same in by_header.values():
        df = reader.option("header", True).csv(same)
        missing = [n for n, _ in RAW_COLUMNS if n not in df.columns]
        if missing:
            raise ValueError(f"raw extract {same[0]} lacks columns {missing}")
        frames.append(df)
    return stack([df.select([strict_text(F.col(n), t, n).alias(n) for n, t in RAW_COLUMNS]) for df in frames])


def land_raw(raw: DataFrame, path: str) -> None:
    """Land typed raw rows as Parquet, one partition per year and month.

    Dynamic partition overwrite replaces only the months present in ``raw``,
    so re-ingesting one extract never touches the others.
    """
    (raw.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("Ano", "V1013").parquet(path))


def read_landed_raw(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark.read.parquet(path))


def stack(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of N frames by column name (not position)."""
    if not frames:
        raise ValueError("nothing to stack")
    return reduce(lambda a, b: a.unionByName(b), frames)
