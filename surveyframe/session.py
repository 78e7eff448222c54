"""Session helper: defaults for tests and bench that never override a launcher."""

from __future__ import annotations

import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # No broadcast by size estimate: every broadcast in this library is an
    # explicit hint on a side whose row count is proven (literal code tables,
    # order lists, per-bin or per-category results, checked stored tables).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # A wide decode stage (16 probes + derived columns) generates a loop method
    # above HotSpot's 8000-byte JIT limit; let the JIT compile it anyway.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_spark(master: str | None = None, app: str = "surveyframe",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults this library expects.

    On a cluster, pass ``master=None`` so the launcher's master and configs win:
    the defaults only fill in what the launcher (spark-submit, spark-defaults) left
    unset; ``shuffle_partitions`` and ``extra`` are the caller's own wishes and are set.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in launcher_unset(DEFAULT_CONF).items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def launcher_unset(conf: dict[str, str]) -> dict[str, str]:
    """The entries of ``conf`` that neither a running context nor the launcher has set."""
    running = SparkContext._active_spark_context
    launched = running.getConf() if running else SparkConf()
    return {k: v for k, v in conf.items() if not launched.contains(k)}


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the session's ``spark.checkpoint.dir``; only a local session without that setting gets a scratch folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir is not set; a cluster needs a shared folder")
            folder = tempfile.mkdtemp(prefix="surveyframe-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there from now on."""
    scratch_folder(df.sparkSession)
    return df.checkpoint()
