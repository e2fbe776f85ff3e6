"""Session defaults and staged tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Measuring a batch for Python after every row costs more than sending rows of a few numbers; batches are cut by their rows as well.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int = 8, name: str = "merch", memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        # Small tables still use every core after a shuffle.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    SparkContext._ensure_initialized()  # so that the installation's own settings are known
    if not SparkConf().get("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
    return builder.getOrCreate()


def stage_root(spark: SparkSession) -> str:
    """The shared folder for staged tables, from ``spark.checkpoint.dir``; without it other machines could not read them."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir, when the session is built, to a folder every executor can reach")
    return root


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the stage root; nothing is ever overwritten."""
    return f"{stage_root(spark)}/merch/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out to all cores when the source has fewer splits than that.

    For work that is heavy per row. Large tables have enough splits already and
    pass through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def staged(df: DataFrame, label: str, by: list[str] | None = None, narrow: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several branches: the branches then see the same
    rows, the facts behind it are scanned once, and a lost executor costs a
    re-read instead of the whole lineage. Parquet keeps pruning and real sizes.
    ``narrow`` rows, of a few numbers each, go to Python in batches that are cut by their rows alone.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    writer = df.write.mode("errorifexists")
    if by:
        writer = writer.partitionBy(*by)
    # once the table is written nothing reads the shuffle files behind it
    wanted = {CLEANUP: "true", **({BATCH_BYTES: str(2**31 - 1)} if narrow else {})}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        writer.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)
