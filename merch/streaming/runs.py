"""Bounded runs of a stream: what has landed is read in batches of a few files, and a run goes on where the last one stopped.

A run belongs to its checkpoint folder. A later run with the same folder starts behind the last committed batch, with the state
and the watermark of that batch; a batch that was not committed is run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from merch.session import stage_path

BATCH = "_batch"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files: int | None = None) -> DataFrame:
    """The Parquet files that land in ``path``, at most ``files`` of them in a batch, oldest first."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def finish(spark: SparkSession, writer: DataStreamWriter, checkpoint: str | None = None) -> list:
    """Run over all that is there now, batch by batch, and return the progress of every batch."""
    query = writer.option("checkpointLocation", checkpoint or stage_path(spark, "progress")).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.recentProgress


def drain(stream: DataFrame, path: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Append the results to ``path`` and read them back."""
    spark = stream.sparkSession
    finish(spark, stream.writeStream.format("parquet").outputMode(mode).option("path", path), checkpoint)
    return spark.read.schema(stream.schema).parquet(path)


def drain_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str | None = None, mode: str = "append") -> list:
    return finish(stream.sparkSession, stream.writeStream.foreachBatch(handle).outputMode(mode), checkpoint)


def _put(path: str) -> Callable[[DataFrame, int], None]:
    """A batch is a folder of its own and is overwritten when it runs again."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return put


def _batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(path)


def drain_updates(stream: DataFrame, path: str, keys: list[str], checkpoint: str | None = None) -> DataFrame:
    """Read back the last state of each key, also of keys that are not final yet."""
    drain_batches(stream, _put(path), checkpoint, "update")
    values = [c for c in stream.columns if c not in keys]
    rows = _batches(stream.sparkSession, path, stream.schema)
    return rows.groupBy(*keys).agg(*[F.max_by(c, BATCH).alias(c) for c in values]).select(*stream.columns)


def drain_new(stream: DataFrame, path: str, keys: list[str], checkpoint: str | None = None) -> DataFrame:
    """Keep of every batch the keys that no earlier batch has, and read them all back.

    What is stored takes the place of state without end: a key that comes again when the watermark has long dropped it is found
    in ``path``. A batch that is run again compares with the batches before it only.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{path}/{BATCH}=-1")

    def put(batch: DataFrame, number: int) -> None:
        before = _batches(batch.sparkSession, path, stream.schema).where(F.col(BATCH) < number).select(*keys)
        _put(path)(batch.dropDuplicates(keys).join(before, keys, "left_anti").select(*stream.columns), number)

    drain_batches(stream, put, checkpoint)
    return _batches(spark, path, stream.schema).drop(BATCH)
