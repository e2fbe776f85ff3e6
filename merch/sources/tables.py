"""Writing and maintaining tables kept as parquet folders."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merch.session import staged


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Empty the table and load it; also replaces a table of another shape."""
    df.write.mode("overwrite").parquet(path)


def rewrite(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace a table by a function of itself.

    The new rows are staged in the shared folder first, because Spark must not
    overwrite what it is still reading, and a failed load leaves them there.
    """
    overwrite(staged(change(spark.read.parquet(path)), "rewrite"), path)


def touched_partitions(rows: DataFrame, by: list[str], predicate: Column) -> list[tuple]:
    """The partitions that hold a row for which the predicate is true, one row each.

    The scan is pushed the predicate, so partitions and row groups whose folder name or least and largest values rule it out are
    not read, and of the others only the columns of the predicate.
    """
    return [tuple(r) for r in rows.where(predicate).select(*by).distinct().collect()]


def rewrite_touched(
    spark: SparkSession, path: str, by: list[str], predicate: Column, change: Callable[[DataFrame], DataFrame]
) -> list[tuple]:
    """Replace the partitions that the predicate touches by a function of their rows, and return them.

    All other folders keep their files. ``change`` may drop rows but must not move them to another partition. The new rows are
    staged first; they then replace their folders one by one, so a failed load can be repeated from them. A partition that loses
    all its rows stays as a folder with an empty file.
    """
    rows = spark.read.parquet(path)
    touched = touched_partitions(rows, by, predicate)
    if not touched:
        return []
    values = [F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(by, key)]) for key in touched]
    same = F.lit(False)
    for value in values:
        same = same | F.struct(*by).eqNullSafe(value)
    old = rows.where(same)
    new = staged(change(old), "touched")
    left = {tuple(r) for r in new.select(*by).distinct().collect()}
    if left - set(touched):
        raise ValueError(f"rows would move to other partitions: {sorted(left - set(touched), key=str)[:3]}")
    emptied = [key for key in touched if key not in left]
    gone = {}
    if emptied:  # the folder's own name, whatever characters its value has
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
        gone = {tuple(r[c] for c in by): r["folder"] for r in old.groupBy(*by).agg(F.min(folder).alias("folder")).collect()}
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    for key in emptied:
        new.limit(0).drop(*by).write.mode("overwrite").parquet(unquote(gone[key]))
    return touched


def replace_days(df: DataFrame, path: str, day: str = "d_date") -> None:
    """Replace exactly the day partitions present in ``df``; a rerun leaves the same rows."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def replace_day(df: DataFrame, path: str, value: str, day: str = "d_date") -> None:
    """Replace one day, also when the new load has no rows for it."""
    rows = df.where(F.col(day) == F.lit(value).cast("date")).drop(day)
    rows.write.mode("overwrite").parquet(f"{path}/{day}={value}")


def replace_day_versions(df: DataFrame, path: str, day: str = "d_date", version: str = "load") -> None:
    """Store the rows of each (day, version) in a folder of its own, replacing that folder alone.

    Of several versions of a day in ``df`` only the highest is stored. Loads may run again and in any order.
    """
    newest = df.groupBy(day).agg(F.max(version).alias(version))
    rows = df.join(newest, [day, version], "left_semi")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day, version).parquet(path)


def latest_days(rows: DataFrame, day: str = "d_date", version: str = "load") -> DataFrame:
    """The rows of the highest version of each day; older versions are folders that are not read.

    One row a day comes to the driver to name the folders, from the folders' own names.
    """
    newest = rows.groupBy(day).agg(F.max(version).alias(version)).select(F.concat_ws("/", day, version)).collect()
    return rows.where(F.concat_ws("/", day, version).isin([r[0] for r in newest])).drop(version)


def drop_range(df: DataFrame, column: str, begin: str, end: str) -> DataFrame:
    """Rows outside a closed date range; rows without a date stay."""
    inside = F.col(column).between(F.lit(begin).cast("date"), F.lit(end).cast("date"))
    return delete_where(df, inside)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true (false or unknown)."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def update_where(df: DataFrame, predicate: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns where the predicate is true."""
    return df.withColumns({c: F.when(predicate, v).otherwise(F.col(c)) for c, v in values.items()})


def split_failed(df: DataFrame, failed: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters)."""
    bad = F.coalesce(failed, F.lit(True))
    return df.where(~bad), df.where(bad)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def page_rows(df: DataFrame, order: list[Column], page: int, size: int = 300) -> DataFrame:
    """Page ``page`` (from 1) of ``size`` rows in a total order; for the first pages, whose rows alone leave the tasks.

    Pages far behind come from ``page_slices`` and ``read_page``.
    """
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


SLICE = "_slice"


def page_slices(df: DataFrame, order: list[Column], slices: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows in folders of consecutive ranges of a total order, and their directory (slice, rows, rows_before).

    The order is computed once, in parallel; the directory has one row a slice.
    """
    cut = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    rows = staged(cut.withColumn(SLICE, F.spark_partition_id()), "slices", [SLICE])
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(SLICE).agg(F.count(F.lit(1)).alias("rows"))
    return rows, staged(sizes.withColumn("rows_before", F.coalesce(F.sum("rows").over(before), F.lit(0))), "directory")


def read_page(rows: DataFrame, directory: DataFrame, order: list[Column], page: int, size: int = 300) -> DataFrame:
    """Page ``page`` (from 1): the slices that overlap it are looked up, and only their folders are read and sorted."""
    first = (page - 1) * size
    hit = directory.where((F.col("rows_before") < first + size) & (F.col("rows_before") + F.col("rows") > first)).collect()
    if not hit:
        return rows.drop(SLICE).limit(0)
    skipped = first - min(r["rows_before"] for r in hit)
    return rows.where(F.col(SLICE).isin([r[SLICE] for r in hit])).drop(SLICE).orderBy(*order).offset(skipped).limit(size)


def first_match(df: DataFrame, column: str, text: str, position: str, value: str) -> DataFrame:
    """One row: ``value`` of the first entry, by position, whose column contains the text."""
    return df.where(F.contains(F.col(column), F.lit(text))).agg(F.min_by(value, position).alias(value))
