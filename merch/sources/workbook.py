"""Workbook sheets landed as CSV: schemas from labels, all-text scans, cleaning."""

from __future__ import annotations

import csv
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merch.functions.text import header_name, strip_thousands, trim_or_null
from merch.session import staged

# 0-based places of the columns that carry thousands separators, per feed.
NUMERIC_PLACES = {"inventory": (2, 3), "sales": (6, 7, 8, 9)}


def schema_from_labels(labels: list[str], renames: dict[str, str] | None = None) -> T.StructType:
    """All-text schema; the sheet label stays as the column comment."""
    return T.StructType(
        [T.StructField(header_name(x, renames), T.StringType(), True, {"comment": x}) for x in labels]
    )


def sheet_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every line of the files that is not blank, with its file and place in it; the one read of the sheets."""
    lines = spark.read.text(paths).where(F.trim("value") != "")
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("place"),
    )


def first_lines(lines: DataFrame) -> DataFrame:
    """(file, place, head): the header line of each file; a file without lines has none."""
    return lines.groupBy("file").agg(F.min("place").alias("first"), F.min_by("value", "place").alias("head"))


def labels_of(head: str) -> list[str]:
    """The labels of a header line; empty ones are named, and repeated ones told apart, by their place, as a CSV scan does."""
    labels = next(csv.reader([head]))
    times = Counter(x.lower() for x in labels)
    return [f"_c{i}" if not x else f"{x}{i}" if times[x.lower()] > 1 else x for i, x in enumerate(labels)]


def read_sheets(spark: SparkSession, paths: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """All sheets as one all-text table under normalised names.

    The lines are read once and staged with their file and place. The first line of a file names the cells of its others, which
    are cut by that header; different headers are united by name, and sheets without lines drop out. Without any header the
    result has no columns and no rows. The distinct headers, a handful, come to the driver; the files' own first places, one row
    a file, are joined to the lines by file.
    """
    if not paths:
        return spark.createDataFrame([], T.StructType([]))
    lines = staged(sheet_lines(spark, paths), "sheet-lines")
    heads = staged(first_lines(lines), "sheet-heads")
    distinct = [r["head"] for r in heads.select("head").distinct().orderBy("head").collect()]
    if not distinct:
        return spark.createDataFrame([], T.StructType([]))
    cells = lines.join(heads.withColumnRenamed("file", "of"), F.col("file") == F.col("of")).where(F.col("place") != F.col("first"))
    names: dict[str, list[Column]] = {}
    for head in distinct:
        schema = schema_from_labels(labels_of(head), renames)
        columns = ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema.fields)
        row = F.when(F.col("head") == head, F.from_csv("value", columns, {"escape": '"'}))  # a quote is written twice
        for field in schema.fields:
            names.setdefault(field.name, []).append(row[field.name])
    return cells.select(*[F.coalesce(*found).alias(name) for name, found in names.items()])


def clean_rows(df: DataFrame, numeric: list[str] | tuple[int, ...] = ()) -> DataFrame:
    """Trim every text column, blanks to NULL, and drop thousands separators in the ``numeric`` ones.

    ``numeric`` holds names or 0-based places, as in ``NUMERIC_PLACES``.
    """
    marked = {df.columns[c] if isinstance(c, int) else c for c in numeric}

    def clean(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return c
        return trim_or_null(strip_thousands(c) if field.name in marked else c).alias(field.name)

    return df.select(*[clean(f) for f in df.schema.fields])
