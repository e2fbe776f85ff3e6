"""Small helpers of this subpackage: row keys, fresh column names, word streams."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merch.session import staged

FILE, ROW = "_key_file", "_key_row"
KEY = [FILE, ROW]

#: Bytes that separate words for the whitespace rule are those of bytes.split(): space and \t \n \v \f \r.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _one_row_each(df: DataFrame) -> bool:
    """Whether every row of ``df`` is one row of a file: the plan holds only projections, filters and the file scan itself."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation" or not hasattr(plan.relation(), "location"):
        return False
    roots = plan.relation().location().rootPaths()
    paths = sorted(roots.apply(i).toString().rstrip("/") + "/" for i in range(roots.size()))
    if any(later.startswith(path) for path, later in zip(paths, paths[1:])):
        return False  # a file that is read twice
    df.select("_metadata.row_index")  # fails where the source has no places, or another column has the name
    return True


def from_files(df: DataFrame) -> DataFrame:
    """``df`` itself when each of its rows is a row of a file, else a staged copy, so that the place of a row names it.

    The place alone does not tell: Spark hands it on through generators, joins and unions, which repeat it.
    """
    try:
        return df if _one_row_each(df) else staged(df, "copy")
    except AnalysisException as error:
        if "_metadata" not in str(error):
            raise
    return staged(df, "copy")  # a source without places


def keyed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``columns`` of ``df`` with two longs that name each row and stay the same when the row is read again.

    The key is the place of the row in its Parquet file, so repeated rows and null ids stay apart and a lost
    executor changes nothing. A frame whose rows are not the rows of files, each once, is staged first.
    """
    place = [F.xxhash64("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW)]
    try:
        if _one_row_each(df):
            return df.select(*[c.alias(n) for n, c in columns.items()], *place)
    except AnalysisException as error:
        if "_metadata" not in str(error):
            raise
    copy = staged(df.select(*[c.alias(n) for n, c in columns.items()]), "keyed")
    return copy.select(*columns, *place)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return stem if stem not in taken else f"{stem}_{uuid.uuid4().hex}"


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def text_batches(spark: SparkSession, most: str = "8m") -> Iterator[None]:
    """What is staged inside sends Python batches of at most so many bytes, or of one row, however long the texts are."""
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, most)
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BYTES) if before is None else spark.conf.set(BATCH_BYTES, before)


#: Empty what operators keep in a Python worker between their tasks.
KEPT: list[Callable[[], None]] = []


def give_back(keep: Callable[[], None] | None = None) -> None:
    """Return freed memory to the system, as Python workers stay and go on to tasks of other stages.

    What other operators have kept in the worker goes first; an operator names its own with ``keep``.
    """
    for empty in KEPT:
        if empty != keep:
            empty()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library on Linux
    if trim:
        trim(0)


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 of the text with A-Z in lower case; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def vectors(column) -> tuple[np.ndarray, np.ndarray]:
    """A padded float64 matrix of a list column (pandas object series) and the mask of finite, non-null vectors.

    Shorter vectors are filled up with zeros, which changes no inner product.
    """
    width = max((len(v) for v in column if v is not None), default=0)
    out = np.zeros((len(column), max(width, 1)))
    good = np.zeros(len(column), dtype=bool)
    for i, v in enumerate(column):
        if v is None:
            continue
        row = np.array([np.nan if x is None else x for x in v] if getattr(v, "dtype", None) == object else v, dtype=float)
        good[i] = bool(np.isfinite(row).all())
        if good[i]:
            out[i, : len(row)] = row
    return out, good
