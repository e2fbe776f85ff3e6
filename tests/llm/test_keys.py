"""Row keys name rows, also of frames that repeat the rows of a file."""

import pytest
from pyspark.sql import functions as F

from merch.llm import decontaminate, mixing, packing, simhash
from merch.llm.common import KEY, from_files, keyed
from merch.llm.queries import table, vocabulary

SF = "/root/testdata/sf0.001"


def shapes(spark):
    docs = table(spark, SF, "documents")
    twice = F.explode(F.array(F.lit(1), F.lit(2)))
    return {
        "plain": docs.where("doc_id > 3").withColumn("more", F.lit(1)),
        "exploded": docs.withColumn("more", twice),
        "joined": docs.join(docs.select("lang", F.col("doc_id").alias("other")).where("other < 9"), "lang"),
        "union": docs.union(docs),
        "path twice": spark.read.parquet(f"{SF}/documents.parquet", f"{SF}/documents.parquet"),
    }


@pytest.mark.parametrize("shape", ["plain", "exploded", "joined", "union", "path twice"])
def test_keys_are_unique(spark, shape):
    frame = shapes(spark)[shape]
    rows = keyed(frame, {"doc_id": F.col("doc_id")})
    assert rows.count() == frame.count() == rows.select(*KEY).distinct().count()
    again = from_files(frame)
    assert again.columns == frame.columns and (again is frame) == (shape == "plain")
    assert again.select("_metadata.file_path", "_metadata.row_index").distinct().count() == frame.count()


def test_operators_on_exploded_rows(spark):
    """Every row comes out once."""
    docs = shapes(spark)["exploded"].select("doc_id", "text", "lang", "source")
    n = docs.count()
    assert mixing.mix(docs).count() == n
    assert simhash.near_copies(docs).count() == n
    assert packing.packed_sequences(docs, vocabulary()).where("piece = 0").count() == n
    assert decontaminate.contamination(docs, table(spark, SF, "benchmark")).count() == n
