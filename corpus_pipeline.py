"""The corpus pipeline: quality, toxicity, near copies, source mix, packing.

Every stage is a function of (spark, docs, sf_dir) that works on all rows it gets; all but the last return the columns of
documents. ``run`` writes each stage's result as Parquet in the shared folder and reads it for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merch.llm import mixing, packing, quality, simhash, toxicity
from merch.llm.common import KEY, fresh, from_files, keyed, text_batches
from merch.llm.queries import table, vocabulary
from merch.session import staged

#: A learned score and a hash order have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def _joined(docs: DataFrame, keys: DataFrame, how: str, **more: str) -> DataFrame:
    """The columns of ``docs`` (rows of files) joined to ``keys`` by the row key; ``more`` renames columns of ``keys`` that come along.

    The key has names of its own here, so documents may have columns of any names.
    """
    place = {KEY[0]: F.xxhash64("_metadata.file_path"), KEY[1]: F.col("_metadata.row_index")}
    own = {name: fresh(docs, f"{name}_here") for name in KEY}
    there = {name: fresh(docs, f"{name}_there") for name in KEY}
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns], *[c.alias(own[name]) for name, c in place.items()])
    keys = keys.select(*[F.col(name).alias(there[name]) for name in KEY], *[F.col(c).alias(name) for c, name in more.items()])
    same = (F.col(own[KEY[0]]) == F.col(there[KEY[0]])) & (F.col(own[KEY[1]]) == F.col(there[KEY[1]]))
    return rows.join(keys, same, how).select(*[F.col(f"`{c}`") for c in docs.columns], *more.values())


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is above the threshold of their language go."""
    docs = from_files(docs)
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    rejected = staged(judged.where("NOT keep").select(*KEY), "rejected")
    return _joined(docs, rejected, "left_anti")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go."""
    docs = from_files(docs)
    model = staged(toxicity.train(docs, table(spark, sf_dir, "labels")), "toxicity")
    scored = toxicity.score_texts(keyed(docs, {"text": F.col("text")}), model, flag=None)
    with text_batches(spark):
        rejected = staged(scored.where("score >= 0.3").select(*KEY), "toxic")
    return _joined(docs, rejected, "left_anti")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    docs = from_files(docs)
    others = staged(simhash.near_copies(docs).where("NOT kept").select(*KEY), "others")
    return _joined(docs, others, "left_anti")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document comes as many times as the mix takes it."""
    docs = from_files(docs)
    copies = fresh(docs, "copies")
    taken = staged(mixing.mix(docs).where("copies > 0").select(*KEY, "copies"), "copies")
    repeated = _joined(docs, taken, "inner", copies=copies).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    found = packing.packed_sequences(docs, vocabulary())
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("SimHash near-dedup", near_copies),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
