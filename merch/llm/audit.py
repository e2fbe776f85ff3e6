"""Interaction audit of text filters, with a counting-Bloom prepass for repeated texts.

``filter_masks`` gives every document one bit per filter it fails: A under 200 words, B fewer than half of the words distinct,
C over 3 % capitals, D special characters, E the text of a document with a smaller id. Only E looks at other documents:

1. every task counts the hashes of its texts in small sections of saturating counters; the sections are merged, one at a time,
   and what stays of a section is the bit map of counters at two or more;
2. in the pass that computes A to D, a text with a counter below two is cleared as unique for certain; the bit maps have at most
   ``MAX_COUNTERS`` bits (32 MB), so they may be broadcast; beyond some 2^25 documents more texts pass as possible repeats, which
   costs time and changes no result;
3. only possible repeats are shuffled, grouped by their full text for the smallest id, and compared with it.

``audit`` joins the masks with the labels, adds them up by part and mask, and unfolds the counts into every order of the filters.

Defined cases: a null text is empty; a null part is the empty string; a null id never fails E and is nobody's smaller id; rows
that share the smallest id of a text do not fail E; a document is good (toxic) if any of its label rows says 1; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merch.llm.common import from_files, text_batches, text_or_empty
from merch.session import staged

FILTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = b"#$%&*|"

SECTION = 1 << 16
MAX_COUNTERS = 1 << 28
COUNTERS_EACH = 16
PROBES = 3


def failures(text: str) -> int:
    """The bits of A to D for one text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    found = BIT["A"] if len(words) < 200 else 0
    if 100 * len(set(words)) < 50 * len(words):
        found |= BIT["B"]
    if 100 * (len(data) - len(data.translate(None, CAPITALS))) > 3 * len(text):
        found |= BIT["C"]
    if len(data.translate(None, MARKS)) < len(data):
        found |= BIT["D"]
    return found


def _sections(documents: int) -> int:
    """A power of two, so that a text has some 16 counters, within the bound."""
    wanted = min(max(documents, 1) * COUNTERS_EACH, MAX_COUNTERS)
    return 1 << max(0, (wanted - 1) // SECTION).bit_length() if wanted > SECTION else 1


def _places(h: Column) -> list[Column]:
    """The counters of a hash inside its section; the odd step keeps them apart."""
    step = F.shiftrightunsigned(h, 16).bitwiseAND(F.lit(SECTION - 1)).bitwiseOR(F.lit(1))
    return [(h + F.lit(i) * step).bitwiseAND(F.lit(SECTION - 1)) for i in range(PROBES)]


def _section(h: Column, sections: int) -> Column:
    return F.shiftrightunsigned(h, 48).bitwiseAND(F.lit(sections - 1)).cast("int")


def repeat_sketch(hashes: DataFrame, sections: int) -> DataFrame:
    """(section, twice): per section the bit map, as longs, of counters that two or more rows of ``hashes`` (h long) share."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(h):
                continue
            section = (h >> np.uint64(48)) & np.uint64(sections - 1)
            step = ((h >> np.uint64(16)) & np.uint64(SECTION - 1)) | np.uint64(1)
            place = [(h + np.uint64(i) * step) & np.uint64(SECTION - 1) for i in range(PROBES)]
            met, times = np.unique(np.concatenate([section * np.uint64(SECTION) + p for p in place]), return_counts=True)
            owner = (met // np.uint64(SECTION)).astype(np.int64)
            ids, starts = np.unique(owner, return_index=True)
            low, twice = (met % np.uint64(SECTION)).astype(np.uint16), times > 1
            ends = np.append(starts[1:], len(met))
            yield pa.record_batch(
                {
                    "section": pa.array(ids, pa.int32()),
                    "once": pa.array([low[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    "again": pa.array([low[a:b][twice[a:b]].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                }
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by section; one section's counters are held at a time."""
        now, counters = None, np.zeros(SECTION, dtype=np.uint8)

        def close():
            bits = np.packbits(counters >= 2, bitorder="little").view(np.int64)
            return pa.record_batch({"section": pa.array([now], pa.int32()), "twice": pa.array([bits], pa.list_(pa.int64()))})

        for batch in batches:
            for section, once, again in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if section != now:
                    if now is not None:
                        yield close()
                    now = section
                    counters[:] = 0
                for part in (once, again):  # the places of a part are distinct
                    at = np.frombuffer(part, dtype=np.uint16)
                    counters[at] = np.minimum(counters[at] + 1, 2)
        if now is not None:
            yield close()

    parts = hashes.mapInArrow(count, "section int, once binary, again binary")
    dealt = parts.repartition("section").sortWithinPartitions("section")
    return dealt.mapInArrow(merge, "section int, twice array<bigint>")


def filter_masks(docs: DataFrame, *, part: str = "lang") -> DataFrame:
    """(doc_id, part, mask) of every row; ``mask`` has bit i for the i-th of ``FILTERS``."""
    spark = docs.sparkSession
    docs = from_files(docs)
    sections = _sections(docs.count())
    h = F.xxhash64(text_or_empty())
    sketch = staged(repeat_sketch(docs.select(h.alias("h")), sections), "repeats")

    @F.pandas_udf("int")
    def own(texts: pd.Series) -> pd.Series:
        return pd.Series([failures(t) for t in texts], dtype="int32")

    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_or_empty().alias("text"), h.alias("h"))
    rows = rows.withColumn("section", _section(F.col("h"), sections))
    bits = [F.getbit(F.col("twice")[F.shiftright(p, 6).cast("int")], p.bitwiseAND(F.lit(63)).cast("int")) == 1 for p in _places(F.col("h"))]
    probed = rows.join(F.broadcast(sketch), "section", "left")  # at most MAX_COUNTERS bits
    possible = F.coalesce(bits[0] & bits[1] & bits[2], F.lit(False))
    narrow = probed.select("doc_id", "part", possible.alias("possible"), "text").select(
        "doc_id", "part", "possible", F.when(F.col("possible"), F.col("text")).alias("text"),
        F.when(F.col("possible"), F.sha2("text", 256)).alias("digest"), own("text").alias("mask"),
    )
    with text_batches(spark):
        narrow = staged(narrow, "masks")

    least = narrow.where("possible").groupBy("text").agg(F.min("doc_id").alias("least"))
    least = least.where("least IS NOT NULL").select("least", F.sha2("text", 256).alias("first_digest"), F.lit(True).alias("first"))
    repeats = narrow.where("possible").drop("text")
    met = (F.col("doc_id") == F.col("least")) & (F.col("digest") == F.col("first_digest"))
    later = F.col("first").isNull() & F.col("doc_id").isNotNull()
    checked = repeats.join(least, met, "left").select("doc_id", "part", F.when(later, F.col("mask") + BIT["E"]).otherwise(F.col("mask")).alias("mask"))
    return narrow.where("NOT possible").select("doc_id", "part", "mask").union(checked)


def _unfolded(counts: DataFrame) -> DataFrame:
    """Every row of ``counts`` once for each order of the filters and step, with the step's filter and the filters before it."""
    orders = F.split(F.lit(" ".join("".join(o) for o in permutations(FILTERS))), " ")
    rows = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = [
        F.when(F.instr(F.col("filter_order"), letter) == F.col("step"), F.lit(bit)).otherwise(F.lit(0)) for letter, bit in BIT.items()
    ]
    earlier = [
        F.when(F.instr(F.col("filter_order"), letter) < F.col("step"), F.lit(bit)).otherwise(F.lit(0)) for letter, bit in BIT.items()
    ]
    return rows.withColumn("own", sum(bits, F.lit(0))).withColumn("before", sum(earlier, F.lit(0)))


def audit(docs: DataFrame, labels: DataFrame, *, part: str = "lang") -> DataFrame:
    """Per part, order of the filters and step: what the step's filter keeps, removes, repeats, removes alone, and costs."""
    masks = filter_masks(docs, part=part)
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("marked")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    one = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)).cast("bigint"))
    counts = masks.join(marks, F.col("doc_id") == F.col("marked"), "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), one("good").alias("good"), one("toxic").alias("toxic")
    )
    counts = staged(counts, "mask-counts")  # at most 32 rows a part

    mask, own, before = F.col("mask"), F.col("own"), F.col("before")
    fails, earlier = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) != 0
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(F.lit(0)))
    # of the orders of all filters, an equal share begins with each of those that the document fails
    share = F.lit(factorial(len(FILTERS))) / F.bit_count(mask)
    return (
        _unfolded(counts)
        .groupBy("part", "filter_order", "step")
        .agg(
            total(~fails & ~earlier).alias("kept"),
            total(fails & ~earlier).alias("removed"),
            total(fails & earlier).alias("redundant"),
            total(mask == own).alias("unique_fails"),
            total(fails & ~earlier, "good").alias("good_lost"),
            total(fails & ~earlier, "toxic").alias("toxic_lost"),
            F.sum(F.when(fails, F.col("n") * share.cast("bigint")).otherwise(F.lit(0))).alias("shapley"),
        )
    )
