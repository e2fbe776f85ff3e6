"""Mixing sources to target weights by Pareto order sampling.

Sizes are words. A source's target is its share by weight of ``epochs`` times all words, at most ``cap`` times its own words, the
excess reshared by weight. Inside a source a document is wanted ``e = min(cap, rate x preference)`` times, where the preference
grows slowly with its length class and the rate makes the wanted words add up to the target. The whole part of ``e`` is
allocated for certain. The rest is an inclusion probability p, and Pareto order sampling decides: documents are ranked by
(u / (1 - u)) / (p / (1 - p)), u being a hash of the row, and taken in that order; a document that would pass the target is left
out and those behind it go on.

So a mix never passes a source's target, misses it by less than the smallest document left out of the draw, and is the same on
every run. A document gets the whole part of ``e`` or one copy more, so a source whose words are mostly those of one document
that does not fit misses its target where all others have been drawn.

Defined cases: null or blank text has size 0, is wanted never and taken 0 words; a null source is a source of its own, last in
order; a source without words has target 0; repeated rows are separate documents with one u each; a very long document that
does not fit is left to its whole copies; an empty table gives no rows; only doc_id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merch.llm.common import KEY, keyed, text_or_empty
from merch.operators.running import running_totals
from merch.session import staged

WEIGHTS = (5.0, 2.0, 1.0)
EPOCHS, CAP = 1.5, 2.0
SEED = 20


def word_count(text: Column) -> Column:
    """Number of runs of anything but blank, tab, newline, vertical tab, form feed and carriage return."""
    blanks = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    # a word begins where a non-blank follows a blank; one leading blank makes the first word count too
    shrunk = F.regexp_replace(F.concat(F.lit(" "), blanks), " [^ ]+", "x")
    return F.length(F.translate(shrunk, " ", "")).cast("bigint")


def sizes(docs: DataFrame) -> DataFrame:
    """key, doc_id, source, size, and a tie-breaking hash of the text, for every document."""
    text = text_or_empty()
    return keyed(
        docs,
        {"doc_id": F.col("doc_id"), "source": F.col("source").cast("string"), "size": word_count(text), "text_hash": F.xxhash64(text)},
    )


def source_targets(sized: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, epochs: float = EPOCHS, cap: float = CAP) -> DataFrame:
    """source, source_size, target: weights by code point order of the source names, null last, repeating.

    Raising all uncapped targets together until the capped ones have been paid for is the fixed point of resharing. Sorted by
    size per weight, the capped sources come first: with c words in the sources before and w weight in the rest, the rate is
    (epochs x all - cap x c) / w, and the first source that does not reach its cap at that rate ends the capped ones.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(
        per.withColumn("_none", F.col("source").isNull()), [], [F.col("_none"), F.col("source")], {}, rank="_rank"
    )
    choice = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    weighed = ranked.withColumn("weight", choice).where("source_size > 0")
    order = [(F.col("source_size") / F.col("weight")).asc(), F.col("_none"), F.col("source")]
    run = running_totals(
        weighed, [], order, {"_words": "source_size", "_weights": "weight"}, totals={"_all": "source_size", "_weight_all": "weight"}
    )
    before = F.col("_words") - F.col("source_size")
    rest = F.col("_weight_all") - F.col("_weights") + F.col("weight")
    rate = (epochs * F.col("_all") - cap * before) / rest
    free = run.withColumn("_rate", rate).withColumn("_free", F.col("_rate") * F.col("weight") <= cap * F.col("source_size"))
    level = free.where("_free").agg(F.min_by("_rate", F.col("source_size") / F.col("weight")).alias("level")).first()["level"]
    paid = cap * F.col("source_size") if level is None else F.least(F.lit(level) * F.col("weight"), cap * F.col("source_size"))
    found = run.select("source", paid.alias("target"))
    return per.join(found.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "source", "source_size", F.coalesce("target", F.lit(0.0)).alias("target")
    )


def preference(size: Column) -> Column:
    """Longer documents carry more context: 1 for one word, and one more for each doubling, tempered by a half power."""
    return F.sqrt(1 + F.floor(F.log2(F.greatest(size, F.lit(1)))))


def wanted(sized: DataFrame, targets: DataFrame, *, cap: float = CAP) -> DataFrame:
    """source, class, expected: times that documents of each length class are wanted.

    There are at most 64 length classes to a source, so the rate of each source is found over a bounded window: classes are
    capped from the most preferred down, as the sources are above.
    """
    level = F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int")
    classes = sized.where("size > 0").groupBy("source", level.alias("class")).agg(F.sum("size").alias("words"))
    liked = F.sqrt(1.0 + F.col("class"))
    down = Window.partitionBy("source").orderBy(F.desc("class"))
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    after = down.rowsBetween(0, Window.unboundedFollowing)
    joined = classes.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    rates = joined.withColumn("liked", liked).select(
        "source", "class", "liked",
        ((F.col("target") - cap * F.coalesce(F.sum("words").over(above), F.lit(0))) / F.sum(F.col("words") * F.col("liked")).over(after)).alias("rate"),
    )
    free = F.when(F.col("rate") * F.col("liked") <= cap, F.struct(F.col("class"), F.col("rate")))
    pick = F.max(free).over(Window.partitionBy("source"))["rate"]
    return rates.select("source", "class", F.least(F.coalesce(pick * F.col("liked"), F.lit(cap)), F.lit(cap)).alias("expected"))


def mix(docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, epochs: float = EPOCHS, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """key, doc_id, source, size, source_size, target, copies for every document row."""
    sized = staged(sizes(docs), "sizes")
    targets = staged(source_targets(sized, weights=weights, epochs=epochs, cap=cap), "targets")
    plan = staged(wanted(sized, targets, cap=cap), "wanted")
    level = F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int")
    plan = plan.select(F.col("source").alias("_ps"), F.col("class").alias("_pc"), "expected")
    goals = targets.select(F.col("source").alias("_ts"), "source_size", "target")
    rows = (
        sized.join(goals, F.col("source").eqNullSafe(F.col("_ts")))
        .join(plan, F.col("source").eqNullSafe(F.col("_ps")) & (level == F.col("_pc")) & (F.col("size") > 0), "left")
        .drop("_ts", "_ps", "_pc")
    )
    expected = F.coalesce("expected", F.lit(0.0))
    sure = F.least(F.floor(expected + 1e-9), F.lit(int(cap)))
    chance = F.greatest(expected - sure, F.lit(0.0))
    # 52 bits of the hash, never 0 or 1
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash", "source", F.lit(seed)), 12).cast("double") + 0.5) / float(1 << 52)
    open_ = F.when(chance > 1e-9, chance)
    odds = (u / (1 - u)) * ((1 - open_) / open_)
    rows = staged(rows.withColumns({"sure": sure.cast("bigint"), "order": odds}), "odds")

    gap = staged(rows.groupBy(F.col("source").alias("_s")).agg((F.first("target") - F.sum(F.col("sure") * F.col("size"))).alias("gap")), "gap")
    columns = ["source", "order", "doc_id", "text_hash", "size", *KEY]
    place = [F.col("order"), F.col("doc_id"), F.col("text_hash"), *[F.col(k) for k in KEY]]
    fits = lambda pool: pool.join(gap, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") <= F.col("gap"))).drop("_s")
    pool, more = fits(rows.where("`order` IS NOT NULL").select(*columns)), None
    # a round draws up to the first document that does not fit; that one never fits again, and those behind it are drawn on
    while True:
        drawn = running_totals(pool, ["source"], place, {"run": "size"})
        drawn = staged(drawn.select(*columns, "gap", (F.col("run") <= F.col("gap")).alias("inside")), "drawn")
        took = drawn.where("inside").select(*KEY)
        more = took if more is None else more.union(took)
        taken = F.coalesce(F.sum(F.when(F.col("inside"), F.col("size"))), F.lit(0))
        gap = staged(drawn.groupBy(F.col("source").alias("_s")).agg((F.first("gap") - taken).alias("gap")), "gap")
        pool = staged(fits(drawn.where("NOT inside").select(*columns)), "pool")
        if not pool.take(1):
            break
    more = more.withColumn("one", F.lit(1))
    return rows.join(more, KEY, "left").select(
        *KEY, "doc_id", "source", "size", "source_size", "target", (F.col("sure") + F.coalesce("one", F.lit(0))).alias("copies")
    )
