"""Benchmark passages inside documents: a prefix-filtered set join that verifies exact windows.

A window is a run of ``WINDOW`` consecutive words of an item, or the whole of a shorter item. Its tokens are its shingles of
``SHINGLE`` words (fewer if the window is shorter). A document that holds the window holds all of its tokens, so for full
containment a prefix of one token is enough: the rarest, by exact counts over all documents. A window with a token that no
document has is dropped. The join on prefix tokens aligns a document's words with the window; the place must leave room in front
(positional bound) and behind (length bound), and the words must be equal one by one.

Documents are read twice, once for the counts and once for the join, and their words never leave the scan's stage: the prefix
table is broadcast when its measured size is at most ``BROADCAST_BYTES``, so only counts and verified places are shuffled. A
larger table is joined by a shuffle of tokens with the few words around them. All of it is DataFrame operations.

Defined cases: null texts have no words; A-Z count as lower case; a row is a document, whatever its id, and repeated rows each
come out; items with the same id count once, rows of items without an id mark words but are not listed; items without words
have no window; empty tables give no rows, or no hits; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merch.llm.common import KEY, keyed
from merch.session import staged

WINDOW, SHINGLE = 10, 3
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64  # of a broadcast row besides its text

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), BREAKS), "")


def _token(words: Column, at: Column, size: int) -> Column:
    """A hash of ``size`` words from position ``at`` (from 0)."""
    return F.xxhash64(*[F.get(words, at + F.lit(i)) for i in range(size)])


def _text(words: Column, at: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, at + F.lit(1), size), " ")


def item_windows(items: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """(item_id string, window, size): every window of every item as its words joined by spaces."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(window))
    rows = rows.withColumn("size", size).withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))))
    return rows.select("item_id", _text(F.col("words"), F.col("at"), F.col("size")).alias("window"), "size")


def window_tokens(windows: DataFrame, *, shingle: int = SHINGLE) -> DataFrame:
    """(window, size, token, width, place): the tokens of every window with their place in it."""
    words = F.split("window", " ")
    wide = windows.select("window", "size", words.alias("words"), F.least(F.col("size"), F.lit(shingle)).alias("width"))
    at = wide.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("width"))))
    token = F.coalesce(*[F.when(F.col("width") == k, _token(F.col("words"), F.col("place"), k)) for k in range(1, shingle + 1)])
    return at.select("window", "size", token.alias("token"), "width", "place")


def _positions(docs: DataFrame, widths: list[int], outer: bool) -> DataFrame:
    """Every position of every document with its token, once for each width; ``words`` must not leave the stage."""
    deal = F.posexplode_outer if outer else F.posexplode
    rows = docs.select("*", deal("words").alias("pos", "_word")).drop("_word")
    if widths == [max(widths)]:
        return rows.withColumn("token", _token(F.col("words"), F.col("pos"), widths[0]))
    return rows.withColumn("token", F.explode(F.array(*[_token(F.col("words"), F.col("pos"), k) for k in widths])))


def _bounded(table: DataFrame, text: str | None = None) -> bool:
    """Whether a staged table, held in memory, stays below the bound."""
    letters = F.sum(F.octet_length(text)) if text else F.lit(0)
    rows, size = table.agg(F.count(F.lit(1)), F.coalesce(letters, F.lit(0))).first()
    return rows * ROW_BYTES + size <= BROADCAST_BYTES


def hits(docs: DataFrame, windows: DataFrame, *, shingle: int = SHINGLE, reach: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` (key, doc_id, words) with n_words, and one row for each place of a window: start, size, window.

    ``windows`` (window, size) are distinct and of at most ``reach`` words; a document comes at least once, without a place if
    nothing is found.
    """
    tokens = staged(window_tokens(windows, shingle=shingle), "tokens")
    widths = [r["width"] for r in tokens.select("width").distinct().orderBy("width").collect()] or [shingle]  # at most ``shingle`` rows
    known = staged(tokens.select("token").distinct(), "known-tokens")
    small = _bounded(known)
    met = _positions(docs.select("words"), widths, outer=False).select("token").join(F.broadcast(known) if small else known, "token")
    counts = staged(met.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token-counts")

    rarity = tokens.join(counts, "token", "left")
    first = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "place")).alias("first")
    prefix = rarity.groupBy("window", "size").agg(first).where("first.n > 0")
    prefix = staged(prefix.select(F.col("first.token").alias("prefix"), F.col("first.place").alias("place"), "size", "window"), "prefix")

    n_words, pos = F.size("words"), F.col("pos")
    start = pos - F.col("place")
    room = (start >= 0) & (start + F.col("size") <= F.col("n_words"))
    place = ["n_words", start.alias("start"), "size", "window"]
    docs = docs.select(*KEY, "doc_id", "words", n_words.alias("n_words"))
    if _bounded(prefix, "window"):
        equal = _text(F.col("words"), start, F.col("size")) == F.col("window")
        rows = _positions(docs, widths, outer=True)
        found = rows.join(F.broadcast(prefix), (F.col("token") == F.col("prefix")) & room & equal, "left")
        return found.where("window IS NOT NULL OR pos IS NULL OR pos = 0").select(*KEY, "doc_id", *place)
    # a token travels with the words that a window around it can have
    left = F.greatest(pos - F.lit(reach - 1), F.lit(0))
    around = _positions(docs, widths, outer=False).select(
        *KEY, "doc_id", "n_words", "pos", "token", left.alias("left"), F.slice("words", left + 1, F.lit(2 * reach - 1)).alias("near")
    )
    equal = _text(F.col("near"), start - F.col("left"), F.col("size")) == F.col("window")
    found = around.join(prefix, (F.col("token") == F.col("prefix")) & room & equal).select(*KEY, "doc_id", *place)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("start", "int"), ("size", "int"), ("window", "string"))]
    return found.union(docs.select(*KEY, "doc_id", "n_words", *nothing))


def contamination(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit (words inside a window's occurrence) and items (ids whose windows occur, sorted) of every row."""
    owners = staged(item_windows(items, window=window).distinct(), "windows")
    words = keyed(docs, {"doc_id": F.col("doc_id"), "words": words_of(F.col("text"))})
    found = hits(words, owners.select("window", "size").distinct(), shingle=shingle, reach=window)

    end = F.col("start") + F.col("size")
    before = Window.partitionBy(*KEY).orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(end - F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    docs_hit = found.withColumn("fresh", F.coalesce(fresh, F.lit(0))).groupBy(*KEY).agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").cast("bigint").alias("n_words"), F.sum("fresh").alias("n_hit"),
        F.collect_set("window").alias("windows"),  # of one document
    )
    docs_hit = staged(docs_hit, "hits")
    named = owners.where("item_id IS NOT NULL").select("item_id", F.col("window").alias("of"))
    listed = docs_hit.where("n_hit > 0").select(*KEY, F.explode("windows").alias("window")).join(named, F.col("window") == F.col("of"))
    listed = listed.groupBy(*KEY).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    none = F.array().cast("array<string>")
    return docs_hit.join(listed, KEY, "left").select("doc_id", "n_words", "n_hit", F.coalesce("items", none).alias("items"))
