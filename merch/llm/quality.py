"""Quality by an interpolated modified Kneser-Ney model of characters.

The model is trained on the trusted documents (those labelled good), all but a tenth by hash, which sets the thresholds. An n-gram is a long: ``order`` symbols of 12 bits, a symbol
being a code point below 3072 or one of 1024 classes of the higher ones; a text begins with padding and ends with an end symbol.
Counting is one aggregation; lower orders count in how many contexts a suffix was seen. Discounts come from the counts of
counts of each order, and probabilities are interpolated from single symbols up to the full order, every order by a window over
the n-grams of a context and a join on their suffixes, both sharded by n-gram. All n-grams of the corpus take part, seen in
trusted text or not, so every place of every document has its own probability.

To score, documents are dealt into blocks of bounded size; each block asks for its distinct n-grams, the requests are joined
with the probabilities, and the answers meet the block again. A document's perplexity is the exponential of its mean surprise,
drawn to the mean of its language by ``prior`` places, so that very short texts are not judged by a few characters. It is
rejected above its language's threshold: the ``quantile`` of the trusted documents kept out of training.

Defined cases: null and empty texts are an end symbol only and get their language's mean; a null language is a language of its
own; a language with fewer than ``least`` documents for its threshold uses the distance from typical that all languages together
give, typical being its own mean; without any trusted document nothing is rejected and the perplexity is that of the uniform model; repeated rows are scored each; labels that occur twice
count once, and a document is trusted when any of its labels is 1; a very long document lies in one block with those that its
hash meets; an empty table gives no rows; only doc_id, text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from merch.llm.common import KEY, give_back, keyed, text_batches, text_or_empty
from merch.session import staged

ORDER = 4
BITS = 12
PAD, END = 1, 2
BLOCK_CHARS = 16 << 20
PRIOR = 60
QUANTILE, LEAST = 0.99, 30
HELD_OUT, SEED = 10, 9  # one trusted document in ten judges


def symbols(text: str) -> np.ndarray:
    """Symbols of a text: code points, the high ones folded into classes, the three lowest into one."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    return np.where(points < 3072, np.maximum(points, 3), 3072 + (points * 40503 >> 4) % 1024)


def ngrams(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram at every place of every text in a row, and the number of places of each text."""
    parts, counts = [], []
    pad = np.full(order - 1, PAD, dtype=np.int64)
    for text in texts:
        own = symbols(text)
        counts.append(len(own) + 1)
        parts += [pad, own, np.array([END])]
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.concatenate(parts)
    n = len(row) - order + 1
    codes = np.zeros(n, dtype=np.int64)
    for k in range(order):
        codes = (codes << BITS) | row[k : k + n]
    # windows that begin in one text and end in the next one's padding are no places
    counts = np.array(counts)
    lengths = counts + order - 1
    firsts = np.cumsum(lengths) - lengths
    keep = np.zeros(n, dtype=bool)
    place = np.repeat(firsts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    keep[place] = True
    return codes[keep], counts


@F.pandas_udf(BinaryType())
def packed(texts: pd.Series) -> pd.Series:
    """Texts as they travel: a shuffle of whole texts costs a third less disk."""
    return pd.Series([pa.compress(t.encode("utf-8", "surrogatepass"), codec="zstd", asbytes=True) for t in texts])


def unpacked(frame: pd.DataFrame) -> list[str]:
    pairs = zip(frame["packed"], frame["size"].tolist())
    return [pa.decompress(p, decompressed_size=n, codec="zstd", asbytes=True).decode("utf-8", "surrogatepass") if n else "" for p, n in pairs]


def _chunks(frame: pd.DataFrame, chars: int = 1 << 19) -> Iterator[pd.DataFrame]:
    sizes = frame["size"].to_numpy().cumsum()
    at = 0
    while at < len(frame):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + chars)))
        yield frame.iloc[at:stop]
        at = stop


def count_ngrams(docs: DataFrame, trusted: DataFrame, *, order: int = ORDER) -> DataFrame:
    """(code, seen, all): how often each n-gram of the corpus occurs in trusted documents and in all."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        held, rows = [pd.DataFrame({"code": np.zeros(0, np.int64), "seen": np.zeros(0, np.int64), "all": np.zeros(0, np.int64)})], 0
        for batch in batches:
            for part in _chunks(batch):
                codes, counts = ngrams(unpacked(part), order)
                at, distinct = pd.factorize(codes)
                good = np.repeat(part["trusted"].to_numpy(dtype=bool), counts)
                more = pd.DataFrame(
                    {"code": distinct, "seen": np.bincount(at[good], minlength=len(distinct)), "all": np.bincount(at, minlength=len(distinct))}
                )
                held.append(more)
                rows += len(more)
                if rows > 1 << 20:
                    held = [pd.concat(held).groupby("code", as_index=False, sort=False).sum()]
                    if len(held[0]) > 1 << 19:  # the rest of the sum is the shuffle's
                        yield held[0]
                        held = [held[0].iloc[:0]]
                    rows = len(held[0])
        yield pd.concat(held).groupby("code", as_index=False, sort=False).sum()
        give_back()

    text = text_or_empty()
    rows = docs.select("doc_id", F.octet_length(text).alias("size"), packed(text).alias("packed"))
    # a merge join at every size: labels grow with the documents
    known = trusted.withColumn("trusted", F.lit(True)).hint("merge")
    flagged = rows.join(known, "doc_id", "left").select("packed", "size", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counted = flagged.mapInPandas(count, "code bigint, seen bigint, all bigint")
    return counted.groupBy("code").agg(F.sum("seen").alias("seen"), F.sum("all").alias("all"))


def discounts(counts: DataFrame) -> list[float]:
    """Discounts for counts 1, 2 and 3 or more, from the counts of counts; plain ones where those are missing."""
    n1, n2, n3, n4 = counts.agg(*[F.sum((F.col("seen") == k).cast("bigint")) for k in (1, 2, 3, 4)]).first()
    if not (n1 and n2 and n3 and n4):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1)]


def probabilities(counts: DataFrame, *, order: int = ORDER) -> DataFrame:
    """(code, p) of every n-gram in ``counts`` (code, seen): interpolated modified Kneser-Ney."""
    tables = [counts.select("code", "seen")]
    for k in range(order - 1, 0, -1):
        suffix = F.col("code").bitwiseAND(F.lit((1 << (BITS * k)) - 1))
        # contexts in which the suffix was seen; n-grams that are only asked for count 0
        tables.append(staged(tables[-1].groupBy(suffix.alias("code")).agg(F.sum((F.col("seen") > 0).cast("bigint")).alias("seen")), f"order{k}"))
    lower = None
    for k, table in enumerate(reversed(tables), 1):
        d1, d2, d3 = discounts(table)
        seen = F.col("seen")
        context = Window.partitionBy("context")  # at most 2^12 n-grams share a context
        cut = F.when(seen == 1, d1).when(seen == 2, d2).when(seen > 2, d3).otherwise(0.0)
        measured = table.withColumn("context", F.shiftright("code", BITS)).select(
            "code", (seen - cut).alias("kept"), F.sum("seen").over(context).alias("total"), F.sum(cut).over(context).alias("freed")
        )
        if lower is None:
            below = measured.withColumn("q", F.lit(1.0 / (1 << BITS)))
        else:
            suffix = F.col("code").bitwiseAND(F.lit((1 << (BITS * (k - 1))) - 1))
            below = measured.withColumn("suffix", suffix).join(lower.select(F.col("code").alias("suffix"), F.col("p").alias("q")), "suffix")
        p = F.when(F.col("total") > 0, (F.col("kept") + F.col("freed") * F.col("q")) / F.nullif(F.col("total"), F.lit(0))).otherwise(F.col("q"))
        lower = staged(below.select("code", p.alias("p")), f"p{k}")
    return lower


def surprises(docs: DataFrame, model: DataFrame, blocks: int, *, order: int = ORDER) -> DataFrame:
    """key, doc_id, lang, places and total surprise (natural log) of every document row."""
    text = text_or_empty()
    rows = keyed(docs, {"doc_id": F.col("doc_id").cast("string"), "lang": F.col("lang").cast("string"), "text": text, "size": F.octet_length(text)})
    # both the questions and the answers read this one exchange, so they take the same columns
    dealt = rows.select(*KEY, "doc_id", "lang", "size", packed("text").alias("packed"), F.pmod(F.xxhash64(*KEY), F.lit(blocks)).cast("int").alias("block"))
    dealt = dealt.repartition("block")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The distinct n-grams of each block; blocks come one after the other, and one is held at a time."""
        give_back()
        now, held = None, []

        def close():
            codes = pd.unique(np.concatenate(held))
            return pd.DataFrame({"block": np.full(len(codes), now, np.int32), "code": codes})

        for batch in batches:
            for block, some in batch.groupby("block", sort=False):
                if block != now and held:
                    yield close()
                    held = []
                now = block
                held.extend(pd.unique(ngrams(unpacked(part), order)[0]) for part in _chunks(some))
                if len(held) > 8:
                    held = [pd.unique(np.concatenate(held))]
        if held:
            yield close()
        give_back()

    def answer(frame: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        codes = told["code"].to_numpy()
        by = np.argsort(codes)
        codes, cost = codes[by], -np.log(told["p"].to_numpy()[by])
        out = []
        give_back()
        for part in _chunks(frame):
            places, counts = ngrams(unpacked(part), order)
            at, distinct = pd.factorize(places)
            spot = np.searchsorted(codes, distinct)
            if len(distinct) and (spot.max() >= len(codes) or (codes[spot] != distinct).any()):
                raise ValueError("an n-gram of the block has no probability")
            each = cost[spot][at]
            total = np.add.reduceat(each, np.cumsum(counts) - counts)
            out.append(part[[*KEY, "doc_id", "lang"]].assign(places=counts, surprise=total))
        return pd.concat(out) if out else pd.DataFrame(columns=[*KEY, "doc_id", "lang", "places", "surprise"])

    asked = dealt.sortWithinPartitions("block").mapInPandas(ask, "block int, code bigint")
    told = asked.join(model, "code").select("block", "code", "p")
    scored = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(
        answer, f"{KEY[0]} bigint, {KEY[1]} bigint, doc_id string, lang string, places bigint, surprise double"
    )
    return scored.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id and whether the document only sets thresholds."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.withColumn("judging", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), F.lit(HELD_OUT)) == 0)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    *,
    order: int = ORDER,
    quantile: float = QUANTILE,
    prior: float = PRIOR,
    least: int = LEAST,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """key, doc_id, lang, places, perplexity, trusted, threshold, keep for every document row."""
    trusted = trusted_ids(labels)
    with text_batches(docs.sparkSession):
        counts = staged(count_ngrams(docs, trusted.where("NOT judging").select("doc_id"), order=order), "counts")
    total = counts.agg(F.sum("all")).first()[0] or 0
    model = probabilities(counts, order=order)
    with text_batches(docs.sparkSession):
        blocks = max(-(-total // block_chars), docs.sparkSession.sparkContext.defaultParallelism)
        costs = staged(surprises(docs, model, blocks, order=order), "surprise")

    flagged = costs.join(trusted, "doc_id", "left").withColumns(
        {"trusted": F.col("judging").isNotNull(), "judging": F.coalesce("judging", F.lit(False))}
    )
    means = staged(flagged.groupBy("lang").agg(
        F.sum("surprise").alias("s"), F.sum("places").alias("n"), F.sum(F.when(F.col("trusted"), F.col("surprise"))).alias("ts"),
        F.sum(F.when(F.col("trusted"), F.col("places"))).alias("tn")), "means")
    typical = means.select(F.col("lang").alias("_l"), F.coalesce(F.try_divide("ts", "tn"), F.try_divide("s", "n")).alias("typical"))
    drawn = flagged.join(typical, F.col("lang").eqNullSafe(F.col("_l"))).drop("_l")
    mean = (F.col("surprise") + prior * F.col("typical")) / (F.col("places") + prior)
    scored = staged(drawn.select(*KEY, "doc_id", "lang", "places", "trusted", "judging", "typical", (mean - F.col("typical")).alias("over")), "scored")

    # quantiles of the log of the perplexity over that of the language, so that languages can share one where they must
    cut = F.percentile_approx("over", quantile, 10000)
    good = scored.where("judging")
    everywhere = good.agg(cut).first()[0]
    overall = float("inf") if everywhere is None else float(everywhere)
    by = good.groupBy(F.col("lang").alias("_l")).agg(cut.alias("own"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    by = staged(by.select("_l", "own"), "thresholds")
    limit = F.coalesce("own", F.lit(overall))
    judged = scored.join(by, F.col("lang").eqNullSafe(F.col("_l")), "left")
    return judged.select(
        *KEY, "doc_id", "lang", "places", F.exp(F.col("typical") + F.col("over")).alias("perplexity"), "trusted",
        F.exp(F.col("typical") + limit).alias("threshold"), (F.col("over") <= limit).alias("keep"),
    )
