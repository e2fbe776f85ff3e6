"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the mean of hashed vectors of the word and of its leading and trailing letters, so unseen forms of a word
share most of their embedding with seen ones. Filters of several widths run over the word embeddings, each keeps its largest
response over the whole text, and a logistic layer turns the responses into a score. Because a filter is linear before its
maximum, the responses of a word to every filter position are looked up in one table row and only added up per place.

``train`` learns from every labelled text. A shard of the texts (by a hash of the id) is learned by a task of its own, so no task
holds more than a shard; the first shard is learned to the end, and the others go on from its network side by side and are averaged,
an embedding by the texts that hold it. A table of one shard is learned as a whole. Scores use the text alone. ``thresholds`` finds,
for each language, the score that best separates the labelled texts (a fifth by hash) held out from training, all of them.

Defined cases: null and empty texts are one padding word and get the score the network gives that; very long texts are scored
whole, in slices that overlap by the widest filter; repeated rows get equal scores; labels that are null or not 0 or 1 are not
used; without texts of both classes every score is the share of toxic labels (0 without labels); a language without texts of
both classes uses the threshold of all. Extra columns pass through.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merch.llm.common import give_back, lower_ascii
from merch.operators.running import running_totals
from merch.session import staged

SHARD_TEXTS, SHARD_BYTES = 6000, 1 << 26  # what a task learns; more texts make more shards
BUCKETS = 1 << 16
DIM, FILTERS, WIDTHS = 16, 8, (1, 2, 3)
EPOCHS, RATE, BATCH = 5, 0.02, 64
LEAST_STEPS = 200
LEAST_TEXTS = 3
SLICE = 1 << 16
SEED = 8
SPAN = 1 << 10  # buckets that are averaged together
PARTS = 5  # hashed features of a word


#: Letters of scripts that put no blanks between words: each is a word of its own here, and the wider filters read their runs.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"
)


def words_of(text: str | None) -> list[bytes]:
    """The words between blanks in lower case, and the letters of scripts without blanks; one empty word where there is none."""
    if text and not text.isascii():
        text = _UNSPACED.sub(r" \g<0> ", text)
    return lower_ascii(text).split() or [b""]


@lru_cache(maxsize=100_000)
def word_buckets(word: bytes) -> tuple[int, ...]:
    """Buckets of the word without its outer punctuation, of its first 4 and 5 and last 4 letters, and of its shape."""
    core = word.strip(b".,;:!?\"'()[]{}") or word
    text = core.decode("utf-8", "replace")
    shape = b"#" if any(c.isdigit() for c in text) else b"!" if core != word else b"a"
    keys = (b"w" + core, b"p" + text[:4].encode(), b"q" + text[:5].encode(), b"s" + text[-4:].encode(), b"h" + shape + bytes([min(len(text), 20)]))
    return tuple(xxhash.xxh32_intdigest(k) % BUCKETS for k in keys)


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the distinct words, each text's words as positions in that table, and the bounds of the texts."""
    known: dict[bytes, int] = {}
    rows: list[np.ndarray] = []
    for text in texts:
        words = words_of(text)
        rows.append(np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int32))
    table = np.array([word_buckets(w) for w in known], dtype=np.int32).reshape(-1, PARTS)
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    return table, np.concatenate(rows) if rows else np.zeros(0, np.int32), bounds


def part_of(table: np.ndarray, at: np.ndarray, bounds: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of encoded texts those at ``some``, as ``encode`` gives them by themselves."""
    places = np.concatenate([at[bounds[i] : bounds[i + 1]] for i in some])
    used, first, back = np.unique(places, return_index=True, return_inverse=True)
    order = np.argsort(first)
    rank = np.empty(len(used), np.int32)
    rank[order] = np.arange(len(used), dtype=np.int32)
    return table[used[order]], rank[back], np.concatenate([[0], np.cumsum(bounds[some + 1] - bounds[some])])


class Network:
    """Embeddings E, filters W[width] (width x dim x filters), biases, and the output layer."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {"E": rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)}
        for w in WIDTHS:
            self.p[f"W{w}"] = rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32)
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.p["out"] = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.p["bias"] = np.zeros(1, np.float32)
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    def keep_shared(self, table: np.ndarray, at: np.ndarray, bounds: np.ndarray) -> None:
        """Buckets of fewer than LEAST_TEXTS of the encoded texts are not learned: they could only tell single texts apart."""
        self.seen = np.zeros(BUCKETS, dtype=np.int64)
        for a, b in zip(bounds, bounds[1:]):
            self.seen[np.unique(table[np.unique(at[a:b])])] += 1
        self.fixed = self.seen < LEAST_TEXTS

    def save(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **{k: v.astype(np.float16) if k == "E" else v for k, v in self.p.items()})
        return out.getvalue()

    def state(self) -> bytes:
        """Everything that a further step needs."""
        out = io.BytesIO()
        np.savez(out, t=self.t, **{f"{part}.{k}": v for part in "pmv" for k, v in getattr(self, part).items()})
        return out.getvalue()

    @classmethod
    def resume(cls, data: bytes) -> Network:
        net = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as held:
            net.t = int(held["t"])
            for part in "pmv":
                setattr(net, part, {k[2:]: held[k] for k in held if k.startswith(f"{part}.")})
        return net

    def spans(self, texts: int) -> pd.DataFrame:
        """The network as rows (span, weight by row, numbers): embeddings weigh the texts that hold their bucket, the rest all texts."""
        heavy = np.where(self.fixed, 0, self.seen).astype(np.float64)
        rows = [(i, heavy[i : i + SPAN].tobytes(), self.p["E"][i : i + SPAN].tobytes()) for i in range(0, BUCKETS, SPAN)]
        rest = np.concatenate([self.p[k].ravel() for k in sorted(self.p) if k != "E"])
        rows.append((-1, np.array([float(texts)]).tobytes(), rest.tobytes()))
        return pd.DataFrame(rows, columns=["span", "weight", "numbers"])

    def put_span(self, span: int, weight: bytes, numbers: bytes) -> None:
        """Take an averaged span; embeddings that nobody learned stay."""
        got = np.frombuffer(numbers, dtype=np.float32)
        if span >= 0:
            learned = np.frombuffer(weight) > 0
            self.p["E"][span : span + SPAN][learned] = got.reshape(-1, DIM)[learned]
            return
        at = 0
        for k in sorted(self.p):
            if k != "E":
                self.p[k] = got[at : at + self.p[k].size].reshape(self.p[k].shape).copy()
                at += self.p[k].size

    @classmethod
    def load(cls, data: bytes) -> Network:
        net = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as held:
            net.p = {k: held[k].astype(np.float32) for k in held}
        return net

    def responses(self, table: np.ndarray, at: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of every filter in every text, and the place of it. Texts are padded to the widest filter."""
        words = self.p["E"][table].mean(axis=1)
        n = len(bounds) - 1
        top = np.empty((n, FILTERS * len(WIDTHS)), np.float32)
        where = np.empty((n, FILTERS * len(WIDTHS)), np.int64)
        for slot, w in enumerate(WIDTHS):
            looked = [words @ self.p[f"W{w}"][k] for k in range(w)]
            for i in range(n):
                a, b = bounds[i], bounds[i + 1]
                best, place = None, None
                for s in range(a, max(b - w + 1, a + 1), SLICE):
                    e = min(s + SLICE, max(b - w + 1, a + 1))
                    total = looked[0][at[s:e]]
                    for k in range(1, w):
                        if s + k < b:
                            there = looked[k][at[s + k : min(e + k, b)]]
                            total[: len(there)] += there
                    got = total.argmax(axis=0)
                    high = total[got, np.arange(FILTERS)]
                    if best is None:
                        best, place = high, got + s
                    else:
                        more = high > best
                        best, place = np.where(more, high, best), np.where(more, got + s, place)
                top[i, slot * FILTERS : (slot + 1) * FILTERS] = best + self.p[f"b{w}"]
                where[i, slot * FILTERS : (slot + 1) * FILTERS] = place
        return top, where

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        top, _ = self.responses(*encode(texts))
        z = np.maximum(top, 0) @ self.p["out"] + self.p["bias"][0]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -50, 50)))

    def gradient(self, texts: list[str | None], labels: np.ndarray, weights: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
        """Gradients of the weighted mean cross-entropy and the small penalties, and those of the embeddings that the texts touch.

        The gradient of a maximum goes to the place that reached it.
        """
        return self.gradient_of(*encode(texts), labels, weights)

    def gradient_of(
        self, table: np.ndarray, at: np.ndarray, bounds: np.ndarray, labels: np.ndarray, weights: np.ndarray
    ) -> tuple[dict, np.ndarray, np.ndarray]:
        top, where = self.responses(table, at, bounds)
        act = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(act @ self.p["out"] + self.p["bias"][0], -30, 30)))
        dz = ((p - labels) * weights / weights.sum()).astype(np.float32)
        grad = {"out": act.T @ dz + 1e-4 * self.p["out"], "bias": np.array([dz.sum()], np.float32)}
        dtop = np.outer(dz, self.p["out"]) * (top > 0)
        dwords = np.zeros((len(table), DIM), np.float32)
        words = self.p["E"][table].mean(axis=1)
        for slot, w in enumerate(WIDTHS):
            cols = slice(slot * FILTERS, (slot + 1) * FILTERS)
            d, spot = dtop[:, cols], where[:, cols]
            grad[f"b{w}"] = d.sum(axis=0)
            gw = np.zeros_like(self.p[f"W{w}"])
            for k in range(w):
                inside = spot + k < bounds[1:, None]
                ids = at[np.minimum(spot + k, len(at) - 1)]
                dk = np.where(inside, d, 0)
                gw[k] = np.einsum("nfd,nf->df", words[ids], dk)
                np.add.at(dwords, ids.ravel(), (dk[:, :, None] * self.p[f"W{w}"][k].T[None]).reshape(-1, DIM))
            grad[f"W{w}"] = gw + 1e-5 * self.p[f"W{w}"]
        rows, back = np.unique(table, return_inverse=True)
        ge = np.zeros((len(rows), DIM), np.float32)
        np.add.at(ge, back.ravel(), np.repeat(dwords / PARTS, PARTS, axis=0))
        free = ~self.fixed[rows]
        return grad, rows[free], ge[free]

    def step(self, *batch: np.ndarray) -> None:
        """One Adam step on a batch: encoded texts, labels, weights."""
        grad, rows, ge = self.gradient_of(*batch)
        self.t += 1
        for name, g in grad.items():
            self._adam(name, slice(None), g)
        self._adam("E", rows, ge)

    def _adam(self, name: str, at, g: np.ndarray) -> None:
        self.m[name][at] = 0.9 * self.m[name][at] + 0.1 * g
        self.v[name][at] = 0.999 * self.v[name][at] + 0.001 * g * g
        m = self.m[name][at] / (1 - 0.9**self.t)
        v = self.v[name][at] / (1 - 0.999**self.t)
        self.p[name][at] -= RATE * m / (np.sqrt(v) + 1e-8)


def fit(texts: list[str], labels: np.ndarray, *, epochs: int = EPOCHS, seed: int = SEED, share: float | None = None) -> Network:
    """Train on the texts; both classes weigh the same (``share``: that of toxic ones). A small table is gone over more often."""
    net, rng, known = Network(seed), np.random.default_rng(seed), encode(texts)
    net.keep_shared(*known)
    net.p["E"][net.fixed] = 0
    go_over(net, known, labels, rng, max(epochs, -(-LEAST_STEPS * BATCH // len(texts))), labels.mean() if share is None else share)
    return net


def go_on(state: bytes, texts: list[str], labels: np.ndarray, share: float, *, seed: int = SEED) -> Network:
    """The network of ``state`` after all further texts, each once."""
    net, known = Network.resume(state), encode(texts)
    net.keep_shared(*known)
    go_over(net, known, labels, np.random.default_rng(seed), 1, share)
    return net


def go_over(net: Network, known: tuple[np.ndarray, np.ndarray, np.ndarray], labels: np.ndarray, rng, epochs: int, share: float) -> None:
    share = max(share, 1e-6)
    weights = np.where(labels == 1, 0.5 / share, 0.5 / max(1 - share, 1e-6))
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for s in range(0, len(order), BATCH):
            some = order[s : s + BATCH]
            net.step(*part_of(*known, some), labels[some], weights[some])


def best_thresholds(scored: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, threshold): the middle of the widest best cut of (score, toxic) by F1; groups without both classes have none.

    Equal scores are one row, and running totals over slices count what a cut takes, so a language of any size has no task for itself.
    """
    steps = scored.groupBy(*keys, "score").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").cast("bigint").alias("y"))
    totals = running_totals(steps, keys, [F.col("score").desc()], {"taken": "n", "hit": "y"}, totals={"all_n": "n", "all_y": "y"})
    f1 = 2 * F.col("hit") / (F.col("taken") + F.col("all_y"))
    rated = staged(totals.where("all_y > 0 AND all_y < all_n").select(*keys, "score", f1.alias("f1")), "cuts")
    best = rated.groupBy(*keys).agg(F.max_by("score", F.struct("f1", "score")).alias("best"))
    below = F.coalesce(F.max(F.when(F.col("score") < F.col("best"), F.col("score"))), F.lit(0.0))
    return rated.join(best, keys).groupBy(*keys).agg(((F.first("best") + below) / 2).alias("threshold"))


MODEL = "weights binary, rate double, thresholds map<string,double>, base double"


def sampled(docs: DataFrame, labels: DataFrame, per_class: int | None = None, class_bytes: int | None = None) -> DataFrame:
    """(doc_id, toxic, text, lang, order): the labelled texts, one for each id, with their place in an order by hash.

    An id with both labels counts as toxic; of the texts of a repeated id the one of the smallest hash is taken, so reruns agree.
    With ``per_class`` or ``class_bytes`` (not used by ``train``) it is a sample: so many ids of a class, chosen before any text is
    read; texts over 1/64 of ``class_bytes`` are left out, and the others of a class are taken in order until they hold that much.
    """
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED))
    chosen = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if per_class is not None:
        some = [chosen.where(F.col("toxic") == value).orderBy(order, "doc_id").limit(per_class) for value in (0, 1)]
        chosen = F.broadcast(staged(some[0].union(some[1]), "chosen"))
    text, lang = F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    picked = docs.select("doc_id", text, lang, F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    if class_bytes is not None:
        picked = picked.where(F.col("size") <= class_bytes // 64)
    one = F.min(F.struct(F.xxhash64("text", "lang").alias("h"), "size", "text", "lang")).alias("one")
    found = picked.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(one)
    found = found.select("doc_id", "toxic", "one.size", "one.text", "one.lang", order.alias("order"))
    if class_bytes is None:
        return found.drop("size")
    found = staged(found, "found")
    so_far = F.sum("size").over(Window.partitionBy("toxic").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    kept = found.select("doc_id", "toxic", "size", "order").withColumn("so_far", so_far).where(F.col("so_far") <= class_bytes)  # per_class rows each
    return found.drop("size").join(kept.select("doc_id"), "doc_id", "left_semi")


def _learned(rows: DataFrame, shards: int, share: float) -> bytes:
    """The weights of the network that has learned from all rows (text, toxic, order, doc_id, shard)."""

    def arranged(data: pd.DataFrame) -> tuple[list, np.ndarray]:
        data = data.sort_values(["order", "doc_id"])
        return data["text"].tolist(), data["toxic"].to_numpy(dtype=np.float32)

    def first(data: pd.DataFrame) -> pd.DataFrame:
        give_back()
        net = fit(*arranged(data), share=share if shards > 1 else None)
        word_buckets.cache_clear()
        give_back()
        return pd.DataFrame({"state": [net.state() if shards > 1 else net.save()]})

    def others(data: pd.DataFrame) -> pd.DataFrame:
        give_back()
        out = go_on(state, *arranged(data), share).spans(len(data)).assign(shard=data["shard"].iloc[0])
        word_buckets.cache_clear()
        give_back()
        return out

    def average(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("shard")
        total, weight = None, None
        for w, x in zip(parts["weight"], parts["numbers"]):
            w = np.frombuffer(w)
            x = np.frombuffer(x, dtype=np.float32).reshape(len(w), -1) * w[:, None]
            total, weight = (x, w) if total is None else (total + x, weight + w)
        mean = (total / np.maximum(weight, 1)[:, None]).astype(np.float32)
        return pd.DataFrame([(parts["span"].iloc[0], weight.tobytes(), mean.tobytes())], columns=["span", "weight", "numbers"])

    start = rows.agg(F.min("shard")).first()[0]
    state = bytes(rows.where(F.col("shard") == start).groupBy("shard").applyInPandas(first, "state binary").first()[0])
    if shards == 1:
        return state
    net = Network.resume(state)
    schema = "span long, weight binary, numbers binary"
    spans = staged(rows.where(F.col("shard") > start).groupBy("shard").applyInPandas(others, f"{schema}, shard int"), "spans")
    spans = spans.repartition(BUCKETS // SPAN, "span")  # small groups, which would else be put together in few tasks
    for r in spans.groupBy("span").applyInPandas(average, schema).collect():  # one network, of a fixed size
        net.put_span(r["span"], bytes(r["weight"]), bytes(r["numbers"]))
    return net.save()


def train(docs: DataFrame, labels: DataFrame, *, shard_texts: int = SHARD_TEXTS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row: weights, toxic share, threshold by language ('' for null) and for all (base), from all labelled texts.

    A fifth of them by hash is kept from training and calibrates the thresholds.
    """
    spark = docs.sparkSession
    rows = staged(sampled(docs, labels), "labelled")
    apart = F.pmod("order", F.lit(5)) == 0
    held = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("toxic").alias("rate"), F.count_if(apart).alias("apart")).first()
    rate = held["rate"] or 0.0
    if not held["n"] or rate in (0.0, 1.0):
        return spark.createDataFrame([(None, rate, {}, 0.5)], MODEL)
    seen, tried = (rows.where(~apart), rows.where(apart)) if held["n"] >= 50 and held["apart"] else (rows, rows)
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))
    told = seen.agg(F.count(F.lit(1)).alias("n"), size.alias("bytes"), F.avg("toxic").alias("share")).first()
    shards = max(-(-told["n"] // shard_texts), -(-told["bytes"] // shard_bytes), 1)
    shard = F.pmod(F.floor(F.col("order") / 5), F.lit(shards)).cast("int")  # not the remainder that sets the fifth apart
    weights = _learned(seen.withColumn("shard", shard), shards, told["share"])
    model = spark.createDataFrame([(weights, rate, {}, 0.5)], MODEL)
    scored = score_texts(tried, model, flag=None).select(F.coalesce("lang", F.lit("")).alias("lang"), "toxic", "score")
    scored = staged(scored, "scored")
    cuts = {r["lang"]: r["threshold"] for r in best_thresholds(scored, ["lang"]).collect()}  # languages
    base = best_thresholds(scored.withColumn("lang", F.lit("")), ["lang"]).first()
    return spark.createDataFrame([(weights, rate, cuts, base["threshold"] if base else 0.5)], MODEL)


def score_texts(docs: DataFrame, model: DataFrame, *, score: str = "score", flag: str | None = "toxic_flag") -> DataFrame:
    """``docs`` with the score of every whole text and, by the threshold of its language, the flag.

    The model is one row of a fixed size (a table of 2^16 x 16 numbers and a few filters).
    """
    held = model.first()
    weights, rate = held["weights"], held["rate"]

    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        give_back()
        net = Network.load(bytes(weights)) if weights is not None else None
        for batch in batches:
            if net is None:
                yield pd.Series(np.full(len(batch), rate))
                continue
            out, texts = np.empty(len(batch)), batch.tolist()
            for s in range(0, len(texts), 256):
                out[s : s + 256] = net.scores(texts[s : s + 256])
            yield pd.Series(out)
        word_buckets.cache_clear()
        give_back()

    out = docs.withColumn(score, apply(F.col("text").cast("string")))
    if flag:
        cut = F.lit(float(held["base"]))
        if held["thresholds"]:  # languages of the sample
            by = F.create_map(*[F.lit(v) for lang, value in sorted(held["thresholds"].items()) for v in (lang, float(value))])
            cut = F.coalesce(F.try_element_at(by, F.coalesce(F.col("lang").cast("string"), F.lit(""))), cut)
        out = out.withColumn(flag, F.col(score) >= cut)
    return out
