"""Embedding near copies by NN-descent.

Equal vectors are collapsed first. A neighbour graph is begun from blocks of vectors that are alike under random hyperplanes and
refined by neighbours-of-neighbours joins: in each round a vector visits a few of its neighbours, is compared with the
neighbours found there, and both sides keep what improves their list. A list holds the ``k`` best; a list whose last entry
still reaches the threshold is saturated and enlarged until its last entry falls below, so that no link is pushed out.

Recall is audited without comparing all pairs, in three ways. A graph from new hyperplanes, made apart from the refined one, is
held against it: the share of its links that the refined graph has already (recapture) shows also pairs that lie alone. Some
``AUDIT`` vectors drawn from all, and some drawn from those with links, are compared with all. Vectors are judged in classes by
their number of links, each vector counting once, so a large group hides nothing that small groups lose. The new graph is merged
into the refined one, so a link that one set of hyperplanes cuts apart has another chance in each round: with the number of
trees chosen, a lone pair at the threshold is missed by one graph with a chance of 1 in 20, and by all of r + 1 with 1 in
20^(r+1). The rounds go on, with longer lists and more visits where the audit fails, until every class reaches ``recall`` and a
round adds next to none to any class; there are two rounds at least. Only if the last round still fails are all vectors compared
with all (``all_pairs``), with a warning.

All similarities are cosines in double precision of the vectors as given. Only links at or above the threshold are kept at the
end.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing and are their own
component; shorter vectors count as filled up with zeros; repeated rows are rows of their own and link with each other; a null
id belongs to the component but never names it, and names itself null; an empty table gives no rows; only the id and the
embedding are read.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merch.llm.common import KEY, keyed, vectors
from merch.llm.components import components
from merch.session import stage_path, staged

THRESHOLD = 0.95
K = 8
TREES = 4
BLOCK = 256
VISITS = 4
ROUNDS = 8
AUDIT = 256
RECALL = 0.995
CHUNK = 4096
SETTLED = 0.0005
SEED = 1

LISTS = "u bigint, ids array<bigint>, sims array<double>"


def unpack(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype="<f8").reshape(len(blobs), -1) if len(blobs) else np.zeros((0, 1))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(u, copies, vec): each distinct usable vector, its smallest place among its rows, and its unit vector as bytes."""
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0

    def units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, good = vectors(batch["embedding"])
            full = np.zeros((len(found), max(width, 1)))
            full[:, : found.shape[1]] = found
            top = np.abs(full).max(axis=1)
            good &= top > 0
            # first by the largest component, so that squares neither overflow nor vanish
            scaled = full / np.where(good, top, 1)[:, None]
            unit = scaled / np.where(good, np.linalg.norm(scaled, axis=1), 1)[:, None]
            kept = np.flatnonzero(good)
            yield batch.iloc[kept][["u", "copies"]].assign(vec=[unit[i].tobytes() for i in kept])

    same = rows.groupBy("embedding").agg(F.min("row").alias("u"), F.count(F.lit(1)).alias("copies"))
    return same.where("embedding IS NOT NULL").select("u", "copies", "embedding").mapInPandas(units, "u bigint, copies bigint, vec binary")


def keep_best(u: np.ndarray, v: np.ndarray, s: np.ndarray, k: int, threshold: float) -> pd.DataFrame:
    """Lists of each u: distinct v by falling similarity, the k best and all that reach the threshold."""
    by = np.lexsort((v, u))
    u, v, s = u[by], v[by], s[by]
    new = np.ones(len(u), dtype=bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    u, v, s = u[new], v[new], s[new]
    by = np.lexsort((v, -s, u))
    u, v, s = u[by], v[by], s[by]
    firsts = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]])) if len(u) else np.zeros(0, np.int64)
    rank = np.arange(len(u)) - np.repeat(firsts, np.diff(np.append(firsts, len(u))))
    keep = (rank < k) | (s >= threshold)
    u, v, s = u[keep], v[keep], s[keep]
    firsts = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]])) if len(u) else np.zeros(0, np.int64)
    lists = lambda x: pd.Series(np.split(x, firsts[1:]) if len(u) else [], dtype=object)
    return pd.DataFrame({"u": u[firsts], "ids": lists(v), "sims": lists(s)})


def merge(lists: DataFrame, k: int, threshold: float) -> DataFrame:
    """One list per vector out of several; a list streams through its task sorted by vector."""

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch])
            last = frame["u"].iloc[-1]
            done, rest = frame[frame["u"] != last], frame[frame["u"] == last]
            if len(done):
                yield best(done)
        if rest is not None:
            yield best(rest)

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame["ids"].map(len).to_numpy()
        return keep_best(np.repeat(frame["u"].to_numpy(), sizes), np.concatenate(frame["ids"].to_list()), np.concatenate(frame["sims"].to_list()), k, threshold)

    return lists.repartition("u").sortWithinPartitions("u").mapInPandas(join, LISTS)


def first_graph(nodes: DataFrame, width: int, *, k: int, threshold: float, trees: int, block: int, seed: int) -> DataFrame:
    """Lists from blocks of vectors with like signatures, once for each of ``trees`` sets of hyperplanes.

    Sorting by (signature, hash) cuts even blocks whatever the signatures are, so no block and no task is hot.
    """
    planes = np.random.default_rng(seed).normal(size=(trees, width, 24))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = unpack(batch["vec"].tolist())
            for t in range(trees):
                bits = (x @ planes[t] > 0) @ (1 << np.arange(24, dtype=np.int64))[::-1]
                yield batch[["u", "vec"]].assign(tree=np.int32(t), bits=bits)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch])
            while len(held) >= 2 * block:
                yield from inside(held.iloc[:block])
                held = held.iloc[block // 2 :]  # half a block overlaps, so that neighbours are not cut apart
        if held is not None:
            for at in range(0, max(len(held) - block // 2, 1), block // 2):
                yield from inside(held.iloc[at : at + block])

    def inside(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for _, part in frame.groupby("tree", sort=False):
            if len(part) < 2:
                continue
            x, u = unpack(part["vec"].tolist()), part["u"].to_numpy()
            s = x @ x.T
            np.fill_diagonal(s, -2)
            n = min(k, len(u) - 1)
            near = np.zeros(s.shape, dtype=bool)
            np.put_along_axis(near, np.argpartition(-s, n - 1, axis=1)[:, :n], True, axis=1)
            a, b = np.nonzero(near | (s >= threshold))
            yield keep_best(u[a], u[b], s[a, b], k, threshold)

    signed = nodes.mapInPandas(sign, "u bigint, vec binary, tree int, bits bigint")
    order = [F.col("tree"), F.col("bits"), F.xxhash64("u"), F.col("u")]
    return merge(signed.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(compare, LISTS), k, threshold)


def descend(nodes: DataFrame, graph: DataFrame, round_: int, *, k: int, threshold: float, visits: int) -> DataFrame:
    """One neighbours-of-neighbours round.

    A vector visits its best neighbours and some drawn by a hash, the draw changing with the round. At a pivot the members are
    its list and the visitors stream past them; a pivot with many visitors needs no more memory than its list.
    """
    drawn = F.transform("ids", lambda v: F.struct(F.xxhash64(v, F.col("u"), F.lit(round_)).alias("h"), v.alias("v")))
    some = F.transform(F.slice(F.array_sort(drawn), 1, visits), lambda x: x["v"])
    picks = F.array_distinct(F.concat(F.slice("ids", 1, visits // 2), some))
    worst = F.when(F.size("ids") >= k, F.element_at("sims", k)).otherwise(F.lit(-2.0))
    known = graph.select("u", "ids", picks.alias("picks"), worst.alias("worst")).join(nodes.select("u", "vec"), "u")
    known = staged(known, "known")
    members = known.select(F.col("u").alias("w"), F.explode("ids").alias("v")).join(known.select(F.col("u").alias("v"), "vec", "worst"), "v")
    visitors = known.select(F.explode("picks").alias("w"), F.col("u").alias("v"), "vec", "worst", "ids")
    none = F.array().cast("array<bigint>").alias("ids")
    met = members.select("w", F.lit(0).alias("kind"), "v", "vec", "worst", none).union(visitors.select("w", F.lit(1).alias("kind"), "v", "vec", "worst", "ids"))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivot, members, seen = None, None, []
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            w, kind = batch["w"].to_numpy(), batch["kind"].to_numpy()
            cuts = np.flatnonzero((w[1:] != w[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if w[a] != pivot:
                    pivot, members, seen = w[a], None, []
                part = batch.iloc[a:b]
                if kind[a] == 0:
                    seen.append((part["v"].to_numpy(), unpack(part["vec"].tolist()), part["worst"].to_numpy()))
                    continue
                if members is None:
                    members = tuple(np.concatenate(x) for x in zip(*seen)) if seen else (np.zeros(0, np.int64),) * 3
                ids, x, low = members
                if not len(ids):
                    continue
                who, y, own = part["v"].to_numpy(), unpack(part["vec"].tolist()), part["worst"].to_numpy()
                s = y @ x.T
                new = np.array([~np.isin(ids, np.append(own_ids, me)) for me, own_ids in zip(who, part["ids"])])
                i, j = np.nonzero(new & ((s > own[:, None]) | (s >= threshold)))
                found.append((who[i], ids[j], s[i, j]))
                i, j = np.nonzero(new & ((s > low[None, :]) | (s >= threshold)))
                found.append((ids[j], who[i], s[i, j]))
            if found:
                yield keep_best(*(np.concatenate(x) for x in zip(*found)), k, threshold)

    offers = met.repartition("w").sortWithinPartitions("w", "kind").mapInPandas(meet, LISTS)
    return merge(graph.union(offers), k, threshold)


def trees_for(n: int, *, threshold: float, trees: int, block: int) -> int:
    """Trees that leave one link in twenty outside all common blocks, ``trees`` at least.

    A block of n rows is as narrow as log2(n / block) hyperplanes, each of which a link crosses by its angle.
    """
    together = (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** max(np.log2(max(n, 1) / block), 0)
    return trees if together > 0.999 else max(trees, int(np.ceil(np.log(0.05) / np.log1p(-together))))


def compared_with_all(nodes: DataFrame, chosen: pd.DataFrame, threshold: float) -> DataFrame:
    """Lists of all links of the chosen vectors (u, vec; at most ``CHUNK``), by one pass over all vectors."""
    ids, x = chosen["u"].to_numpy(), unpack(chosen["vec"].tolist())

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch) if len(ids) else 0, 256):
                some = batch.iloc[at : at + 256]
                who = some["u"].to_numpy()
                s = x @ unpack(some["vec"].tolist()).T
                i, j = np.nonzero((s >= threshold) & (ids[:, None] != who[None, :]))
                if len(i):
                    firsts = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
                    lists = lambda y: pd.Series(np.split(y, firsts[1:]), dtype=object)  # noqa: E731, B023
                    yield pd.DataFrame({"u": ids[i[firsts]], "ids": lists(who[j]), "sims": lists(s[i, j])})

    return nodes.select("u", "vec").mapInPandas(near, LISTS)


class Audit:
    """All links of a bounded sample of vectors: ``sample`` of all, and as many of those that a graph links."""

    def __init__(self, nodes: DataFrame, n: int, *, threshold: float, sample: int):
        self.nodes, self.threshold, self.sample = nodes, threshold, sample
        self.path = stage_path(nodes.sparkSession, "truth")
        self._add(nodes.where(self._one_in(n, 0)))

    def _one_in(self, n: int, salt: int):
        """A draw by hash of some ``sample`` out of n."""
        return F.pmod(F.xxhash64("u", F.lit(SEED + salt)), F.lit(max(n // self.sample, 1))) == 0

    def _add(self, some: DataFrame) -> None:
        chosen = some.select("u", "vec").limit(CHUNK).toPandas()  # some ``sample`` vectors
        compared_with_all(self.nodes, chosen, self.threshold).write.mode("append").parquet(self.path)

    def add_linked(self, graph: DataFrame) -> None:
        """Judge vectors with links as well, of each class by their number some."""
        counts = link_counts(graph, self.threshold).where("links > 0").withColumn("class", F.floor(F.log2("links")))
        sizes = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a power of two
        drawn = F.lit(False)
        for class_, n in sizes.items():
            drawn = drawn | ((F.col("class") == class_) & self._one_in(n * len(sizes), 1))
        self._add(self.nodes.join(counts.where(drawn).select("u"), "u", "left_semi"))

    def lists(self) -> DataFrame:
        """One list a vector; a vector drawn twice has the same list twice, and one task's share of its links in each row."""
        rows = self.nodes.sparkSession.read.schema(LISTS).parquet(self.path)
        return rows.select("u", F.explode("ids").alias("v")).distinct()

    def recall(self, graph: DataFrame) -> float:
        """Mean share of a vector's links that the graph has, in the class of vectors where it is least."""
        there = self.lists().groupBy("u").agg(F.count(F.lit(1)).alias("there"))
        share = F.least(F.coalesce("links", F.lit(0)) / F.col("there"), F.lit(1.0))
        return _worst(there.join(link_counts(graph, self.threshold), "u", "left").select("there", share.alias("share")))


def _worst(shares: DataFrame) -> float:
    """The least mean of ``share`` over classes by ``there``; 1 where there is nothing to judge."""
    worst = shares.groupBy(F.floor(F.log2("there")).alias("class")).agg(F.avg("share").alias("share")).agg(F.min("share")).first()[0]
    return 1.0 if worst is None else worst


def linked_ids(graph: DataFrame, threshold: float) -> DataFrame:
    """(u, ids) of the vectors with links."""
    ids = F.transform(F.filter(F.arrays_zip("ids", "sims"), lambda x: x["sims"] >= threshold), lambda x: x["ids"])
    return graph.select("u", ids.alias("ids")).where(F.size("ids") > 0)


def recapture(graph: DataFrame, other: DataFrame, threshold: float) -> float:
    """Mean share of a vector's links in ``other`` that ``graph`` has, in the class of vectors where it is least."""
    held = linked_ids(graph, threshold).withColumnRenamed("ids", "held")
    both = linked_ids(other, threshold).join(held, "u", "left")
    share = F.coalesce(F.size(F.array_intersect("ids", "held")), F.lit(0)) / F.size("ids")
    return _worst(both.select(F.size("ids").alias("there"), F.when(F.col("held").isNull(), F.lit(0.0)).otherwise(share).alias("share")))


def all_pairs(nodes: DataFrame, n: int, threshold: float) -> DataFrame:
    """Lists of all links, all vectors with all, ``CHUNK`` of them at a time: the last step, of n^2 products."""
    path, parts = stage_path(nodes.sparkSession, "all-pairs"), max(-(-n // (CHUNK // 2)), 1)
    for part in range(parts):
        chosen = nodes.where(F.pmod(F.xxhash64("u", F.lit(SEED)), F.lit(parts)) == part).select("u", "vec").toPandas()
        compared_with_all(nodes, chosen, threshold).write.mode("append").parquet(path)
    return nodes.sparkSession.read.schema(LISTS).parquet(path)


def link_counts(graph: DataFrame, threshold: float) -> DataFrame:
    return graph.select("u", F.size(F.filter("sims", lambda s: s >= threshold)).alias("links"))


def still(before: DataFrame, graph: DataFrame, threshold: float) -> bool:
    """Whether in each class of vectors by number of links next to none have gained any."""
    old = link_counts(before, threshold).withColumnRenamed("links", "old")
    both = link_counts(graph, threshold).where("links > 0").join(old, "u", "left")
    gained = F.avg((F.col("links") > F.coalesce("old", F.lit(0))).cast("double"))
    most = both.groupBy(F.floor(F.log2("links")).alias("class")).agg(gained.alias("gained")).agg(F.max("gained")).first()[0]
    return (most or 0) <= SETTLED


def neighbour_graph(
    nodes: DataFrame, width: int, *, threshold: float = THRESHOLD, k: int = K, trees: int = TREES, block: int = BLOCK, visits: int = VISITS,
    rounds: int = ROUNDS, recall: float = RECALL, sample: int = AUDIT, seed: int = SEED,
) -> DataFrame:
    """(u, ids, sims): neighbour lists of the distinct vectors, refined until the audit is content."""
    n = nodes.count()
    trees = trees_for(n, threshold=threshold, trees=trees, block=block)
    audit = Audit(nodes, n, threshold=threshold, sample=sample)
    begun = lambda i: staged(first_graph(nodes, width, k=k, threshold=threshold, trees=trees, block=block, seed=seed + i), "graph")
    graph, content = begun(0), False
    for round_ in range(rounds):
        before, graph = graph, staged(descend(nodes, graph, round_, k=k, threshold=threshold, visits=visits), "graph")
        other = begun(round_ + 1)
        found_again = recapture(graph, other, threshold)
        graph = staged(merge(graph.union(other), k, threshold), "graph")
        if not round_:
            audit.add_linked(graph)
            continue
        content = found_again >= recall and audit.recall(graph) >= recall
        if content and still(before, graph, threshold):
            return graph
        if not content and round_ > 1:  # the graph is too coarse: longer lists and more visits
            k, visits = min(2 * k, max(n, 1)), min(2 * visits, max(n, 1))
    if content:
        return graph
    warnings.warn(f"{rounds} rounds of NN-descent did not reach a recall of {recall}: comparing all of {n} vectors with all", stacklevel=2)
    return staged(merge(all_pairs(nodes, n, threshold), k, threshold), "graph")


def near_vectors(embeddings: DataFrame, *, ident: str = "vec_id", threshold: float = THRESHOLD, **options) -> DataFrame:
    """key, vec_id, n_links, component_id, kept for every row."""
    rows = keyed(embeddings, {"vec_id": F.col(ident), "embedding": F.col("embedding")})
    rows = staged(rows.withColumn("row", F.xxhash64(*KEY)), "rows")
    nodes = staged(distinct_vectors(rows), "nodes")
    width = len(bytes((nodes.select("vec").first() or [b"\0" * 8])[0])) // 8
    graph = neighbour_graph(nodes, width, threshold=threshold, **options)

    links = staged(linked_ids(graph, threshold), "links")
    copies = nodes.select(F.col("u").alias("v"), "copies")
    counted = links.select("u", F.explode("ids").alias("v")).join(copies, "v").groupBy("u").agg(F.sum("copies").alias("others"))
    # v and the smallest of u's list and u: as connected as all links, and far fewer
    least = F.least(F.array_min("ids"), F.col("u"))
    edges = links.select(F.explode(F.concat("ids", F.array("u"))).alias("a"), least.alias("b")).distinct()
    groups = components(edges)
    classes = (
        nodes.select("u", "copies")
        .join(counted, "u", "left")
        .join(groups.withColumnRenamed("node", "u"), "u", "left")
        .select("u", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "u").alias("root"))
    )
    classes = staged(classes, "classes")
    # rows of a distinct vector share it; unusable vectors have no node
    owner = rows.groupBy("embedding").agg(F.min("row").alias("u"))
    named = rows.join(owner.withColumnRenamed("embedding", "_e"), F.col("embedding") == F.col("_e"), "left").join(classes, "u", "left")
    named = staged(named.select(*KEY, "vec_id", "row", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "row").alias("root")), "named")
    smallest = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return named.join(smallest, "root").select(
        *KEY, "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
