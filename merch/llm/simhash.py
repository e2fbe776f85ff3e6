"""SimHash near copies by BK-trees.

``fingerprints`` gives every text its 64-bit SimHash over word shingles. ``near_links`` finds a spanning set of the links
between distinct fingerprints that differ in at most ``radius`` bits: the 64 bits are cut into radius + 2 blocks, and since at
most ``radius`` blocks can differ, two linked fingerprints agree on at least two blocks; so each pair of blocks deals the
fingerprints to shards of equal bits, and a linked pair meets in a shard. Each shard is a BK-tree, whose children are keyed by
their distance to the parent; a search follows only the edges within the radius. A shard is a tree of its own, so trees go to
the task that has the shard instead of to all of them; a shard beyond ``shard_size`` is cut into chunks and every chunk's tree
is sent to the chunks after it, so no task holds more than two chunks.

Defined cases: null and blank texts have fingerprint 0 and are linked like any other; fewer words than a shingle make one
shingle; repeated rows share a fingerprint; a null id belongs to its group and is its representative only if all ids are null;
ties are settled by the smallest id; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merch.llm.common import KEY, give_back, keyed, lower_ascii, text_batches, text_or_empty
from merch.llm.components import components
from merch.session import staged

SHINGLE, RADIUS = 4, 4
SEED = 42
SHARD_SIZE = 20_000


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit j is set when more than half of the shingles' XXH64 have it."""
    words = lower_ascii(text).split()
    if not words:
        return 0
    whole = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(whole, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(whole[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())], dtype=np.uint64)
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):  # bounded scratch for very long texts
        part = hashes[at : at + (1 << 16)]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE) -> DataFrame:
    """key, doc_id and the fingerprint as a signed long, for every row."""

    @F.pandas_udf("bigint")
    def finger(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([simhash(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
        give_back()

    rows = keyed(docs, {"doc_id": F.col("doc_id"), "text": text_or_empty()})
    return rows.select(*KEY, "doc_id", finger("text").alias("fp"))


class BKTree:
    """Children are keyed by their integer Hamming distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at, new = 0, len(self.values)
        self.values.append(value)
        self.children.append({})
        if not new:
            return
        while True:
            distance = (self.values[at] ^ value).bit_count()
            nearer = self.children[at].get(distance)
            if nearer is None:
                self.children[at][distance] = new
                return
            at = nearer

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Positions of the values at most ``radius`` bits away."""
        stack = [0] if self.values else []
        while stack:
            at = stack.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                yield at
            for key, child in self.children[at].items():
                if distance - radius <= key <= distance + radius:
                    stack.append(child)


class Forest:
    """Union-find that remembers only the links which joined two groups."""

    def __init__(self):
        self.up: list[int] = []
        self.links: list[tuple[int, int]] = []

    def node(self) -> None:
        self.up.append(len(self.up))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.links.append((x, y))
        return a != b


def shard_links(own: list[int], other: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside ``own`` (when ``other`` is empty) or between the two."""
    tree, forest = BKTree(), Forest()
    values = own + other
    for at, value in enumerate(values):
        forest.node()
        if at < len(own):
            if not other:
                for near in tree.within(value, radius):
                    forest.join(near, at)
            tree.add(value)
        else:
            for near in tree.within(value, radius):
                forest.join(near, at)
    return [(values[a], values[b]) for a, b in forest.links]


def block_masks(radius: int) -> list[int]:
    """For every pair of the radius + 2 blocks of the 64 bits, the mask of both."""
    blocks = radius + 2
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(bounds, bounds[1:])]
    return [a | b for a, b in combinations(single, 2)]


def near_links(distinct: DataFrame, *, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints (column fp) which are connected at ``radius``."""
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(radius)]
    dealt = distinct.select(
        F.col("fp"),
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("bigint")) for m in signed])).alias("block", "bits"),
    )
    shard = ["block", "bits"]
    large = staged(
        dealt.groupBy(*shard).count().where(F.col("count") > shard_size).select(*shard, F.ceil(F.col("count") / shard_size).cast("int").alias("chunks")), "large"
    )
    dealt = dealt.join(large, shard, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    # a cell (i, j) has chunk i as its tree and chunk j as its searches; (i, i) is chunk i within itself
    tree_side = F.transform(F.sequence(mine, F.col("chunks") - 1), lambda j: F.struct(mine.alias("i"), j.alias("j"), F.lit(0).alias("side")))
    search_side = F.transform(F.sequence(F.lit(0), mine), lambda i: F.struct(i.alias("i"), mine.alias("j"), F.lit(1).alias("side")))
    cells = dealt.select("fp", *shard, F.explode(F.concat(tree_side, F.filter(search_side, lambda c: c["i"] < c["j"]))).alias("cell"))
    cells = cells.select("fp", *shard, "cell.i", "cell.j", "cell.side")
    cell = [*shard, "i", "j"]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by cell; a cell may go on in the next batch."""
        key, own, other = None, [], []
        for batch in batches:
            links: list[tuple[int, int]] = []
            columns = [batch[c].to_numpy() for c in cell]
            fresh = np.zeros(len(batch), dtype=bool)
            fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0) if len(batch) > 1 else False
            values, sides = batch["fp"].to_numpy().view(np.uint64), batch["side"].to_numpy()
            bounds = [0, *np.flatnonzero(fresh).tolist(), len(batch)]
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                now = tuple(int(c[a]) for c in columns)
                if now != key:
                    if len(own) + len(other) > 1:
                        links += shard_links(own, other, radius)
                    key, own, other = now, [], []
                if b - a > 1 or own:
                    own += values[a:b][sides[a:b] == 0].tolist()
                    other += values[a:b][sides[a:b] == 1].tolist()
                else:
                    (own if sides[a] == 0 else other).append(int(values[a]))
            yield pd.DataFrame(np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])
        if len(own) + len(other) > 1:
            yield pd.DataFrame(np.array(shard_links(own, other, radius), dtype=np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])
        give_back()

    return cells.repartition(*[F.col(c) for c in cell]).sortWithinPartitions(*cell, "side", "fp").mapInPandas(search, "a bigint, b bigint").distinct()


def near_copies(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """key, doc_id, fp, component_id, kept (one row of each group) for every row."""
    with text_batches(docs.sparkSession):
        rows = staged(fingerprints(docs, shingle=shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *KEY))
    distinct = staged(rows.groupBy("fp").agg(first.alias("first")), "distinct")
    groups = components(near_links(distinct.select("fp"), radius=radius, shard_size=shard_size))
    named = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    chosen = named.groupBy("root").agg(F.min("first").alias("chosen"))
    classes = staged(named.select("fp", "root").join(chosen, "root").select("fp", "chosen"), "classes")
    same = F.lit(True)
    for k in KEY:
        same = same & (F.col(k) == F.col(f"chosen.{k}"))
    return rows.join(classes, "fp").select(*KEY, "doc_id", "fp", F.col("chosen.doc_id").alias("component_id"), same.alias("kept"))
