"""Exact top-k by inner product with an M-tree.

Inner products become distances by one more coordinate: with M the largest norm, a vector x gets sqrt(M^2 - |x|^2) and a query
0, so |q - x|^2 = |q|^2 + M^2 - 2 q.x, and the nearest vectors are those of the largest product. The tree's upper nodes are a
table: the vectors of a node beyond ``shard_rows`` are dealt to the nearest of up to ``PIVOTS`` pivots of its own, level by level,
and every node keeps its pivot and the covering radius of all vectors below it. A node that its pivots hardly divide (vectors
all alike) is cut evenly. Each leaf is a shard, an M-tree of pages: an entry has its object, the distance to its parent and, in
an inner page, a covering radius. A query searches its own shard first, then, with the k-th product found so far, the
``NEAREST`` shards of least distance, then every shard that the nodes' bounds do not exclude. In a shard, pages are opened
best-first, and an entry whose stored distances exclude it is passed over without computing its distance.

Components are floored to integers after scaling. Where the largest squared norm is below 2^53 all products are exact in
doubles; otherwise doubles scaled by a power of two only choose what may be among the best, and those products are computed
again in whole numbers of any size. Distances only decide what is passed over and are given a small margin.

Defined cases: vectors that are null or hold null or non-finite components are neither candidates nor queries; empty vectors are
zero and shorter ones count as filled up with zeros; equal products go to the smaller id; repeated rows are candidates each, but
a query's own row is not; a query with fewer candidates than k gets all; null ids are candidates of last rank and never
queries; finite components may be of any size, and a score beyond 64 bits is null at its right rank; an empty table gives no
rows; only the id and the embedding are read.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merch.llm.common import KEY, keyed, text_batches, vectors
from merch.session import staged

SCALE = 256
TOP = 5
PAGE = 64
SHARD_ROWS = 4096
PIVOTS = 64
NEAREST = 4
LEVELS = 8
#: A part of this size of a node means that its pivots hardly divide it.
ALIKE = 0.9
#: Doubles from here on are whole numbers.
WHOLE = 2.0**53
QUERY_BLOCK = 512
SEED = 10


def whole_vectors(rows: DataFrame, scale: int, width: int) -> DataFrame:
    """(row, id, x, norm, top): floor(scale * component) of every usable vector as bytes, its squared norm and largest size.

    The bytes are 32-bit integers, or doubles where these do not hold a component; a value that scaling would take beyond the
    doubles keeps its own size, as all its digits are whole: see ``exactly``.
    """

    def floor(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, good = vectors(batch["embedding"])
            full = np.zeros((len(found), max(width, 1)))
            full[:, : found.shape[1]] = np.where(np.abs(found) < WHOLE, np.floor(np.where(np.abs(found) < WHOLE, found, 0) * scale) / scale, found)
            kept = np.flatnonzero(good)
            top = np.abs(full[kept]).max(axis=1, initial=0)
            small = top < 2**31 / scale - 1
            blobs = [(np.rint(full[i] * scale).astype("<i4") if s else full[i].astype("<f8")).tobytes() for i, s in zip(kept, small)]
            norm = (np.where(small[:, None], full[kept], 0) ** 2).sum(axis=1) * float(scale) ** 2
            yield batch.iloc[kept][["row", "id"]].assign(x=blobs, norm=np.where(small, norm, np.inf), top=top)

    return rows.mapInPandas(floor, "row bigint, id string, x binary, norm double, top double")


def matrix(blobs, width: int, scale: int, shift: int = 0) -> np.ndarray:
    """The whole vectors as doubles, times 2^-shift."""
    out = np.zeros((len(blobs), width))
    for i, blob in enumerate(blobs):
        if len(blob) == 4 * width:
            out[i] = np.frombuffer(blob, dtype="<i4") if not shift else np.ldexp(np.frombuffer(blob, dtype="<i4").astype(float), -shift)
        else:
            out[i] = np.ldexp(np.frombuffer(blob, dtype="<f8"), -shift) * scale
    return out


def exactly(blob, width: int, scale: int) -> list[int]:
    """The whole vector in Python integers."""
    if len(blob) == 4 * width:
        return np.frombuffer(blob, dtype="<i4").tolist()
    return [int(v) * scale if abs(v) >= WHOLE else round(v * scale) for v in np.frombuffer(blob, dtype="<f8").tolist()]


class Metric:
    """Distances in the space with the additional coordinate."""

    def __init__(self, limit: float, slack: float = 0.0):
        self.limit = limit  # M^2
        self.slack = slack  # how far a computed product may be off; 0 where products are exact
        self.margin = 1e-6 * (1 + np.sqrt(limit)) + 4 * np.sqrt(slack)

    def height(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.limit - (x * x).sum(axis=1), 0))

    def between(self, x: np.ndarray, hx: np.ndarray, y: np.ndarray, hy: np.ndarray) -> np.ndarray:
        square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T + (hx[:, None] - hy[None, :]) ** 2
        return np.sqrt(np.maximum(square, 0))

    def of_product(self, norm: float, product):
        return np.sqrt(np.maximum(norm + self.limit - 2 * product, 0))

    def reach(self, norm: float, product):
        """The distance beyond which no product is as large as ``product``."""
        return self.of_product(norm, product - self.slack) + self.margin


class MTree:
    """Paged nodes in flat arrays: page p holds the entries first[p] .. first[p + 1].

    An entry has an object, its distance to the page's routing object, and for inner pages a radius and a child page.
    """

    FIELDS = ("objects", "heights", "ids", "first", "leaf", "entry", "to_parent", "radius", "child")

    @classmethod
    def build(cls, metric: Metric, x: np.ndarray, ids: np.ndarray, page: int = PAGE) -> MTree:
        """Bulk load: a set beyond a page is split around spread-out objects, each part below its own routing entry."""
        tree = cls()
        tree.objects, tree.ids, tree.heights = x, ids, metric.height(x)
        pages: list[tuple | None] = []

        def load(members: np.ndarray, parent: int | None) -> int:
            number = len(pages)
            pages.append(None)
            far = np.zeros(len(members)) if parent is None else metric.between(x[[parent]], tree.heights[[parent]], x[members], tree.heights[members])[0]
            if len(members) <= page:
                pages[number] = (True, members, far, np.zeros(len(members)), np.full(len(members), -1))
                return number
            ways = min(page, -(-len(members) // page) + 1)
            pivots = members[np.linspace(0, len(members) - 1, ways).astype(np.int64)]
            near = metric.between(x[members], tree.heights[members], x[pivots], tree.heights[pivots])
            own = near.argmin(axis=1)
            if np.bincount(own).max() > 0.9 * len(members):
                own = np.arange(len(members)) * ways // len(members)  # nearly all alike: an even split does as well
            parts = [(pivots[i], members[own == i], near[own == i, i].max()) for i in range(len(pivots)) if (own == i).any()]
            children = [load(some, pivot) for pivot, some, _ in parts]
            routing = np.array([p for p, _, _ in parts])
            at = np.zeros(len(routing)) if parent is None else metric.between(x[[parent]], tree.heights[[parent]], x[routing], tree.heights[routing])[0]
            pages[number] = (False, routing, at, np.array([r for _, _, r in parts]), np.array(children))
            return number

        load(np.arange(len(x)), None)
        tree.first = np.cumsum([0] + [len(p[1]) for p in pages])
        tree.leaf = np.array([p[0] for p in pages])
        tree.entry, tree.to_parent, tree.radius, tree.child = (np.concatenate([p[i] for p in pages]) for i in (1, 2, 3, 4))
        return tree

    def save(self, blobs: list[bytes]) -> bytes:
        """The tree with the vectors as they are in ``blobs``."""
        out = io.BytesIO()
        held = {f: getattr(self, f) for f in self.FIELDS}
        sizes = np.array([len(b) for b in blobs], dtype=np.int64)
        np.savez(out, **held | {"objects": np.frombuffer(b"".join(blobs), dtype=np.uint8), "sizes": sizes, "ids": np.array(self.ids, dtype="U")})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes, width: int, scale: int, shift: int) -> MTree:
        tree = cls()
        with np.load(io.BytesIO(data)) as held:
            for f in cls.FIELDS:
                setattr(tree, f, held[f])
            ends = np.cumsum(held["sizes"])
        stored = tree.objects.tobytes()
        tree.blobs = [stored[e - n : e] for e, n in zip(ends.tolist(), np.diff(ends, prepend=0).tolist())]
        tree.objects = matrix(tree.blobs, width, scale, shift)
        return tree

    def search(self, metric: Metric, q: np.ndarray, own, k: int, floor: float, rank, score=None) -> tuple[list[tuple], int]:
        """The k best (product, id, object) with a product of at least ``floor``, best-first; and the distances computed.

        ``score`` gives (exact product, the same as a double) of an entry where doubles are not exact.
        """
        norm = float(q @ q)
        best: list[tuple] = []  # the worst first: product, then the later id
        reach = metric.reach(norm, floor) if floor > -np.inf else np.inf
        low = floor  # as a double: the k-th product or the floor
        waiting = [(0.0, 0, None)]  # lower bound, page, distance to the page's routing object
        computed = 0
        while waiting:
            bound, page, above = heapq.heappop(waiting)
            if bound > reach:
                break
            a, b = self.first[page], self.first[page + 1]
            entry, radius = self.entry[a:b], self.radius[a:b]
            if above is not None:  # stored distances exclude what is too far without computing it
                kept = np.flatnonzero(np.abs(above - self.to_parent[a:b]) - radius <= reach)
                if not len(kept):
                    continue
                entry, radius = entry[kept], radius[kept]
            else:
                kept = np.arange(b - a)
            products = self.objects[entry] @ q
            computed += len(entry)
            if self.leaf[page]:
                for i in np.flatnonzero(products >= low - 2 * metric.slack).tolist():
                    if self.ids[entry[i]] == own:
                        continue
                    value, near = score(entry[i]) if score else (float(products[i]),) * 2
                    item = (value, rank(self.ids[entry[i]]), int(entry[i]), near)
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                if len(best) == k:
                    low = max(low, best[0][3])
                    reach = min(reach, metric.reach(norm, best[0][3]))
            else:
                far = metric.of_product(norm, products)
                lower = np.maximum(far - radius, 0)
                for i in np.flatnonzero(lower <= reach).tolist():
                    heapq.heappush(waiting, (float(lower[i]), int(self.child[a + kept[i]]), float(far[i])))
        return best, computed

    def search_all(self, metric: Metric, q: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``search`` for many queries (rows of ``q``) where products are exact: objects and products of the k best, and the distances computed.

        A page is opened once for all queries that its bound does not exclude, and its products are one matrix product. ``place``
        ranks the objects: of equal products the larger place is better. Free spots have object -1.
        """
        norm = (q * q).sum(axis=1)
        low = floor.astype(float)
        unlimited = np.isneginf(low)
        reach = np.where(unlimited, np.inf, metric.reach(norm, np.where(unlimited, 0, low)))
        best, score = np.full((len(q), k), -1), np.full((len(q), k), -np.inf)
        computed = np.zeros(len(q), dtype=np.int64)
        every = np.arange(len(q))
        waiting = [(0.0, 0, 0, every, None, np.zeros(len(q)))]  # least bound, turn, page, queries, their distances to its object, their bounds
        turn = 0
        while waiting:
            _, _, page, who, above, bound = heapq.heappop(waiting)
            here = np.flatnonzero(bound <= reach[who])
            if not len(here):
                continue
            who = who[here]
            a, b = self.first[page], self.first[page + 1]
            entry, radius, child = self.entry[a:b], self.radius[a:b], self.child[a:b]
            if above is None:
                wanted = np.ones((len(who), len(entry)), dtype=bool)
            else:  # stored distances exclude what is too far without computing it
                wanted = np.abs(above[here][:, None] - self.to_parent[a:b]) - radius <= reach[who][:, None]
            products = np.full(wanted.shape, -np.inf)
            if 2 * np.count_nonzero(wanted) >= wanted.size:
                computed[who] += len(entry)
                products = np.where(wanted, q[who] @ self.objects[entry].T, -np.inf)
            else:
                computed[who] += np.count_nonzero(wanted, axis=1)
                at, of = np.nonzero(wanted)
                products[at, of] = np.einsum("ij,ij->i", q[who[at]], self.objects[entry[of]])
            if self.leaf[page]:
                products[self.ids[entry][None, :] == own[who][:, None]] = -np.inf
                products[products < low[who][:, None]] = -np.inf
                some = np.flatnonzero(products.max(axis=1, initial=-np.inf) > -np.inf)
                if not len(some):
                    continue
                who = who[some]
                values = np.concatenate([score[who], products[some]], axis=1)
                objects = np.concatenate([best[who], np.broadcast_to(entry, (len(some), len(entry)))], axis=1)
                top = np.lexsort((place[objects], values), axis=-1)[:, -k:]
                score[who] = np.take_along_axis(values, top, axis=1)
                best[who] = np.where(np.isneginf(score[who]), -1, np.take_along_axis(objects, top, axis=1))
                full = who[score[who, 0] > -np.inf]
                low[full] = np.maximum(low[full], score[full, 0])
                reach[full] = np.minimum(reach[full], metric.reach(norm[full], score[full, 0]))
            else:
                far = metric.of_product(norm[who][:, None], np.where(wanted, products, 0))
                lower = np.maximum(far - radius, 0)
                open_ = wanted & (lower <= reach[who][:, None])
                for i in np.flatnonzero(open_.any(axis=0)).tolist():
                    at, turn = np.flatnonzero(open_[:, i]), turn + 1
                    heapq.heappush(waiting, (float(lower[at, i].min()), turn, int(child[i]), who[at], far[at, i], lower[at, i]))
        return best, score, computed


def id_rank(text: str) -> tuple:
    """Sorts so that the better of equal products is the larger: smaller numbers first, other ids by text, null last."""
    try:
        return (2, -int(text), "")
    except ValueError:
        return (1, 0, "".join(chr(0x10FFFF - ord(c)) for c in text)) if text else (0, 0, "")


def in_turn(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, list[pd.DataFrame], pd.DataFrame]]:
    """(key, held rows, asking rows) of each key in turn; held rows come first and stay for the key's later batches."""
    key, held = None, []
    for batch in batches:
        for own, some in batch.groupby(keys, sort=False):
            if own != key:
                key, held = own, []
            if (some["kind"] == 0).any():
                held.append(some[some["kind"] == 0])
            asking = some[some["kind"] == 1]
            if len(asking):
                yield key, held, asking


def meet(held: DataFrame, asking: DataFrame, keys: list[str], use, schema: str) -> DataFrame:
    """Sends the few held rows of every key to the task that its asking rows stream through."""
    both = held.withColumn("kind", F.lit(0)).unionByName(asking.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    both = both.fillna(0, [c for c in ("row", "slot", "pieces", "node", "home", "place") if c in both.columns])
    return both.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInPandas(use, schema)


def root() -> Column:
    """The root node's number 0, as a column that stays a key of joins: a literal would turn them into nested loops."""
    return F.pmod(F.col("row"), F.lit(1)).cast("bigint")


class Shards:
    """The vectors dealt to shards: the upper nodes of the tree as a table, and a paged tree for each leaf.

    ``nodes`` has (parent, node, x, radius, pieces): ``pieces`` is 0 for an inner node, else the number of shards of the leaf, 1
    but for nodes that cannot be divided. ``rows`` has (row, id, x, node, piece).
    """

    def __init__(self, whole: DataFrame, width: int, scale: int, shard_rows: int, page: int):
        self.width, self.scale = max(width, 1), scale
        limit, top = whole.agg(F.max("norm"), F.max("top")).first()
        self.exact = float(limit or 0) < 2.0**53
        self.shift = 0 if self.exact else int(np.frexp(top)[1]) + int(np.ceil(np.log2(scale)))
        self.metric = Metric(float(limit or 0)) if self.exact else Metric(float(self.width), self.width * (self.width + 8) * 2.0**-52)
        self.matrix = partial(matrix, width=self.width, scale=scale, shift=self.shift)
        self._deal(whole.select("row", "id", "x"), shard_rows)
        self._build(page)

    def _deal(self, rows: DataFrame, shard_rows: int) -> None:
        unpack, metric = self.matrix, self.metric
        waiting = rows.withColumn("node", root())
        sizes = waiting.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        ended, nodes = [], []

        def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            last, held = None, None
            for key, pivots, some in in_turn(batches, ["node", "salt"]):
                if key != last:
                    last, table = key, pd.concat(pivots)
                    at, slots = unpack(table["x"].tolist()), table["slot"].to_numpy()
                    held = at, metric.height(at), slots
                at, heights, slots = held
                x = unpack(some["x"].tolist())
                far = metric.between(x, metric.height(x), at, heights)
                own = far.argmin(axis=1)
                child = (some["node"].to_numpy() + 1) * PIVOTS + slots[own]
                yield some[["row", "id", "x"]].assign(parent=some["node"], node=child, far=far[np.arange(len(x)), own])

        for level in range(LEVELS):
            ways = F.when(F.col("n") <= shard_rows, 1).otherwise(F.least(F.lit(PIVOTS), F.ceil(F.col("n") / shard_rows) + 1)).cast("int")
            salts = F.ceil(F.col("n") / (16 * shard_rows)).cast("int")
            large = staged(sizes.select("node", ways.alias("ways"), salts.alias("salts"), F.col("n").alias("whole")), "sizes")
            known = waiting.join(large, "node")
            slot = F.pmod(F.xxhash64("row", F.lit(SEED + level)), F.col("ways")).cast("int")
            pivots = known.groupBy("node", slot.alias("slot")).agg(F.min_by("x", F.xxhash64("row", F.lit(SEED))).alias("x"))
            pivots = staged(pivots, "pivots")
            held = pivots.join(large.select("node", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")), "node")
            salt = F.pmod(F.xxhash64("row"), F.col("salts")).cast("int")
            dealt = meet(held, known.select("node", salt.alias("salt"), "row", "id", "x"), ["node", "salt"], deal, "row bigint, id string, x binary, parent bigint, node bigint, far double")
            dealt = staged(dealt, "dealt")
            counts = dealt.groupBy("parent", "node").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"))
            counts = counts.join(large.select(F.col("node").alias("parent"), "whole"), "parent")
            last = F.lit(level == LEVELS - 1)
            pieces = F.when(F.col("n") <= shard_rows, 1).when(last | (F.col("n") > ALIKE * F.col("whole")), F.ceil(F.col("n") / shard_rows)).otherwise(0)
            known = staged(counts.withColumn("pieces", pieces.cast("int")), "counts")
            at = pivots.select(((F.col("node") + 1) * PIVOTS + F.col("slot")).alias("node"), "x")
            nodes.append(known.join(at, "node").select("parent", "node", "x", "radius", "pieces"))
            placed = dealt.join(known.select("node", "n", "pieces"), "node")
            piece = F.pmod(F.xxhash64("row", F.lit("piece")), F.col("pieces")).cast("int")
            ended.append(placed.where("pieces > 0").select("row", "id", "x", "node", piece.alias("piece")))
            sizes = known.where("pieces = 0").select("node", "n")
            if sizes.isEmpty():
                break
            waiting = placed.where("pieces = 0").select("row", "id", "x", "node")
        self.levels = len(nodes)
        self.nodes = staged(reduce(DataFrame.union, nodes), "nodes")
        self.rows = staged(reduce(DataFrame.union, ended), "sharded")

    def _build(self, page: int) -> None:
        unpack, metric = self.matrix, self.metric

        def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            ids = np.array([f"{i}\t{r}" for i, r in zip(frame["id"], frame["row"])])
            blobs = [bytes(x) for x in frame["x"]]
            tree = MTree.build(metric, unpack(blobs), ids, page)
            return pd.DataFrame([(int(key[0]), int(key[1]), tree.save(blobs))], columns=["node", "piece", "tree"])

        self.trees = staged(self.rows.groupBy("node", "piece").applyInPandas(build, "node bigint, piece int, tree binary"), "trees")

    def visit(self, pairs: DataFrame, k: int) -> DataFrame:
        """(query, query_id, vec, score, product, computed) of queries met with shards: each shard's tree is sent once to every block.

        One row of each pair has no vec and holds the number of distances computed.
        """
        width, scale, shift, exact, metric = self.width, self.scale, self.shift, self.exact, self.metric

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            last, tree, texts, order, place = None, None, [], {}, None
            for key, held, some in in_turn(batches, ["node", "piece", "block"]):
                if key != last:
                    last, tree = key, MTree.load(bytes(held[0]["tree"].iloc[0]), width, scale, shift)
                    names = [t.split("\t") for t in tree.ids.tolist()]
                    texts = [i for i, _ in names]
                    tree.ids = np.array([int(r) for _, r in names], dtype=np.int64)
                    order = {int(r): (*id_rank(i), -int(r)) for i, r in names}
                    place = np.empty(len(names), dtype=np.int64)
                    place[sorted(range(len(names)), key=[order[int(r)] for _, r in names].__getitem__)] = np.arange(len(names))
                out = []
                if exact:
                    asked = [some[c].to_numpy() for c in ("row", "id", "floor")]
                    found = tree.search_all(metric, matrix(some["x"].tolist(), width, scale, shift), asked[0], k, asked[2], place)
                    for row, ident, objects, products, computed in zip(*asked[:2], *found):
                        out.append((row, ident, None, None, None, computed))
                        out += [(row, ident, texts[e], str(int(p)), p, 0) for e, p in zip(objects.tolist(), products.tolist()) if e >= 0]
                    yield pd.DataFrame(out, columns=["query", "query_id", "vec", "score", "product", "computed"])
                    continue
                for row, ident, x, floor in zip(*(some[c] for c in ("row", "id", "x", "floor"))):
                    q = exactly(x, width, scale)

                    def score(entry, q=q):
                        whole = sum(a * b for a, b in zip(q, exactly(tree.blobs[entry], width, scale)))
                        return whole, whole / (1 << 2 * shift)

                    best, computed = tree.search(metric, matrix([x], width, scale, shift)[0], row, k, floor, order.__getitem__, score)
                    out.append((row, ident, None, None, None, computed))
                    out += [(row, ident, texts[entry], str(int(value)), near, 0) for value, _, entry, near in best]
                yield pd.DataFrame(out, columns=["query", "query_id", "vec", "score", "product", "computed"])

        met = pairs.select("node", "piece", "block").distinct().join(self.trees, ["node", "piece"])
        asking = pairs.select("node", "piece", "block", "row", "id", "x", "floor")
        return meet(met, asking, ["node", "piece", "block"], search, "query bigint, query_id string, vec string, score string, product double, computed bigint")

    def route(self, known: DataFrame) -> DataFrame:
        """Queries with every shard that the bounds of the nodes do not exclude, less the one they are in; and the shard's bound."""
        unpack, metric = self.matrix, self.metric

        def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            last, held = None, None
            for key, below, some in in_turn(batches, ["parent", "block"]):
                if key != last:
                    table = pd.concat(below)
                    last, held = key, (unpack(table["x"].tolist()), *(table[c].to_numpy() for c in ("node", "radius", "pieces")))
                at, nodes, radius, pieces = held
                x = unpack(some["x"].tolist())
                norm, floor = (x * x).sum(axis=1), some["floor"].to_numpy()
                bound = np.maximum(metric.of_product(norm[:, None], x @ at.T) - radius[None, :], 0)
                open_ = np.isneginf(floor)
                reach = np.where(open_, np.inf, metric.reach(norm, np.where(open_, 0, floor)))
                for j in range(len(nodes)):
                    near = np.flatnonzero(bound[:, j] <= reach)
                    if len(near):
                        kept = some.iloc[near][["block", "row", "id", "x", "floor", "home", "place"]]
                        yield kept.assign(node=nodes[j], pieces=np.int32(pieces[j]), bound=bound[near, j], norm=norm[near])

        schema = "block int, row bigint, id string, x binary, floor double, home bigint, place int, node bigint, pieces int, bound double, norm double"
        found, asking = [], known.withColumn("parent", root())
        for _ in range(self.levels):
            below = asking.select("parent", "block").distinct().join(self.nodes, "parent")
            step = staged(meet(below, asking, ["parent", "block"], descend, schema), "route")
            found.append(step.where("pieces > 0"))
            asking = step.where("pieces = 0").select("block", "row", "id", "x", "floor", "home", "place", F.col("node").alias("parent"))
        pairs = reduce(DataFrame.union, found).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        return pairs.where("NOT (node = home AND piece = place)")


def floors(found: DataFrame, k: int) -> DataFrame:
    """(row, low): the k-th product of each query that has as many."""
    lists = found.where("vec IS NOT NULL").groupBy("query").agg(F.sort_array(F.collect_list("product"), asc=False).alias("s"))
    return lists.where(F.size("s") >= k).select(F.col("query").alias("row"), F.element_at("s", k).alias("low"))


def search_shards(
    embeddings: DataFrame, queries, *, ident: str = "vec_id", k: int = TOP, scale: int = SCALE, page: int = PAGE, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """What the shards visited gave each query: see ``Shards.visit``."""
    rows = keyed(embeddings, {"id": F.coalesce(F.col(ident).cast("string"), F.lit("")), "embedding": F.col("embedding"), "asks": F.coalesce(queries, F.lit(False))})
    rows = rows.withColumn("row", F.xxhash64(*KEY))
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    asked = rows.where("asks AND id <> ''").select("row")
    with text_batches(embeddings.sparkSession, "32m"):
        shards = Shards(staged(whole_vectors(rows.select("row", "id", "embedding"), scale, width), "whole"), width, scale, shard_rows, page)
        wanted = staged(shards.rows.join(asked, "row"), "asked")
        blocks = max(1, -(-wanted.count() // QUERY_BLOCK))
        wanted = wanted.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
        first = staged(shards.visit(wanted.withColumn("floor", F.lit(float("-inf"))), k), "first")

        known = wanted.join(floors(first, k), "row", "left").withColumn("floor", F.coalesce("low", F.lit(float("-inf"))))
        known = known.select("block", "row", "id", "x", "floor", F.col("node").alias("home"), F.col("piece").alias("place"))
        place = F.row_number().over(Window.partitionBy("row").orderBy("bound", "node", "piece"))
        ranked = staged(shards.route(known).withColumn("nth", place), "ranked")
        near = staged(shards.visit(ranked.where(F.col("nth") <= NEAREST), k), "near")

        so_far = first.union(near)
        rest = ranked.where(F.col("nth") > NEAREST).drop("floor").join(floors(so_far, k), "row", "left")
        metric = shards.metric
        reach = F.sqrt(F.greatest(F.col("norm") + F.lit(metric.limit) - 2 * (F.col("low") - F.lit(metric.slack)), F.lit(0.0))) + F.lit(metric.margin)
        rest = rest.where(F.col("low").isNull() | (F.col("bound") <= reach)).withColumn("floor", F.coalesce("low", F.lit(float("-inf"))))
        return so_far.union(staged(shards.visit(rest, k), "rest"))


def top_products(
    embeddings: DataFrame, queries, *, ident: str = "vec_id", k: int = TOP, scale: int = SCALE, page: int = PAGE, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row for which the condition ``queries`` holds."""
    every = search_shards(embeddings, queries, ident=ident, k=k, scale=scale, page=page, shard_rows=shard_rows).where("vec IS NOT NULL")
    lists = every.groupBy("query", "query_id").agg(F.collect_list(F.struct("score", "vec")).alias("found"))  # k from each shard at most

    @F.pandas_udf("array<struct<rank:int,vec:string,score:bigint>>")
    def ranked(lists_: pd.Series) -> pd.Series:
        out = []
        for some in lists_:
            top = sorted(((int(s["score"]), id_rank(s["vec"]), s["vec"]) for s in some), reverse=True)[:k]
            out.append([{"rank": r, "vec": v, "score": s if -(2**63) <= s < 2**63 else None} for r, (s, _, v) in enumerate(top, 1)])
        return pd.Series(out)

    best = lists.select("query_id", F.explode(ranked("found")).alias("b"))
    return best.select("query_id", F.col("b.rank").alias("rank"), F.when(F.col("b.vec") != "", F.col("b.vec")).alias("vec_id"), F.col("b.score").alias("score"))
