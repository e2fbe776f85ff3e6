"""Vector and page operators against brute force, and the defined odd cases."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from merch.llm import mtree, neighbours, warc
from merch.llm.components import components
from merch.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.01"
NAN = float("nan")


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def linked(ids, x, threshold):
    with np.errstate(all="ignore"):
        good = np.array([v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in x])
    unit = [np.array(v, float) / np.linalg.norm(v) if g else None for v, g in zip(x, good)]
    near = [[i != j and good[i] and good[j] and float(unit[i] @ unit[j]) >= threshold for j in range(len(ids))] for i in range(len(ids))]
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if near[i][j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return [sum(row) for row in near], [min((a for a, h in zip(ids, group) if h == g and a is not None), default=None) for g in group]


def test_nn_descent_finds_all_links(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    x = [(centres[i % 30] + 0.05 * rng.normal(size=16)).tolist() for i in range(300)] + rng.normal(size=(100, 16)).tolist()
    x += [x[0], None, [0.0] * 16, [NAN] + [1.0] * 15, [None] + [1.0] * 15]
    ids = [*range(404), 0]
    frame = spark.createDataFrame([(i, v, 0) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>, n_links int")
    got = neighbours.near_vectors(frame, k=4, block=64).toPandas().sort_values(["vec_id", "n_links"])
    links, roots = linked(ids, x, 0.95)
    want = sorted(zip(ids, links, roots))
    assert list(zip(got["vec_id"], got["n_links"], got["component_id"])) == want
    assert (got["kept"] == (got["vec_id"] == got["component_id"])).all()
    assert neighbours.near_vectors(frame.where("false")).count() == 0


@pytest.mark.parametrize("pairs", [60, 600])
def test_nn_descent_finds_pairs_beside_a_large_group(spark, pairs):
    """The large group has nearly all links, so their sum hides lost pairs; few pairs are missed by a sample."""
    rng = np.random.default_rng(3)
    some = rng.normal(size=(pairs, 32))
    x = np.concatenate([some, some + 0.1 * rng.normal(size=some.shape), rng.normal(size=32) + 0.01 * rng.normal(size=(800, 32)), rng.normal(size=(1200, 32))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = neighbours.near_vectors(frame, k=4, block=16, trees=1, visits=2).toPandas().set_index("vec_id").loc[range(len(x))]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.95).sum(axis=1) - 1
    share = np.minimum(got["n_links"].to_numpy() / np.maximum(want, 1), 1)
    assert (got["n_links"].to_numpy() <= want).all()
    assert share[want == 1].mean() >= 0.99 and share[want > 100].mean() >= 0.99


def counted(monkeypatch, *names):
    """How often each of the functions of ``neighbours`` is called."""
    calls = dict.fromkeys(names, 0)

    def wrap(name, own):
        def call(*args, **kwargs):
            calls[name] += 1
            return own(*args, **kwargs)

        return call

    for name in names:
        monkeypatch.setattr(neighbours, name, wrap(name, getattr(neighbours, name)))
    return calls


def test_nn_descent_recall(spark, monkeypatch):
    """The supplied vectors have no link at all; they are searched by descents, not by all pairs."""
    calls = counted(monkeypatch, "descend", "all_pairs")
    rows = table(spark, SF, "embeddings").toPandas()
    got = QUERIES["op1_nn_descent"](spark, SF).toPandas().set_index("vec_id").loc[rows["vec_id"]]
    x = np.stack(rows["embedding"]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.95).sum(axis=1) - 1
    assert got["n_links"].tolist() == want.tolist()
    assert calls["descend"] >= 2 and calls["all_pairs"] == 0


def test_few_links_are_found_by_descents(spark, monkeypatch):
    calls = counted(monkeypatch, "descend", "all_pairs")
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 24))
    x[[10, 20, 30, 2999]] = x[[11, 21, 31, 0]] + 0.12 * rng.normal(size=(4, 24))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = neighbours.near_vectors(frame, block=64).where("n_links > 0").toPandas()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = np.flatnonzero((x @ x.T >= 0.95).sum(axis=1) > 1)
    assert sorted(got["vec_id"]) == want.tolist() and len(want) >= 6
    assert calls["descend"] >= 2 and calls["all_pairs"] == 0


def test_audit_sees_what_a_graph_lacks(spark):
    """Recapture and the samples fall when links are taken out of the graph, in small groups as in large ones."""
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(200, 16)), rng.normal(size=16) + 0.01 * rng.normal(size=(300, 16))])
    x = np.concatenate([x, x[:200] + 0.05 * rng.normal(size=(200, 16))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    nodes = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(x)], "u bigint, vec binary")
    every = neighbours.all_pairs(nodes, len(x), 0.95)
    want = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    assert {r["u"]: sorted(r["ids"]) for r in neighbours.merge(every, 8, 0.95).collect()} == {i: np.flatnonzero(w).tolist() for i, w in enumerate(want) if w.any()}
    audit = neighbours.Audit(nodes, len(x), threshold=0.95, sample=128)
    audit.add_linked(neighbours.merge(every, 8, 0.95))
    whole = neighbours.merge(every, 8, 0.95)
    assert audit.recall(whole) == neighbours.recapture(whole, whole, 0.95) == 1.0
    for lost in (whole.where("size(ids) > 1 OR u % 4 > 0"), whole.where("size(ids) = 1 OR u % 4 > 0")):
        assert audit.recall(lost) < 0.95 and neighbours.recapture(lost, whole, 0.95) < 0.95


def test_all_pairs_is_the_last_step(spark, monkeypatch):
    calls = counted(monkeypatch, "all_pairs")
    monkeypatch.setattr(neighbours, "recapture", lambda *a: 0.0)
    x = np.random.default_rng(1).normal(size=(60, 8))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([x, x + 0.01]))], "vec_id bigint, embedding array<double>")
    with pytest.warns(UserWarning, match="did not reach"):
        got = neighbours.near_vectors(frame, rounds=2)
    assert calls["all_pairs"] == 1 and got.where("n_links >= 1").count() == 120


@pytest.mark.parametrize("limit", [40, 4096])
def test_m_tree_is_exact(spark, limit):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)).tolist() + [[0.5] * 8] * 5 + [None, [NAN] * 8, [None] * 8, [], [1.0, 2.0]]
    ids = [*range(len(x) - 1), 7]
    frame = spark.createDataFrame([(i, v, "c") for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>, score string")
    got = mtree.top_products(frame, F.col("vec_id") % 20 == 0, shard_rows=limit, page=8).collect()
    whole = {n: [*np.floor(256 * np.array(v, float)).astype(int).tolist(), *[0] * (8 - len(v))] for n, v in enumerate(x) if v is not None and all(c is not None and np.isfinite(c) for c in v)}
    want = []
    for q in (n for n in whole if ids[n] % 20 == 0):
        best = sorted((-int(np.dot(whole[q], whole[n])), ids[n]) for n in whole if n != q)[:5]
        want += [(str(ids[q]), r, str(i), -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert mtree.top_products(frame.where("false"), F.lit(True)).count() == 0


def test_m_tree_takes_components_of_any_size(spark):
    """Beyond 2^53 the products are whole numbers in Python; scores beyond 64 bits are null at their right rank."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(120, 5)) * 10.0 ** rng.integers(0, 4, size=(120, 1))
    for size, label in ((1e6, "long"), (1e30, "wide"), (1e308, "beyond 256 times")):
        some = (x * (size / 1e4)).tolist()
        some[3] = some[4] = [v + 1.0 for v in some[5]]
        frame = spark.createDataFrame(list(enumerate(some)), "vec_id bigint, embedding array<double>")
        got = mtree.top_products(frame, F.col("vec_id") % 5 == 0, shard_rows=30, page=8).collect()
        whole = [[math.floor(Fraction(v) * 256) for v in row] for row in some]
        want = []
        for q in range(0, len(some), 5):
            best = sorted((-sum(a * b for a, b in zip(whole[q], whole[n])), n) for n in range(len(some)) if n != q)[:5]
            want += [(str(q), r, str(n), -s if -(2**63) <= -s < 2**63 else None) for r, (s, n) in enumerate(best, 1)]
        assert sorted(tuple(r) for r in got) == sorted(want), label


@pytest.mark.parametrize("alike", [0.0, 1.0])
def test_shards_are_metric_nodes(spark, alike):
    """Far clusters: most shards are never visited. All vectors alike: the shards are cut evenly, and every one is visited."""
    rng = np.random.default_rng(2)
    angle = rng.normal(size=(12, 6))
    angle *= 40 / np.linalg.norm(angle, axis=1, keepdims=True)
    x = np.concatenate([a + 0.05 * rng.normal(size=(100, 6)) for a in angle]) if not alike else np.ones((1200, 6))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = mtree.search_shards(frame, F.col("vec_id") % 40 == 0, shard_rows=64, page=16).toPandas()
    visited = found[found["vec"].isna()].groupby("query")
    assert len(visited) == 30
    if alike:
        assert (visited.size() >= 1200 // 64).all()
    else:
        assert visited["computed"].sum().mean() < 0.35 * len(x)
    got = mtree.top_products(frame, F.col("vec_id") % 40 == 0, shard_rows=64, page=16).toPandas()
    whole = np.floor(256 * x).astype(int)
    for q in range(0, 1200, 40):
        order = [n for n in np.lexsort((np.arange(len(x)), -(whole @ whole[q]))) if n != q][:5]
        mine = got[got["query_id"] == str(q)].sort_values("rank")
        assert mine["vec_id"].astype(int).tolist() == order and mine["score"].tolist() == (whole[order] @ whole[q]).tolist()


def test_m_tree_passes_entries_over():
    rng = np.random.default_rng(1)
    x = np.concatenate([np.round(rng.normal(c, 3, (100, 4))) for c in (0, 200, 400, 800)])
    metric = mtree.Metric(float((x * x).sum(axis=1).max()))
    tree = mtree.MTree.build(metric, x, np.arange(len(x)), page=16)
    total = 0
    for q in x[::37]:
        best, computed = tree.search(metric, q, None, 5, -np.inf, lambda i: -i)
        order = np.lexsort((np.arange(len(x)), -(x @ q)))[:5]
        assert sorted((-s, i) for s, _, i, _ in best) == sorted((-float(x[i] @ q), i) for i in order)
        total += computed
    assert total < 0.7 * len(x) * len(x[::37])  # queries near the origin, where all products are alike, exclude little


def test_m_tree_serves_many_queries_at_once():
    """The same best objects as one query at a time, with equal products, own rows left out, floors and fewer objects than k."""
    rng = np.random.default_rng(3)
    x = np.concatenate([np.round(rng.normal(c, 3, (60, 4))) for c in (0, 200, 400)])
    x[10:20] = x[5]
    metric = mtree.Metric(float((x * x).sum(axis=1).max()))
    place = -np.arange(len(x))
    for n, k in ((len(x), 5), (4, 5)):
        tree = mtree.MTree.build(metric, x[:n], np.arange(n), page=16)
        own = np.arange(0, n, 3)
        floor = np.full(len(own), -np.inf)
        for i in range(0, len(own), 2):
            floor[i] = np.sort(np.delete(x[:n] @ x[own[i]], own[i]))[-min(k, n - 1)]
        best, score, computed = tree.search_all(metric, x[own], own, k, floor, place)
        assert computed.sum() < 0.8 * n * len(own) or n < 16
        for i, q in enumerate(own.tolist()):
            alone, _ = tree.search(metric, x[q], q, k, floor[i], lambda j: -j)
            mine = sorted((s, o) for s, o in zip(score[i].tolist(), best[i].tolist()) if o >= 0)
            assert mine == sorted((s, o) for s, _, o, _ in alone)


def test_archive_round_trip(spark):
    big, small = "<p>" + "é" * 800, "tiny"
    rows = [(1, "http://a.example.com/x?b=1#f", big), (9, "https://www.example.org:8443/", big), (9, "https://www.example.org:8443/", big), (3, None, big),
            (4, "http://a.example.com/x?b=1", small), (5, "", small), (None, "http://b", big), (6, "http://[bad", None), (7, "x\ty\nz", "")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id bigint, url string, html string, payload_bytes string")
    got = warc.archive_and_read(spark, pages).toPandas()
    assert len(got) == len(rows)
    by = {i: g for i, g in got.groupby("page_id")}
    assert sorted(by["9"]["record_type"]) == ["response", "revisit"]
    assert set(by["1"]["refers_to"]) == set(by["3"]["refers_to"]) == {"9"} and by[""]["record_type"].tolist() == ["response"]
    assert set(got[got["payload_bytes"] < 1000]["record_type"]) == {"response"}
    assert by["1"]["payload_digest"].iloc[0] == hashlib.sha1(big.encode()).hexdigest() and by["1"]["payload_bytes"].iloc[0] == 1603
    assert bytes(by["4"]["payload"].iloc[0]) == small.encode() and warc.archive_and_read(spark, pages.where("false")).count() == 0


def test_index_finds_keys_across_blocks(spark, tmp_path):
    rows = [(f"k{i // 3:05d}", "f", i, 1) for i in range(1000)]
    shards = warc.write_index(spark.createDataFrame(rows, "key string, file string, start bigint, size bigint"), str(tmp_path / "i"), block_lines=7)
    asked = spark.createDataFrame([(f"k{i:05d}",) for i in range(0, 400, 5)] + [("zz",), ("",)], "key string")
    got = sorted((r["key"], r["start"]) for r in warc.find_captures(asked, str(tmp_path / "i"), shards).collect())
    assert got == sorted((k, s) for k, _, s, _ in rows if int(k[1:]) % 5 == 0)


def test_reversed_host_keys():
    assert warc.surt("http://www.Example.com:80/A?q#f") == "com,example,www)/A?q"
    assert warc.surt("https://x.org:444") == "org,x:444)/" and warc.surt(None) == "-" and warc.surt("http://1.2.3.4/a") == "1.2.3.4)/a"
