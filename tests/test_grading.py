from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from merch.operators import grading as g
from merch.operators.running import running_totals

METRICS = "sku string, type string, num bigint, revenue decimal(18,2), profit decimal(18,2)"


def metrics(spark, rows):
    return spark.createDataFrame([(s, t, n, Decimal(r), Decimal(p)) for s, t, n, r, p in rows], METRICS)


def scored(spark, rows):
    return spark.createDataFrame([(s, p, c, Decimal(v)) for s, p, c, v in rows], "sku string, pool string, score double, profit decimal(18,2)")


def test_weights_follow_the_definition(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 50, size=(200, 3)).astype(float)
    df = spark.createDataFrame([tuple(r) for r in x.tolist()], "num double, revenue double, profit double")
    p = x / x.sum(axis=0)
    p[p == 0] = 1e-10
    entropy = -(p * np.log(p)).sum(axis=0) / np.log(len(p))
    want = (1 - entropy) / (1 - entropy).sum()
    row = g.entropy_weights(df).first()
    assert [row["w_num"], row["w_revenue"], row["w_profit"]] == pytest.approx(want, rel=1e-9)


def test_single_row_gets_equal_weights(spark):
    row = g.entropy_weights(metrics(spark, [("a", "t", 5, "1.00", "2.00")])).first()
    assert [row[f"w_{m}"] for m in g.MEASURES] == pytest.approx([1 / 3] * 3)


def test_item_over_the_cut_leaves_level_three_only(spark):
    df = scored(spark, [("a", "p", 0.9, "90"), ("b", "p", 0.5, "5"), ("c", "p", 0.1, "5")])
    levels = {r["sku"]: r["level"] for r in g.pareto_levels(df).collect()}
    assert levels == {"a": 3, "b": 3, "c": 3}


def test_levels_break_score_ties_by_sku_and_pools_are_separate(spark):
    rows = [(f"s{i}", "p", 0.5, "10") for i in range(10)] + [("z", "q", 0.1, "1")]
    levels = {r["sku"]: r["level"] for r in g.pareto_levels(scored(spark, rows)).collect()}
    assert [levels[f"s{i}"] for i in range(10)] == [1] * 8 + [2] + [3]
    assert levels["z"] == 3


def test_pools_by_size_and_special_types(spark):
    rows = [(f"a{i}", "big", 1, "1", "1") for i in range(40)] + [(f"b{i}", "small", 1, "1", "1") for i in range(39)]
    rows += [("RB1", "own", 1, "1", "1"), ("rb2", "own", 1, "1", "1"), ("XX", "own", 1, "1", "1"), ("n", None, 1, "1", "1")]
    pools = g.grade_pools(metrics(spark, rows), ["own"], F.col("sku").ilike("RB%"))
    found = {r["sku"]: r["pool"] for r in pools.collect()}
    assert found["a0"] == "big" and found["b0"] == g.REST_POOL and found["n"] == g.REST_POOL
    assert (found["RB1"], found["rb2"], found["XX"]) == ("own|other", "own|other", "own|brand")


def test_grade_gives_one_level_per_sku_and_keeps_new_ones(spark):
    rows = [(f"p{i}", "t", i + 1, str(10 + i), str(i + 1)) for i in range(20)]
    rows += [("loss1", "t", 1, "5", "-3"), ("loss2", "t", 99, "5", "-3"), ("even", "t", 1, "5", "0")]
    new = spark.createDataFrame([("p19",), ("brand_new",)], "sku string")
    args = dict(special=["own"], non_brand=F.col("sku").ilike("RB%"))
    strict = g.sku_grade(metrics(spark, rows), new, "2024-01-01", "2024-12-31", **args).collect()
    levels = {r["sku"]: r["level"] for r in strict}
    assert len(strict) == len(levels) == 20 + 2 + 1
    assert levels["p19"] == levels["brand_new"] == 6 and "even" not in levels
    assert (levels["loss1"], levels["loss2"]) == (5, 4)
    loose = g.sku_grade(metrics(spark, rows), new, "2024-01-01", "2024-12-31", strict=False, **args).collect()
    assert sorted(r["level"] for r in loose if r["sku"] == "p19") == [1, 1]


def test_running_totals_over_many_slices_equal_a_plain_window(spark):
    df = spark.range(5000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
        (F.col("id") * 7919 % 13).alias("o"), (F.col("id") % 11).alias("v"),
    )
    out = running_totals(df, ["k"], [F.col("o").desc(), F.col("id").asc()], {"acc": "v"}, rank="rn", totals={"tot": "v"}, slices=16)
    w = Window.partitionBy("k").orderBy(F.col("o").desc(), "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumns(
        {"acc2": F.sum("v").over(w), "rn2": F.row_number().over(w), "tot2": F.sum("v").over(Window.partitionBy("k"))}
    ).select("id", "acc2", "rn2", "tot2")
    joined = out.join(plain, "id")
    assert joined.count() == 5000
    assert joined.where("acc <> acc2 OR rn <> rn2 OR tot <> tot2").count() == 0


def test_running_totals_without_keys(spark):
    out = running_totals(spark.range(100), [], [F.col("id").asc()], {"acc": "id"}, rank="rn", slices=7)
    assert out.where("rn <> id + 1 OR acc <> id * (id + 1) / 2").count() == 0
