from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from merch.operators import allocate as al

TEAM = ["team"]
PEOPLE = [f"a{i:03d}" for i in range(1, 7)]
SKUS = (
    "sku bigint, level bigint, unit_price decimal(18,2), stock bigint, sku_target bigint, forecast bigint, principals array<string>"
)


def catalogue(n=60, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        people = [p for p in PEOPLE if rng.random() < 0.7] if k % 17 else []
        rows.append(
            (k, int(rng.integers(1, 7)), Decimal(int(rng.integers(500, 9000))) / 100, int(rng.integers(0, 800)),
             int(rng.integers(0, 60)), int(rng.integers(0, 20)), people)
        )
    return rows


def budgets():
    lows = (40000, 30000, 20000, 9000, 2000, 50)
    return [(p, Decimal(low), Decimal(low) * Decimal("1.1")) for p, low in zip(PEOPLE, lows)]


@pytest.fixture(scope="module")
def frames(spark):
    skus = spark.createDataFrame(catalogue(), SKUS).withColumn("team", F.lit("x"))
    goal = spark.createDataFrame(budgets(), "principal string, low decimal(18,2), high decimal(18,2)").withColumn("team", F.lit("x"))
    return skus, goal


def cents(x):
    return int(x * 100)


def first_by_hand(rows, goal):
    """The sequential first round in plain Python: {sku: {person: qty}}, {person: [low, high]}."""
    state, given = {p: [cents(lo), cents(hi)] for p, lo, hi in goal}, {}

    def pay(p, qty, price):
        if state[p][0] > 0:
            state[p] = [max(state[p][0] - qty * price, 0), state[p][1] - qty * price]

    for sku, _, price, _, target, _, people in sorted(rows, key=lambda r: (r[1], -r[4], r[0])):
        if not people:
            continue
        price, base = cents(price), round((target // len(people)) * 0.2)
        for p in people:
            pay(p, base, price)
        total, rest = sum(state[p][0] for p in people), target - base * len(people)
        extra = {p: round(rest * (state[p][0] / total)) if total else 0 for p in people}
        for p in people:
            pay(p, extra[p], price)
        given[sku] = {p: base + extra[p] for p in people}
    return given, state


def round_by_hand(queue, state, who, by_high=True, clamp=False):
    given = {}
    for sku, price, units, people in queue:
        order = sorted(people, key=lambda p: (-state[p][0], -state[p][1], p) if by_high else (-state[p][0], p))
        unmet = [p for p in order if state[p][0] > 0]
        served = order if who == "all" or (who == "unmet" and not unmet) else unmet
        if not served:
            continue
        cells = {} if who == "unmet_only" else dict.fromkeys(people, 0)
        for i, p in enumerate(served):
            cells[p] = max(units, 0) // len(served) + (i < max(units, 0) % len(served))
        for p, qty in list(cells.items()):
            state[p] = [state[p][0] - qty * price, state[p][1] - qty * price]
            if clamp:
                state[p] = [max(state[p][0], 0), max(state[p][1], 0)]
                if state[p][1] <= 0:
                    del cells[p]
        given[sku] = cells
    return given


def as_cells(df):
    out = {}
    for r in al.cells(df).where(F.col("qty").isNotNull()).collect():
        out.setdefault(r["sku"], {})[r["principal"]] = r["qty"]
    return out


def as_state(df):
    return {r["principal"]: [r["low"], r["high"]] for r in df.collect()}


def queue_of(residual):
    rows = residual.collect()
    rows.sort(key=lambda r: (r["level"], -r["priority"], r["sku"]))
    return [(r["sku"], cents(r["unit_price"]), r["units"], list(r["principals"])) for r in rows if r["principals"]]


def test_first_round_equals_the_sequence(frames):
    skus, goal = frames
    assigned, state = al.allocate_targets(skus, goal, TEAM)
    given, left = first_by_hand(catalogue(), budgets())
    assert as_cells(assigned) == given
    assert as_state(state) == left
    assert any(low == 0 for low, _ in left.values()) and any(low > 0 for low, _ in left.values())
    assert assigned.where("assigned + leftover <> sku_target").count() == 0
    assert assigned.count() == 60


@pytest.mark.parametrize("who,by_high,clamp", [("unmet", True, False), ("all", True, False), ("all", False, False), ("unmet_only", False, False), ("all", True, True)])
def test_later_rounds_equal_the_sequence(frames, who, by_high, clamp):
    skus, goal = frames
    assigned, state = al.allocate_targets(skus, goal, TEAM)
    left = as_state(state)
    rest = al.residual(assigned, "fifth")
    dealt, after = al.allocate_round(rest, state, TEAM, who, clamp, by_high)
    want = round_by_hand(queue_of(rest), left, who, by_high, clamp)
    assert as_cells(dealt) == {s: c for s, c in want.items() if c}
    assert as_state(after) == left
    if not clamp:
        served = dealt.where(F.size("principals") > 0)
        assert served.where("assigned <> units").count() == 0


def test_one_each(frames):
    skus, goal = frames
    assigned, state = al.allocate_targets(skus, goal, TEAM)
    ones, after = al.allocate_one_each(assigned, state, TEAM)
    zero = [(r["sku"], p, cents(r["unit_price"])) for r in assigned.collect() for p, q in zip(r["principals"], r["qty"]) if q == 0 and r["stock"]]
    assert {(s, p) for s, cells in as_cells(ones).items() for p in cells} == {(s, p) for s, p, _ in zero}
    left = as_state(state)
    for _, p, price in zero:
        left[p] = [max(left[p][0] - price, 0), left[p][1] - price]
    assert as_state(after) == left


def test_groups_are_independent(spark, frames):
    skus, goal = frames
    both = skus.unionByName(skus.withColumn("team", F.lit("y")))
    goals = goal.unionByName(goal.withColumn("team", F.lit("y")))
    assigned, state = al.allocate_targets(both, goals, TEAM)
    alone = as_cells(al.allocate_targets(skus, goal, TEAM)[0])
    for team in "xy":
        assert as_cells(assigned.where(F.col("team") == team)) == alone
    rows = al.target_attainment(state, goals, TEAM).collect()
    assert len(rows) == 2 * len(PEOPLE) and all(r["low_left"] <= r["low"] for r in rows)
    # a SKU that two teams share keeps a residual in each of them
    first, later = al.residual(assigned, "surplus"), assigned.where("sku < 30")
    rest = al.residual(assigned, "fifth", (later,), partition_cols=TEAM)
    counts = {r["team"]: r["n"] for r in rest.groupBy("team").agg(F.count("sku").alias("n")).collect()}
    assert first.count() and counts["x"] == counts["y"] == al.residual(assigned.where("team = 'x'"), "fifth", (later.where("team = 'x'"),), partition_cols=TEAM).count()


def test_same_result_for_any_batch_and_partition_count(spark, frames):
    skus, goal = frames
    want = as_cells(al.allocate_targets(skus, goal, TEAM)[0])
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "7"), ("spark.sql.shuffle.partitions", "3")):
        before = spark.conf.get(key)
        spark.conf.set(key, value)
        try:
            assert as_cells(al.allocate_targets(skus, goal, TEAM)[0]) == want
        finally:
            spark.conf.set(key, before)


def test_people_without_targets_and_territories_without_skus(spark):
    skus = spark.createDataFrame([(1, 1, Decimal("1.00"), 9, 10, 0, ["a001", "a002"])], SKUS).withColumn("team", F.lit("x"))
    goal = spark.createDataFrame([("x", "a001", Decimal(5), Decimal(6)), ("z", "a009", Decimal(3), Decimal(4))], "team string, principal string, low decimal(18,2), high decimal(18,2)")
    assigned, state = al.allocate_targets(skus, goal, TEAM)
    row = assigned.first()
    assert row["principals"] == ["a001", "a002"] and row["qty"][1] is None and row["assigned"] + row["leftover"] == 10
    got = {(r["team"], r["principal"]): r["sold"] for r in al.target_attainment(state, goal, TEAM).collect()}
    assert set(got) == {("x", "a001"), ("z", "a009")} and got["z", "a009"] == 0
    with pytest.raises(ValueError):
        al.allocate_targets(skus, goal, [])


def test_clamped_state_also_without_units(spark):
    """Someone served 0 units is clamped too: an opening high of -700 closes at 0."""
    rows = [(1, 1, Decimal("1.00"), 0, 0, 0, ["a001"], 0, 0)]
    rest = spark.createDataFrame(rows, SKUS + ", units bigint, priority bigint").withColumn("team", F.lit("x"))
    state = spark.createDataFrame([("x", "a001", 0, -700)], "team string, principal string, low bigint, high bigint")
    assert as_state(al.allocate_round(rest, state, TEAM, "all", clamp=True)[1]) == {"a001": [0, 0]}


def test_gradient_split_examples(spark):
    rows = [(1, 10, PEOPLE), (2, 0, PEOPLE[:5]), (3, 2, PEOPLE[:3]), (4, 7, [])]
    df = spark.createDataFrame(rows, "sku bigint, units bigint, principals array<string>")
    got = {}
    for r in al.gradient_split(df).orderBy("sku", "principal").collect():
        got.setdefault(r["sku"], []).append(r["qty"])
    assert got == {1: [2, 2, 2, 2, 1, 1], 2: [0] * 5, 3: [1, 1, 0]}


def test_residual_rules(spark):
    rows = [(1, 1, Decimal("1.00"), 100, 10, 0, ["a001"], 5), (2, 1, Decimal("1.00"), 100, 10, 20, ["a001"], 5),
            (3, 1, Decimal("1.00"), 30, 0, 0, ["a001"], 0)]
    first = spark.createDataFrame(rows, SKUS + ", assigned bigint").withColumns(
        {"units": F.lit(0), "leftover": F.lit(0), "qty": F.lit(None), "spend": F.lit(None)}
    )
    pick = lambda df: {r["sku"]: r["units"] for r in df.collect()}
    assert pick(al.residual(first, "surplus")) == {1: 10, 2: 10, 3: 0}
    assert pick(al.residual(first, "coverage")) == {1: 55, 2: 15}
    assert pick(al.residual(first, "target")) == {1: 5, 2: 5}
    assert pick(al.residual(first, "fifth")) == {1: 15, 2: 15, 3: 6}
    assert pick(al.residual(first, "fifth", soft=True)) == {1: 15, 2: 15, 3: 6}


def test_a_territory_is_opened_once():
    """The opening state comes on one row before the SKUs, also in a batch of its own; territories without SKUs close nothing."""
    sku = {"sku": 1, "units": 3, "price_cents": 100, "principals": ["a001", "a002"], "opening": None}
    head = sku | {"sku": 0, "units": 0, "price_cents": 0, "principals": None, "opening": [{"principal": "a001", "low": 900, "high": 950}]}
    frames = [[head | {"_territory": "x"}], [sku | {"_territory": "x"}, sku | {"_territory": "x", "sku": 2}, head | {"_territory": "y"}], [sku | {"_territory": "z"}]]
    step = lambda *args: al._even(*args, whom="all", by_high=True, clamp=False)
    out = pd.concat(al._fold(step)(iter([pd.DataFrame(f) for f in frames])))
    assert [(r.sku, r.qty, r.spend) for r in out.itertuples() if r.closing is None] == [(1, [3, None], [300, 0]), (2, [3, None], [300, 0]), (1, [None, None], [0, 0])]
    ends = {t: c for t, c in zip(out["_territory"], out["closing"]) if c is not None}
    assert ends == {"x": [{"principal": "a001", "low": 300, "high": 350}], "z": []}
