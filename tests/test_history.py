from datetime import date, timedelta

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from merch.operators import history as h
from merch.operators import stockout as so

START = date(2024, 1, 1)


def daily(spark, histories):
    """Rows from {sku: (qty, stock)}; a day without sales and stock has no row."""
    rows = [
        (sku, START + timedelta(days=i), q, s)
        for sku, (qty, stock) in histories.items()
        for i, (q, s) in enumerate(zip(qty, stock))
        if q or s is not None
    ]
    return spark.createDataFrame(rows, "sku string, sales_date date, total_sales_qty bigint, total_available_quantity bigint")


def run(spark, histories):
    got = {}
    for r in so.correct_stockout_sales(daily(spark, histories)).collect():
        got.setdefault(r["sku"], {})[(r["sales_date"] - START).days] = r["adjusted_qty"]
    return got


def test_worked_corrections(spark):
    """Expected numbers come from the rule's weights: 14 rising days 1..14 average 25/3, and days without sales do not count."""
    rising = [*range(1, 15), 2], [50] * 14 + [2]
    half_idle = [0] * 7 + [6] * 7 + [0], [50] * 14 + [1]
    at_limit = [10] * 14 + [1], [50] * 14 + [15]
    below_limit = [10] * 14 + [1], [50] * 14 + [14]
    half_drop = [10] * 14 + [5], [50] * 14 + [2]
    got = run(spark, {"rising": rising, "idle": half_idle, "limit": at_limit, "below": below_limit, "half": half_drop})
    assert got["rising"][14] == pytest.approx(25 / 3) and got["idle"][14] == pytest.approx(6.0)
    assert got["limit"][14] == 1.0 and got["below"][14] == pytest.approx(10.0) and got["half"][14] == 5.0


def steady(qty=10, stock=50, days=20):
    return [qty] * days, [stock] * days


def test_edges_of_the_stock_rule(spark):
    two_days = steady()
    two_days[0][16:18], two_days[1][16:18] = [1, 1], [2, 2]
    no_drop = steady()
    no_drop[1][16] = 2
    early = steady()
    early[0][13], early[1][13] = 1, 2
    seven, six = steady(), steady()
    for history, known in ((seven, 7), (six, 6)):
        history[0][14], history[1][14] = 1, 2
        history[1][: 14 - known] = [None] * (14 - known)
    idle = [5] + [0] * 19, [50] * 20
    idle[1][16] = 2
    got = run(spark, {"two": two_days, "flat": no_drop, "early": early, "seven": seven, "six": six, "idle": idle})
    assert got["two"][16] == got["two"][17] == pytest.approx(10.0)
    assert got["flat"][16] == 10.0 and got["early"][13] == 1.0
    assert got["seven"][14] == pytest.approx(10.0) and got["six"][14] == 1.0
    assert got["idle"][16] == 0.0


def test_fill_days_covers_the_calendar_and_keeps_unknown_stock(spark):
    days = daily(spark, {"a": ([0, 3, 0, 2], [None, 7, None, None]), "b": ([1], [None])})
    rows = h.fill_days(days, "2024-01-01", "2024-01-06").orderBy("sku", "sales_date").collect()
    assert [r["total_sales_qty"] for r in rows] == [0, 3, 0, 2, 0, 0, 1, 0, 0, 0, 0, 0]
    assert [r["inventory_missing"] for r in rows] == [True, False] + [True] * 10


def test_repeated_stock_rows_do_not_multiply_sales(spark):
    sales = spark.createDataFrame([("a", "Amazon", START, 4)], "sku string, platform string, sales_date date, sales_qty bigint")
    stock = spark.createDataFrame([("a", START, 5), ("a", START, 9)], "sku string, date date, total_available_quantity bigint")
    row = h.daily_totals(sales, stock, "2024-01-01", "2024-01-31").first()
    assert (row["total_sales_qty"], row["total_available_quantity"]) == (4, 9)


def test_months_and_model_choice(spark):
    long = ([5] * 600, [None] * 600)
    short = ([0] * 540 + [5] * 60, [None] * 600)
    fresh = ([0] * 595 + [5] * 5, [None] * 600)
    end = (START + timedelta(days=599)).isoformat()
    days = h.trim_to_first_sale(daily(spark, {"long": long, "short": short, "fresh": fresh}), end)
    models = {r["sku"]: r for r in h.select_model(h.monthly_totals(days, end)).collect()}
    assert {k: v["model_type"] for k, v in models.items()} == {"long": 1, "short": 0, "fresh": -1}
    assert models["long"]["mean_daily"] == pytest.approx(5.0)


def test_sku_without_sales_leaves(spark):
    assert h.trim_to_first_sale(daily(spark, {"a": ([0, 0], [3, 3])}), "2024-12-31").count() == 0


def test_samples_need_all_weeks(spark):
    days = daily(spark, {"a": ([1] * 7 * 63, [None] * 441), "b": ([1] * 7 * 62, [None] * 434)})
    end = (START + timedelta(days=440)).isoformat()
    features = h.weekly_features(h.weekly_totals(days.where("sku = 'a'"), end))
    assert h.weekly_samples(features).count() == 1
    short = h.weekly_features(h.weekly_totals(days.where("sku = 'b'"), (START + timedelta(days=433)).isoformat()))
    assert h.weekly_samples(short).count() == 0


def test_skus_meet_however_they_are_written(spark):
    """Case, accents (composed or not), width, ligatures and outer spaces do not tell SKUs apart; letters and digits do."""
    same = [["café-1", "CAFÉ-1", "café-1", "Ｃafe-１", " cafe-1 "], ["ﬁx", "fix", "FIX", "ＦＩＸ"], ["straße", "STRASSE"], ["İ2", "i2", "I2"], ["Æ", "ae"]]
    alone = ["cafe1", "cafe-2", "fi", "x-1", "x1", "", "Ø9", "O8"]
    written = [x for group in same for x in group] + alone
    names = h.sku_names(spark.createDataFrame([(w,) for w in [*written, *written, None]], "s string"), spark.createDataFrame([("fix",)], "t string"))
    found = {r["written"]: r["sku"] for r in names.collect()}
    assert set(found) == set(written)
    for group in same:
        assert {found[w] for w in group} == {min((w.strip() for w in group), key=str.encode)}, group
    assert len({found[w] for w in written}) == len(same) + len(alone)


def test_facts_join_by_name_as_plain_strings(spark):
    sales = spark.createDataFrame([("É1", 2), ("e1", 3), (None, 5)], "sku string, q int")
    names = h.sku_names(sales.select("sku"))
    rows = h.with_sku_name(sales, names)
    assert sorted((r["sku"] or "", r["q"]) for r in rows.collect()) == [("", 5), ("e1", 2), ("e1", 3)]
    assert rows.columns == ["sku", "q"] and rows.schema["sku"].dataType.simpleString() == "string"
    plan = rows._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("collat" not in line.lower() for line in joins)


def test_spans_hold_what_marked_days_look_at(spark):
    """A span is a run of marked days with the 14 days before each; marks out of each other's reach are apart."""
    days = {"a": [0, 1, 2, 20, 21, 40, 41, 42, 43, 60], "b": [5, 6, 7], "c": [0, 30]}
    low = {"a": {2, 40, 43}, "c": {30}}
    start = date(2031, 1, 1)
    rows = [(s, start + timedelta(days=d), d in low.get(s, ())) for s, ds in days.items() for d in ds]
    spans = so.dependency_spans(spark.createDataFrame(rows, "sku string, sales_date date, low_stock boolean"))
    got = {(r["sku"], (r["sales_date"] - start).days): r["span"] and r["span"] - (start - date(1970, 1, 1)).days for r in spans.collect()}
    wanted = {("a", 0): 2, ("a", 1): 2, ("a", 2): 2, ("a", 40): 40, ("a", 41): 40, ("a", 42): 40, ("a", 43): 40, ("c", 30): 30}
    assert got == {(s, d): wanted.get((s, d)) for s, ds in days.items() for d in ds}


def test_few_days_travel_when_few_are_marked(spark):
    """Stock that runs low on one day in a year sends some two weeks of each SKU through Python; the others pass as they are."""
    rows = spark.range(20 * 730).select(
        (F.col("id") % 20).cast("string").alias("sku"), F.floor(F.col("id") / 20).cast("int").alias("n")
    ).select(
        "sku", F.date_add(F.lit(date(2030, 1, 1)), F.col("n")).alias("sales_date"),
        F.when(F.col("n") % 365 == 300, 1).otherwise(10 + F.col("n") % 5).cast("bigint").alias("total_sales_qty"),
        F.when(F.col("n") % 365 == 300, 2).otherwise(90).cast("bigint").alias("total_available_quantity"),
    )
    spans = so.dependency_spans(so.mark_low_stock(rows))
    assert spans.where("low_stock").count() == 40 and spans.where("span IS NOT NULL").count() == 40 * 15
    found = so.correct_stockout_sales(rows)
    assert found.count() == 20 * 730
    changed = found.where("adjusted_qty <> total_sales_qty")
    assert changed.count() == 40 and changed.where("low_stock AND adjusted_qty BETWEEN 10 AND 15").count() == 40


def test_marked_days_of_many_skus_are_walked_together():
    """Batches that cut SKUs anywhere give what each SKU walked alone gives, with repeated days, unknown days and odd stock."""
    rng = np.random.default_rng(3)
    rows, wanted = [], []
    for sku in range(40):
        days = np.sort(rng.choice(120, 70, replace=False))
        days = np.sort(np.append(days, days[:5])) if sku % 3 == 0 else days
        qty = rng.choice([0, 1, 2, 30, 40], len(days)).astype(float)
        stock = np.where(rng.random(len(days)) < 0.3, rng.integers(0, 3, len(days)), 50 + rng.integers(0, 40, len(days))).astype(float)
        stock[rng.random(len(days)) < 0.1] = np.nan
        low = []
        for d, s in zip(days, stock):
            before = stock[(days >= d - 14) & (days < d) & (stock > 0)]
            low.append(d - days[0] >= 14 and len(before) >= 7 and s < before.mean() * 0.3)
        order = np.lexsort((np.nan_to_num(stock, nan=-1), low, qty, days))
        fixed = so._walk(days[order], qty[order], np.array(low)[order], 14, 0.5)
        wanted += [(sku, int(days[i]), qty[i], bool(low[i]), f) for i, f in zip(order, fixed)]
        rows += [(sku, int(d), q, None if np.isnan(s) else int(s), len(days)) for d, q, s in rng.permutation(np.array([days, qty, stock]).T).tolist()]
    names = ["sku", "sales_date", "total_sales_qty", "total_available_quantity", "_rows"]
    kinds = [pa.int64(), pa.date32(), pa.int64(), pa.int64(), pa.int64()]
    columns = [pa.array([int(v) if v is not None else None for v in c], pa.int32() if k == pa.date32() else k).cast(k) for c, k in zip(zip(*rows), kinds)]
    for size, block in ((11, 1), (100, 300), (10_000, 200_000)):
        batches = pa.table(columns, names).to_batches(max_chunksize=size)
        got = pa.Table.from_batches(so._correct_batches(14, 0.5, 0.3, block)(batches))
        found = zip(*(got[c].cast(pa.int32()).to_pylist() if c == "sales_date" else got[c].to_pylist() for c in ("sku", "sales_date", "total_sales_qty", "low_stock", "adjusted_qty")))
        assert sorted(found) == sorted(wanted)
    assert sum(w[3] for w in wanted) > 300 and sum(w[4] != w[2] for w in wanted) > 100


def test_corrected_stock_rule_is_that_of_mark_low_stock(spark):
    rows = [(s, date(2030, 1, 1) + timedelta(days=d) if d else None, 9 - d % 7, (None, 60, 70, 1, 0)[(d * d + s) % 5]) for s in range(6) for d in range(s // 5 * -1 + 1, 90)]
    days = spark.createDataFrame(rows, "sku long, sales_date date, total_sales_qty bigint, total_available_quantity bigint")
    found, marked = so.correct_stockout_sales(days), so.mark_low_stock(days)
    columns = ["sku", "sales_date", "low_stock"]
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, marked.select(columns).collect()))
    assert marked.where("low_stock AND sku < 5").count() > 20 and marked.where("low_stock AND sku = 5").count() == 0


def test_months_are_sorted_once_and_keep_no_hash_maps(spark):
    """The months of a SKU follow from two sorts, which spill; equal to sums by hand, also with months without rows."""
    rows = [("a", date(2024, 1, 3), 0), ("a", date(2024, 1, 20), 4), ("a", date(2024, 1, 20), 1), ("a", date(2024, 4, 2), 6), ("b", date(2024, 2, 9), None),
            ("b", date(2024, 3, 9), 2), (None, date(2024, 4, 30), 7), ("c", date(2024, 1, 1), 0), ("d", date(2023, 12, 31), -2), ("d", date(2024, 4, 1), 3)]
    frame = spark.createDataFrame(rows, "sku string, sales_date date, total_sales_qty bigint")
    months = h.monthly_totals(h.trim_to_first_sale(frame, "2024-04-30"), "2024-04-30")
    got = sorted(((r["sku"] or "", r["month_end"].month, r["qty"], r["days"]) for r in months.collect()))
    assert got == [("", 4, 7, 1), ("a", 1, 5, 12), ("a", 2, 0, 29), ("a", 3, 0, 31), ("a", 4, 6, 30), ("b", 3, 2, 23), ("b", 4, 0, 30), ("d", 4, 3, 30)]
    untrimmed = sorted(((r["sku"] or "", r["month_end"].month, r["qty"]) for r in h.monthly_totals(frame, "2024-04-30").collect()))
    assert untrimmed == [g[:3] for g in got]
    plan = months._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" not in plan and "SortAggregate" in plan


def test_a_calendar_is_made_by_many_tasks(spark):
    """Few distinct SKUs are read by one task; their days are not made by that one."""
    skus = spark.range(2000).select((F.col("id") % 40).alias("sku")).distinct()
    days = h.sku_calendar(skus, "2024-01-01", "2024-01-10")
    parts = days.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert sum(r["count"] for r in parts) == 400 and days.distinct().count() == 400
    assert len(parts) > 1
