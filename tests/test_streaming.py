"""Streams over many batches: restarts, eviction, late rows and replays."""

from datetime import date, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from merch.operators import stockout as batch
from merch.session import stage_path
from merch.sources.tables import latest_days, replace_day_versions
from merch.streaming import feeds, runs, stockout

START = date(2031, 1, 1)


def day(n):
    return START + timedelta(days=n)


def landed(spark, schema, parts):
    """One file for each part, in order."""
    path = stage_path(spark, "landed")
    spark.createDataFrame([], schema).write.parquet(path)
    land(spark, path, schema, parts)
    return path


def land(spark, path, schema, parts):
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def rocksdb(spark):
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, stockout.ROCKSDB)
    yield
    spark.conf.set(setting, before)


SALES = "sku bigint, ts timestamp, sales_qty bigint"


def test_days_leave_the_state_and_late_rows_change_nothing(spark):
    at = lambda n: f"{day(n)} 12:00:00"
    parts = [[(s, at(n), 1) for s in range(3)] + [(0, at(max(n - 1, 0)), 10)] for n in range(0, 24, 3)] + [[(0, at(0), 1000)], [(9, at(60), 1)]]
    rows = [[(s, t, q) for s, t, q in part] for part in parts]
    path = stage_path(spark, "landed")
    schema = "sku bigint, ts string, sales_qty bigint"
    for part in rows:
        spark.createDataFrame(part, schema).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)
    stream = runs.file_stream(spark, path, spark.read.parquet(path).schema, files=1)
    writer = feeds.stream_daily_totals(stream).writeStream.format("parquet").option("path", (target := stage_path(spark, "final")))
    progress = runs.finish(spark, writer)
    state = [p.stateOperators[0] for p in progress]
    assert len(progress) >= len(parts)
    assert sum(s.numRowsRemoved for s in state) >= 20 and max(s.numRowsTotal for s in state) <= 10
    assert sum(s.numRowsDroppedByWatermark for s in state) > 0
    got = {(r["sku"], r["sales_date"]): r["total_sales_qty"] for r in spark.read.parquet(target).collect()}
    wanted = {}
    for part in rows[:-2]:
        for sku, t, q in part:
            key = (sku, date.fromisoformat(t[:10]))
            wanted[key] = wanted.get(key, 0) + q
    assert got == wanted  # final days only, once each, without the late 1000


def test_a_failed_batch_runs_again(spark):
    path = landed(spark, "sku bigint, sales_date date, total_sales_qty bigint", [[(1, day(n), n)] for n in range(6)])
    schema = spark.read.parquet(path).schema
    target, checkpoint, failed = stage_path(spark, "target"), stage_path(spark, "progress"), []

    def flaky(rows, number):
        rows.write.mode("overwrite").parquet(f"{target}/_batch={number}")
        if number == 3 and not failed:
            failed.append(number)
            raise RuntimeError("lost")

    with pytest.raises(StreamingQueryException):
        runs.drain_batches(runs.file_stream(spark, path, schema, files=1), flaky, checkpoint)
    again = runs.drain_batches(runs.file_stream(spark, path, schema, files=1), flaky, checkpoint)
    assert failed == [3] and min(p.batchId for p in again) == 3
    assert sorted(r["total_sales_qty"] for r in spark.read.parquet(target).collect()) == [0, 1, 2, 3, 4, 5]


LISTINGS = "category string, vc_item_link string, ts timestamp, d_num1 string, d_num2 string"


def test_frontier_lists_a_link_once_per_category(spark):
    """Also when it comes again long after the state has dropped it, and in another run."""
    row = lambda c, link, n, mark="3 sold": (c, link, day(n), mark, "")
    schema = "category string, vc_item_link string, ts date, d_num1 string, d_num2 string"
    listings = lambda stream: stream.withColumn("ts", F.col("ts").cast("timestamp"))
    path = landed(spark, schema, [[row("a", "x", 0), row("a", "x", 0), row("b", "x", 0)], [row("a", "y", 5), row("a", "z", 5, "new")], [row("a", "x", 40), row("a", "kept", 40)]])
    details = spark.createDataFrame([("a", "kept"), ("b", "y")], "category string, vc_item_link string")
    target, checkpoint = stage_path(spark, "frontier"), stage_path(spark, "progress")

    def run():
        stream = feeds.stream_frontier(listings(runs.file_stream(spark, path, spark.read.parquet(path).schema, files=1)), details)
        return sorted(tuple(r) for r in runs.drain_new(stream, target, feeds.FRONTIER_KEYS, checkpoint).collect())

    assert run() == [("a", "x"), ("a", "y"), ("b", "x")]
    land(spark, path, schema, [[row("a", "x", 80), row("b", "kept", 80)], [row("b", "y", 81), row("b", "x", 90)]])
    assert run() == [("a", "x"), ("a", "y"), ("b", "kept"), ("b", "x")]


def test_older_loads_change_nothing(spark):
    schema = "d_date date, shop string, fee int, load bigint"
    loads = [[(day(d), f"s{i}", 100 * n + i, n) for d in range(n, 6) for i in range(3 - n % 2)] for n in range(4)]
    tables = []
    for order in ((0, 1, 2, 3), (3, 2, 1, 0), (2, 3, 3, 0, 1, 0, 2), ((0, 1, 2, 3),)):
        path = stage_path(spark, "versions")
        for n in order:
            rows = sum((loads[m] for m in n), []) if isinstance(n, tuple) else loads[n]
            replace_day_versions(spark.createDataFrame(rows, schema), path)
        tables.append(sorted(tuple(r) for r in latest_days(spark.read.parquet(path)).select("d_date", "shop", "fee").collect()))
    assert tables[0] == sorted((day(d), f"s{i}", 100 * min(d, 3) + i) for d in range(6) for i in range(3 - min(d, 3) % 2))
    assert all(t == tables[0] for t in tables)


def test_latest_days_reads_the_newest_folders_only(spark):
    path = stage_path(spark, "versions")
    for n in range(3):
        replace_day_versions(spark.createDataFrame([(day(d), d, n) for d in range(4)], "d_date date, fee int, load bigint"), path)
    found = latest_days(spark.read.parquet(path))
    assert sorted(r["fee"] for r in found.collect()) == [0, 1, 2, 3]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [concat_ws" in plan and "ReadSchema: struct<fee:int>" in plan


DAYS = "sku bigint, sales_date date, total_sales_qty bigint, total_available_quantity bigint"


def daily_rows(skus=3, days=120):
    rows = []
    for sku in range(skus):
        for n in range(sku, days):
            low = n % 17 in (3, 4, 5)
            if (n + sku) % 11:
                rows.append((sku, day(n), 1 if low else 5 + (n * 7 + sku) % 9, None if n % 13 == 0 else 1 if low else 60 + n % 20))
    return rows


def corrected(spark, parts, delay="10 days", runs_at=(None,)):
    schema = spark.createDataFrame([], DAYS).schema
    path, target, checkpoint = landed(spark, schema, []), stage_path(spark, "corrected"), stage_path(spark, "progress")
    done = 0
    for stop in runs_at:
        land(spark, path, schema, parts[done:stop])
        done = stop or len(parts)
        found = runs.drain(stockout.stream_stockout(runs.file_stream(spark, path, schema, files=1), delay), target, checkpoint=checkpoint)
    return sorted((r["sku"], r["sales_date"], r["total_sales_qty"], round(r["adjusted_qty"], 9)) for r in found.collect())


def in_batch(spark, rows):
    found = batch.correct_stockout_sales(spark.createDataFrame(rows, DAYS)).collect()
    return sorted((r["sku"], r["sales_date"], float(r["total_sales_qty"]), round(r["adjusted_qty"], 9)) for r in found)


END_MARK = [(-1, day(400), 0, None)]


def test_shuffled_days_give_the_batch_result(spark, rocksdb):
    rows = daily_rows()
    place = lambda r: (r[1] - START).days + (r[0] * 31 + (r[1] - START).days * 17) % 10
    parts = [[r for r in rows if place(r) // 18 == i][::-1] for i in range(8)]
    found = corrected(spark, [*parts, END_MARK], runs_at=(3, 6, None))
    assert found == in_batch(spark, rows)
    assert any(q != a for _, _, q, a in found)


def test_rows_behind_final_days_change_nothing(spark, rocksdb):
    """A day that is out is not taken back; a late day is left out; parts of a day that come in time add up."""
    rows = daily_rows(1, 60)
    split = [(s, d, 2, q) for s, d, n, q in rows if n > 5] + [(s, d, n - 2, None) for s, d, n, q in rows if n > 5] + [r for r in rows if r[2] <= 5]
    parts = [[r for r in split if (r[1] - START).days // 12 == i] for i in range(5)]
    late = [(0, day(3), 10_000, 1), (0, day(0), 10_000, 1)]
    assert corrected(spark, [*parts, [*late], END_MARK], delay="2 days") == in_batch(spark, rows)


def test_days_wait_for_the_watermark(spark, rocksdb):
    rows = daily_rows(1, 30)
    found = corrected(spark, [rows], delay="5 days")
    assert 0 < len(found) < len(rows) and max(r[1] for r in found) <= day(24)


def test_large_landings_are_several_files_and_one_batch(spark, monkeypatch):
    """No task writes or reads a whole landing; a landing is still one batch, so nothing of it comes late."""
    from merch.plans import streaming_queries as sq

    monkeypatch.setattr(sq, "FILE_ROWS", 100)
    day = F.expr("date_add(DATE '2024-01-01', CAST(id DIV 7 AS INT))")
    rows = spark.range(2800).select((F.col("id") % 3).alias("sku"), day.cast("timestamp").alias("ts"), F.lit(2).cast("bigint").alias("sales_qty"), day.alias("d"))
    rows = rows.where("d < DATE '2024-12-01' OR d > DATE '2025-01-20'")
    landings = sq.Landings(spark, rows.withColumn("_place", sq.shuffled(F.col("d"), "ts", "sku")).drop("d"), "many")
    target = sq.stage_path(spark, "daily")

    def run(stream, checkpoint):
        return sq.runs.drain_updates(sq.st.stream_daily_totals(stream, f"{sq.DELAY_DAYS} days"), target, ["sku", "sales_date"], checkpoint)

    got = sq._in_two_runs(landings, run).toPandas()
    want = rows.groupBy("sku", F.col("d").alias("sales_date")).agg(F.sum("sales_qty").alias("total_sales_qty")).toPandas()
    keys = ["sku", "sales_date"]
    assert landings.files > 3
    assert got.sort_values(keys).values.tolist() == want.sort_values(keys).values.tolist()
    assert max(r[0] for r in spark.read.parquet(landings.path).groupBy(F.input_file_name()).count().select("count").collect()) <= 120


def test_fee_loads_of_several_files(spark, monkeypatch, tmp_path):
    """A load is dealt to several files and read as one batch, with the same rows stored."""
    from merch.plans import streaming_queries as sq

    ts = F.expr("timestampadd(HOUR, CAST(id AS INT), TIMESTAMP '2024-01-05 00:00:00')")
    kinds = F.expr("element_at(array('view', 'click', 'purchase', 'error'), CAST(id % 4 + 1 AS INT))")
    events = spark.range(300).select(F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 9).alias("user_id"), kinds.alias("event_type"), (F.col("id") / 4).alias("value"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    asked = []
    plain = sq.runs.file_stream
    monkeypatch.setattr(sq.runs, "file_stream", lambda spark, path, schema, files=None: asked.append(files) or plain(spark, path, schema, files))
    want = sorted(map(str, sq._fees(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(sq, "FILE_ROWS", 40)
    assert sorted(map(str, sq._fees(spark, str(tmp_path)).collect())) == want and len(want) > 90
    assert asked[0] == 1 and asked[-1] > 1
