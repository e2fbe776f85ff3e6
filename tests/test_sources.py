from datetime import date

import pytest
from pyspark.sql import functions as F

from merch.functions import text as tx
from merch.session import spread, stage_path, staged
from merch.sources import feeds as fd
from merch.sources import tables as tb
from merch.sources import workbook as wb


def grid_row(day, shop, *fees):
    return ["", shop, day, *[""] * 13, *fees]


def test_adfee_rerun_leaves_the_same_rows(spark):
    raw = spark.createDataFrame(
        [(0, grid_row("2031-05-02", "total", "￥7,008.25", "￥0.00", "￥0.00")),
         (1, grid_row("2031-05-02", "Q7", "￥7,008.25", "0.00", "3.5")), (2, grid_row(" 2031-05-02", "Q8", "", "x", "3.0625"))],
        "position int, cells array<string>",
    )
    path = stage_path(spark, "fees")
    for _ in range(2):
        fd.adfee_daily_replace(raw, path, ["2031-05-02"])
    rows = spark.read.parquet(path).orderBy("shop").collect()
    assert [(r["shop"], r["plp_ad_rate"], r["po_ad_rate"], r["plg_ad_rate"]) for r in rows] == [("Q7", 7008.25, 0.0, 3.5), ("Q8", None, None, 3.0625)]
    assert {r["d_date"] for r in rows} == {date(2031, 5, 2)}


def test_replace_day_also_empties_a_day(spark):
    path = stage_path(spark, "days")
    rows = spark.createDataFrame([(date(2024, 1, 1), 1), (date(2024, 1, 2), 2)], "d_date date, v int")
    tb.replace_days(rows, path)
    tb.replace_day(rows.where("v > 1"), path, "2024-01-01")
    assert [r["v"] for r in spark.read.parquet(path).collect()] == [2]


def test_rewrite_and_range(spark):
    path = stage_path(spark, "range")
    rows = [(date(2024, 1, d), d) for d in range(1, 6)] + [(None, 9)]
    tb.overwrite(spark.createDataFrame(rows, "d date, v int"), path)
    tb.rewrite(spark, path, lambda t: tb.drop_range(t, "d", "2024-01-02", "2024-01-04"))
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 5, 9]


def test_null_safe_update_and_delete(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert [r["v"] for r in tb.delete_where(df, F.col("k") == "a").collect()] == [2]
    assert sorted(r["v"] for r in tb.update_where(df, F.col("k") == "a", {"v": F.lit(7)}).collect()) == [2, 7]


def test_clean_rows_by_place(spark):
    df = spark.createDataFrame([("a ", " ", "1,2，3", "nan"), (None, "x", "", " 4 ")], "a string, b string, c string, d string")
    rows = [tuple(r) for r in wb.clean_rows(df, wb.NUMERIC_PLACES["inventory"]).collect()]
    assert rows == [("a", None, "123", None), (None, "x", None, "4")]


def test_labels_become_columns(spark):
    schema = wb.schema_from_labels(["SKU-No", "Qty (pcs)", "数量（件）"], {"数量（件）": "shu_liang"})
    assert schema.fieldNames() == ["sku_no", "qty", "shu_liang"]
    assert schema["sku_no"].metadata["comment"] == "SKU-No"
    assert tx.header_name("Fee)x") == "fee"


def test_money_text(spark):
    df = spark.createDataFrame([("￥7,008.25",), ("free",), (None,)], "t string")
    assert [r["m"] for r in df.select(tx.money(F.col("t")).alias("m")).collect()] == [7008.25, None, None]


def test_order_without_goods_keeps_its_line(spark):
    body = '{"code": 200, "result": [{"orderNo": "1", "goodsList": []}, {"orderNo": "2", "goodsList": [{"qty": 2, "unitValue": 1.5, "kg": 3}, {"qty": 1}]}]}'
    replies = spark.createDataFrame([(body,), ('{"code": 500, "result": [{"orderNo": "3"}]}',), ("broken",)], "body string")
    orders = fd.freight_orders(replies)
    rows = fd.order_lines(orders).orderBy("orderNo", "line").collect()
    assert [(r["orderNo"], r["qty"], r["total_qty"], r["total_value"]) for r in rows] == [("1", None, 0, 0.0), ("2", 2, 3, 3.0), ("2", 1, 3, 3.0)]


def test_unknown_feed_is_refused(spark):
    with pytest.raises(ValueError):
        fd.read_dimension(spark.createDataFrame([("x", "y")], "feed string, body string"), "nope")


def test_staged_rows_survive_and_spread_only_when_few(spark):
    df = spark.range(10).coalesce(1)
    assert staged(df, "t").count() == 10
    assert spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 32)
    assert spread(wide).rdd.getNumPartitions() == 32


def test_single_results_and_failed_replies(spark):
    bodies = ['{"code":200,"result":{"id":"a"}}', '{"code":200,"result":[{"id":"b"},{"id":"c"}]}', '{"code":500,"result":[]}', "not json", None, '{"code":200,"result":[]}']
    replies = spark.createDataFrame(list(enumerate(bodies)), "n int, body string")
    assert [r["item"]["id"] for r in fd.unwrap_envelope(replies, "body", fd.ITEM).orderBy("n", "item.id").collect()] == ["a", "b", "c"]
    assert sorted(r["n"] for r in fd.failed_replies(replies, "body").collect()) == [2, 3, 4]


def test_sheets_are_grouped_by_header_and_empty_ones_drop_out(spark, tmp_path):
    texts = {"a 1.csv": "Sku No,Qty\nA,1\n", "b.csv": "\nSku No,Qty\nB,2\nC,3\n", "c.csv": "Sku No,Shop\nD,Q7\n", "d.csv": "", "e%41.csv": "Sku No,Qty\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    paths = [str(tmp_path / n) for n in texts]
    heads = wb.first_lines(wb.sheet_lines(spark, [str(tmp_path)])).groupBy("head").count().collect()
    assert {r["head"]: r["count"] for r in heads} == {"Sku No,Qty": 3, "Sku No,Shop": 1}
    for source in ([str(tmp_path)], paths):
        rows = wb.read_sheets(spark, source)
        assert len(rows.columns) == 3
        assert sorted(tuple(x or "" for x in r) for r in rows.collect()) == [("A", "1", ""), ("B", "2", ""), ("C", "3", ""), ("D", "", "Q7")]
    assert wb.read_sheets(spark, [paths[3]]).columns == [] and wb.read_sheets(spark, []).count() == 0


def test_sheets_are_read_once(spark, tmp_path):
    """Also a sheet in several splits, quoted cells, rows of other lengths, repeated and empty labels, and a header again in the data."""
    (tmp_path / "long.csv").write_text("Sku,Qty,Note\n" + "".join(f's{i},"1,{i:03d}", n \n' for i in range(2000)))
    (tmp_path / "odd.csv").write_text('Note,Sku,,Qty,qty\n"say ""hi""",o1,x,1\nonly\nNote,Sku,,Qty,qty\na,b,c,d,e,f\n')
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4k")
    try:
        rows = wb.read_sheets(spark, [str(tmp_path)])
        plan = rows._jdf.queryExecution().executedPlan().toString()
        got = {tuple(r) for r in rows.select("sku", "qty", "note", "_c2", "qty3", "qty4").collect()}
        assert wb.sheet_lines(spark, [str(tmp_path)]).rdd.getNumPartitions() > 3
    finally:
        spark.conf.set(setting, before)
    assert plan.count("FileScan") == 2 and "text" not in plan  # staged lines and one row a file
    assert len(got) == 2000 + 4
    assert ("s7", "1,007", " n ", None, None, None) in got
    assert ("o1", None, 'say "hi"', "x", "1", None) in got and (None, None, "only", None, None, None) in got
    assert ("Sku", None, "Note", None, "Qty", "qty") in got and ("b", None, "a", "c", "d", "e") in got


def test_untouched_folders_keep_their_files(spark):
    path = stage_path(spark, "touched")
    days = [(date(2024, m, d), f"{m}/{d}", v) for m in (1, 2, 3) for d, v in ((1, 1), (2, 5), (20, None))] + [(None, "x y%", 7), (date(2024, 2, 9), None, 2)]
    rows = spark.createDataFrame(days, "d date, name string, v int").withColumn("part", F.coalesce(F.concat(F.lit("m %/"), F.month("d")), F.lit(None)))
    rows.coalesce(1).write.partitionBy("part").parquet(path)
    files = lambda: {r[0]: r[1] for r in spark.read.parquet(path).groupBy("part").agg(F.min("_metadata.file_path")).collect()}
    before, low = files(), F.col("v") < 5

    touched = tb.rewrite_touched(spark, path, ["part"], low & (F.col("d") < "2024-03-01"), lambda t: tb.delete_where(t, low & (F.col("d") < "2024-03-01")))
    after = files()
    assert sorted(touched) == [("m %/1",), ("m %/2",)]
    assert {k for k in before if before[k] == after[k]} == {"m %/3", None}
    left = sorted((str(r["d"]), r["v"]) for r in spark.read.parquet(path).collect())
    assert left == sorted((str(d), v) for d, _, v in days if not (v is not None and v < 5 and d < date(2024, 3, 1)))

    gone = F.col("part") == "m %/3"
    assert tb.rewrite_touched(spark, path, ["part"], gone, lambda t: tb.delete_where(t, gone)) == [("m %/3",)]
    assert spark.read.parquet(path).where(gone).count() == 0 and spark.read.parquet(path).count() == len(left) - 3
    assert tb.rewrite_touched(spark, path, ["part"], gone, lambda t: t) == []
    assert tb.rewrite_touched(spark, path, ["part"], F.col("part").isNull(), lambda t: tb.update_where(t, F.lit(True), {"v": F.lit(9)})) == [(None,)]
    assert spark.read.parquet(path).where("part IS NULL").first()["v"] == 9
    with pytest.raises(ValueError):
        tb.rewrite_touched(spark, path, ["part"], F.col("v") == 9, lambda t: t.withColumn("part", F.lit("elsewhere")))


def test_a_deep_page_reads_its_slice(spark):
    rows = spark.range(40_000).select(F.xxhash64("id").alias("h"), "id")
    order = [(F.col("h") % 100).desc(), F.col("id")]
    slices, directory = tb.page_slices(rows, order, 20)
    sizes = [tuple(r) for r in directory.orderBy("_slice").collect()]
    assert len(sizes) == 20 and all(b == sum(n for _, n, _ in sizes[:i]) for i, (_, _, b) in enumerate(sizes))
    want = [r["id"] for r in rows.orderBy(*order).collect()]
    for page, size in ((1, 300), (77, 300), (10_000, 4), (134, 300), (135, 300), (3, 9_000)):
        found = tb.read_page(slices, directory, order, page, size)
        assert [r["id"] for r in found.collect()] == want[(page - 1) * size : page * size]
    deep = tb.read_page(slices, directory, order, 10_000, 4)
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_slice" in plan
    empty, none = tb.page_slices(rows.where("false"), order, 4)
    assert tb.read_page(empty, none, order, 1).count() == 0
