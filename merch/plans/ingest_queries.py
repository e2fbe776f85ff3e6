"""Feed and table-maintenance queries. Landed files are first written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from merch.functions import numbers as num
from merch.functions import text as tx
from merch.operators import grading as g
from merch.plans import binding as b
from merch.plans.grading_queries import METRICS
from merch.plans.query import Query
from merch.session import spread, stage_path, staged
from merch.sources import feeds as fd
from merch.sources import replies as rp
from merch.sources import tables as tb
from merch.sources import workbook as wb

# --- workbooks --------------------------------------------------------------

LABELS = {"Part-Key": "p_partkey", "Name（品名）": "name", "On-Hand(pcs)": "on_hand", "Value": "value", "Note": "note"}
RENAMES = {"Name（品名）": "name"}


def _sheet_rows(spark, sf_dir):
    """Part rows as a clerk would type them."""
    whole = F.format_number(F.col("p_partkey") * 1000 + F.col("p_size"), 0)
    return b.table(spark, sf_dir, "part").select(
        "p_size",
        F.col("p_partkey").cast("string").alias("Part-Key"),
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("Name（品名）"),
        F.when(F.col("p_size") % 3 == 0, F.replace(whole, F.lit(","), F.lit("，"))).otherwise(whole).alias("On-Hand(pcs)"),
        F.format_number("p_retailprice", 2).alias("Value"),
        F.when(F.col("p_size") % 4 == 0, F.lit("nan")).when(F.col("p_size") % 4 == 1, F.lit("  ")).otherwise(F.col("p_brand")).alias("Note"),
    )


def workbook(spark, sf_dir):
    """Three sheets: full, without the last label, and empty; then read, name and clean them."""
    rows, root = _sheet_rows(spark, sf_dir), stage_path(spark, "workbook")
    labels = list(LABELS)
    parts = {
        "full": (rows.where("p_size % 2 = 0"), labels),
        "short": (rows.where("p_size % 2 = 1"), labels[:-1]),
        "empty": (rows.where("p_size < 0"), labels),
    }
    for name, (part, keep) in parts.items():
        options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        part.select(*[F.col(f"`{c}`") for c in keep]).write.options(**options).csv(f"{root}/{name}")
    return wb.read_sheets(spark, [f"{root}/{name}" for name in parts], RENAMES)


def _cleaned_workbook(spark, sf_dir):
    return wb.clean_rows(workbook(spark, sf_dir), ["on_hand", "value"])


def _column_comments(spark, sf_dir):
    """Generated columns with their labels, next to how many cells each holds."""
    sheet = staged(workbook(spark, sf_dir), "sheet")
    fields = wb.schema_from_labels(list(LABELS), RENAMES).fields
    counts = sheet.agg(*[F.count(f"`{f.name}`").alias(f.name) for f in fields])
    long = counts.unpivot([], [f.name for f in fields], "column_name", "cells")
    label = F.lit(None).cast("string")
    for f in fields:
        label = F.when(F.col("column_name") == f.name, F.lit(f.metadata["comment"])).otherwise(label)
    return long.withColumn("label", label)


# --- JSON feeds -------------------------------------------------------------


def table_pages(spark, sf_dir):
    """Suppliers exported as pages of 50 rows, landed as JSON lines and read back."""
    path = stage_path(spark, "pages")
    names = ["s_suppkey", "s_name", "s_acctbal"]
    rows = b.table(spark, sf_dir, "supplier").select(
        F.floor(F.col("s_suppkey") / 50).alias("page"), "s_suppkey", F.array(*[F.col(c).cast("string") for c in names]).alias("cells")
    )
    pages = rows.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "cells"))).alias("r"))
    doc = F.struct(
        F.struct(
            F.array(*[F.struct(F.lit(n).alias("name")) for n in names]).alias("fields"),
            F.col("r.cells").alias("data"),
            F.struct((F.col("page") + 1).alias("pageIndex"), F.lit(50).alias("pageSize")).alias("pageInfo"),
        ).alias("data")
    )
    pages.select(F.to_json(doc).alias("value")).write.text(path)
    return fd.page_fields(fd.read_table_pages(spark, path), names)


def _first_match(spark, sf_dir):
    parts = b.table(spark, sf_dir, "part")
    hits = [tb.first_match(parts, "p_name", word, "p_partkey", "p_partkey").withColumn("word", F.lit(word)) for word in ("gear", "bolt", "nothing")]
    return hits[0].unionByName(hits[1]).unionByName(hits[2])


def _reply(items, ok):
    """A JSON reply around a list column."""
    return F.to_json(
        F.struct(
            ok.alias("success"),
            F.when(ok, "0").otherwise("1").alias("status"),
            F.when(ok, 200).otherwise(500).alias("code"),
            items.alias("result"),
            F.lit(1000000000000).alias("timestamp"),
        )
    )


def _envelopes(spark, sf_dir):
    """Each event as a reply; errors come with code 500."""
    item = F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("code"), F.col("props").alias("name"))
    replies = b.table(spark, sf_dir, "events").select(
        "event_id", _reply(F.array(item, item), F.col("event_type") != "error").alias("body")
    )
    return fd.unwrap_envelope(replies, "body", fd.ITEM).select("event_id", "item.*")


def _dimensions(spark, sf_dir):
    """All twelve reference feeds, each fed from one of the given dimension tables."""
    source = {
        "country": ("nation", "n_nationkey", "n_name"), "fba_code": ("supplier", "s_suppkey", "s_name"),
        "overseas_warehouse": ("region", "r_regionkey", "r_name"), "mixed_code": ("part", "p_partkey", "p_brand"),
        "order_channel": ("customer", "c_custkey", "c_mktsegment"), "declare_type": ("part", "p_partkey", "p_type"),
        "delivery_warehouse": ("nation", "n_regionkey", "n_name"), "file_type": ("documents", "doc_id", "lang"),
        "unit": ("part", "p_partkey", "p_name"), "address": ("customer", "c_custkey", "c_name"),
        "courier_channel": ("orders", "o_orderkey", "o_orderpriority"), "courier_delivery_warehouse": ("supplier", "s_nationkey", "s_name"),
    }
    whole = None
    for feed, (table, key, name) in source.items():
        item = F.struct(F.col(key).cast("string").alias("id"), F.concat(F.lit("C"), F.col(key).cast("string")).alias("code"), F.col(name).alias("name"))
        replies = b.table(spark, sf_dir, table).select(F.lit(feed).alias("feed"), _reply(F.array(item), F.lit(True)).alias("body"))
        part = fd.read_dimension(replies, feed)
        whole = part if whole is None else whole.unionByName(part)
    return whole


DIMENSION_SQL = " UNION ALL ".join(
    f"SELECT '{feed}' AS feed, {key}::VARCHAR AS id, 'C' || {key} AS code, {name} AS name FROM {table}"
    for feed, table, key, name in [
        ("country", "nation", "n_nationkey", "n_name"), ("fba_code", "supplier", "s_suppkey", "s_name"),
        ("overseas_warehouse", "region", "r_regionkey", "r_name"), ("mixed_code", "part", "p_partkey", "p_brand"),
        ("order_channel", "customer", "c_custkey", "c_mktsegment"), ("declare_type", "part", "p_partkey", "p_type"),
        ("delivery_warehouse", "nation", "n_regionkey", "n_name"), ("file_type", "documents", "doc_id", "lang"),
        ("unit", "part", "p_partkey", "p_name"), ("address", "customer", "c_custkey", "c_name"),
        ("courier_channel", "orders", "o_orderkey", "o_orderpriority"), ("courier_delivery_warehouse", "supplier", "s_nationkey", "s_name"),
    ]
)


def freight_orders(spark, sf_dir):
    """Orders as freight documents with 0-3 goods each, wrapped in replies; every 10th reply fails."""
    key = F.col("o_orderkey")
    goods = F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(3)), lambda i: i <= key % 4),
        lambda i: F.struct(
            F.concat(key.cast("string"), F.lit("-"), i.cast("string")).alias("referenceId"),
            (key % 7 + i).alias("qty"), i.cast("bigint").alias("ctn"),
            (key % 5 * F.lit(0.5)).alias("kg"), (i * F.lit(1.25)).alias("unitValue"),
        ),
    )
    order = F.struct(key.cast("string").alias("orderNo"), F.col("o_custkey").cast("string").alias("customer"), goods.alias("goodsList"))
    replies = spread(b.table(spark, sf_dir, "orders")).select(_reply(F.array(order), key % 10 != 0).alias("body"))
    return fd.freight_orders(replies)


FREIGHT_SQL = """good AS (SELECT o_orderkey AS k, o_custkey FROM orders WHERE o_orderkey % 10 <> 0),
goods AS (SELECT k, i, k % 7 + i AS qty, i AS ctn, k % 5 * 0.5::DOUBLE AS kg, i * 1.25::DOUBLE AS unitValue FROM good, range(1, 4) AS r(i) WHERE i <= k % 4),
totals AS (SELECT k, o_custkey, coalesce(sum(qty), 0) AS total_qty, coalesce(sum(ctn), 0) AS total_ctn, coalesce(sum(kg), 0) AS total_kg,
  coalesce(sum(qty * unitValue), 0) AS total_value FROM good LEFT JOIN goods USING (k) GROUP BY 1, 2)"""

def track_replies(spark, sf_dir):
    """Each user's events of a day as the track of an order; some replies are errors, some are cut off, some have one bare item."""
    at, key = F.col("ts").cast("timestamp"), F.col("event_id")
    value = F.when(key % 7 == 0, F.lit('"n/a"')).when(key % 7 == 1, F.lit("null")).otherwise(F.col("value").cast("string"))
    extra = F.when(key % 3 == 0, F.concat(F.lit(', "detail": '), "props")).otherwise("")
    entry = F.concat(
        F.lit('{"eventId": '), key.cast("string"), F.lit(', "status": "'), "event_type", F.lit('", "time": "'),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit('", "value": '), value, extra, F.lit("}"),
    )
    days = b.table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct(key, entry.alias("entry")))).alias("e")
    )
    whole = F.array_join("e.entry", ", ")
    result = F.when(F.size("e") == 1, whole).when(F.col("user_id") % 13 == 5, F.lit('"none"')).otherwise(F.concat(F.lit("["), whole, F.lit("]")))
    code = F.when(F.day("day") % 10 == 0, "500").otherwise("200")
    body = F.concat(F.lit('{"success": true, "code": '), code, F.lit(', "result": '), result, F.when(F.col("user_id") % 11 == 0, "").otherwise("}"))
    return days.select("user_id", "day", body.alias("body"))


TRACK_SQL = """e AS (SELECT *, ts::DATE AS day, count(*) OVER (PARTITION BY user_id, ts::DATE) AS n FROM events),
r AS (SELECT *, CASE WHEN user_id % 11 = 0 THEN 'not JSON' WHEN day(ts) % 10 = 0 THEN 'code 500' WHEN n > 1 AND user_id % 13 = 5 THEN 'no items' END AS reason FROM e)"""


def _track(spark, sf_dir):
    fields = {"event_id": ("$.eventId", "bigint"), **rp.TRACK, "k": ("$.detail.k", "int")}
    found = rp.order_track(track_replies(spark, sf_dir), fields=fields)
    return found.withColumn("logged", F.date_format("logged", "yyyy-MM-dd HH:mm:ss")).withColumn("unread", F.array_join("unread", ","))


def _unread_track(spark, sf_dir):
    return rp.unread_replies(track_replies(spark, sf_dir))


def _track_fields(spark, sf_dir):
    return rp.item_fields(rp.reply_items(track_replies(spark, sf_dir)))


def _cartons(spark, sf_dir):
    """Orders with 0-3 measured cartons each; odd ones come as one bare object, and an order without cartons may lack the list."""
    key = F.col("o_orderkey")
    cartons = F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(3)), lambda i: i <= key % 4),
        lambda i: F.struct(i.alias("no"), (key % 5 * F.lit(0.5) + i).alias("kg"), F.when(i < 3, i * F.lit(0.125)).alias("cmb")),
    )
    order = F.struct(key.cast("string").alias("orderNo"), F.when(key % 8 > 0, cartons).alias("cartons"))
    one = F.to_json(order)
    result = F.when(key % 2 == 1, one).otherwise(F.concat(F.lit("["), one, F.lit("]")))
    code = F.when(key % 10 == 0, "404").otherwise("200")
    body = F.concat(F.lit('{"code": '), code, F.lit(', "result": '), result, F.lit("}"))
    replies = spread(b.table(spark, sf_dir, "orders")).select(key.alias("order_no"), body.alias("body"))
    return rp.order_cartons(replies)


# --- advertising fees -------------------------------------------------------

FEE_TYPES = {"plp_ad_rate": "click", "po_ad_rate": "view", "plg_ad_rate": "purchase"}
FEE_DAYS = ["2024-01-14", "2024-01-15"]


def fee_grid(spark, sf_dir):
    """Landed grid rows: 19 text cells per day and shop, and a total in row 0 of each day."""
    day = F.to_date("ts")
    value = F.col("value").cast("decimal(12,2)")
    fees = [F.coalesce(F.sum(F.when(F.col("event_type") == t, value)), F.lit(0)).alias(c) for c, t in FEE_TYPES.items()]
    shops = b.table(spark, sf_dir, "events").groupBy(day.alias("day"), F.col("user_id")).agg(*fees)
    text = {c: F.concat(F.lit("￥"), F.format_number(F.col(c) * 100, 2), F.lit(" ")) for c in FEE_TYPES}
    blank = [F.lit("-")] * 13
    cells = F.array(
        F.lit("x"), F.concat(F.lit("H"), F.format_number(F.col("user_id") + 1000, 0)), F.concat(F.lit(" "), F.col("day").cast("string")),
        *blank, *[text[c] for c in FEE_TYPES],
    )
    rows = shops.select("day", (F.col("user_id") + 1).alias("position"), cells.alias("cells"))
    totals = shops.select("day").distinct().select("day", F.lit(0).cast("bigint").alias("position"), F.array_repeat(F.lit("total"), 19).alias("cells"))
    return rows.unionByName(totals)


FEE_SQL = "fees AS (SELECT ts::DATE AS d_date, 'H' || (user_id + 1000) AS shop, " + ", ".join(
    f"100 * coalesce(sum(CASE WHEN event_type = '{t}' THEN value::DECIMAL(12,2) END), 0)::DOUBLE AS {c}" for c, t in FEE_TYPES.items()
) + " FROM events GROUP BY 1, user_id)"


def _fees_replaced(spark, sf_dir):
    """All days loaded with zeros, then two days replaced, the second of them twice."""
    raw = staged(fee_grid(spark, sf_dir), "grid")
    path = stage_path(spark, "adfee")
    zeros = fd.adfee_rows(raw).withColumns({c: F.lit(0.0) for c in FEE_TYPES})
    tb.replace_days(zeros, path)
    fd.adfee_daily_replace(raw, path, FEE_DAYS)
    fd.adfee_daily_replace(raw, path, FEE_DAYS[1:])
    return spark.read.parquet(path)


# --- table maintenance ------------------------------------------------------


def _orders(spark, sf_dir):
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("d"), F.col("o_totalprice").alias("price")
    )


ORDERS_SQL = "SELECT o_orderkey, o_orderstatus, o_orderdate::DATE AS d, o_totalprice AS price FROM orders"


def _appended(spark, sf_dir):
    orders, path = _orders(spark, sf_dir), stage_path(spark, "append")
    tb.append(orders.where("o_orderstatus = 'F'"), path)
    tb.append(orders.where("o_orderstatus <> 'F'"), path)
    return spark.read.parquet(path)


def _reloaded(spark, sf_dir):
    """Loaded twice: the second load empties the table first."""
    orders, path = _orders(spark, sf_dir), stage_path(spark, "reload")
    tb.overwrite(orders, path)
    tb.overwrite(orders.where("o_orderstatus = 'P'"), path)
    return spark.read.parquet(path)


def _replaced(spark, sf_dir):
    """A table replaced by one of another shape."""
    orders, path = _orders(spark, sf_dir), stage_path(spark, "replace")
    tb.overwrite(orders, path)
    tb.overwrite(orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.parquet(path)


def _range_dropped(spark, sf_dir):
    orders, path = _orders(spark, sf_dir), stage_path(spark, "range")
    tb.overwrite(orders, path)
    tb.rewrite(spark, path, lambda t: tb.drop_range(t, "d", "1996-01-01", "1997-12-31"))
    return spark.read.parquet(path)


def _by_month(spark, sf_dir):
    """Orders in folders of their month."""
    path = stage_path(spark, "months")
    _orders(spark, sf_dir).withColumn("month", F.date_format("d", "yyyy-MM")).write.partitionBy("month").parquet(path)
    return path


def _range_dropped_in_place(spark, sf_dir):
    """A closed date range goes; only the folders of its months are written again."""
    path, inside = _by_month(spark, sf_dir), F.col("d").between("1996-01-10", "1997-11-20")
    tb.rewrite_touched(spark, path, ["month"], inside, lambda t: tb.delete_where(t, inside))
    return spark.read.parquet(path).drop("month")


def _updated_in_place(spark, sf_dir):
    path, low = _by_month(spark, sf_dir), (F.col("price") < 20_000) & (F.col("d") < "1995-03-05")
    tb.rewrite_touched(spark, path, ["month"], low, lambda t: tb.update_where(t, low, {"price": F.lit(0.0), "o_orderstatus": F.lit("X")}))
    return spark.read.parquet(path).drop("month")


def _deep_page(spark, sf_dir):
    """Page 60 of 20 rows, looked up in the directory of slices."""
    order = [F.col("price").desc(), F.col("o_orderkey")]
    rows, directory = tb.page_slices(_orders(spark, sf_dir), order, 16)
    return tb.read_page(rows, directory, order, 60, 20)


def _updated(spark, sf_dir):
    return tb.update_where(_orders(spark, sf_dir), F.col("o_orderstatus") == "P", {"price": F.lit(0.0), "o_orderstatus": F.lit("X")})


def _deleted(spark, sf_dir):
    m = staged(b.metrics(spark, sf_dir), "metrics")
    return tb.delete_where(m, F.col("type").isin("T1", "T2"))


def _exported(spark, sf_dir):
    path = stage_path(spark, "export")
    tb.write_csv(_orders(spark, sf_dir), path)
    return spark.read.option("header", True).csv(path)


def _dead_letters(spark, sf_dir):
    """Amounts that do not read as a number go to their own table."""
    text = F.when(F.col("o_orderkey") % 13 == 0, F.lit("n/a")).otherwise(F.concat(F.lit("￥"), F.format_number("o_totalprice", 2)))
    read = b.table(spark, sf_dir, "orders").select("o_orderkey", tx.money(text).alias("amount"))
    good, bad = tb.split_failed(read, F.col("amount").isNull())
    good_path, bad_path = stage_path(spark, "good"), stage_path(spark, "bad")
    tb.append(good, good_path)
    tb.append(bad, bad_path)
    back = lambda p, t: spark.read.parquet(p).withColumn("target", F.lit(t))
    return back(good_path, "good").unionByName(back(bad_path, "failed"))


# --- column functions -------------------------------------------------------


def _text_functions(spark, sf_dir):
    t = F.col("text")
    return b.table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.clip_text(t).alias("head"),
        F.length(tx.double_quotes(t)).alias("quoted_chars"),
        F.length(tx.strip_thousands(t)).alias("plain_chars"),
        F.size(F.split(t, ",")).alias("pieces"),
        tx.trim_or_null(F.concat(F.lit(" "), F.when(F.col("doc_id") % 3 == 0, F.lit("NaN")).otherwise(F.col("lang")))).alias("lang"),
        tx.drop_trailing_commas(F.concat("source", F.lit(",,"))).alias("source"),
    )


def _number_functions(spark, sf_dir):
    q, price = F.col("l_quantity").cast("bigint"), F.col("l_extendedprice")
    return b.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum(q).alias("q"), F.sum(price).alias("p")).select(
        "l_orderkey",
        "l_linenumber",
        num.half_even(F.col("q") / 4).alias("quarter_even"),
        num.half_up(F.col("q") / 4).alias("quarter_up"),
        num.make_even(F.col("q")).alias("even"),
        F.floor(F.col("q") / 7).alias("sevens"),
        (F.col("q") % 7).alias("rest"),
        F.ceil(F.col("p") / 1000).alias("thousands"),
        F.ln("p").alias("log_price"),
        num.capped_at(F.col("q"), F.lit(30)).alias("capped"),
    )


def _column_scan(spark, sf_dir):
    """Renaming scan with a pushed filter."""
    return b.table(spark, sf_dir, "lineitem").where("l_quantity > 25").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_quantity").alias("sales_normalized"), F.col("l_extendedprice").alias("revenue_normalized")
    )


def rows_where(df, predicate):
    """Set level 3 on the rows a caller's predicate selects."""
    return tb.update_where(df.withColumn("level", F.lit(123)), predicate, {"level": F.lit(3)})


QUERIES = {
    "column_scan": Query(
        _column_scan, "order_id:l sales_normalized:d2 revenue_normalized:d2",
        "SELECT l_orderkey AS order_id, l_quantity AS sales_normalized, l_extendedprice AS revenue_normalized FROM lineitem WHERE l_quantity > 25",
    ),
    "workbook_sheets": Query(
        workbook, "part_key:s name:s on_hand:s note:s",
        """SELECT p_partkey::VARCHAR AS part_key, '  ' || p_name || ' ' AS name,
            CASE WHEN p_size % 3 = 0 THEN replace(format('{:,}', p_partkey * 1000 + p_size), ',', '，') ELSE format('{:,}', p_partkey * 1000 + p_size) END AS on_hand,
            CASE WHEN p_size % 2 = 1 THEN NULL WHEN p_size % 4 = 0 THEN 'nan' ELSE p_brand END AS note FROM part""",
    ),
    "clean_workbook_rows": Query(
        _cleaned_workbook, "part_key:s name:s on_hand:l value:d2 note:s",
        """SELECT p_partkey::VARCHAR AS part_key, trim(p_name) AS name, p_partkey * 1000 + p_size AS on_hand, p_retailprice AS value,
            CASE WHEN p_size % 2 = 0 AND p_size % 4 > 1 THEN p_brand END AS note FROM part""",
    ),
    "workbook_columns": Query(
        _column_comments, "column_name:s label:s cells:l",
        """SELECT 'part_key' AS column_name, 'Part-Key' AS label, count(*) AS cells FROM part
            UNION ALL SELECT 'name', 'Name（品名）', count(*) FROM part UNION ALL SELECT 'on_hand', 'On-Hand(pcs)', count(*) FROM part
            UNION ALL SELECT 'value', 'Value', count(*) FROM part UNION ALL SELECT 'note', 'Note', count(*) FROM part WHERE p_size % 2 = 0""",
    ),
    "table_pages": Query(
        table_pages, "page:l place:l data_num:l s_suppkey:l s_name:s s_acctbal:d2",
        """SELECT s_suppkey // 50 + 1 AS page, row_number() OVER (PARTITION BY s_suppkey // 50 ORDER BY s_suppkey) - 1 AS place,
            count(*) OVER (PARTITION BY s_suppkey // 50) AS data_num, s_suppkey, s_name, s_acctbal FROM supplier""",
    ),
    "order_page": Query(
        lambda s, d: tb.page_rows(_orders(s, d), [F.col("price").desc(), F.col("o_orderkey")], 2),
        "o_orderkey:l price:d2", f"SELECT * FROM ({ORDERS_SQL}) ORDER BY price DESC, o_orderkey LIMIT 300 OFFSET 300",
    ),
    "order_page_deep": Query(
        _deep_page, "o_orderkey:l price:d2", f"SELECT * FROM ({ORDERS_SQL}) ORDER BY price DESC, o_orderkey LIMIT 20 OFFSET 1180"
    ),
    "drop_date_range_in_place": Query(
        _range_dropped_in_place, "o_orderkey:l o_orderstatus:s d:s price:d2",
        f"SELECT * FROM ({ORDERS_SQL}) WHERE NOT coalesce(d BETWEEN DATE '1996-01-10' AND DATE '1997-11-20', FALSE)",
    ),
    "update_where_in_place": Query(
        _updated_in_place, "o_orderkey:l o_orderstatus:s d:s price:d2",
        f"""SELECT o_orderkey, d, CASE WHEN price < 20000 AND d < DATE '1995-03-05' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
            CASE WHEN price < 20000 AND d < DATE '1995-03-05' THEN 0 ELSE price END AS price FROM ({ORDERS_SQL})""",
    ),
    "first_match": Query(
        _first_match, "word:s p_partkey:d0",
        "SELECT w AS word, (SELECT min(p_partkey) FROM part WHERE contains(p_name, w)) AS p_partkey FROM (VALUES ('gear'), ('bolt'), ('nothing')) AS v(w)",
    ),
    "unwrap_envelope": Query(
        _envelopes, "event_id:l id:s code:s name:s",
        "SELECT event_id, event_id::VARCHAR AS id, event_type AS code, props AS name FROM events, range(0, 2) AS r(i) WHERE event_type <> 'error'",
    ),
    "dimension_feeds": Query(_dimensions, "feed:s id:s code:s name:s", DIMENSION_SQL),
    "order_lines": Query(
        lambda s, d: fd.order_lines(freight_orders(s, d)).withColumnRenamed("unitValue", "unit_value"),
        "orderNo:s customer:s referenceId:s qty:d0 unit_value:d2 total_qty:l total_ctn:l total_kg:d2 total_value:d2",
        f"""WITH {FREIGHT_SQL} SELECT t.k AS orderNo, o_custkey AS customer, CASE WHEN i IS NOT NULL THEN t.k || '-' || i END AS referenceId,
            qty, unitValue AS unit_value, total_qty, total_ctn, total_kg, total_value FROM totals t LEFT JOIN goods ON goods.k = t.k""",
    ),
    "order_track": Query(
        _track, "user_id:l day:s event_id:l status:s logged:s amount:d4 k:d0 unread:s",
        f"""WITH {TRACK_SQL} SELECT user_id, day, event_id, event_type AS status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS logged,
            CASE WHEN event_id % 7 > 1 THEN value END AS amount, CASE WHEN event_id % 3 = 0 THEN (props->>'k')::INT END AS k,
            CASE WHEN event_id % 7 = 0 THEN 'amount' ELSE '' END AS unread FROM r WHERE reason IS NULL""",
    ),
    "order_track_unread": Query(
        _unread_track, "user_id:l day:s reason:s", f"WITH {TRACK_SQL} SELECT DISTINCT user_id, day, reason FROM r WHERE reason IS NOT NULL"
    ),
    "order_track_fields": Query(
        _track_fields, "key:s kind:s n:l",
        f"""WITH {TRACK_SQL}, k AS (SELECT * FROM r WHERE reason IS NULL)
            SELECT 'eventId' AS key, 'BIGINT' AS kind, count(*) AS n FROM k HAVING count(*) > 0
            UNION ALL SELECT 'status', 'STRING', count(*) FROM k HAVING count(*) > 0 UNION ALL SELECT 'time', 'STRING', count(*) FROM k HAVING count(*) > 0
            UNION ALL SELECT 'detail', 'OBJECT<k: BIGINT>', count(*) FROM k WHERE event_id % 3 = 0 HAVING count(*) > 0
            UNION ALL SELECT 'value', CASE WHEN event_id % 7 = 0 THEN 'STRING' WHEN event_id % 7 = 1 THEN 'VOID' ELSE 'DECIMAL' END, count(*) FROM k GROUP BY 2""",
    ),
    "order_cartons": Query(
        _cartons, "order_no:l place_in:d0 carton:d0 kg:d2 cmb:d4",
        """WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 8 > 0 THEN o_orderkey % 4 ELSE 0 END AS n FROM orders WHERE o_orderkey % 10 <> 0)
            SELECT k AS order_no, i - 1 AS place_in, i AS carton, k % 5 * 0.5::DOUBLE + i AS kg, CASE WHEN i < 3 THEN i * 0.125::DOUBLE END AS cmb
            FROM o LEFT JOIN range(1, 4) AS r(i) ON i <= n""",
    ),
    "order_totals": Query(
        lambda s, d: fd.order_totals(freight_orders(s, d)), "orderNo:s total_qty:l total_ctn:l total_kg:d2 total_value:d2",
        f"WITH {FREIGHT_SQL} SELECT k AS orderNo, total_qty, total_ctn, total_kg, total_value FROM totals",
    ),
    "adfee_rows": Query(
        lambda s, d: fd.adfee_rows(fee_grid(s, d)), "d_date:s shop:s plp_ad_rate:d2 po_ad_rate:d2 plg_ad_rate:d2",
        f"WITH {FEE_SQL} SELECT * FROM fees",
    ),
    "adfee_daily_replace": Query(
        _fees_replaced, "d_date:s shop:s plp_ad_rate:d2 po_ad_rate:d2 plg_ad_rate:d2",
        f"WITH {FEE_SQL} SELECT d_date, shop, " + ", ".join(
            f"CASE WHEN d_date IN (DATE '{FEE_DAYS[0]}', DATE '{FEE_DAYS[1]}') THEN {c} ELSE 0 END AS {c}" for c in FEE_TYPES
        ) + " FROM fees",
    ),
    "append_load": Query(_appended, "o_orderkey:l o_orderstatus:s d:s price:d2", ORDERS_SQL),
    "truncate_load": Query(_reloaded, "o_orderkey:l o_orderstatus:s d:s price:d2", f"SELECT * FROM ({ORDERS_SQL}) WHERE o_orderstatus = 'P'"),
    "replace_table": Query(_replaced, "o_orderstatus:s n:l", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1"),
    "drop_date_range": Query(
        _range_dropped, "o_orderkey:l d:s price:d2", f"SELECT * FROM ({ORDERS_SQL}) WHERE d NOT BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"
    ),
    "update_where": Query(
        _updated, "o_orderkey:l o_orderstatus:s price:d2",
        f"SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE price END AS price FROM ({ORDERS_SQL})",
    ),
    "update_by_caller_predicate": Query(
        lambda s, d: rows_where(g.brand_type(b.metrics(s, d), b.SPECIAL, F.col("name").ilike("red%")), F.col("type") == "T3|brand"),
        "sku:l type:s level:l",
        f"WITH {METRICS} SELECT sku, level, CASE WHEN type IN ('T3', 'T5') THEN type || CASE WHEN name ILIKE 'red%' THEN '|other' ELSE '|brand' END ELSE type END AS type FROM (SELECT *, CASE WHEN type = 'T3' AND name NOT ILIKE 'red%' THEN 3 ELSE 123 END AS level FROM metrics)",
    ),
    "delete_where": Query(
        _deleted, "sku:l type:s", f"WITH {METRICS} SELECT sku, type FROM metrics WHERE type IS NULL OR type NOT IN ('T1', 'T2')"
    ),
    "dead_letters": Query(
        _dead_letters, "o_orderkey:l amount:d2 target:s",
        "SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS amount, CASE WHEN o_orderkey % 13 = 0 THEN 'failed' ELSE 'good' END AS target FROM orders",
    ),
    "csv_export": Query(_exported, "o_orderkey:l o_orderstatus:s d:s price:d2", ORDERS_SQL),
    "text_functions": Query(
        _text_functions, "doc_id:l head:s quoted_chars:l plain_chars:l pieces:l lang:s source:s",
        """SELECT doc_id, left(text, 100) AS head, length(replace(text, '''', '''''')) AS quoted_chars,
            length(replace(replace(text, ',', ''), '，', '')) AS plain_chars, len(string_split(text, ',')) AS pieces,
            CASE WHEN doc_id % 3 <> 0 THEN nullif(nullif(trim(lang), ''), 'nan') END AS lang, rtrim(source, ',') AS source FROM documents""",
    ),
    "number_functions": Query(
        _number_functions,
        "l_orderkey:l l_linenumber:l quarter_even:l quarter_up:l even:l sevens:l rest:l thousands:l log_price:d6 capped:l",
        """SELECT l_orderkey, l_linenumber, round_even(q / 4, 0) AS quarter_even, round(q / 4) AS quarter_up, q - q % 2 AS even, q // 7 AS sevens,
            q % 7 AS rest, ceil(p / 1000) AS thousands, ln(p) AS log_price, CASE WHEN q > 30 THEN 30 ELSE q END AS capped
            FROM (SELECT l_orderkey, l_linenumber, sum(l_quantity::BIGINT) AS q, sum(l_extendedprice) AS p FROM lineitem GROUP BY 1, 2)""",
    ),
}
