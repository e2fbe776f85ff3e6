"""Streaming queries: the given tables land as files in several batches, runs stop and go on, and the sinks are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from merch.operators import history as h
from merch.operators.listings import CATEGORIES
from merch.plans import binding as b
from merch.plans.history_queries import CORRECTED_SQL, DENSE_SQL, END, START, WALK_SQL, dense_lines
from merch.plans.ingest_queries import FEE_SQL, FEE_TYPES, fee_grid
from merch.plans.query import Query
from merch.session import stage_path, staged
from merch.sources.tables import latest_days
from merch.streaming import feeds as st
from merch.streaming import runs
from merch.streaming import stockout as so

LANDINGS = 6
DELAY_DAYS = 10
FILE_ROWS = 1 << 20  # of a landed file; a larger landing is several files that are read as one batch


def shuffled(day, *keys):
    """When a row of ``day`` (a date) lands: up to ``DELAY_DAYS - 1`` days late, by a hash of its keys."""
    return F.unix_date(day) + F.pmod(F.xxhash64(*keys), F.lit(DELAY_DAYS)).cast("int")


class Landings:
    """The rows of ``df`` dealt by ``_place`` (an ordered number) over files, one a landing, and the stream over what has landed."""

    def __init__(self, spark, df, label):
        self.spark, self.schema, self.path = spark, df.drop("_place").schema, stage_path(spark, label)
        self.rows = staged(df, label)
        self.low, self.high = self.rows.agg(F.min("_place"), F.max("_place")).first()
        most = 0
        if self.low is not None:
            most = self.rows.groupBy(self.part().alias("part")).count().agg(F.max("count")).first()[0]
        self.files = max(1, -(-most // FILE_ROWS))  # every landing has as many, so that a batch is a landing
        spark.createDataFrame([], self.schema).write.parquet(self.path)
        self.fill(self.files)

    def part(self):
        """The landing of a row."""
        return F.floor((F.col("_place") - self.low) * LANDINGS / F.lit(self.high - self.low + 1))

    def fill(self, files):
        """Empty files up to that many: a batch of the stream must not take files of two landings."""
        there = len(self.spark.read.schema(self.schema).parquet(self.path).inputFiles())
        for _ in range(there, files):
            self.spark.createDataFrame([], self.schema).write.mode("append").parquet(self.path)

    def land(self, first, last):
        """Land the parts ``first`` to ``last`` of ``LANDINGS``, in order."""
        for i in range(first, last + 1) if self.low is not None else ():
            self.rows.where(self.part() == i).select(*self.schema.names).repartition(self.files).write.mode("append").parquet(self.path)
            self.fill((i + 2) * self.files)

    def stream(self):
        return runs.file_stream(self.spark, self.path, self.schema, files=self.files)


def _in_two_runs(landings, run, close=None):
    """Half of the landings, a run, the others and ``close``, and a run that goes on from the first one's checkpoint."""
    checkpoint = stage_path(landings.spark, "progress")
    landings.land(0, LANDINGS // 2 - 1)
    run(landings.stream(), checkpoint)
    landings.land(LANDINGS // 2, LANDINGS - 1)
    if close is not None:
        close.write.mode("append").parquet(landings.path)
    return run(landings.stream(), checkpoint)


def _fees(spark, sf_dir):
    """Three loads of the grids land newest first and one of them again: every day keeps its newest load."""
    grid = staged(fee_grid(spark, sf_dir), "grid")
    files = max(1, -(-grid.count() // FILE_ROWS))  # of a load, in one batch
    blank = F.concat(F.slice("cells", 1, 16), F.array_repeat(F.lit("-1"), 3))
    load = lambda n, cells, where: grid.where(where).select("day", "position", cells.alias("cells"), F.lit(n).cast("bigint").alias("load"))
    newest = load(3, F.col("cells"), F.day("day") > 10)
    middle = load(2, blank, "true")
    oldest = load(1, F.concat(F.slice("cells", 1, 16), F.array_repeat(F.lit("5"), 3)), "true")
    target = stage_path(spark, "adfee")
    landed = stage_path(spark, "landed")
    checkpoint = stage_path(spark, "progress")
    for loads in ((newest, middle), (oldest, middle, oldest)):
        for part in loads:
            part.repartition(files).write.mode("append").parquet(landed)
        st.stream_adfee_days(runs.file_stream(spark, landed, newest.schema, files=files), target, checkpoint)
    return latest_days(spark.read.parquet(target))


def _daily(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    sales = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("sku"), F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_quantity").cast("bigint").alias("sales_qty"),
        shuffled(day, "l_orderkey", "l_linenumber").alias("_place"),
    )
    target = stage_path(spark, "daily")

    def run(stream, checkpoint):
        return runs.drain_updates(st.stream_daily_totals(stream, f"{DELAY_DAYS} days"), target, ["sku", "sales_date"], checkpoint)

    return _in_two_runs(Landings(spark, sales, "sales"), run)


def _category(number):
    return F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (number % len(CATEGORIES) + 1).cast("int"))


def category_sql(number):
    return "[" + ", ".join(f"'{c}'" for c in CATEGORIES) + f"][{number} % {len(CATEGORIES)} + 1]"


def _frontier(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    listings = events.select(
        _category(F.col("event_id")).alias("category"),
        F.col("user_id").cast("string").alias("vc_item_link"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "purchase", "1 SOLD").otherwise("new").alias("d_num1"),
        F.lit("").alias("d_num2"),
    )
    details = b.table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(
        _category(F.col("c_custkey")).alias("category"), F.col("c_custkey").cast("string").alias("vc_item_link")
    )
    target = stage_path(spark, "frontier")

    def run(stream, checkpoint):
        return runs.drain_new(st.stream_frontier(stream, details), target, st.FRONTIER_KEYS, checkpoint)

    return _in_two_runs(Landings(spark, listings.withColumn("_place", F.unix_seconds("ts")), "listings"), run)


def _stockout(spark, sf_dir):
    """The days of all SKUs land shuffled within the delay; a last row far behind them moves the watermark past all."""
    lines = dense_lines(spark, sf_dir)
    days = h.trim_to_first_sale(h.daily_totals(lines, b.inventory_of(lines), START, END), END)
    days = days.select("sku", "sales_date", "total_sales_qty", "total_available_quantity")
    days = days.withColumn("_place", shuffled(F.col("sales_date"), "sku", "sales_date"))
    last = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("sku"), F.date_add(F.lit(END).cast("date"), 2 * DELAY_DAYS).alias("sales_date"),
        F.lit(0).cast("bigint").alias("total_sales_qty"), F.lit(None).cast("bigint").alias("total_available_quantity"),
    )
    target = stage_path(spark, "corrected")

    def run(stream, checkpoint):
        return runs.drain(so.stream_stockout(stream, f"{DELAY_DAYS} days"), target, checkpoint=checkpoint)

    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, so.ROCKSDB)
    try:
        return _in_two_runs(Landings(spark, days, "days"), run, last)
    finally:
        spark.conf.set(setting, before)


QUERIES = {
    "stream_adfee_days": Query(
        _fees, "d_date:s shop:s plp_ad_rate:d2 po_ad_rate:d2 plg_ad_rate:d2",
        f"WITH {FEE_SQL} SELECT d_date, shop, " + ", ".join(f"CASE WHEN day(d_date) > 10 THEN {c} ELSE -1 END AS {c}" for c in FEE_TYPES) + " FROM fees",
    ),
    "stream_daily_totals": Query(
        _daily, "sku:l sales_date:s total_sales_qty:l",
        """SELECT l_suppkey AS sku, l_shipdate::DATE AS sales_date, sum(l_quantity::BIGINT) AS total_sales_qty FROM lineitem
            GROUP BY 1, 2""",
    ),
    "stream_frontier": Query(
        _frontier, "category:s vc_item_link:s",
        f"""SELECT DISTINCT {category_sql("event_id")} AS category, user_id::VARCHAR AS vc_item_link FROM events WHERE event_type = 'purchase'
            AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey % 3 = 0 AND c_custkey = user_id
                            AND {category_sql("c_custkey")} = {category_sql("event_id")})""",
    ),
    "stream_stockout": Query(
        _stockout, "sku:l sales_date:s total_sales_qty:l adjusted_qty:d6", f"WITH RECURSIVE {DENSE_SQL}, {WALK_SQL} {CORRECTED_SQL}"
    ),
}
