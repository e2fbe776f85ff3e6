"""Incremental feeds as streams: advertising fees by day, sales totals by day, and the links to fetch next.

State is bounded by the watermark; runs are those of ``runs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merch.operators.listings import sold_listings
from merch.sources.feeds import adfee_rows
from merch.sources.tables import replace_day_versions
from merch.streaming.runs import drain_batches

FRONTIER_KEYS = ["category", "vc_item_link"]


def stream_adfee_days(raw: DataFrame, path: str, checkpoint: str | None = None) -> None:
    """Store the days of each batch of landed grids as versions; ``latest_days`` reads the highest of each day.

    A landed grid is the full state of its day. Its ``load`` numbers the landings; without that column the number of the batch
    does. A load that is run again, or an older one that is run late, changes nothing that is read.
    """

    def store(batch: DataFrame, number: int) -> None:
        load = F.col("load") if "load" in batch.columns else F.lit(number)
        rows = adfee_rows(batch.withColumn("load", load.cast("bigint")), "load")
        replace_day_versions(rows, path)

    drain_batches(raw, store, checkpoint)


def stream_daily_totals(sales: DataFrame, delay: str = "1 day") -> DataFrame:
    """Sales per SKU and day; a day is final, and leaves the state, once the watermark has passed it."""
    return (
        sales.withWatermark("ts", delay)
        .groupBy("sku", F.window("ts", "1 day"))
        .agg(F.sum("sales_qty").alias("total_sales_qty"))
        .select("sku", F.col("window.start").cast("date").alias("sales_date"), "total_sales_qty")
    )


def stream_frontier(listings: DataFrame, details: DataFrame, delay: str = "1 day") -> DataFrame:
    """Sold listings of each category without stored details, each once within the watermark.

    Beyond the watermark the state has forgotten a link; ``drain_new`` keeps it from being listed again.
    """
    fresh = sold_listings(listings.withWatermark("ts", delay)).dropDuplicatesWithinWatermark(FRONTIER_KEYS)
    return fresh.join(details.select(*FRONTIER_KEYS), FRONTIER_KEYS, "left_anti").select(*FRONTIER_KEYS)
