"""The supplied tables seen in their merchandise roles (sales, inventory, SKU facts, ...).

Every role is a Spark expression over the given parquet and has a SQL twin
below it, so that both sides of a check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START, END = "1995-01-01", "2001-12-31"
SPECIAL = ["T3", "T5"]
PLATFORM = "Amazon"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- daily sales lines ------------------------------------------------------

SKU_COLUMNS = {"supplier": "l_suppkey", "part": "l_partkey", "order": "l_orderkey"}


def sales(spark: SparkSession, sf_dir: str, sku: str = "part") -> DataFrame:
    """sku, platform, sales_date, sales_qty from the order lines."""
    return table(spark, sf_dir, "lineitem").select(
        F.col(SKU_COLUMNS[sku]).alias("sku"),
        F.when(F.col("l_linestatus") == "O", "Amazon").otherwise("Ebay").alias("platform"),
        F.col("l_shipdate").cast("date").alias("sales_date"),
        F.col("l_quantity").cast("bigint").alias("sales_qty"),
    )


def sales_sql(sku: str = "part") -> str:
    return (
        f"SELECT {SKU_COLUMNS[sku]} AS sku, CASE WHEN l_linestatus = 'O' THEN 'Amazon' ELSE 'Ebay' END AS platform, "
        "l_shipdate::DATE AS sales_date, l_quantity::BIGINT AS sales_qty FROM lineitem"
    )


def stock_level(sku, day):
    """Invented stock: unknown every 11th day, low on 5 of 29 days, else 20..119."""
    return (
        F.when((sku + day) % 11 == 0, F.lit(None).cast("bigint"))
        .when((sku * 3 + day) % 29 < 5, (sku + day) % 4)
        .otherwise((sku * 31 + day * 17) % 100 + 20)
    )


STOCK_SQL = (
    "CASE WHEN (sku + day) % 11 = 0 THEN NULL WHEN (sku * 3 + day) % 29 < 5 THEN (sku + day) % 4 "
    "ELSE (sku * 31 + day * 17) % 100 + 20 END"
)


def inventory_of(days: DataFrame) -> DataFrame:
    """sku, date, total_available_quantity for the (sku, sales_date) pairs of ``days``."""
    day = F.unix_date("sales_date").cast("bigint")
    return days.select(
        "sku", F.col("sales_date").alias("date"), stock_level(F.col("sku"), day).alias("total_available_quantity")
    )


# --- SKU facts --------------------------------------------------------------


def part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size") % 30
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku"),
        F.col("p_name").alias("name"),
        F.when(size != 7, F.concat(F.lit("T"), size.cast("string"))).alias("type"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").cast("bigint").alias("size"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price"),
    )


PART_SQL = (
    "SELECT p_partkey AS sku, p_name AS name, CASE WHEN p_size % 30 <> 7 THEN 'T' || (p_size % 30)::VARCHAR END AS type, "
    "p_brand AS brand, p_size::BIGINT AS size, p_retailprice::DECIMAL(18,2) AS unit_price FROM part"
)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sku, name, type, num, revenue, profit; the lines are summed before parts are joined."""
    shipped = F.col("l_shipdate")
    paid = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    sums = (
        table(spark, sf_dir, "lineitem")
        .where((shipped >= F.lit(START).cast("timestamp")) & (shipped < F.date_add(F.lit(END).cast("date"), 1).cast("timestamp")))
        .groupBy(F.col("l_partkey").alias("sku"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("num"), F.sum(paid).alias("paid"))
    )
    revenue = F.col("paid").cast("decimal(18,2)")
    cost = 2 * F.col("num") * F.col("unit_price")
    return sums.join(part_types(spark, sf_dir), "sku").select(
        "sku",
        "name",
        "type",
        "num",
        revenue.alias("revenue"),
        (revenue - cost).cast("decimal(18,2)").alias("profit"),
    )


METRICS_SQL = f"""
SELECT p.sku, p.name, p.type, s.num, s.revenue,
       (s.revenue - 2 * s.num * p.unit_price)::DECIMAL(18,2) AS profit
FROM (SELECT l_partkey AS sku, sum(l_quantity::BIGINT)::BIGINT AS num,
             sum(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2)))::DECIMAL(18,2) AS revenue
      FROM lineitem WHERE l_shipdate::DATE BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1) s
JOIN ({PART_SQL}) p ON s.sku = p.sku"""


def new_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where("p_partkey % 50 = 0").select(F.col("p_partkey").alias("sku"))


NEW_SKU_SQL = "SELECT p_partkey AS sku FROM part WHERE p_partkey % 50 = 0"
