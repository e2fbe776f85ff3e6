"""JSON feeds: reply envelopes, paged table exports, dimensions, freight orders, ad-fee grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merch.functions.text import money, strip_thousands
from merch.sources.tables import replace_day

OK_CODE = 200


def _texts(names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names.split()]


def _numbers(names: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names.split()]


# Fields of the reply envelope, of a freight order, its files and its goods.
FILE = T.StructType(_texts("id name url") + _numbers("size", T.LongType()) + _texts("type ext"))
GOODS = T.StructType(
    _texts("shipmentId referenceId name ename hscode taxRate material purpose addtionalCode")
    + _numbers("unitCost unitValue", T.DoubleType())
    + _numbers("qty ctn", T.LongType())
    + _numbers("nkg kg cmb", T.DoubleType())
    + _texts("maker makerAdd saleLink mixed remark asin fnSku amazonIdNum")
)
ORDER = T.StructType(
    _texts(
        "containerType orderNo cusId customer shipmentCountry channelName channelId lockChayan packageType hasTax "
        "withinOrderRemark sanLock shipmentType shipmentCode state city shipmentZip shipmentAddress contact tel "
        "shipmentCompany deliveryPointName deliveryPoint shipperName shipperAddress shipperContact shipperTel "
        "shipperEmail insurance"
    )
    + _numbers("insuranceFee", T.DoubleType())
    + _texts("insured insuranceCur insuranceRemark deliveryRemark declareTypeName declareType")
    + _numbers("blNumber", T.LongType())
    + _texts("isRucang expetTime isBattery isSui isZheng isDischarge isYuyue yuyueRemark")
    + [T.StructField("fileList", T.ArrayType(FILE)), T.StructField("goodsList", T.ArrayType(GOODS))]
    + _texts("whType froRemark deliveryType hyDeliveryType")
)

# The reference-data feeds. Their items share these fields here.
FEEDS = [
    "country", "fba_code", "overseas_warehouse", "mixed_code", "order_channel", "declare_type",
    "delivery_warehouse", "file_type", "unit", "address", "courier_channel", "courier_delivery_warehouse",
]
ITEM = T.StructType(_texts("id code name"))


def envelope(result: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField("success", T.BooleanType()), *_texts("status message"), T.StructField("code", T.IntegerType()),
         T.StructField("result", result), *_texts("errorMsg overageMes"), T.StructField("timestamp", T.LongType())]
    )


def unwrap_envelope(df: DataFrame, body: str, item: T.DataType) -> DataFrame:
    """One row per item of each good reply (code 200); a result that is one object is one item."""
    parsed = df.withColumns(
        {"_e": F.from_json(body, envelope(T.ArrayType(item))), "_one": F.get_json_object(body, "$.result")}
    )
    single = F.when(F.trim("_one").startswith("{"), F.array(F.from_json("_one", item)))
    return (
        parsed.where(F.col("_e.code") == OK_CODE)
        .select(*[c for c in df.columns if c != body], F.explode(F.coalesce(single, F.col("_e.result"))).alias("item"))
    )


def failed_replies(df: DataFrame, body: str) -> DataFrame:
    """Replies that give no items: not JSON, another code, or no readable result."""
    code = F.get_json_object(body, "$.code").try_cast("int")
    result = F.trim(F.get_json_object(body, "$.result"))
    good = (code == OK_CODE) & (result.startswith("{") | result.startswith("["))
    return df.where(~F.coalesce(good, F.lit(False)))


def read_dimension(replies: DataFrame, feed: str, body: str = "body") -> DataFrame:
    """Items of one reference-data feed."""
    if feed not in FEEDS:
        raise ValueError(f"unknown feed {feed!r}")
    return unwrap_envelope(replies.where(F.col("feed") == feed), body, ITEM).select("feed", "item.*")


def freight_orders(replies: DataFrame, body: str = "body") -> DataFrame:
    return unwrap_envelope(replies, body, ORDER).select("item.*")


def order_totals(orders: DataFrame) -> DataFrame:
    """Quantity, cartons, weight and value per order, summed inside each document."""

    def total(value, kind):
        goods = F.coalesce("goodsList", F.array().cast(T.ArrayType(GOODS)))
        return F.aggregate(goods, F.lit(0).cast(kind), lambda a, g: a + F.coalesce(value(g), F.lit(0)).cast(kind))

    return orders.withColumns(
        {
            "total_qty": total(lambda g: g["qty"], "bigint"),
            "total_ctn": total(lambda g: g["ctn"], "bigint"),
            "total_kg": total(lambda g: g["kg"], "double"),
            "total_value": total(lambda g: g["qty"] * g["unitValue"], "double"),
        }
    )


def order_lines(orders: DataFrame) -> DataFrame:
    """One row per goods item (one without goods for an empty order) with the order's totals."""
    totals = ["total_qty", "total_ctn", "total_kg", "total_value"]
    return order_totals(orders).select("orderNo", "customer", *totals, F.posexplode_outer("goodsList").alias("line", "goods")).select(
        "orderNo", "customer", "line", "goods.*", *totals
    )


# --- paged table exports ----------------------------------------------------

PAGE = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("fields", T.ArrayType(T.StructType(_texts("name")))),
                    T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
                    T.StructField("pageInfo", T.StructType(_numbers("pageIndex pageSize total", T.LongType()))),
                ]
            ),
        )
    ]
)


def read_table_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per exported table row: page, place in the page, rows in the page, and a name-to-text map."""
    page = spark.read.schema(PAGE).json(path).select("data.*")
    rows = page.select(
        F.col("pageInfo.pageIndex").alias("page"), F.size("data").alias("data_num"), "fields", F.posexplode("data").alias("place", "cells")
    )
    return rows.select("page", "place", "data_num", F.map_from_arrays(F.col("fields.name"), "cells").alias("row"))


def page_fields(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select("page", "place", "data_num", *[F.try_element_at("row", F.lit(n)).alias(n) for n in names])


# --- advertising fees -------------------------------------------------------

# Places of the grid cells that are kept, by column.
GRID_PLACES = {"d_date": 2, "shop": 1, "plp_ad_rate": 16, "po_ad_rate": 17, "plg_ad_rate": 18}


def grid_cell(place: int) -> Column:
    return F.trim(F.get("cells", F.lit(place)))


def adfee_rows(raw: DataFrame, *carried: str) -> DataFrame:
    """Dated fees per shop from landed grid rows (``position``, ``cells``, ``carried``); row 0 is the grid's own total."""
    rows = raw.where(F.col("position") > 0)
    fees = [money(grid_cell(GRID_PLACES[c])).alias(c) for c in ("plp_ad_rate", "po_ad_rate", "plg_ad_rate")]
    return rows.select(
        grid_cell(GRID_PLACES["d_date"]).try_cast("date").alias("d_date"), strip_thousands(grid_cell(GRID_PLACES["shop"])).alias("shop"), *fees, *carried
    )


def adfee_daily_replace(raw: DataFrame, path: str, days: list[str]) -> None:
    """Clean the landed grids and replace the given days (usually yesterday and today)."""
    rows = adfee_rows(raw)
    for day in days:
        replace_day(rows, path, day)
