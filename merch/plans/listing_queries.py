"""Listing queries over pages written from the part table, and the raw page table."""

from __future__ import annotations

from pyspark.sql import functions as F

from merch.operators import listings as ls
from merch.plans import binding as b
from merch.plans.query import Query
from merch.session import spread, stage_path

LINK = "https://shop.example/itm/"


def _row(label, value):
    """Markup of one label and value, with the comments and spans real pages carry."""
    return (
        f"'<dl data-testid=\"ux-labels-values\" class=\"row\"><dt class=\"ux-labels-values__labels\"><div><span> {label}: </span></div></dt>"
        f"<dd class=\"ux-labels-values__values\"><!--F#1--><div class=\"c\"><span>' || {value} || ' </span></div></dd></dl>'"
    )


# One SQL text builds the pages on both engines; the oracle never parses them.
OE = "repeat(p_type || '/', 30)"
MPN = "p_name || '-' || CAST(p_partkey AS STRING)"
HTML = " || ".join([
    "'<html><body><div class=\"top\">' ",
    _row("Brand", "'outside'"),
    "'</div><div id=\"x\" class=\"a ux-layout-section-module-evo__container\"><div class=\"in\">'",
    _row("Brand", "'draft'"),
    _row("Manufacturer Part Number", MPN),
    _row("OE/OEM Part Number", OE),
    _row("Items Included", "p_type"),
    _row("Wheel Stud Quantity", "CAST(p_size AS STRING)"),
    _row("Placement on Vehicle", "CASE WHEN p_size % 2 = 0 THEN 'Front &amp; Rear' ELSE 'Left' END"),
    "CASE WHEN p_size % 5 = 0 THEN '' ELSE " + _row("Interchange Part Number", "p_name || ' O''Ring'") + " END",
    _row("Brand", "p_brand"),
    "'</div></div><div>'",
    _row("Items Included", "'outside'"),
    "'</div></body></html>'",
])
BROKEN = "p_size % 17 = 0"
CATEGORY = "CASE WHEN p_size % 2 = 0 THEN 'wheelhub' ELSE 'abssensor' END"


def pages(spark, sf_dir):
    return spread(b.table(spark, sf_dir, "part")).selectExpr(
        f"'{LINK}' || CAST(p_partkey AS STRING) AS url",
        f"{CATEGORY} AS category",
        f"CASE WHEN {BROKEN} THEN '<html><body>gone</body></html>' ELSE {HTML} END AS html",
    )


def listings(spark, sf_dir):
    return b.table(spark, sf_dir, "part").selectExpr(
        f"'{LINK}' || CAST(p_partkey AS STRING) AS vc_item_link",
        f"{CATEGORY} AS category",
        "p_name AS vc_item",
        "CASE p_size % 3 WHEN 0 THEN CAST(p_size AS STRING) || ' SOLD' WHEN 1 THEN '3 watchers' END AS d_num1",
        "CASE WHEN p_size % 7 = 1 THEN '2 sold' ELSE '' END AS d_num2",
    )


LISTINGS_SQL = f"""SELECT '{LINK}' || p_partkey AS vc_item_link, {CATEGORY} AS category, p_name AS vc_item FROM part
  WHERE (p_size % 3 = 0 OR p_size % 7 = 1)"""


def details(spark, sf_dir):
    return listings(spark, sf_dir).join(
        b.table(spark, sf_dir, "part").where("p_size % 4 = 0").selectExpr(f"'{LINK}' || CAST(p_partkey AS STRING) AS vc_item_link"),
        "vc_item_link", "left_semi",
    ).select("category", "vc_item_link")


def all_pages(spark, sf_dir):
    raw = b.table(spark, sf_dir, "pages").select("url", F.lit("raw").alias("category"), "html")
    return pages(spark, sf_dir).unionByName(raw)


def _split(spark, sf_dir):
    good, failed = ls.listing_deadletter(all_pages(spark, sf_dir))
    return good.select("url", F.lit("detail").alias("target")).unionByName(failed.select("url", F.lit("failed").alias("target")))


def _quoted(spark, sf_dir):
    return ls.listing_attributes(pages(spark, sf_dir), quote_twice=True)


def _table(spark, sf_dir):
    """Listings of both categories in one table, read back one category at a time."""
    path = stage_path(spark, "listings")
    ls.write_listings(listings(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return back.where("category = 'wheelhub'").unionByName(back.where("category = 'abssensor'"))


ATTRIBUTES_SQL = f"""SELECT '{LINK}' || p_partkey AS vc_item_link, {CATEGORY} AS category, p_brand AS vc_brand,
  CASE WHEN p_size % 2 = 0 THEN {MPN} ELSE left({MPN}, 100) END AS vc_manufacturer_part_number, left({OE}, 100) AS vc_oe_number,
  CASE WHEN p_size % 2 = 1 THEN p_type END AS vc_items_included, CASE WHEN p_size % 2 = 0 THEN p_size::VARCHAR END AS d_wheelhub_stub_quantity,
  CASE WHEN p_size % 2 = 0 THEN 'Front & Rear' ELSE 'Left' END AS vc_placement_on_vehicle,
  CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name || ' O''Ring' END AS vc_interchange_part_num FROM part WHERE NOT ({BROKEN})"""

QUERIES = {
    "sold_listings": Query(lambda s, d: ls.sold_listings(listings(s, d)), "vc_item_link:s category:s vc_item:s", LISTINGS_SQL),
    "listing_frontier": Query(
        lambda s, d: ls.listing_frontier(listings(s, d), details(s, d)), "vc_item_link:s category:s vc_item:s",
        f"{LISTINGS_SQL} AND p_size % 4 <> 0",
    ),
    "listing_details": Query(
        lambda s, d: ls.listing_details(pages(s, d)),
        "vc_item_link:s category:s vc_brand:s vc_manufacturer_part_number:s vc_oe_number:s vc_items_included:s "
        "d_wheelhub_stub_quantity:s vc_placement_on_vehicle:s vc_interchange_part_num:s",
        ATTRIBUTES_SQL,
    ),
    "listing_attributes_quoted": Query(
        _quoted, "vc_item_link:s vc_interchange_part_num:s",
        f"SELECT vc_item_link, replace(vc_interchange_part_num, '''', '''''') AS vc_interchange_part_num FROM ({ATTRIBUTES_SQL})",
    ),
    "listing_table": Query(
        _table, "vc_item_link:s category:s vc_item:s vc_brand:s",
        f"""SELECT '{LINK}' || p_partkey AS vc_item_link, {CATEGORY} AS category, p_name AS vc_item, NULL AS vc_brand FROM part""",
    ),
    "listing_deadletter": Query(
        _split, "url:s target:s",
        f"""SELECT '{LINK}' || p_partkey AS url, CASE WHEN {BROKEN} THEN 'failed' ELSE 'detail' END AS target FROM part
            UNION ALL SELECT url, 'failed' FROM pages""",
    ),
}
