"""Listing pages: which to fetch next, what they say about an item, and which failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merch.functions.text import clip_text, double_quotes
from merch.session import staged

# Class names and attributes of the stored pages, and the word that marks a sale.
CONTAINER = "ux-layout-section-module-evo__container"
ROW_TEST_ID = "ux-labels-values"
LABEL_CLASS = "ux-labels-values__labels"
VALUE_CLASS = "ux-labels-values__values"
SOLD_MARK = "sold"

# The label text that selects each column, in order of precedence,
# with the length a value is cut to.
RULES = [
    ("vc_brand", "Brand", None),
    ("vc_manufacturer_part_number", "Manufacturer Part Number", 100),
    ("vc_oe_number", "OE/OEM", 100),
    ("vc_items_included", "Items Included", 100),
    ("vc_placement_on_vehicle", "Vehicle", None),
    ("vc_interchange_part_num", "Interchange", None),
]
WHEEL_HUB_RULES = [
    ("vc_brand", "Brand", None),
    ("vc_manufacturer_part_number", "Manufacturer Part Number", None),
    ("vc_oe_number", "OE/OEM", 100),
    ("d_wheelhub_stub_quantity", "Wheel Stud Quantity", None),
    ("vc_placement_on_vehicle", "Vehicle", None),
    ("vc_interchange_part_num", "Interchange", None),
]
CATEGORIES = [
    "abssensor", "balljoint", "brakekit", "brakepad", "controlarm",
    "idlerarm", "pitmanarm", "swaybarendlink", "tierodend", "wheelhub",
]
CATEGORY_RULES = {c: WHEEL_HUB_RULES if c == "wheelhub" else RULES for c in CATEGORIES}

# Columns of a listing table, all text, with what they hold.
LISTING = T.StructType(
    [
        T.StructField(name, T.StringType(), True, {"comment": comment})
        for name, comment in [
            ("vc_item", "title"),
            ("vc_item_link", "link"),
            ("d_sell_price", "price in dollars"),
            ("d_num1", "sales note"),
            ("d_num2", "sales note"),
            ("vc_type", "type"),
            ("vc_brand", "brand"),
            ("vc_manufacturer_part_number", "part number of the maker"),
            ("vc_oe_number", "OE/OEM number"),
            ("vc_items_included", "items included"),
            ("vc_placement_on_vehicle", "placement on vehicle"),
            ("vc_interchange_part_num", "interchange part number"),
            ("d_wheelhub_stub_quantity", "wheel stud quantity"),
        ]
    ]
)

ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def _class(name: str) -> str:
    return rf"""\bclass\s*=\s*["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["']"""


CONTAINER_OPEN = rf"""(?is)<div\b[^>]*{_class(CONTAINER)}[^>]*>"""
ROW = rf"""(?is)<dl\b[^>]*\bdata-testid\s*=\s*["']{ROW_TEST_ID}["'][^>]*>(.*?)</dl>"""
LABEL = rf"""(?is)<dt\b[^>]*{_class(LABEL_CLASS)}[^>]*>(.*?)</dt>"""
VALUE = rf"""(?is)<dd\b[^>]*{_class(VALUE_CLASS)}[^>]*>(.*?)</dd>"""


def sold_listings(listings: DataFrame) -> DataFrame:
    mark = f"%{SOLD_MARK}%"
    return listings.where(F.col("d_num1").ilike(mark) | F.col("d_num2").ilike(mark))


KEYS = ["category", "vc_item_link"]
BUCKET_BITS = 32_768  # of Spark's bitmaps, 4096 bytes
LINK_BITS = 16  # of a filter, for each stored link
PROBES = 4
FILTER_BYTES = 64 << 20


def _probes() -> list[Column]:
    """The bits of a link inside its bucket, from 1 as Spark's bitmaps count them."""
    h = F.xxhash64(*KEYS)
    step = F.shiftrightunsigned(h, 15).bitwiseAND(F.lit(BUCKET_BITS - 1)).bitwiseOR(F.lit(1))
    return [(h + F.lit(i) * step).bitwiseAND(F.lit(BUCKET_BITS - 1)) for i in range(PROBES)]


def _bucket() -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(*KEYS), 30), F.col("buckets"))


def link_filter(details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(category, buckets) and (category, bucket, bits): a blocked Bloom filter of the stored links of each category.

    A link sets ``PROBES`` bits of one bucket of 4 KB; a category has a bucket for every 2,048 of its links. Partial bit maps are
    made where the links are; the filter takes 2 bytes a stored link.
    """
    links = details.select(*KEYS).where(F.col("category").isNotNull() & F.col("vc_item_link").isNotNull())
    sizes = links.groupBy("category").agg(F.ceil(F.count(F.lit(1)) * LINK_BITS / F.lit(BUCKET_BITS)).alias("buckets"))
    sizes = staged(sizes, "filter-sizes")
    placed = links.join(sizes, "category").select("category", _bucket().alias("bucket"), F.explode(F.array(*_probes())).alias("bit"))
    bits = placed.groupBy("category", "bucket").agg(F.bitmap_construct_agg(F.col("bit")).alias("bits"))
    return sizes, staged(bits, "filter")


def _is_set(bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


def maybe_stored(links: DataFrame, sizes: DataFrame, bits: DataFrame) -> DataFrame:
    """``links`` with ``maybe``: false only for links that are not stored for certain."""
    found = links.join(sizes, "category", "left").withColumn("bucket", _bucket()).join(F.broadcast(bits), ["category", "bucket"], "left")
    maybe = F.lit(True)
    for bit in _probes():
        maybe = maybe & _is_set(bit)
    return found.withColumn("maybe", maybe).select(*links.columns, "maybe")


def listing_frontier(listings: DataFrame, details: DataFrame) -> DataFrame:
    """Sold listings of each category whose details are not stored yet.

    A Bloom filter of the stored links tells most new links apart where they are; only links that may be stored take the exact
    anti join. The filter is used while it has at most ``FILTER_BYTES``, some 33 million stored links; beyond, all links take the
    anti join.
    """
    sold = sold_listings(listings)
    sizes, bits = link_filter(details)
    if bits.count() * BUCKET_BITS // 8 > FILTER_BYTES:
        return sold.join(details, KEYS, "left_anti")
    probed = maybe_stored(sold, sizes, bits)
    maybes = staged(probed.where("maybe").drop("maybe"), "maybe-stored")
    return probed.where("NOT maybe").drop("maybe").union(maybes.join(details.select(*KEYS), KEYS, "left_anti").select(*sold.columns))


def has_container(html: Column) -> Column:
    return F.coalesce(F.rlike(html, F.lit(CONTAINER_OPEN)), F.lit(False))


def container(html: Column) -> Column:
    """Inside of the first container ``div``; NULL if there is none.

    The text after its opening tag is cut at every ``div`` tag, and the pieces
    are kept until the nesting depth returns to 0.
    """
    after = F.element_at(F.split(html, CONTAINER_OPEN, 2), 2)
    pieces = F.split(after, r"(?i)(?=<div\b|</div\b)")
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("kept"))

    def step(acc: Column, piece: Column) -> Column:
        head = F.lower(F.substring(piece, 1, 5))
        depth = acc["depth"] + F.when(head == "</div", -1).when(F.substring(head, 1, 4) == "<div", 1).otherwise(0)
        open_ = (acc["depth"] > 0) & (depth > 0)
        return F.struct(
            F.when(open_, depth).otherwise(0).alias("depth"), (acc["kept"] + F.when(open_, 1).otherwise(0)).alias("kept")
        )

    kept = F.aggregate(pieces, start, step, lambda acc: acc["kept"])
    return F.when(has_container(html), F.array_join(F.slice(pieces, 1, kept), ""))


def tag_text(markup: Column) -> Column:
    """Text of a piece of markup: every text node trimmed, tags and comments gone."""
    text = F.trim(F.regexp_replace(markup, r"(?s)\s*(?:<!--.*?-->|<[^>]*>)\s*", ""))
    for code, char in ENTITIES:
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def label_values(html: Column) -> Column:
    """``[(label, value)]`` of the container in page order, pairs without both sides left out."""
    rows = F.regexp_extract_all(container(html), F.lit(ROW), F.lit(1))
    whole = F.filter(rows, lambda r: F.rlike(r, F.lit(LABEL)) & F.rlike(r, F.lit(VALUE)))
    return F.transform(
        whole,
        lambda r: F.struct(
            tag_text(F.regexp_extract(r, LABEL, 1)).alias("label"), tag_text(F.regexp_extract(r, VALUE, 1)).alias("value")
        ),
    )


def _pick(pairs: Column, labels: Column, rules: list, column: str, size: int | None) -> Column:
    """Value of the last label that falls to this rule and to none before it."""

    def chosen(label: Column) -> Column:
        name = F.lit(None).cast("string")
        for out, text, _ in reversed(rules):
            name = F.when(F.contains(label, F.lit(text)), F.lit(out)).otherwise(name)
        return F.coalesce(name == column, F.lit(False))

    label = F.try_element_at(F.filter(labels, chosen), F.lit(-1))
    value = F.try_element_at(F.filter(pairs, lambda p: p["label"] == label), F.lit(-1))["value"]
    value = clip_text(value, size) if size else value
    return F.coalesce(value, F.lit(""))


def listing_attributes(pages: DataFrame, rules: list = RULES, quote_twice: bool = False) -> DataFrame:
    """One row per stored page with a container: its link and the columns of ``rules``.

    A repeated label keeps its first place and its last value.
    """
    read = pages.where(has_container(F.col("html"))).withColumn("_pairs", label_values(F.col("html")))
    read = read.withColumn("_labels", F.array_distinct(F.transform("_pairs", lambda p: p["label"])))
    columns = {name: _pick(F.col("_pairs"), F.col("_labels"), rules, name, size) for name, _, size in rules}
    if quote_twice and "vc_interchange_part_num" in columns:
        columns["vc_interchange_part_num"] = double_quotes(columns["vc_interchange_part_num"])
    return read.withColumns(columns).select(
        *[c for c in pages.columns if c not in ("url", "html")], F.col("url").alias("vc_item_link"), *columns
    )


def listing_details(pages: DataFrame, category_rules: dict | None = None) -> DataFrame:
    """Attributes of all categories; columns a category does not have are NULL.

    Every page is read once and the rules are chosen by its category. Categories without rules give no
    attributes: ``listing_deadletter`` reports their pages.
    """
    by_rules: dict[int, tuple[list, list[str]]] = {}
    known = category_rules or CATEGORY_RULES
    for category, rules in known.items():
        by_rules.setdefault(id(rules), (rules, []))[1].append(category)
    read = pages.where(has_container(F.col("html")) & F.col("category").isin(*known))
    read = read.withColumn("_pairs", label_values(F.col("html")))
    read = read.withColumn("_labels", F.array_distinct(F.transform("_pairs", lambda p: p["label"])))
    columns: dict[str, Column] = {}
    for rules, names in by_rules.values():
        for name, _, size in rules:
            picked = _pick(F.col("_pairs"), F.col("_labels"), rules, name, size)
            before = columns.get(name, F.lit(None).cast("string"))
            columns[name] = F.when(F.col("category").isin(*names), picked).otherwise(before)
    return read.withColumns(columns).select(
        *[c for c in pages.columns if c not in ("url", "html")], F.col("url").alias("vc_item_link"), *columns
    )


def listing_deadletter(pages: DataFrame, category_rules: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages to read, failed links): pages without the container, and of categories without rules where ``pages`` has one."""
    good = F.coalesce(has_container(F.col("html")), F.lit(False))
    if "category" in pages.columns:
        good = good & F.coalesce(F.col("category").isin(*(category_rules or CATEGORY_RULES)), F.lit(False))
    return pages.where(good), pages.where(~good).select(*[c for c in pages.columns if c != "html"])


def listing_rows(df: DataFrame) -> DataFrame:
    """Rows in the shape of the listing table: every column, missing ones NULL, and the ``category`` it is partitioned by."""
    cells = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast("string").alias(f.name, metadata=f.metadata)
        for f in LISTING.fields
    ]
    return df.select(*cells, "category")


def write_listings(df: DataFrame, path: str) -> None:
    """One table for all categories instead of one per category; a category is a folder."""
    listing_rows(df).write.mode("append").partitionBy("category").parquet(path)
