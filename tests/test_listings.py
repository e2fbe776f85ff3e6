from pyspark.sql import functions as F

from merch.operators import listings as ls


def row(label, value):
    return (
        f'<dl data-testid="ux-labels-values"><dt class="ux-labels-values__labels x"><span>{label}</span></dt>'
        f'<dd class="ux-labels-values__values"><div><span> {value} </span></div></dd></dl>'
    )


def page(*rows, outside=""):
    return f'<div>{outside}</div><div class="ux-layout-section-module-evo__container"><div>{"".join(rows)}</div></div><div>{outside}</div>'


def read(spark, html, rules=ls.RULES, **kw):
    pages = spark.createDataFrame([("u", html)], "url string, html string")
    return ls.listing_attributes(pages, rules, **kw).first()


def test_last_value_of_a_repeated_label_and_nothing_from_outside(spark):
    r = read(spark, page(row("Brand", "one"), row("Brand", "two"), outside=row("Brand", "other")))
    assert r["vc_brand"] == "two" and r["vc_oe_number"] == ""


def test_label_goes_to_the_first_matching_rule(spark):
    r = read(spark, page(row("Vehicle Brand", "b"), row("Placement on Vehicle", "front"), row("Interchange Part", "x")))
    assert (r["vc_brand"], r["vc_placement_on_vehicle"], r["vc_interchange_part_num"]) == ("b", "front", "x")


def test_later_label_of_a_rule_wins_by_first_place(spark):
    r = read(spark, page(row("Brand", "1"), row("Sub Brand", "2"), row("Brand", "3")))
    assert r["vc_brand"] == "2"


def test_long_values_are_cut_where_the_category_says(spark):
    html = page(row("Manufacturer Part Number", "m" * 101), row("OE/OEM Number", "o" * 101), row("Wheel Stud Quantity", "5"))
    plain, hub = read(spark, html), read(spark, html, ls.WHEEL_HUB_RULES)
    assert (len(plain["vc_manufacturer_part_number"]), len(plain["vc_oe_number"])) == (100, 100)
    assert (len(hub["vc_manufacturer_part_number"]), len(hub["vc_oe_number"]), hub["d_wheelhub_stub_quantity"]) == (101, 100, "5")


def test_entities_comments_and_quotes(spark):
    html = page(row("Brand", "<!--F#0-->A &amp; B"), row("Interchange", "O'Ring"))
    assert read(spark, html)["vc_brand"] == "A & B"
    assert read(spark, html, quote_twice=True)["vc_interchange_part_num"] == "O''Ring"


def test_page_without_container_is_a_dead_letter(spark):
    pages = spark.createDataFrame([("a", page()), ("b", "<html></html>"), ("c", None)], "url string, html string")
    good, failed = ls.listing_deadletter(pages)
    assert [r["url"] for r in good.collect()] == ["a"]
    assert sorted(r["url"] for r in failed.collect()) == ["b", "c"]


def test_frontier_by_category(spark):
    schema = "category string, vc_item_link string, d_num1 string, d_num2 string"
    listed = spark.createDataFrame([("k", "1", "12 SOLD", None), ("k", "2", None, "3 sold"), ("k", "3", "new", ""), ("k", "4", "1 sold", "")], schema)
    done = spark.createDataFrame([("k", "4"), ("other", "1")], "category string, vc_item_link string")
    assert sorted(r["vc_item_link"] for r in ls.listing_frontier(listed, done).collect()) == ["1", "2"]


def frontier_tables(spark, stored=6000, new=300):
    category = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int"))
    link = F.concat(F.lit("https://x/"), F.col("id"))
    row = lambda r: r.select(category.alias("category"), link.alias("vc_item_link"), F.lit("2 Sold").alias("d_num1"), F.lit(None).cast("string").alias("d_num2"))
    details = spark.range(stored).select(category.alias("category"), link.alias("vc_item_link"), F.lit(1).alias("page"))
    odd = spark.createDataFrame([("a", None, "sold", ""), (None, "https://x/0", "sold", ""), ("new", "https://x/0", "sold", ""), ("b", "https://x/0", "x", "sold")], "category string, vc_item_link string, d_num1 string, d_num2 string")
    listings = row(spark.range(stored - 50, stored + new)).union(row(spark.range(stored + 1, stored + 3))).union(odd)
    return listings, details.union(spark.createDataFrame([(None, "https://x/0", 1), ("a", None, 1)], "category string, vc_item_link string, page int"))


def test_frontier_by_filter_is_the_anti_join(spark, monkeypatch):
    listings, details = frontier_tables(spark)
    wanted = sorted(tuple(str(x) for x in r) for r in ls.sold_listings(listings).join(details, ["category", "vc_item_link"], "left_anti").select(*listings.columns).collect())
    found = ls.listing_frontier(listings, details)
    assert found.columns == listings.columns
    assert sorted(tuple(str(x) for x in r) for r in found.collect()) == wanted and len(wanted) == 300 + 2 + 4
    for none in (details.where("false"), details.where("category IS NULL")):
        assert ls.listing_frontier(listings, none).count() == 350 + 2 + 4
    assert ls.listing_frontier(listings.where("false"), details).count() == 0
    monkeypatch.setattr(ls, "FILTER_BYTES", 0)
    assert sorted(tuple(str(x) for x in r) for r in ls.listing_frontier(listings, details).select(*listings.columns).collect()) == wanted


def test_only_possibly_stored_links_are_exchanged(spark):
    listings, details = frontier_tables(spark, stored=60_000, new=20_000)
    sizes, bits = ls.link_filter(details)
    assert {r["category"]: r["buckets"] for r in sizes.collect()} == {"a": 10, "b": 10, "c": 10}
    probed = ls.maybe_stored(ls.sold_listings(listings), sizes, bits)
    row = probed.agg(F.count_if("maybe").alias("maybe"), F.count(F.lit(1)).alias("n")).first()
    assert 50 <= row["maybe"] < 50 + 0.01 * row["n"]
    plan = probed.where("NOT maybe")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert bits.count() * 4096 < 2.2 * 60_000
