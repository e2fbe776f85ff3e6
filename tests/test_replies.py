"""Replies without a fixed schema: items, typed columns, what cannot be read."""

import pytest

from merch.sources import replies as rp

BODIES = [
    '{"code": 200, "result": [{"status": "a", "value": 1.5}, {"status": 7, "value": "x", "more": [1, 2]}, 5, null]}',
    '{"code": "200", "result": {"status": "one"}}', '{"code": 200, "result": []}', '{"code": 200, "result": "none"}', '{"code": 200}',
    '{"code": 500, "result": [{"status": "a"}]}', '{"result": []}', '{"code": 200, "result": [', "", None, "[]",
]


@pytest.fixture(scope="module")
def replies(spark):
    return spark.createDataFrame([(i, x, "kept") for i, x in enumerate(BODIES)], "order_no int, body string, extra string")


def test_every_reply_is_read_or_named(spark, replies):
    items = rp.reply_items(replies)
    assert items.columns == ["order_no", "extra", "place", "item"]
    assert sorted((r["order_no"], r["place"]) for r in items.collect()) == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 0)]
    bad = {r["order_no"]: r["reason"] for r in rp.unread_replies(replies).collect()}
    assert bad == {3: "no items", 4: "no items", 5: "code 500", 6: "no code", 7: "not JSON", 8: "not JSON", 9: "not JSON", 10: "no code"}
    assert rp.unread_replies(replies).columns == ["order_no", "body", "extra", "reason"]


def test_typed_columns_name_what_they_cannot_read(spark, replies):
    rows = rp.typed_items(rp.reply_items(replies), {"status": ("$.status", "string"), "value": ("$.value", "double"), "second": ("$.more[1]", "int")})
    got = {(r["order_no"], r["place"]): (r["status"], r["value"], r["second"], r["unread"]) for r in rows.collect()}
    assert got[0, 0] == ("a", 1.5, None, [])
    assert got[0, 1] == ("7", None, 2, ["value"])
    assert got[0, 2] == got[0, 3] == (None, None, None, [])
    assert got[1, 0] == ("one", None, None, [])


def test_nested_lists_and_fields(spark):
    body = '{"code": 200, "result": [{"orderNo": "x", "cartons": [{"no": 1, "kg": 2}, {"no": 2, "kg": "heavy"}]}, {"orderNo": "y"}, {"cartons": {"no": 9}}]}'
    replies = spark.createDataFrame([("q", body)], "request string, body string")
    rows = [(r["request"], r["place"], r["place_in"], r["carton"], r["kg"], r["unread"]) for r in rp.order_cartons(replies).orderBy("place", "place_in").collect()]
    assert rows == [("q", 0, 0, 1, 2.0, []), ("q", 0, 1, 2, None, ["kg"]), ("q", 1, None, None, None, []), ("q", 2, None, None, None, [])]
    fields = {(r["key"], r["kind"]): r["n"] for r in rp.item_fields(rp.reply_items(replies)).collect()}
    assert fields["orderNo", "STRING"] == 2 and sum(n for (k, _), n in fields.items() if k == "cartons") == 2


def test_each_reply_is_parsed_in_one_scan_without_a_shuffle(spark, replies):
    plan = rp.order_track(replies)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_empty(spark, replies):
    none = replies.where("false")
    assert rp.order_track(none).count() == rp.order_cartons(none).count() == rp.unread_replies(none).count() == 0
    assert rp.item_fields(rp.reply_items(none)).count() == 0
