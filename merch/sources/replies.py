"""Replies whose items have no fixed schema, such as an order's track and its cartons, read as VARIANT.

A reply is parsed once. Its items stay variants, of which typed columns are taken by path; what the paths do not name stays in
the item, and ``item_fields`` lists it. A value that is there but cannot be read as the wanted type is named, not lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merch.sources.feeds import OK_CODE


def _part(value: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, path, kind)


def _is(value: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def _result(reply: Column) -> tuple[Column, Column]:
    """The items of a parsed reply, and why there are none: NULL where they can be read."""
    result, code = _part(reply, "$.result"), _part(reply, "$.code", "int")
    several, one = _is(result, "ARRAY"), _is(result, "OBJECT")
    reason = (
        F.when(reply.isNull(), "not JSON")
        .when(code.isNull(), "no code")
        .when(code != OK_CODE, F.concat(F.lit("code "), code.cast("string")))
        .when(~several & ~one, "no items")
    )
    return F.when(several, _part(reply, "$.result", "array<variant>")).when(one, F.array(result)), reason


def reply_items(replies: DataFrame, body: str = "body") -> DataFrame:
    """``place`` and ``item`` (variant) of every item of the good replies; a result that is one object is one item."""
    items, reason = _result(F.col("_reply"))
    parsed = replies.withColumn("_reply", F.try_parse_json(body)).where(reason.isNull())
    return parsed.select(*[c for c in replies.columns if c != body], F.posexplode(items).alias("place", "item"))


def unread_replies(replies: DataFrame, body: str = "body") -> DataFrame:
    """The replies without readable items, as they came, with the ``reason``."""
    _, reason = _result(F.col("_reply"))
    return replies.withColumn("_reply", F.try_parse_json(body)).withColumn("reason", reason).drop("_reply").where("reason IS NOT NULL")


def typed_items(items: DataFrame, fields: dict[str, tuple[str, str]], item: str = "item") -> DataFrame:
    """Columns ``name: (path, type)`` of the items, and ``unread``: the names whose value is there but is not of the type."""
    value = F.col(item)
    columns = {name: _part(value, path, kind) for name, (path, kind) in fields.items()}

    def lost(name: str, path: str) -> Column:
        there = _part(value, path)
        return F.when(there.isNotNull() & ~F.is_variant_null(there) & columns[name].isNull(), F.lit(name))

    unread = F.array_compact(F.array(*[lost(name, path) for name, (path, _) in fields.items()]))
    kept = [c for c in items.columns if c != item]
    return items.select(*kept, *[c.alias(name) for name, c in columns.items()], unread.alias("unread"))


def nested_items(items: DataFrame, path: str, item: str = "item") -> DataFrame:
    """One row for each member of the list at ``path`` (``place_in``, ``part``), one without a part where there is no list."""
    parts = _part(F.col(item), path, "array<variant>")
    return items.select("*", F.posexplode_outer(parts).alias("place_in", "part"))


def item_fields(items: DataFrame, item: str = "item") -> DataFrame:
    """(key, kind, n): the fields that the items have, by the kind of their values; for finding out what a feed sends."""
    each = items.select(item).lateralJoin(items.sparkSession.tvf.variant_explode(F.col(item).outer()))
    kind = F.regexp_replace(F.schema_of_variant("value"), r"DECIMAL\(\d+,\d+\)", "DECIMAL")  # of any width
    return each.groupBy("key", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


# --- the two feeds ----------------------------------------------------------

#: Paths and types of an order's track and of its cartons. The service documents neither; other names can be given.
TRACK = {"status": ("$.status", "string"), "logged": ("$.time", "timestamp_ntz"), "amount": ("$.value", "double")}
CARTON = {"carton": ("$.no", "bigint"), "kg": ("$.kg", "double"), "cmb": ("$.cmb", "double")}


def order_track(replies: DataFrame, body: str = "body", fields: dict[str, tuple[str, str]] = TRACK) -> DataFrame:
    """One row for each entry of an order's track; the columns of the request stay."""
    return typed_items(reply_items(replies, body), fields)


def order_cartons(replies: DataFrame, body: str = "body", list_path: str = "$.cartons", fields: dict[str, tuple[str, str]] = CARTON) -> DataFrame:
    """One row for each measured carton of an order, one without a carton for an order that has none."""
    parts = nested_items(reply_items(replies, body), list_path)
    return typed_items(parts.drop("item"), fields, "part")
