"""Order lot queries and the list helpers behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from merch.functions import numbers as num
from merch.operators import moq
from merch.plans import binding as b
from merch.plans.query import Query

LOTS = {"T1": 12, "T2": 30, "T4": 50}


def forecasts(spark, sf_dir):
    """Six small slots per SKU; January and July share the first, and so on, so that every line counts."""
    month = F.month("l_shipdate")
    sums = [
        F.coalesce(F.sum(F.when((month - 1) % 6 == i, F.col("l_quantity"))), F.lit(0)) for i in range(6)
    ]
    slots = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("sku")).agg(
        *[F.floor(total / 16).cast("bigint").alias(c) for total, c in zip(sums, moq.SLOTS)]
    )
    return slots.join(b.part_types(spark, sf_dir).select("sku", "type"), "sku")


def lists(spark, sf_dir):
    return forecasts(spark, sf_dir).withColumn("v", F.array(*moq.SLOTS))


SLOTS_SQL = "forecasts AS (SELECT l.*, p.type FROM (SELECT l_partkey AS sku, " + ", ".join(
    f"floor(coalesce(sum(CASE WHEN (month(l_shipdate) - 1) % 6 = {i} THEN l_quantity END), 0) / 16)::BIGINT AS {c}" for i, c in enumerate(moq.SLOTS)
) + f" FROM lineitem GROUP BY 1) l JOIN ({b.PART_SQL}) p USING (sku)), lists AS (SELECT *, [" + ", ".join(moq.SLOTS) + "] AS v FROM forecasts)"


def moq_sql(version):
    first = 2 if version == 2 else 0
    lot = "m" if version == 2 else "CASE WHEN x > 0 THEN m ELSE total END"
    case = " ".join(f"WHEN type = '{t}' THEN {n}" for t, n in LOTS.items())
    return f"""{SLOTS_SQL},
sized AS (SELECT *, CASE {case} ELSE 16 END AS m, list_filter(range(0, 6), lambda i: v[i + 1] <> 0 AND i >= {first}) AS spots,
          list_sum(v[{first + 1}:6])::BIGINT AS total FROM lists),
counted AS (SELECT *, total // m AS x FROM sized),
lots AS (SELECT *, greatest(x, 1) AS k, {lot} AS lot, len(spots) AS n, v[6] <> 0 AND v[6] < m AS merging FROM counted),
placed AS (SELECT *, CASE WHEN k >= n THEN spots WHEN k = 1 THEN [spots[n // 2 + 1]]
    ELSE list_transform(range(0, k), lambda i: spots[round_even(i * ((n - 1)::DOUBLE / (k - 1)), 0)::BIGINT + 1]) END AS chosen FROM lots),
moq AS (SELECT sku, type, CASE WHEN merging THEN greatest(k - n, 0) * lot ELSE 0 END AS lost_qty, """ + ", ".join(
        f"CASE WHEN NOT merging THEN {c} WHEN list_contains(chosen, {i}) THEN lot ELSE 0 END AS {c}" for i, c in enumerate(moq.SLOTS)
    ) + " FROM placed)"


SLOT_SHAPE = " ".join(f"{c}:l" for c in moq.SLOTS)


def _list_stats(spark, sf_dir):
    v = F.col("v")
    text = lambda a: F.concat_ws(",", F.transform(a, lambda i: i.cast("string")))
    return lists(spark, sf_dir).select(
        "sku",
        num.list_sum(v).alias("total"),
        num.non_zero_count(v).alias("filled"),
        num.non_zero_mean(v).alias("mean"),
        text(num.non_zero_positions(v)).alias("spots"),
        text(num.non_zero_positions(v, 2)).alias("late_spots"),
    )


QUERIES = {
    "moq_consolidate": Query(
        lambda s, d: moq.moq_consolidate(forecasts(s, d), lots=LOTS), f"sku:l type:s lost_qty:l {SLOT_SHAPE}",
        f"WITH {moq_sql(2)} SELECT * FROM moq",
    ),
    "moq_consolidate_first_version": Query(
        lambda s, d: moq.moq_consolidate(forecasts(s, d), lots=LOTS, version=1), f"sku:l type:s lost_qty:l {SLOT_SHAPE}",
        f"WITH {moq_sql(1)} SELECT * FROM moq",
    ),
    "moq_even_lots": Query(
        lambda s, d: moq.moq_even_lots(moq.moq_consolidate(forecasts(s, d), lots=LOTS)), f"sku:l {SLOT_SHAPE}",
        f"WITH {moq_sql(2)} SELECT sku, " + ", ".join(f"{c} - {c} % 2 AS {c}" for c in moq.SLOTS) + " FROM moq",
    ),
    "list_statistics": Query(
        _list_stats, "sku:l total:l filled:l mean:d2 spots:s late_spots:s",
        f"""WITH {SLOTS_SQL} SELECT sku, list_sum(v) AS total, len(list_filter(v, lambda x: x <> 0)) AS filled,
            coalesce(round_even(list_avg(list_filter(v, lambda x: x <> 0)), 2), 0) AS mean,
            array_to_string(list_filter(range(0, 6), lambda i: v[i + 1] <> 0), ',') AS spots,
            array_to_string(list_filter(range(2, 6), lambda i: v[i + 1] <> 0), ',') AS late_spots FROM lists""",
    ),
}
