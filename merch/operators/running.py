"""Running totals that do not put a whole group on one task.

A plain ordered window sends each group to one task, so one pool with a third
of all rows becomes the whole runtime. Here the rows are range-partitioned by
(keys, order) into even slices, each slice is summed, the slice sums are turned
into offsets, and the ordered window then runs inside single slices only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merch.session import staged


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    sums: dict[str, str],
    *,
    rank: str | None = None,
    totals: dict[str, str] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add running sums, row numbers and group totals.

    ``order`` must be a total order inside a group (end it with a unique column).
    ``sums`` maps output name to summed column, ``rank`` names a row number,
    ``totals`` maps output name to a column summed over the whole group.
    """
    spread = [F.col(k).asc() for k in keys] + order
    cut = df.repartitionByRange(slices, *spread) if slices else df.repartitionByRange(*spread)
    rows = staged(cut.withColumn("_slice", F.spark_partition_id()), "running")

    wanted = sorted(set(sums.values()) | set((totals or {}).values()))
    parts = rows.groupBy(*keys, "_slice").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{c}") for c in wanted]
    )
    group = [F.col(k) for k in keys] or [F.lit(0)]
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = parts.select(
        *[F.col(k).alias(f"_at_{k}") for k in keys],
        F.col("_slice").alias("_at_slice"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        *[F.sum(f"_sum_{c}").over(earlier).alias(f"_before_{c}") for c in sorted(set(sums.values()))],
        *[F.sum(f"_sum_{c}").over(whole).alias(out) for out, c in (totals or {}).items()],
    )

    match = F.col("_slice") == F.col("_at_slice")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_at_{k}"))
    joined = rows.join(offsets, match).drop("_at_slice", *[f"_at_{k}" for k in keys])

    inside = Window.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    added = {}
    for out, c in sums.items():
        here = F.sum(c).over(inside)
        added[out] = F.when(F.col(f"_before_{c}").isNull(), here).otherwise(
            F.col(f"_before_{c}") + F.coalesce(here, F.lit(0))
        )
    if rank:
        added[rank] = F.col("_rows_before") + F.count(F.lit(1)).over(inside)
    drop = ["_slice", "_rows_before"] + [f"_before_{c}" for c in set(sums.values())]
    return joined.withColumns(added).drop(*drop)
