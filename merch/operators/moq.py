"""Order consolidation: small monthly forecasts become orderable lots. Arrays only, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merch.functions.numbers import half_even, make_even, non_zero_positions

SLOTS = ["f01", "f02", "f03", "f04", "f05", "f06"]

# Minimum lot by product class, and for every other class.
MIN_LOTS = {"Wheel Hub": 12, "Brake Pads": 30, "ABS Sensor": 50}
DEFAULT_LOT = 16


def min_lot(kind: Column, lots: dict[str, int], default: int) -> Column:
    value = F.lit(default)
    for name, size in lots.items():
        value = F.when(kind == name, size).otherwise(value)
    return value


def spaced_positions(spots: Column, count: Column) -> Column:
    """``count`` entries spread evenly over ``spots``: all if there are too few, the middle one for one."""
    m = F.size(spots)
    step = (m - 1) / F.greatest(count - 1, F.lit(1))
    place = F.transform(
        F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)).cast("int")),
        lambda i: half_even(i.cast("double") * step).cast("int"),
    )
    return (
        F.when(count >= m, spots)
        .when(count == 1, F.array(F.get(spots, F.floor(m / 2).cast("int"))))
        .otherwise(F.transform(place, lambda p: F.get(spots, p)))
    )


def moq_consolidate(
    df: DataFrame,
    slots: list[str] = SLOTS,
    lots: dict[str, int] | None = None,
    default: int = DEFAULT_LOT,
    version: int = 2,
) -> DataFrame:
    """Rewrite the slots of rows whose last slot is not 0 and below the minimum lot.

    Version 2 leaves the first two slots out of sum and positions (and empties
    them); version 1 uses all, and orders the plain sum when it is under one
    lot. ``lost_qty`` is what does not fit: lots beyond the non-zero slots.
    """
    first = 2 if version == 2 else 0
    ready = df.withColumns(
        {
            "_v": F.array(*[F.col(c).cast("bigint") for c in slots]),
            "_min": min_lot(F.col("type"), MIN_LOTS if lots is None else lots, default).cast("bigint"),
        }
    )
    counted = F.slice("_v", first + 1, len(slots) - first)
    total = F.aggregate(counted, F.lit(0).cast("bigint"), lambda a, x: a + x)
    ready = ready.withColumns(
        {
            "_last": F.element_at("_v", -1),
            "_spots": non_zero_positions(F.col("_v"), first),
            "_total": total,
            "_x": (total / F.col("_min")).cast("bigint"),
        }
    )
    whole = F.col("_x") > 0
    ready = ready.withColumns(
        {
            "_count": F.when(whole, F.col("_x")).otherwise(F.lit(1)),
            "_lot": F.col("_min") if version == 2 else F.when(whole, F.col("_min")).otherwise(F.col("_total")),
            "_merge": (F.col("_last") != 0) & (F.col("_last") < F.col("_min")),
        }
    ).withColumn("_at", spaced_positions(F.col("_spots"), F.col("_count")))
    merged = {
        c: F.when(F.col("_merge"), F.when(F.array_contains("_at", i), F.col("_lot")).otherwise(0)).otherwise(F.col(c))
        for i, c in enumerate(slots)
    }
    lost = F.when(F.col("_merge"), F.greatest(F.col("_count") - F.size("_spots"), F.lit(0)) * F.col("_lot")).otherwise(0)
    hidden = ["_v", "_min", "_last", "_spots", "_total", "_x", "_count", "_lot", "_merge", "_at"]
    return ready.withColumn("lost_qty", lost).withColumns(merged).drop(*hidden)


def moq_even_lots(df: DataFrame, slots: list[str] = SLOTS) -> DataFrame:
    return df.withColumns({c: make_even(F.col(c)) for c in slots})
