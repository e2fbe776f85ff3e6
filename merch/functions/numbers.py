"""Number and list expressions.

Two roundings live side by side and must not be mixed: ``half_even`` where the
source rounds in Python, ``half_up`` where it rounds in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(c: Column, places: int = 0) -> Column:
    return F.bround(c, places)


def half_up(c: Column, places: int = 0) -> Column:
    return F.round(c, places)


def make_even(c: Column) -> Column:
    """Odd numbers go down by one."""
    return c - F.pmod(c, F.lit(2))


def clip(c: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(c, low), high)


def min_max(c: Column, low: Column, high: Column) -> Column:
    """Scale to 0..1; a constant column scales to 0."""
    return F.when(high > low, (c - low) / (high - low)).when(c.isNotNull(), F.lit(0.0))


def min_max_inverse(c: Column, low: Column, high: Column) -> Column:
    return c * (high - low) + low


def line_weight(position: Column, n: Column, start: float, stop: float) -> Column:
    """Evenly spaced weights: position 0 gets ``start``, position n-1 gets exactly ``stop``.

    One position alone gets ``start``. The end is set, not computed, because a
    weight above it by one bit would push whole products over the next integer.
    """
    inner = position * (F.lit(stop - start) / (n - 1)) + F.lit(start)
    return F.when(position == 0, F.lit(start)).when(position == n - 1, F.lit(stop)).otherwise(inner)


def split_units(units: Column, people: Column, rank: Column) -> Column:
    """Share of the person at ``rank`` (from 1) when units go round as evenly as possible."""
    odd = F.pmod(units, people)
    return (units - odd) / people + F.when(rank <= odd, 1).otherwise(0)


def capped_at(x: Column, top: Column) -> Column:
    """``x`` unless it is above ``top``; a NULL comparison leaves ``x``."""
    return F.when(x > top, top).otherwise(x)


def list_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("double"), lambda a, x: a + x)


def non_zero_count(values: Column) -> Column:
    return F.size(F.filter(values, lambda x: x != 0))


def non_zero_mean(values: Column) -> Column:
    """Mean of the non-zero entries to two places, 0 when there are none."""
    count = non_zero_count(values)
    return F.when(count > 0, half_even(list_sum(values) / count, 2)).otherwise(F.lit(0.0))


def non_zero_positions(values: Column, first: int = 0) -> Column:
    """0-based positions of non-zero entries, from position ``first`` on."""
    spots = F.sequence(F.lit(0), F.size(values) - 1)
    return F.filter(spots, lambda i: (i >= first) & (F.get(values, i) != 0))


def weighted_mean(values: Column, start: float = 0.5, stop: float = 1.0) -> Column:
    """Mean with weights rising evenly from ``start`` to ``stop`` along the list."""
    n = F.size(values)
    weights = F.transform(values, lambda x, i: line_weight(i.cast("double"), n, start, stop))
    total = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
    pairs = F.zip_with(values, weights, lambda x, w: x * w)
    return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x) / total


def any_zero(columns: list[str]) -> Column:
    """True when one of the columns is 0; NULL columns do not count."""
    cells = F.array(*[F.coalesce(F.col(c) == 0, F.lit(False)) for c in columns])
    return F.exists(cells, lambda hit: hit)


def row_total(columns: list[str]) -> Column:
    """Sum across columns with NULL as 0."""
    return F.aggregate(
        F.array(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in columns]),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )


def cell_sum(base: Column, *others: Column) -> Column:
    """``base`` plus the others with NULL as 0, but NULL where ``base`` is NULL."""
    total = base
    for other in others:
        total = total + F.coalesce(other, F.lit(0))
    return total
