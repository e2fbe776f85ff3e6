"""Allocation of sales targets and surplus stock to the people responsible for each SKU.

Every person has a remaining [low, high] target in money. SKUs are served in
order and each one depletes those targets, so inside one budget the result
depends on the order and is computed by an ordered fold. Budgets are territories
(``partition_cols``, required): each has its own targets and its own order, the
rule is the same at every size, and a finer split means finer territories. The
fold streams the SKUs of a territory and holds two numbers per person.

Money is held in cents, so depletion is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merch.functions.numbers import capped_at, half_even, half_up, split_units
from merch.functions.text import present_names
from merch.session import staged

BASE_SHARE = 0.2
NEW_LEVEL = 6


def cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def money_of(c: Column) -> Column:
    return (c / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")


# --- stateless parts --------------------------------------------------------


def principal_list(wide: DataFrame, names: list[str]) -> DataFrame:
    """Add ``principals``: the names whose cell is not NULL (0 still counts as responsible)."""
    return wide.withColumn("principals", present_names(names))


def principal_matrix(df: DataFrame, names: list[str], values: str | None = None) -> DataFrame:
    """One column per name from list columns; NULL for people who are not responsible."""
    cells = F.map_from_arrays("principals", values) if values else F.map_from_arrays(
        "principals", F.transform("principals", lambda p: F.lit(0).cast("bigint"))
    )
    return df.withColumns({n: F.try_element_at(cells, F.lit(n)) for n in names})


def base_quantity(target: Column, people: Column) -> Column:
    """Equal first share of everyone: a fifth of the even split, rounded half-even."""
    return half_even(F.floor(target / people) * F.lit(BASE_SHARE)).cast("bigint")


def base_share(skus: DataFrame) -> DataFrame:
    """Each responsible person's first share of each SKU."""
    people = F.size("principals")
    return skus.where(people > 0).select(
        "sku", F.explode("principals").alias("principal"), base_quantity(F.col("sku_target"), people).alias("qty")
    )


def gradient_split(skus: DataFrame, units: str = "units", people: str = "principals") -> DataFrame:
    """Split units over the people in list order; earlier people get the odd units."""
    n = F.size(people)
    return (
        skus.where(n > 0)
        .select("sku", F.col(units).alias("_units"), n.alias("_n"), F.posexplode(people).alias("_pos", "principal"))
        .select("sku", "principal", split_units(F.col("_units"), F.col("_n"), F.col("_pos") + 1).cast("bigint").alias("qty"))
    )


# --- territories and state --------------------------------------------------


def territory(keys: list[str]) -> Column:
    """One text per combination of the keys; a NULL key is a territory too."""
    if not keys:
        raise ValueError("name the columns of a territory; the targets belong to territories")
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})


def open_state(targets: DataFrame, keys: list[str]) -> DataFrame:
    """Remaining targets in cents per territory and person."""
    return targets.select(*keys, "principal", *[cents(F.col(c)).alias(c) for c in ("low", "high")])


# --- the ordered fold -------------------------------------------------------


def _weighted(units: int, price: int, who: list[int], low: list[int], high: list[int]):
    """A base share for everyone, the rest in proportion to what each still has to sell.

    A person whose low target is used up is no longer charged.
    """
    base = round(units // len(who) * BASE_SHARE)
    rest = units - base * len(who)

    def charge(w: int, qty: int) -> int:
        if low[w] <= 0:
            return 0
        value = qty * price
        low[w] = max(low[w] - value, 0)
        high[w] -= value
        return value

    spent = [charge(w, base) for w in who]
    left = [low[w] for w in who]
    total = sum(left)
    extra = [round(rest * (x / total)) for x in left] if total else [0] * len(who)
    return [base + e for e in extra], [s + charge(w, e) for s, w, e in zip(spent, who, extra)]


def _even(units: int, price: int, who: list[int], low: list[int], high: list[int], *, whom, by_high, clamp):
    """Units dealt as evenly as possible, odd ones to those with most left to sell; None for no cell."""
    rank = (lambda k: (-low[who[k]], -high[who[k]], k)) if by_high else (lambda k: (-low[who[k]], k))
    ranked = sorted(range(len(who)), key=rank)
    unmet = sum(low[w] > 0 for w in who)
    people = len(who) if whom == "all" or (whom == "unmet" and unmet == 0) else unmet
    dealt = [None if whom == "unmet_only" else 0] * len(who)
    each, odd = divmod(max(units, 0), people) if people else (0, 0)
    for place, k in enumerate(ranked[:people]):
        dealt[k] = each + (place < odd)
    spent = [(qty or 0) * price for qty in dealt]
    for w, value in zip(who, spent):
        low[w] -= value
        high[w] -= value
        if clamp:
            low[w], high[w] = max(low[w], 0), max(high[w], 0)
    return dealt, spent


STATE = "array<struct<principal:string,low:bigint,high:bigint>>"


def _fold(step, drop_spent=False):
    """Serve the SKUs of each territory in order; the last row of a territory carries its closing state.

    The opening state comes once, on a row of its own before the SKUs of its territory.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, spot, low, high, blank, served = None, {}, [], [], None, False

        def closing():
            left = [{"principal": p, "low": low[i], "high": high[i]} for p, i in spot.items()]
            return blank.assign(_territory=[now], closing=pd.Series([left], dtype=object))

        for batch in batches:
            if blank is None:
                blank = pd.DataFrame({c: [None] for c in batch.columns if c != "opening"}, dtype=object).assign(qty=None, spend=None)
            cuts = (batch["_territory"] != batch["_territory"].shift()).to_numpy().nonzero()[0].tolist()
            for a, b in zip(cuts, [*cuts[1:], len(batch)]):
                part = batch.iloc[a:b]
                if part["_territory"].iloc[0] != now:
                    if served:
                        yield closing()
                    now, opening, served = part["_territory"].iloc[0], part["opening"].iloc[0], False
                    head = opening is not None
                    opening, part = (opening, part.iloc[1:]) if head else ([], part)
                    spot = {p["principal"]: i for i, p in enumerate(opening)}
                    low, high = [p["low"] for p in opening], [p["high"] for p in opening]
                if not len(part):
                    continue
                served = True
                qty, spend = [], []
                for units, price, names in zip(part["units"].tolist(), part["price_cents"].tolist(), part["principals"]):
                    at = [i for i, p in enumerate(names) if p in spot]
                    who = [spot[names[i]] for i in at]
                    given, charged = step(units, price, who, low, high) if who else ([], [])
                    if drop_spent:
                        given = [None if high[w] <= 0 else g for w, g in zip(who, given)]
                    # a person without a target stays in the list, without a cell
                    cells_, paid = [None] * len(names), [0] * len(names)
                    for i, g, c in zip(at, given, charged):
                        cells_[i], paid[i] = g, c
                    qty.append(cells_)
                    spend.append(paid)
                yield part.drop(columns="opening").assign(qty=qty, spend=spend, closing=None)
        if served:
            yield closing()

    return run


def _apply(rows: DataFrame, state: DataFrame, keys: list[str], fold) -> tuple[DataFrame, DataFrame]:
    """The folded rows and the closing state; territories without a SKU keep their opening one."""
    served = rows.withColumn("_territory", territory(keys))
    # one row opens a territory; its numbers are not null, which would turn those of the SKUs beside it into floats
    person = F.struct("principal", "low", "high")
    opening = state.groupBy(territory(keys).alias("_territory"), *keys).agg(F.sort_array(F.collect_list(person)).cast(STATE).alias("opening"))
    blank = {f.name: F.lit(0 if isinstance(f.dataType, T.NumericType) else None) for f in rows.schema.fields}
    blank |= {k: F.col(k) for k in keys}
    head = opening.select(*[blank[f.name].cast(f.dataType).alias(f.name) for f in rows.schema.fields], "_territory", "opening")
    met = served.withColumn("opening", F.lit(None).cast(STATE)).unionByName(head)
    order = ["_territory", F.col("opening").isNull(), "level", F.col("priority").desc(), F.col("priority_tie").desc(), "sku"]
    plain = [f for f in met.schema.fields if f.name != "opening"]
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in plain]
        + [T.StructField("qty", T.ArrayType(T.LongType())), T.StructField("spend", T.ArrayType(T.LongType()))]
        + [T.StructField("closing", met.schema["opening"].dataType)]
    )
    both = staged(met.repartition("_territory").sortWithinPartitions(*order).mapInPandas(fold, schema), "folded")
    folded = both.where("closing IS NULL").drop("closing", "_territory")
    ends = both.where("closing IS NOT NULL").select(F.col("_territory").alias("_t"), F.explode("closing").alias("_p"))
    ends = ends.select("_t", F.col("_p.principal").alias("_who"), F.col("_p.low").alias("_low"), F.col("_p.high").alias("_high"))
    after = state.join(ends, (territory(keys) == F.col("_t")) & (F.col("principal") == F.col("_who")), "left")
    return folded, after.select(*keys, "principal", F.coalesce("_low", "low").alias("low"), F.coalesce("_high", "high").alias("high"))


def _rows(df: DataFrame, keys: list[str]) -> DataFrame:
    tie = F.col("priority_tie") if "priority_tie" in df.columns else F.lit(0)
    return df.select(
        *keys,
        "sku",
        F.col("level").cast("bigint").alias("level"),
        cents(F.col("unit_price")).alias("price_cents"),
        *[F.col(c).cast("bigint").alias(c) for c in ("stock", "sku_target", "forecast", "units", "priority")],
        tie.cast("bigint").alias("priority_tie"),
        "principals",
    )


def _result(folded: DataFrame) -> DataFrame:
    given = F.aggregate("qty", F.lit(0).cast("bigint"), lambda a, q: a + F.coalesce(q, F.lit(0)))
    return (
        folded.withColumns({"unit_price": money_of(F.col("price_cents")), "assigned": given})
        .withColumn("leftover", F.col("units") - F.col("assigned"))
        .drop("price_cents", "priority", "priority_tie")
    )


def cells(assigned: DataFrame, *keep: str) -> DataFrame:
    """One row per SKU and person with ``qty`` (NULL for a dropped cell) and ``spend`` in cents."""
    return assigned.select(
        *keep, "sku", F.explode(F.arrays_zip("principals", "qty", "spend")).alias("_c")
    ).select(*keep, "sku", F.col("_c.principals").alias("principal"), F.col("_c.qty").alias("qty"), F.col("_c.spend").alias("spend"))


def allocate_targets(skus: DataFrame, targets: DataFrame, partition_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """First round: SKU targets by base share and remaining-target weight.

    Returns the assigned rows (one per SKU, with aligned lists ``principals``,
    ``qty``, ``spend``) and the state left for the next round. A SKU without
    anyone responsible keeps its whole target as leftover; a person without a
    target has a NULL cell.
    """
    ready = skus.withColumns({"units": F.col("sku_target"), "priority": F.col("sku_target")})
    folded, state = _apply(_rows(ready, partition_cols), open_state(targets, partition_cols), partition_cols, _fold(_weighted))
    return _result(folded), staged(state, "state")


def allocate_round(
    residual_rows: DataFrame, state: DataFrame, partition_cols: list[str], who: str = "all", clamp: bool = False, by_high: bool = True
) -> tuple[DataFrame, DataFrame]:
    """A later round: deal the ``units`` of each residual SKU evenly, most remaining first.

    ``who``: "unmet" serves people with a positive low target, or all if there
    is none; "unmet_only" leaves out SKUs without such people; "all" serves
    everyone. ``clamp`` is the older rule: targets stop at 0 and the cell of a
    person whose high target is used up is dropped although it was charged.
    """

    def step(*args):
        return _even(*args, whom=who, by_high=by_high, clamp=clamp)

    folded, after = _apply(_rows(residual_rows, partition_cols), state, partition_cols, _fold(step, drop_spent=clamp))
    if who == "unmet_only":
        folded = folded.where(F.exists("qty", lambda q: q.isNotNull()))
    return _result(folded), staged(after, "state")


def allocate_one_each(assigned: DataFrame, state: DataFrame, partition_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """One unit for every responsible person who got none, for SKUs in stock.

    The quantity needs no order and the charge is a plain sum, so no fold.
    """
    gap = F.transform("qty", lambda q: F.when(q == 0, F.lit(1).cast("bigint")))
    price = cents(F.col("unit_price"))
    given = (
        assigned.where((F.col("stock") != 0) & F.exists("qty", lambda q: q == 0))
        .withColumn("qty", gap)
        .withColumn("spend", F.transform("qty", lambda q: F.coalesce(q, F.lit(0)) * price))
    )
    spent = cells(given, *partition_cols).groupBy(territory(partition_cols).alias("_t"), F.col("principal").alias("_who")).agg(F.sum("spend").alias("_spent"))
    after = state.join(spent, (territory(partition_cols) == F.col("_t")) & (F.col("principal") == F.col("_who")), "left")
    paid = F.coalesce("_spent", F.lit(0))
    low = F.when(paid > 0, F.greatest(F.col("low") - paid, F.lit(0))).otherwise(F.col("low"))
    return given, after.select(*partition_cols, "principal", low.cast("bigint").alias("low"), (F.col("high") - paid).cast("bigint").alias("high"))


def target_attainment(state: DataFrame, targets: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Target, remaining low and high, and sold value per territory and person, with or without SKUs."""
    left = state.select(
        territory(partition_cols).alias("_t"), F.col("principal").alias("_who"), *[money_of(F.col(c)).alias(f"{c}_left") for c in ("low", "high")]
    )
    met = targets.join(left, (territory(partition_cols) == F.col("_t")) & (F.col("principal") == F.col("_who")), "left").drop("_t", "_who")
    return met.withColumn("sold", F.col("high") - F.col("high_left"))


# --- residual rules ---------------------------------------------------------


def assigned_total(*rounds: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Units per territory and SKU over several rounds."""
    by = [*partition_cols, "sku"]
    stacked = rounds[0].select(*by, "assigned")
    for r in rounds[1:]:
        stacked = stacked.unionByName(r.select(*by, "assigned"))
    return stacked.groupBy(*by).agg(F.sum("assigned").alias("assigned"))


def months_kept(months: int = 4) -> Column:
    """Stock to keep: months of forecast, or of the target where nothing is forecast."""
    return F.when(F.col("forecast") == 0, F.col("sku_target") * months).otherwise(F.col("forecast") * months)


def residual(
    first: DataFrame, rule: str, later: tuple[DataFrame, ...] = (), soft: bool = False, *, partition_cols: list[str] | None = None
) -> DataFrame:
    """SKUs with something left to deal out: ``units``, with ``priority`` for the order.

    ``first`` is the first round's result, ``later`` the rounds after it that
    count as assigned too, within the SKU's territory (``partition_cols``, needed with ``later``). Rules: "surplus" stock beyond what is kept, at most
    the target; "coverage" the same uncapped, for stock over five times the
    target; "target" the unassigned target; "fifth" a fifth of the stock
    (``soft``: only where stock also exceeds four months of forecast).
    """
    df = first.drop("units", "qty", "spend", "leftover")
    if later:
        total = assigned_total(first, *later, partition_cols=partition_cols).withColumnRenamed("assigned", "_total").withColumnRenamed("sku", "_sku")
        total = total.select(territory(partition_cols).alias("_t"), "_sku", "_total")
        df = df.join(total, (territory(partition_cols) == F.col("_t")) & (F.col("sku") == F.col("_sku")))
        df = df.withColumn("assigned", F.col("_total")).drop("_t", "_sku", "_total")
    over = F.col("stock") - F.col("assigned") - months_kept()
    if rule == "surplus":
        df = df.withColumn("priority", over).where("priority > 0")
        return df.withColumn("units", capped_at(F.col("priority"), F.col("sku_target")))
    if rule == "coverage":
        df = df.where(F.try_divide("stock", "sku_target") > 5).withColumn("priority", over)
        return df.withColumn("units", F.col("priority"))
    if rule == "target":
        df = df.withColumn("priority", F.col("sku_target") - F.col("assigned")).where("priority > 0")
        return df.withColumn("units", F.col("priority"))
    if rule == "fifth":
        df = df.withColumn("priority", half_up(F.col("stock") / 5).cast("bigint") - F.col("assigned")).where("priority > 0")
        if soft:
            df = df.where(F.col("stock") - F.col("assigned") - 4 * F.col("forecast") > 0)
        return df.withColumn("units", F.col("priority"))
    raise ValueError(f"unknown rule {rule!r}")


def available_stock(assigned: DataFrame) -> DataFrame:
    """First version's rule: stock beyond target and forecast for SKUs where someone got nothing."""
    zeros = F.size(F.filter("qty", lambda q: q == 0))
    available = F.col("stock") - F.col("sku_target") + F.col("leftover") - zeros
    return (
        assigned.where((zeros > 0) & (F.col("stock") != 0))
        .withColumns({"available": available, "priority": available - F.col("forecast"), "priority_tie": available})
        .where("available > 0 AND priority > 0")
        .withColumn("units", F.col("priority"))
        .drop("qty", "spend", "assigned", "leftover")
    )
