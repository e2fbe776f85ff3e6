"""SKU grading: entropy weights, scores, pools and cumulative-profit levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merch.functions.numbers import min_max
from merch.operators.running import running_totals

MEASURES = ["num", "revenue", "profit"]
REST_POOL = "__rest__"


def sku_metrics(lines: DataFrame, start: str, end: str) -> DataFrame:
    """Sum num, revenue and profit of each SKU over a closed date range."""
    return (
        lines.where(F.col("sales_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .groupBy("sku")
        .agg(F.max("type").alias("type"), *[F.sum(m).alias(m) for m in MEASURES])
    )


def measure_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with the count and, per column, sum, sum of x ln x, zeros, min and max."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.sum(x).alias(f"{c}_sum"),
            F.sum(F.when(x > 0, x * F.ln(x)).otherwise(0.0)).alias(f"{c}_xlnx"),
            F.count_if(x == 0).alias(f"{c}_zeros"),
            F.min(x).alias(f"{c}_min"),
            F.max(x).alias(f"{c}_max"),
        ]
    return df.agg(*aggs)


def entropy_weights(df: DataFrame, cols: list[str] = MEASURES, eps: float = 1e-10) -> DataFrame:
    """One row of entropy weights ``w_<col>`` (with the min and max of each column alongside).

    With p = x / sum(x), the entropy sum of p ln p equals (sum of x ln x) / S - ln S,
    so totals and entropies come out of a single pass. Zeros enter as ``eps``. A
    single row, or columns that carry no information, give equal weights.
    """
    stats = measure_stats(df, cols)
    gain = {}
    for c in cols:
        total = F.col(f"{c}_sum")
        # a measure that is 0 everywhere has no shares, and all its weight is information-free
        entropy = F.try_divide(F.col(f"{c}_xlnx"), total) - F.ln(total) + F.col(f"{c}_zeros") * F.lit(eps) * F.ln(F.lit(eps))
        gain[f"_d_{c}"] = F.lit(1.0) + F.coalesce(F.when(F.col("n") > 1, F.try_divide(entropy, F.ln(F.col("n").cast("double")))), F.when(total == 0, F.lit(-1.0)), F.lit(0.0))
    wide = stats.withColumns(gain)
    whole = sum((F.col(f"_d_{c}") for c in cols[1:]), F.col(f"_d_{cols[0]}"))
    even = F.lit(1.0 / len(cols))
    return wide.select(
        "n",
        *[F.when(whole != 0, F.col(f"_d_{c}") / whole).otherwise(even).alias(f"w_{c}") for c in cols],
        *[F.col(f"{c}_{edge}") for c in cols for edge in ("min", "max")],
    )


def sku_score(df: DataFrame, weights: DataFrame, cols: list[str] = MEASURES) -> DataFrame:
    """Add ``<col>_mms`` (min-max over the rows behind the weights) and the weighted ``score``.

    The weights are one row by construction; it is read here and enters the
    plan as literals, so the SKU rows are neither joined nor shuffled for it.
    """
    w = weights.first()
    scaled = df.withColumns(
        {f"{c}_mms": min_max(F.col(c).cast("double"), F.lit(w[f"{c}_min"]), F.lit(w[f"{c}_max"])) for c in cols}
    )
    parts = [F.lit(w[f"w_{c}"]) * F.col(f"{c}_mms") for c in cols]
    return scaled.withColumn("score", sum(parts[1:], parts[0]))


def column_shares(df: DataFrame, cols: list[str] = MEASURES, eps: float = 1e-10) -> DataFrame:
    """Add ``p_<col>``, the share of the column total, with 0 replaced by ``eps``."""
    totals = measure_stats(df, cols).first()
    return df.withColumns(
        {
            f"p_{c}": F.when(F.col(c) == 0, F.lit(eps)).otherwise(F.try_divide(F.col(c).cast("double"), F.lit(totals[f"{c}_sum"])))
            for c in cols
        }
    )


def brand_type(df: DataFrame, special: list[str], non_brand: Column) -> DataFrame:
    """Split the special types into ``<type>|brand`` and ``<type>|other``."""
    split = F.concat(F.col("type"), F.when(non_brand, F.lit("|other")).otherwise(F.lit("|brand")))
    return df.withColumn("type", F.when(F.col("type").isin(*special), split).otherwise(F.col("type")))


def large_types(df: DataFrame, special: list[str], min_size: int = 40) -> DataFrame:
    """Types outside the special ones with at least ``min_size`` rows; NULL types never qualify."""
    own = [f"{t}|{side}" for t in special for side in ("brand", "other")]
    return (
        df.where(~F.col("type").isin(*own))
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("type_count"))
        .where(F.col("type_count") >= min_size)
    )


def grade_pools(df: DataFrame, special: list[str], non_brand: Column, min_size: int = 40) -> DataFrame:
    """Add the ``pool`` a SKU competes in.

    Special types are split by brand and always stand alone; any other type
    stands alone from ``min_size`` SKUs on; the rest share one pool.
    """
    typed = brand_type(df, special, non_brand)
    own = [f"{t}|{side}" for t in special for side in ("brand", "other")]
    big = large_types(typed, special, min_size).select(F.col("type").alias("_big"))
    return (
        typed.join(big, F.col("type") == F.col("_big"), "left")
        .withColumn(
            "pool",
            F.when(F.col("type").isin(*own) | F.col("_big").isNotNull(), F.col("type")).otherwise(F.lit(REST_POOL)),
        )
        .drop("_big")
    )


def pareto_levels(
    df: DataFrame, pool: str = "pool", order: str = "score", value: str = "profit", *, cut: float = 0.8, tie: str = "sku"
) -> DataFrame:
    """Level 1-3 inside each pool by running share of a positive ``value``.

    Level 1 holds the best rows whose running sum stays within ``cut`` of the
    pool, level 2 repeats the rule on what level 1 left, level 3 is the rest.
    Level 1 is a prefix, so its sum is the largest running sum within the cut
    and both rules need one running sum only.
    """
    share = F.lit(str(cut)).cast("decimal(9,8)")
    ranked = running_totals(
        df, [pool], [F.col(order).desc(), F.col(tie).asc()], {"acc": value}, rank="place", totals={"tot": value}
    )
    top = ranked.groupBy(pool).agg(
        F.coalesce(F.max(F.when(F.col("acc") <= share * F.col("tot"), F.col("acc"))), F.lit(0)).alias("_first")
    )
    return (
        ranked.join(top, pool)
        .withColumn(
            "level",
            F.when(F.col("acc") <= share * F.col("tot"), 1)
            .when(F.col("acc") - F.col("_first") <= share * (F.col("tot") - F.col("_first")), 2)
            .otherwise(3),
        )
        .drop("_first")
    )


def below_mean(df: DataFrame, measure: str = "num") -> Column:
    """Predicate: the measure is below its mean over ``df``."""
    return F.col(measure) < df.agg(F.avg(measure)).scalar()


def loss_levels(metrics: DataFrame) -> DataFrame:
    """SKUs that lose money: level 4, or 5 when they also sell below the mean of that set."""
    losing = metrics.where(F.col("profit") < 0)
    return losing.withColumn("level", F.when(below_mean(losing), 5).otherwise(4))


def sku_grade(
    metrics: DataFrame,
    new_skus: DataFrame,
    start: str,
    end: str,
    *,
    special: list[str],
    non_brand: Column,
    strict: bool = True,
    min_size: int = 40,
) -> DataFrame:
    """Levels 1-6 for every SKU with a profit or loss, and every new SKU.

    ``metrics`` is read several times, so stage it first. With ``strict`` a new
    SKU keeps level 6 only. Without it the profit or loss row stays too, and a
    level 1, 2 or 5 found for that SKU also replaces the 6.
    """
    earning = metrics.where(F.col("profit") > 0)
    scored = sku_score(earning, entropy_weights(earning))
    leveled = pareto_levels(grade_pools(scored, special, non_brand, min_size))
    losing = loss_levels(metrics)
    fresh = new_skus.select("sku").withColumn("level", F.lit(6))
    if strict:
        leveled = leveled.join(new_skus.select("sku"), "sku", "left_anti")
        losing = losing.join(new_skus.select("sku"), "sku", "left_anti")
    else:
        found = leveled.select("sku", "level").unionByName(losing.select("sku", "level"))
        found = found.where(F.col("level").isin(1, 2, 5)).withColumnRenamed("level", "_found")
        fresh = fresh.join(found, "sku", "left").select("sku", F.coalesce("_found", "level").alias("level"))
    keep = ["sku", "level", "type", "pool", *MEASURES, *[f"{m}_mms" for m in MEASURES], "score"]
    return (
        leveled.select(*keep)
        .unionByName(losing.select("sku", "level", "type", *MEASURES), allowMissingColumns=True)
        .unionByName(fresh, allowMissingColumns=True)
        .withColumns({"start_date": F.lit(start).cast("date"), "end_date": F.lit(end).cast("date")})
    )
