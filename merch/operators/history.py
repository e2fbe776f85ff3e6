"""Daily, weekly and monthly sales histories.

Histories are kept sparse (one row per SKU and day with sales) for as long as
possible. Gaps are filled by a generator on each row, up to the next row of the
SKU, so filling needs no grid join and ships only the sparse rows. A SKU has at
most one row per calendar day after the first aggregation, which bounds every
per-SKU window by the calendar.
"""

from __future__ import annotations

from datetime import date

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merch.functions import dates as dt
from merch.functions.numbers import min_max

#: How SKU texts compare: by letters and digits alone, whatever their case, accents, width or ligatures.
SKU_COLLATION = "UNICODE_CI_AI"


def sku_names(*columns: DataFrame) -> DataFrame:
    """(written, sku): one name for all ways of writing a SKU, over the texts of the given one-column frames.

    The name is the smallest of the trimmed texts that the collation holds equal. Only distinct texts are compared under the
    collation; facts are then joined by their own text, as plain strings.
    """
    texts = columns[0]
    for more in columns[1:]:
        texts = texts.union(more)
    texts = texts.toDF("written").where("written IS NOT NULL").distinct()
    trimmed = F.trim("written")
    same = Window.partitionBy(F.collate(trimmed, SKU_COLLATION))
    return texts.select("written", F.min(trimmed).over(same).alias("sku"))


def with_sku_name(df: DataFrame, names: DataFrame, column: str = "sku") -> DataFrame:
    """``df`` with every SKU under its one name; rows without a SKU keep none."""
    found = df.join(names.withColumnsRenamed({"written": "_written", "sku": "_name"}), F.col(column) == F.col("_written"), "left")
    return found.withColumn(column, F.col("_name")).drop("_written", "_name")


def fix_case_mark(c: Column) -> Column:
    """Write the size mark ``x`` as ``X``."""
    return F.translate(c, "x", "X")


def _day(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def daily_totals(
    sales: DataFrame, inventory: DataFrame | None, start: str, end: str, platform: str | None = None
) -> DataFrame:
    """One row per SKU and day with sales: total_sales_qty and the stock known that day.

    Both sides are aggregated before they meet, so repeated inventory rows
    cannot multiply the sales.
    """
    wanted = F.col("sales_date").between(_day(start), _day(end))
    if platform is not None:
        wanted = wanted & (F.col("platform") == platform)
    sold = sales.where(wanted).groupBy("sku", "sales_date").agg(F.sum("sales_qty").alias("total_sales_qty"))
    if inventory is None:
        return sold.withColumn("total_available_quantity", F.lit(None).cast("bigint"))
    stock = (
        inventory.where(F.col("date").between(_day(start), _day(end)))
        .groupBy("sku", F.col("date").alias("sales_date"))
        .agg(F.max("total_available_quantity").alias("total_available_quantity"))
    )
    return sold.join(stock, ["sku", "sales_date"], "left")


def daily_totals_all_stock_days(
    sales: DataFrame, inventory: DataFrame, start: str, end: str, platform: str | None = None
) -> DataFrame:
    """As ``daily_totals``, with a zero-sales row for each day that has stock only.

    One aggregation over both feeds stacked, instead of a join.
    """
    sold = sales.where(F.col("platform") == platform) if platform is not None else sales
    both = sold.select("sku", "sales_date", "sales_qty").unionByName(
        inventory.select("sku", F.col("date").alias("sales_date"), "total_available_quantity"), allowMissingColumns=True
    )
    return (
        both.where(F.col("sales_date").between(_day(start), _day(end)))
        .groupBy("sku", "sales_date")
        .agg(
            F.coalesce(F.sum("sales_qty"), F.lit(0)).alias("total_sales_qty"),
            F.max("total_available_quantity").alias("total_available_quantity"),
        )
    )


def fill_days(daily: DataFrame, start: str, end: str) -> DataFrame:
    """Every SKU on every day from ``start`` to ``end``; added days have no sales and unknown stock."""
    by_day = Window.partitionBy("sku").orderBy("sales_date")
    first = F.lag("sales_date").over(by_day).isNull()
    following = F.lead("sales_date").over(by_day)
    spans = daily.select(
        "*",
        F.when(first, _day(start)).otherwise(F.col("sales_date")).alias("_from"),
        F.coalesce(F.date_sub(following, 1), _day(end)).alias("_to"),
    )
    days = spans.withColumn("_day", F.explode(F.sequence("_from", "_to")))
    own = F.col("_day") == F.col("sales_date")
    stock = F.when(own, F.col("total_available_quantity"))
    return days.select(
        "sku",
        F.col("_day").alias("sales_date"),
        F.when(own, F.coalesce(F.col("total_sales_qty"), F.lit(0))).otherwise(F.lit(0)).alias("total_sales_qty"),
        stock.alias("total_available_quantity"),
        stock.isNull().alias("inventory_missing"),
    )


def densify_daily(
    sales: DataFrame, inventory: DataFrame | None, start: str, end: str, platform: str | None = None
) -> DataFrame:
    return fill_days(daily_totals(sales, inventory, start, end, platform), start, end)


def sku_calendar(skus: DataFrame, start: str, end: str) -> DataFrame:
    """Each SKU with each day, generated row by row.

    The SKUs are few bytes, which would be read by one task; dealt to a fixed number of partitions, their days are made by all.
    """
    dealt = skus.repartition(int(skus.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.select("sku", F.explode(F.sequence(_day(start), _day(end))).alias("sales_date"))


def trim_to_first_sale(daily: DataFrame, end: str, qty: str = "total_sales_qty") -> DataFrame:
    """Drop the days before each SKU's first sale and after ``end``; SKUs without sales leave."""
    first = F.min(F.when(F.col(qty) > 0, F.col("sales_date"))).over(Window.partitionBy("sku"))
    return (
        daily.withColumn("_first", first)
        .where((F.col("sales_date") >= F.col("_first")) & (F.col("sales_date") <= _day(end)))
        .drop("_first")
    )


def monthly_totals(daily: DataFrame, end: str, qty: str = "total_sales_qty") -> DataFrame:
    """Sum and daily mean per calendar month, from a SKU's first sale to ``end``.

    Takes sparse or filled days. The mean divides by the calendar days that
    belong to the history, so it equals the mean over filled days.
    """
    by_month = Window.partitionBy("sku").orderBy("_month")
    spans = (
        _sold_months(daily, end, qty)
        .withColumns({"_first": F.min("_sale").over(by_month), "_next": F.lead("_month").over(by_month)})
        .where(F.col("_month") >= dt.month_number(F.col("_first")))
        .withColumn("_m", F.explode(F.sequence("_month", F.coalesce(F.col("_next") - 1, dt.month_number(_day(end))))))
    )
    opens = dt.month_from_number(F.col("_m"))
    total = F.when(F.col("_m") == F.col("_month"), F.col("_qty")).otherwise(F.lit(0))
    last = F.least(F.last_day(opens), _day(end))
    days = F.datediff(last, F.greatest(opens, F.col("_first"))) + 1
    return spans.select(
        "sku",
        F.last_day(opens).alias("month_end"),
        total.alias("qty"),
        days.alias("days"),
        (total / days).alias("daily_mean"),
    )


def _sold_months(daily: DataFrame, end: str, qty: str) -> DataFrame:
    """The months of a SKU with rows: their sum and first sale.

    The first sale is taken as a struct, so that Spark sorts by SKU and month instead of keeping hash maps of all months: a sort
    spills, and its order serves the windows behind it.
    """
    d = F.col("sales_date")
    months = daily.where(d <= _day(end)).groupBy("sku", dt.month_number(d).alias("_month"))
    sale = F.min(F.when(F.col(qty) > 0, F.struct(d.alias("day"))))
    return months.agg(F.sum(qty).alias("_qty"), sale["day"].alias("_sale"))


def _month_days(months: np.ndarray) -> np.ndarray:
    """The first day, since 1970, of months given as ``month_number``."""
    return (months - 1970 * 12).astype("datetime64[M]").astype("datetime64[D]").astype(np.int64)


def _fill_months(end: int, closing: int):
    """Lists of the months with rows, in any order, to the quantities of all months up to ``closing`` and the mean of their daily means."""

    @F.arrow_udf("struct<y: array<double>, mean_daily: double>")
    def fill(first: pa.Array, lists: pa.Array) -> pa.Array:
        first = first.cast(pa.int32()).to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        month, qty = (lists.flatten().field(i) for i in (0, 1))
        month, qty = month.to_numpy().astype(np.int64), qty.cast(pa.float64(), safe=False)
        known, qty = qty.is_valid().to_numpy(zero_copy_only=False), qty.fill_null(0.0).to_numpy()
        opening = (first.astype("datetime64[D]").astype("datetime64[M]").astype(np.int64)) + 1970 * 12
        order = np.lexsort((month, row))
        order = order[month[order] >= opening[row[order]]]
        row, month, qty, known = row[order], month[order], qty[order], known[order]
        # a list begins with its first month that has rows
        begin = np.full(len(lists), closing + 1)
        np.minimum.at(begin, row, month)
        many = closing + 1 - begin
        offsets = np.concatenate([[0], np.cumsum(many)])
        cells = offsets[row] + month - begin[row]
        y, given = np.zeros(offsets[-1]), np.ones(offsets[-1], dtype=bool)
        y[cells], given[cells] = qty, known
        days = np.minimum(_month_days(month + 1) - 1, end) - np.maximum(_month_days(month), first[row]) + 1
        total = np.bincount(row[known], (qty / days)[known], len(lists))  # in order, one after the other
        counted = many - np.bincount(row[~known], minlength=len(lists))
        mean = np.divide(total, counted, out=np.zeros(len(lists)), where=counted > 0)
        values = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(y, mask=~given))
        return pa.StructArray.from_arrays([values, pa.array(mean, mask=counted == 0)], ["y", "mean_daily"])

    return fill.asNondeterministic()  # or a filter on what it returns would run it once more


def monthly_lists(daily: DataFrame, end: str, qty: str = "total_sales_qty") -> DataFrame:
    """``monthly_totals`` with one row per SKU: quantities ``y`` of its months in order, ``mean_daily``, the mean of their daily means, and ``last_month``.

    A month without rows is a zero that is added to the list, never a row that is sorted or shipped.
    """
    last = date.fromisoformat(end)
    fill = _fill_months((last - date(1970, 1, 1)).days, last.year * 12 + last.month - 1)
    entry = F.struct(F.col("_month").alias("month"), F.col("_qty").alias("qty"))
    lists = (
        _sold_months(daily, end, qty)
        .groupBy("sku")
        .agg(F.min("_sale").alias("_first"), F.collect_list(entry).alias("_m"))
        .where("_first IS NOT NULL")
        .withColumn("_filled", fill("_first", "_m"))
    )
    return lists.select("sku", "_filled.y", "_filled.mean_daily", F.last_day(_day(end)).alias("last_month"))


def weekly_totals(daily: DataFrame, end: str, qty: str = "total_sales_qty") -> DataFrame:
    """Sum per week, labelled by its closing Sunday, from the first sale's week to that of ``end``."""
    d = F.col("sales_date")
    weeks = (
        daily.where(d <= _day(end))
        .groupBy("sku", dt.week_end(d).alias("_week"))
        .agg(F.sum(qty).alias("_qty"), F.max(F.when(F.col(qty) > 0, 1)).alias("_sold"))
    )
    sku = Window.partitionBy("sku")
    return (
        weeks.withColumn("_first", F.min(F.when(F.col("_sold") == 1, F.col("_week"))).over(sku))
        .where(F.col("_week") >= F.col("_first"))
        .withColumn("_next", F.lead("_week").over(sku.orderBy("_week")))
        .withColumn(
            "week_end",
            F.explode(
                F.sequence(
                    F.col("_week"),
                    F.coalesce(F.date_sub("_next", 7), dt.week_end(_day(end))),
                    F.expr("interval 7 days"),
                )
            ),
        )
        .select("sku", "week_end", F.when(F.col("week_end") == F.col("_week"), F.col("_qty")).otherwise(F.lit(0)).alias("qty"))
    )


def model_type(months: Column, mean_daily: Column, min_months: int = 18, low: float = 3.0) -> Column:
    """Forecast route: -1 under two months, 0 for short or slow histories, else 1."""
    return (
        F.when(months < 2, -1).when((months < min_months) | (mean_daily <= low), 0).otherwise(1)
    )


def select_model(monthly: DataFrame, min_months: int = 18, low: float = 3.0) -> DataFrame:
    """Months, mean of monthly daily means, and the route of each SKU."""
    stats = monthly.groupBy("sku").agg(F.count(F.lit(1)).alias("months"), F.avg("daily_mean").alias("mean_daily"))
    return stats.withColumn("model_type", model_type(F.col("months"), F.col("mean_daily"), min_months, low))


FEATURES = ["qty_smooth", "day_of_week", "day_of_month", "week_of_year", "month", "quarter", "year_progress"]


def smooth_weeks(weekly: DataFrame, weeks: int = 4) -> DataFrame:
    """Mean of this week and the ``weeks - 1`` before it, over what there is."""
    back = Window.partitionBy("sku").orderBy("week_end").rowsBetween(1 - weeks, 0)
    return weekly.withColumn("qty_smooth", F.avg("qty").over(back))


def weekly_features(weekly: DataFrame) -> DataFrame:
    """Smoothed weekly quantity and calendar features, each scaled to 0..1 within the SKU.

    ``qty_min`` and ``qty_max`` are kept to turn scaled predictions back.
    """
    sku = Window.partitionBy("sku")
    raw = smooth_weeks(weekly).withColumns(dt.calendar_features(F.col("week_end")))
    scaled = {
        f"{c}_scaled": min_max(
            F.col(c).cast("double"), F.min(c).over(sku).cast("double"), F.max(c).over(sku).cast("double")
        )
        for c in FEATURES
    }
    edges = {"qty_min": F.min("qty_smooth").over(sku), "qty_max": F.max("qty_smooth").over(sku)}
    return raw.withColumns({**scaled, **edges})


def weekly_samples(features: DataFrame, n_in: int = 36, n_out: int = 27) -> DataFrame:
    """Training samples: ``n_in`` weeks of features and the ``n_out`` scaled quantities after them.

    Only full samples are kept, so a SKU with fewer weeks yields none.
    """
    by_week = Window.partitionBy("sku").orderBy("week_end")
    row = F.array(*[F.col(f"{c}_scaled") for c in FEATURES])
    seen = F.collect_list(row).over(by_week.rowsBetween(1 - n_in, 0))
    ahead = F.collect_list(F.col("qty_smooth_scaled")).over(by_week.rowsBetween(1, n_out))
    return (
        features.select("sku", F.col("week_end").alias("sample_end"), seen.alias("inputs"), ahead.alias("targets"))
        .where((F.size("inputs") == n_in) & (F.size("targets") == n_out))
    )
