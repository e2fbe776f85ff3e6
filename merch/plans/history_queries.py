"""Sales history queries: daily grids, stock-out correction, resampling, features."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from merch.functions import dates as dt
from merch.functions import numbers as num
from merch.operators import history as h
from merch.operators import stockout as so
from merch.plans import binding as b
from merch.plans.query import Query
from merch.session import staged

START, END = "1995-01-01", "2001-11-30"
WINDOW = f"sales_date BETWEEN DATE '{START}' AND DATE '{END}'"


def daily(spark, sf_dir, sku="supplier", platform=None):
    lines = b.sales(spark, sf_dir, sku)
    return h.daily_totals(lines, b.inventory_of(lines), START, END, platform)


def daily_sql(sku="supplier", platform=None):
    """CTEs ``lines`` and ``daily``."""
    only = f" AND platform = '{platform}'" if platform else ""
    return f"""lines AS ({b.sales_sql(sku)}),
stock AS (SELECT sku, sales_date, {b.STOCK_SQL} AS total_available_quantity
          FROM (SELECT DISTINCT sku, sales_date, sales_date - DATE '1970-01-01' AS day FROM lines)),
sold AS (SELECT sku, sales_date, sum(sales_qty)::BIGINT AS total_sales_qty FROM lines
         WHERE {WINDOW}{only} GROUP BY 1, 2),
daily AS (SELECT sold.*, total_available_quantity FROM sold LEFT JOIN stock USING (sku, sales_date))"""


GRID_SQL = f"""grid AS (SELECT sku, d::DATE AS sales_date FROM (SELECT DISTINCT sku FROM daily),
  generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY) AS g(d)),
filled AS (SELECT sku, sales_date, coalesce(total_sales_qty, 0) AS total_sales_qty, total_available_quantity,
                  total_available_quantity IS NULL AS inventory_missing
           FROM grid LEFT JOIN daily USING (sku, sales_date)),
trimmed AS (SELECT * FROM (SELECT *, min(CASE WHEN total_sales_qty > 0 THEN sales_date END) OVER (PARTITION BY sku) AS first_sale
                           FROM filled) WHERE sales_date >= first_sale)"""

MONTHLY_SQL = """monthly AS (SELECT sku, last_day(sales_date) AS month_end, sum(total_sales_qty) AS qty, count(*) AS days,
                   avg(total_sales_qty) AS daily_mean FROM trimmed GROUP BY 1, 2)"""

MODEL_SQL = """models AS (SELECT sku, count(*) AS months, avg(daily_mean) AS mean_daily,
  CASE WHEN count(*) < 2 THEN -1 WHEN count(*) < 18 OR avg(daily_mean) <= 3 THEN 0 ELSE 1 END AS model_type
  FROM monthly GROUP BY 1)"""

WEEKLY_SQL = """weekly AS (SELECT sku, (sales_date + (7 - isodow(sales_date))::INTEGER)::DATE AS week_end,
                  sum(total_sales_qty) AS qty FROM trimmed GROUP BY 1, 2)"""

FEATURE_SQL = """smooth AS (SELECT sku, week_end, qty, avg(qty) OVER (PARTITION BY sku ORDER BY week_end
       ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS qty_smooth,
  isodow(week_end) - 1 AS day_of_week, day(week_end) AS day_of_month, weekofyear(week_end) AS week_of_year,
  month(week_end) AS month, quarter(week_end) AS quarter, dayofyear(week_end) / 365.0::DOUBLE AS year_progress FROM weekly),
features AS (SELECT *, """ + ", ".join(
    f"CASE WHEN max({c}) OVER w > min({c}) OVER w THEN ({c} - min({c}) OVER w)::DOUBLE / (max({c}) OVER w - min({c}) OVER w) ELSE 0 END AS {c}_scaled"
    for c in h.FEATURES
) + " FROM smooth WINDOW w AS (PARTITION BY sku))"


def history_sql(*parts, sku="supplier", platform=None):
    return "WITH RECURSIVE " + ", ".join([daily_sql(sku, platform), GRID_SQL, *parts])


def _monthly(spark, sf_dir, sku="supplier"):
    days = h.trim_to_first_sale(daily(spark, sf_dir, sku), END)
    return h.monthly_totals(days, END)


def _weekly(spark, sf_dir):
    return h.weekly_totals(h.trim_to_first_sale(daily(spark, sf_dir), END), END)


def _samples(spark, sf_dir):
    """Samples reduced to a few readable numbers of each."""
    samples = h.weekly_samples(h.weekly_features(_weekly(spark, sf_dir)))
    qty = F.transform("inputs", lambda r: F.get(r, F.lit(0)))
    return samples.select(
        "sku",
        "sample_end",
        F.get(qty, F.lit(0)).alias("first_in"),
        F.element_at(qty, -1).alias("last_in"),
        num.list_sum(qty).alias("sum_in"),
        F.get("targets", F.lit(0)).alias("first_out"),
        num.list_sum(F.col("targets")).alias("sum_out"),
    )


def _written(sku, way):
    """The text ``Éfi-<sku>x`` written in one of six ways: plain, decomposed, full width, with a ligature, shouted, with spaces."""
    digits = sku.cast("string")
    wide = F.translate(digits, "0123456789", "０１２３４５６７８９")
    ways = [
        F.concat(F.lit("Éfi-"), digits, F.lit("X")), F.concat(F.lit("e\u0301fi-"), digits, F.lit("x")), F.concat(F.lit("ｅｆｉ-"), wide, F.lit("ｘ")),
        F.concat(F.lit("E\ufb01-"), digits, F.lit("x")), F.concat(F.lit("EFI-"), digits, F.lit("X")), F.concat(F.lit("  éﬁ-"), digits, F.lit("x ")),
    ]
    return F.element_at(F.array(*ways), (F.pmod(way, F.lit(len(ways))) + 1).cast("int"))


def _sku_text_join(spark, sf_dir):
    """The same SKU written differently on both sides, and within each, meets under one name."""
    lines = b.sales(spark, sf_dir, "supplier")
    day = F.unix_date("sales_date")
    sold = lines.withColumn("sku", h.fix_case_mark(_written(F.col("sku"), day)))
    stock = b.inventory_of(lines).withColumn("sku", _written(F.col("sku"), F.unix_date("date") + 2))
    names = staged(h.sku_names(sold.select("sku"), stock.select("sku")), "names")
    days = h.daily_totals(h.with_sku_name(sold, names), h.with_sku_name(stock, names), START, END, b.PLATFORM)
    return days.withColumn("sku", F.regexp_extract(F.translate("sku", "０１２３４５６７８９", "0123456789"), r"(\d+)", 1).cast("bigint"))


def _reindexed(spark, sf_dir):
    """Calendar grid left-joined to the daily facts, gaps filled with 0."""
    facts = daily(spark, sf_dir, platform=b.PLATFORM).select("sku", "sales_date", "total_sales_qty")
    grid = h.sku_calendar(facts.select("sku").distinct(), START, END)
    return grid.join(facts, ["sku", "sales_date"], "left").select(
        "sku", "sales_date", F.coalesce("total_sales_qty", F.lit(0)).alias("total_sales_qty")
    )


def dense_lines(spark, sf_dir):
    """Sales of product lines busy enough for two weeks of stock readings."""
    return b.table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % 25).alias("sku"),
        F.lit(b.PLATFORM).alias("platform"),
        F.col("l_shipdate").cast("date").alias("sales_date"),
        F.when(F.day("l_shipdate") % 9 == 0, 1).otherwise(F.col("l_quantity")).cast("bigint").alias("sales_qty"),
    )


DENSE_SQL = f"""lines AS (SELECT l_partkey % 25 AS sku, l_shipdate::DATE AS sales_date,
    CASE WHEN day(l_shipdate) % 9 = 0 THEN 1 ELSE l_quantity::BIGINT END AS sales_qty FROM lineitem),
sold AS (SELECT sku, sales_date, sum(sales_qty)::BIGINT AS total_sales_qty FROM lines WHERE {WINDOW} GROUP BY 1, 2),
days AS (SELECT *, {b.STOCK_SQL} AS total_available_quantity
         FROM (SELECT *, sales_date - DATE '1970-01-01' AS day FROM sold))"""

FULL_STOCK_SQL = f"""lines AS ({b.sales_sql("supplier")}),
sold AS (SELECT sku, sales_date, sum(sales_qty)::BIGINT AS qty FROM lines WHERE {WINDOW} GROUP BY 1, 2),
cal AS (SELECT sku, d::DATE AS sales_date, d::DATE - DATE '1970-01-01' AS day FROM (SELECT DISTINCT sku FROM lines),
        generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY) AS g(d)),
every_day AS (SELECT sku, sales_date, day, coalesce(qty, 0) AS total_sales_qty, {b.STOCK_SQL} AS total_available_quantity
         FROM cal LEFT JOIN sold USING (sku, sales_date)),
days AS (SELECT * EXCLUDE (first_sale) FROM (SELECT *, min(CASE WHEN total_sales_qty > 0 THEN day END) OVER (PARTITION BY sku) AS first_sale
         FROM every_day) WHERE day >= first_sale)"""

WALK_SQL = """marked AS (
  SELECT sku, sales_date, day, total_sales_qty::DOUBLE AS qty, row_number() OVER (PARTITION BY sku ORDER BY day) AS rn,
         coalesce(total_available_quantity IS NOT NULL AND day - min(day) OVER (PARTITION BY sku) >= 14
                  AND count(CASE WHEN total_available_quantity > 0 THEN 1 END) OVER prev >= 7
                  AND total_available_quantity < 0.3::DOUBLE * avg(CASE WHEN total_available_quantity > 0 THEN total_available_quantity END) OVER prev,
                  FALSE) AS low
  FROM days WINDOW prev AS (PARTITION BY sku ORDER BY day RANGE BETWEEN 14 PRECEDING AND 1 PRECEDING)),
walk AS (
  SELECT sku, rn, sales_date, day, qty, low, qty AS adjusted, [{'d': day, 'q': qty}] AS recent FROM marked WHERE rn = 1
  UNION ALL
  SELECT sku, rn, sales_date, day, qty, low, adjusted, list_append(kept, {'d': day, 'q': adjusted}) FROM (
    SELECT *, CASE WHEN low AND len(sold) > 0 AND (list_sum(sold) / 14 - qty) / (list_sum(sold) / 14) > 0.5
      THEN CASE WHEN len(sold) = 1 THEN sold[1] ELSE
        list_sum(list_transform(sold, lambda q, i: q * (0.5::DOUBLE + 0.5::DOUBLE / (len(sold) - 1) * (i - 1))))
        / list_sum(list_transform(sold, lambda q, i: 0.5::DOUBLE + 0.5::DOUBLE / (len(sold) - 1) * (i - 1))) END
      ELSE qty END AS adjusted FROM (
      SELECT *, list_transform(list_filter(kept, lambda e: e.q > 0), lambda e: e.q) AS sold FROM (
        SELECT m.sku, m.rn, m.sales_date, m.day, m.qty, m.low, list_filter(w.recent, lambda e: e.d >= m.day - 14) AS kept
        FROM walk w JOIN marked m ON m.sku = w.sku AND m.rn = w.rn + 1))))"""

CORRECTED = "sku:l sales_date:s total_sales_qty:l low_stock:b adjusted_qty:d6"
CORRECTED_SQL = "SELECT sku, sales_date, qty AS total_sales_qty, low AS low_stock, adjusted AS adjusted_qty FROM walk"


def _corrected(spark, sf_dir):
    lines = dense_lines(spark, sf_dir)
    days = h.daily_totals(lines, b.inventory_of(lines), START, END)
    return so.correct_stockout_sales(h.trim_to_first_sale(days, END))


def _corrected_all_days(spark, sf_dir):
    lines = b.sales(spark, sf_dir, "supplier")
    stock = b.inventory_of(h.sku_calendar(lines.select("sku").distinct(), START, END))
    days = h.daily_totals_all_stock_days(lines, stock, START, END)
    return so.correct_stockout_sales(h.trim_to_first_sale(days, END))


def _previous_stats(spark, sf_dir):
    lines = dense_lines(spark, sf_dir)
    days = h.trim_to_first_sale(h.daily_totals(lines, b.inventory_of(lines), START, END), END)
    marked = so.mark_low_stock(days)
    return marked.withColumn("sales_mean", so.previous_mean(F.col("total_sales_qty")))


def _recency_mean(spark, sf_dir):
    """Weighted mean of each SKU's positive months, newest weighted most."""
    months = _monthly(spark, sf_dir, "part").groupBy("sku").agg(
        F.array_sort(F.collect_list(F.struct("month_end", F.col("qty").cast("double").alias("qty")))).alias("m")
    )
    sold = F.transform(F.filter("m", lambda e: e["qty"] > 0), lambda e: e["qty"])
    return months.select("sku", num.weighted_mean(sold).alias("recent_mean"))


def _quantiles(spark, sf_dir):
    qty = F.col("qty")
    return _monthly(spark, sf_dir, "part").groupBy("sku").agg(
        F.percentile(qty, F.lit(0.75)).alias("q75"),
        F.max(qty).alias("top"),
        F.min(qty).alias("low"),
        F.avg(F.when(qty > 0, qty)).alias("sold_mean"),
    )


def _first_per_key(spark, sf_dir):
    return b.sales(spark, sf_dir, "part").groupBy("sku").agg(
        F.min_by("platform", F.struct("sales_date", "platform")).alias("platform"), F.min("sales_date").alias("first_day")
    )


def _missing_flags(spark, sf_dir):
    d = daily(spark, sf_dir)
    return d.select(
        "sku", "sales_date",
        F.col("total_available_quantity").isNull().alias("inventory_missing"),
        F.coalesce("total_available_quantity", F.lit(0)).alias("stock_or_zero"),
    )


def _minmax_fit(spark, sf_dir):
    return _monthly(spark, sf_dir).groupBy("sku").agg(F.min("qty").alias("low"), F.max("qty").alias("high"))


def _minmax_round_trip(spark, sf_dir):
    sku = Window.partitionBy("sku")
    m = _monthly(spark, sf_dir).withColumns({"low": F.min("qty").over(sku), "high": F.max("qty").over(sku)})
    m = m.withColumn("scaled", num.min_max(F.col("qty").cast("double"), F.col("low"), F.col("high")))
    return m.withColumn("back", num.min_max_inverse(F.col("scaled"), F.col("low"), F.col("high")))


def _clipped(spark, sf_dir):
    sku = Window.partitionBy("sku")
    m = _monthly(spark, sf_dir)
    mean = F.avg("qty").over(sku)
    return m.withColumn("clipped", num.clip(F.col("qty").cast("double"), mean * 0.8, mean * 1.3))


def _decay(spark, sf_dir):
    w = Window.partitionBy("sku")
    place = F.row_number().over(w.orderBy("month_end")) - 1
    return _monthly(spark, sf_dir).withColumn("decay", num.line_weight(place, F.count(F.lit(1)).over(w), 1.0, 0.95))


def _calendar(spark, sf_dir):
    """Date functions over every order day."""
    d = F.col("o_orderdate").cast("date")
    days = b.table(spark, sf_dir, "orders").select("o_orderkey", d.alias("d"))
    x = F.col("d")
    return days.select(
        "o_orderkey",
        x.alias("day"),
        dt.week_end(x).alias("week_end"),
        dt.month_end(x).alias("month_end"),
        dt.previous_month_end(x).alias("previous_month_end"),
        dt.year_before(x).alias("year_before"),
        dt.yesterday(x).alias("yesterday"),
        dt.year_month(x).alias("year_month"),
        dt.parse_day(F.date_format(x, "yyyy-MM-dd")).alias("parsed"),
        F.concat_ws(",", F.transform(dt.next_month_ends(x, 6), lambda v: v.cast("string"))).alias("next_months"),
        F.element_at(dt.next_sundays(dt.week_end(x), 27), -1).alias("sunday_27"),
        *[v.alias(k) for k, v in dt.calendar_features(x).items()],
    )


QUERIES = {
    "daily_totals": Query(
        lambda s, d: daily(s, d, platform=b.PLATFORM),
        "sku:l sales_date:s total_sales_qty:l total_available_quantity:d0",
        f"WITH {daily_sql(platform=b.PLATFORM)} SELECT * FROM daily",
    ),
    "sku_text_join": Query(
        _sku_text_join,
        "sku:l sales_date:s total_sales_qty:l total_available_quantity:d0",
        f"WITH {daily_sql(platform=b.PLATFORM)} SELECT * FROM daily",
    ),
    "inventory_flags": Query(
        _missing_flags,
        "sku:l sales_date:s inventory_missing:b stock_or_zero:l",
        f"WITH {daily_sql()} SELECT sku, sales_date, total_available_quantity IS NULL AS inventory_missing, coalesce(total_available_quantity, 0) AS stock_or_zero FROM daily",
    ),
    "distinct_skus": Query(
        lambda s, d: b.sales(s, d).select("sku").distinct(), "sku:l", f"SELECT DISTINCT sku FROM ({b.sales_sql()})"
    ),
    "first_row_per_sku": Query(
        _first_per_key,
        "sku:l platform:s first_day:s",
        f"""SELECT sku, platform, sales_date AS first_day FROM ({b.sales_sql()})
            QUALIFY row_number() OVER (PARTITION BY sku ORDER BY sales_date, platform) = 1""",
    ),
    "sku_calendar": Query(
        lambda s, d: h.sku_calendar(b.sales(s, d, "supplier").select("sku").distinct(), START, END),
        "sku:l sales_date:s",
        f"WITH {daily_sql()}, {GRID_SQL} SELECT * FROM grid",
    ),
    "reindexed_sales": Query(
        _reindexed, "sku:l sales_date:s total_sales_qty:l", f"{history_sql(platform=b.PLATFORM)} SELECT * FROM filled"
    ),
    "densify_daily": Query(
        lambda s, d: h.fill_days(daily(s, d, platform=b.PLATFORM), START, END),
        "sku:l sales_date:s total_sales_qty:l total_available_quantity:d0 inventory_missing:b",
        f"{history_sql(platform=b.PLATFORM)} SELECT * FROM filled",
    ),
    "trim_to_first_sale": Query(
        lambda s, d: h.trim_to_first_sale(h.fill_days(daily(s, d, platform=b.PLATFORM), START, END), END),
        "sku:l sales_date:s total_sales_qty:l",
        f"{history_sql(platform=b.PLATFORM)} SELECT * FROM trimmed",
    ),
    "previous_14_day_stats": Query(
        _previous_stats,
        "sku:l sales_date:s sales_mean:d6 stock_days:l stock_mean:d6",
        f"""WITH {DENSE_SQL} SELECT sku, sales_date, coalesce(sum(total_sales_qty) OVER prev, 0) / 14.0::DOUBLE AS sales_mean,
            count(CASE WHEN total_available_quantity > 0 THEN 1 END) OVER prev AS stock_days,
            avg(CASE WHEN total_available_quantity > 0 THEN total_available_quantity END) OVER prev AS stock_mean
            FROM days WINDOW prev AS (PARTITION BY sku ORDER BY day RANGE BETWEEN 14 PRECEDING AND 1 PRECEDING)""",
    ),
    "correct_stockout_sales": Query(
        _corrected, CORRECTED, f"WITH RECURSIVE {DENSE_SQL}, {WALK_SQL} {CORRECTED_SQL}"
    ),
    "correct_stockout_all_stock_days": Query(
        _corrected_all_days, CORRECTED, f"WITH RECURSIVE {FULL_STOCK_SQL}, {WALK_SQL} {CORRECTED_SQL}"
    ),
    "monthly_totals": Query(
        lambda s, d: _monthly(s, d, "part"),
        "sku:l month_end:s qty:l days:l daily_mean:d8",
        f"{history_sql(MONTHLY_SQL, sku='part')} SELECT * FROM monthly",
    ),
    "select_model": Query(
        lambda s, d: h.select_model(_monthly(s, d, "part")),
        "sku:l months:l mean_daily:d8 model_type:l",
        f"{history_sql(MONTHLY_SQL, MODEL_SQL, sku='part')} SELECT * FROM models",
    ),
    "weekly_totals": Query(
        _weekly, "sku:l week_end:s qty:l", f"{history_sql(WEEKLY_SQL)} SELECT * FROM weekly"
    ),
    "smooth_weeks": Query(
        lambda s, d: h.smooth_weeks(_weekly(s, d)),
        "sku:l week_end:s qty:l qty_smooth:d6",
        f"{history_sql(WEEKLY_SQL, FEATURE_SQL)} SELECT * FROM smooth",
    ),
    "weekly_features": Query(
        lambda s, d: h.weekly_features(_weekly(s, d)),
        "sku:l week_end:s " + " ".join(f"{c}_scaled:d8" for c in h.FEATURES),
        f"{history_sql(WEEKLY_SQL, FEATURE_SQL)} SELECT * FROM features",
    ),
    "weekly_samples": Query(
        _samples,
        "sku:l sample_end:s first_in:d8 last_in:d8 sum_in:d6 first_out:d8 sum_out:d6",
        f"""{history_sql(WEEKLY_SQL, FEATURE_SQL)} SELECT * FROM (
            SELECT sku, week_end AS sample_end, first_value(qty_smooth_scaled) OVER seen AS first_in, qty_smooth_scaled AS last_in,
                   sum(qty_smooth_scaled) OVER seen AS sum_in, count(*) OVER seen AS n_in,
                   first_value(qty_smooth_scaled) OVER ahead AS first_out, sum(qty_smooth_scaled) OVER ahead AS sum_out,
                   count(*) OVER ahead AS n_out FROM features
            WINDOW seen AS (PARTITION BY sku ORDER BY week_end ROWS BETWEEN 35 PRECEDING AND CURRENT ROW),
                   ahead AS (PARTITION BY sku ORDER BY week_end ROWS BETWEEN 1 FOLLOWING AND 27 FOLLOWING))
            WHERE n_in = 36 AND n_out = 27""",
    ),
    "recency_weighted_mean": Query(
        _recency_mean,
        "sku:l recent_mean:d6",
        f"""{history_sql(MONTHLY_SQL, sku='part')}, sold_months AS (
            SELECT sku, qty, row_number() OVER (PARTITION BY sku ORDER BY month_end) - 1 AS i, count(*) OVER (PARTITION BY sku) AS n
            FROM monthly WHERE qty > 0),
            weighted AS (SELECT *, CASE WHEN n = 1 THEN 0.5::DOUBLE ELSE 0.5::DOUBLE + 0.5::DOUBLE / (n - 1) * i END AS w FROM sold_months)
            SELECT sku, sum(w * qty) / sum(w) AS recent_mean FROM weighted GROUP BY 1""",
    ),
    "month_quantiles": Query(
        _quantiles,
        "sku:l q75:d6 top:l low:l sold_mean:d6",
        f"""{history_sql(MONTHLY_SQL, sku='part')} SELECT sku, quantile_cont(qty::DOUBLE, 0.75) AS q75, max(qty) AS top, min(qty) AS low,
            avg(CASE WHEN qty > 0 THEN qty END) AS sold_mean FROM monthly GROUP BY 1""",
    ),
    "min_max_fit": Query(
        _minmax_fit,
        "sku:l low:l high:l",
        f"{history_sql(MONTHLY_SQL)} SELECT sku, min(qty) AS low, max(qty) AS high FROM monthly GROUP BY 1",
    ),
    "min_max_round_trip": Query(
        _minmax_round_trip,
        "sku:l month_end:s scaled:d8 back:d6",
        f"""{history_sql(MONTHLY_SQL)} SELECT sku, month_end, (qty - min(qty) OVER w)::DOUBLE / (max(qty) OVER w - min(qty) OVER w) AS scaled,
            qty AS back FROM monthly WINDOW w AS (PARTITION BY sku)""",
    ),
    "clip_to_bounds": Query(
        _clipped,
        "sku:l month_end:s clipped:d6",
        f"""{history_sql(MONTHLY_SQL)} SELECT sku, month_end,
            least(greatest(qty::DOUBLE, avg(qty) OVER w * 0.8::DOUBLE), avg(qty) OVER w * 1.3::DOUBLE) AS clipped
            FROM monthly WINDOW w AS (PARTITION BY sku)""",
    ),
    "position_decay": Query(
        _decay,
        "sku:l month_end:s decay:d10",
        f"""{history_sql(MONTHLY_SQL)} SELECT sku, month_end,
            1 - 0.05::DOUBLE * (row_number() OVER (PARTITION BY sku ORDER BY month_end) - 1) / (count(*) OVER (PARTITION BY sku) - 1) AS decay
            FROM monthly""",
    ),
    "calendar_functions": Query(
        _calendar,
        "o_orderkey:l day:s week_end:s month_end:s previous_month_end:s year_before:s yesterday:s year_month:s parsed:s "
        "next_months:s sunday_27:s day_of_week:l day_of_month:l week_of_year:l month:l quarter:l year_progress:d8",
        """SELECT o_orderkey, d AS day, (d + (7 - isodow(d))::INTEGER)::DATE AS week_end, last_day(d) AS month_end,
            (date_trunc('month', d)::DATE - 1)::DATE AS previous_month_end, (d - INTERVAL 1 YEAR)::DATE AS year_before,
            (d - 1)::DATE AS yesterday, strftime(d, '%Y-%m') AS year_month, d AS parsed,
            array_to_string(list_transform(range(1, 7), lambda k: last_day(date_trunc('month', d)::DATE + to_months(k::INTEGER))::VARCHAR), ',') AS next_months,
            (d + (7 - isodow(d))::INTEGER + 27 * 7)::DATE AS sunday_27, isodow(d) - 1 AS day_of_week, day(d) AS day_of_month,
            weekofyear(d) AS week_of_year, month(d) AS month, quarter(d) AS quarter, dayofyear(d) / 365.0::DOUBLE AS year_progress
            FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""",
    ),
}
