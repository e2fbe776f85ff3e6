"""Forecast queries: model routes, post-processing, wide and long results, publication."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from merch.operators import forecast as fc
from merch.operators import history as h
from merch.operators import stockout as so
from merch.plans import binding as b
from merch.plans.history_queries import (
    END, FEATURE_SQL, FULL_STOCK_SQL, GRID_SQL, MODEL_SQL, MONTHLY_SQL, START, WALK_SQL, WEEKLY_SQL, WINDOW, daily, history_sql,
)
from merch.plans.query import Query
from merch.session import stage_path, staged
from merch.sources import tables as tb

FIXED = {"alpha": (0.3,), "beta": (0.1,), "phi": (0.9,), "gamma": (0.15,)}
MONTHS = fc.month_labels("2001-12", 7)
AS_OF = "2002-02-28"


def _monthly(spark, sf_dir, sku):
    return h.monthly_totals(h.trim_to_first_sale(daily(spark, sf_dir, sku), END), END)


def _series(spark, sf_dir, sku):
    return fc.monthly_series(h.monthly_lists(h.trim_to_first_sale(daily(spark, sf_dir, sku), END), END))


def ets_sql(sku: str, grid: dict) -> str:
    """CTEs up to ``ets(sku, month_end, forecast)``."""
    return f"{history_sql(MONTHLY_SQL, sku=sku)},\n{smoothing_sql(grid)}"


def smoothing_sql(grid: dict) -> str:
    """CTEs from ``monthly`` to ``ets``: the smoothing recursion over every grid point."""
    season = [(i, *p) for i, p in enumerate(product(grid["alpha"], grid["beta"], grid["phi"], grid["gamma"]))]
    plain = [(i, *p, 0) for i, p in enumerate(product(grid["alpha"], grid["beta"], grid["phi"]))]

    def rows(points):
        return ", ".join(f"({i}, {a}::DOUBLE, {bt}::DOUBLE, {ph}::DOUBLE, {g}::DOUBLE)" for i, a, bt, ph, g in points)

    return f"""series AS (SELECT sku, list(qty::DOUBLE ORDER BY month_end) AS y, count(*) AS n, max(month_end) AS last_month FROM monthly GROUP BY 1),
points AS (SELECT *, TRUE AS seasonal FROM (VALUES {rows(season)}) AS v(pid, alpha, beta, phi, gamma)
           UNION ALL SELECT *, FALSE FROM (VALUES {rows(plain)}) AS v(pid, alpha, beta, phi, gamma)),
starts AS (SELECT sku, y, n, n >= 24 AS seasonal,
    CASE WHEN n >= 24 THEN list_avg(y[1:12]) ELSE y[1] END AS level0,
    CASE WHEN n >= 24 THEN (list_avg(y[13:24]) - list_avg(y[1:12])) / 12 WHEN n > 1 THEN y[2] - y[1] ELSE 0 END AS trend0,
    CASE WHEN n >= 24 THEN list_transform(y[1:12], lambda v: v - list_avg(y[1:12])) ELSE [0::DOUBLE] END AS season0 FROM series),
steps AS (
  SELECT s.sku, s.y, s.n, p.pid, p.alpha, p.beta, p.phi, p.gamma, 0 AS t, s.level0 AS level, s.trend0 AS trend,
         s.season0 AS season, 0::DOUBLE AS sse FROM starts s JOIN points p ON s.seasonal = p.seasonal
  UNION ALL
  SELECT sku, y, n, pid, alpha, beta, phi, gamma, t + 1, level + phi * trend + alpha * e, phi * trend + alpha * beta * e,
         list_transform(season, lambda v, i: CASE WHEN i = t % len(season) + 1 THEN v + gamma * e ELSE v END), sse + e * e
  FROM (SELECT *, y[t + 1] - (level + phi * trend + season[t % len(season) + 1]) AS e FROM steps WHERE t < n)),
best AS (SELECT * FROM steps WHERE t = n QUALIFY row_number() OVER (PARTITION BY sku ORDER BY round(sse, 6), pid) = 1),
bounds AS (SELECT sku, last_month, n, list_count(list_filter(y, lambda v: v > 0)) > 0 AS sold,
    least(list_avg(list_filter(y, lambda v: v > 0)) * 0.8::DOUBLE, list_min(y) * 0.9::DOUBLE) AS low,
    greatest(list_max(y) * 1.3::DOUBLE, list_aggregate(y, 'quantile_cont', 0.75) * 1.6::DOUBLE) AS high FROM series),
raw AS (SELECT sku, k, level + list_sum(list_transform(range(1, k + 1), lambda j: phi ** j)) * trend
               + season[(n + k - 1) % len(season) + 1] AS v
        FROM best, range(1, 7) AS r(k)),
ets AS (SELECT raw.sku, last_day(date_trunc('month', last_month)::DATE + to_months(k::INTEGER)) AS month_end,
        CASE WHEN NOT sold THEN 0 WHEN n < 6 THEN least(greatest(v, low), high) ELSE v END AS forecast
        FROM raw JOIN bounds USING (sku))"""


FLAT_SQL = """flat AS (SELECT sku, last_day(date_trunc('month', last_month)::DATE + to_months(k::INTEGER)) AS month_end, level AS forecast
  FROM (SELECT sku, max(month_end) AS last_month, coalesce(sum(CASE WHEN qty > 0 THEN qty END), 0) AS level,
               count(CASE WHEN qty > 0 THEN 1 END) AS sold FROM monthly GROUP BY 1), range(1, 7) AS r(k) WHERE sold <= 1)"""


def pipeline_daily(spark, sf_dir):
    """Supplier SKUs with long, busy histories and order SKUs of every age, as text keys."""
    lines = b.table(spark, sf_dir, "lineitem")

    def keyed(prefix, column):
        return lines.select(
            F.concat(F.lit(prefix), F.col(column).cast("string")).alias("sku"),
            F.lit(b.PLATFORM).alias("platform"),
            F.col("l_shipdate").cast("date").alias("sales_date"),
            F.col("l_quantity").cast("bigint").alias("sales_qty"),
        )

    both = keyed("S", "l_suppkey").unionByName(keyed("O", "l_orderkey"))
    return h.trim_to_first_sale(h.daily_totals(both, None, START, END), END)


def forecast_pipeline(days, end, horizon: int = 6, grid=None, model=None):
    """Correct, resample, choose a route per SKU, forecast and post-process.

    ``grid`` and ``model`` replace the smoothing grid and the fitted weekly model.

    The corrected days and the monthly series are staged once; the routes are
    filtered branches of them.
    """
    adjusted = so.correct_stockout_sales(days).select("sku", "sales_date", F.col("adjusted_qty").alias("qty"))
    series = staged(fc.monthly_series(h.monthly_lists(adjusted, end, "qty")), "series")
    flat = fc.forecast_flat(series.where("model_type = -1"), horizon)
    ets = fc.forecast_ets(series.where("model_type = 0"), horizon, grid)
    busy = series.where("model_type = 1").select("sku")
    weekly = h.weekly_totals(adjusted.join(busy, "sku", "left_semi"), end, "qty")
    features = staged(h.weekly_features(weekly).select("sku", "week_end", "qty_smooth_scaled", "qty_min", "qty_max"), "features")
    learned = fc.forecast_weekly(features, model) if model else fc.forecast_weekly_ml(features)
    return fc.postprocess_forecast(flat.unionByName(ets).unionByName(learned), series)


def _pipeline(spark, sf_dir):
    return forecast_pipeline(pipeline_daily(spark, sf_dir), END)


def _keyed_sales(spark, sf_dir, sku, kind):
    """Sales of both platforms; the key carries platform and kind of SKU, so that one run serves all."""
    key = F.col("sku") * 4 + kind + F.when(F.col("platform") == "Ebay", 2).otherwise(0)
    return b.sales(spark, sf_dir, sku).withColumn("sku", key.cast("bigint"))


def _keyed_sql(sku, kind):
    return f"SELECT sku * 4 + {kind} + CASE WHEN platform = 'Ebay' THEN 2 ELSE 0 END AS sku, sales_date, sales_qty FROM ({b.sales_sql(sku)})"


def _fixed_pipeline(spark, sf_dir):
    """Supplier SKUs with stock on every day and order SKUs without stock, on both platforms, as published months."""
    lines = _keyed_sales(spark, sf_dir, "supplier", 0)
    stock = b.inventory_of(h.sku_calendar(lines.select("sku").distinct(), START, END))
    stocked = h.daily_totals_all_stock_days(lines, stock, START, END)
    others = h.daily_totals(_keyed_sales(spark, sf_dir, "order", 1), None, START, END)
    days = h.trim_to_first_sale(stocked.unionByName(others.select(*stocked.columns)), END)
    pred = forecast_pipeline(days, END, grid=FIXED, model=COEFFICIENTS)
    long = fc.forecast_long(fc.forecast_wide(pred, MONTHS, drop_last=True))
    platform = F.when(F.col("sku") % 4 >= 2, "Ebay").otherwise("Amazon")
    return long.select(F.floor(F.col("sku") / 4).alias("sku"), (F.col("sku") % 2).alias("kind"), platform.alias("platform"), "model_type", "variable", "value")


def _fixed_pipeline_sql():
    stocked = FULL_STOCK_SQL.replace(b.sales_sql("supplier"), _keyed_sql("supplier", 0))
    return f"""WITH RECURSIVE {stocked}, {WALK_SQL},
daily AS (SELECT sku, sales_date, adjusted AS total_sales_qty, NULL::BIGINT AS total_available_quantity FROM walk
          UNION ALL SELECT sku, sales_date, sum(sales_qty)::DOUBLE, NULL FROM ({_keyed_sql("order", 1)}) WHERE {WINDOW} GROUP BY 1, 2),
{GRID_SQL}, {MONTHLY_SQL}, {MODEL_SQL}, {smoothing_sql(FIXED)}, {FLAT_SQL}, {WEEKLY_SQL}, {FEATURE_SQL}, {model_rows_sql()}, {weekly_forecast_sql()},
routes AS (SELECT sku, month_end, forecast FROM ets JOIN models USING (sku) WHERE model_type = 0
           UNION ALL SELECT sku, month_end, forecast FROM flat JOIN models USING (sku) WHERE model_type = -1
           UNION ALL SELECT sku, month_end, forecast FROM learned JOIN models USING (sku) WHERE model_type = 1),
{processed_sql("routes")},
months AS (SELECT sku, model_type, strftime(date, '%Y-%m') AS month, sum(predicted_qty)::BIGINT AS value FROM processed GROUP BY 1, 2, 3)
SELECT s.sku // 4 AS sku, s.sku % 2 AS kind, CASE WHEN s.sku % 4 >= 2 THEN 'Ebay' ELSE 'Amazon' END AS platform, s.model_type,
       v.month AS variable, m.value FROM (SELECT DISTINCT sku, model_type FROM months) s
CROSS JOIN (VALUES {", ".join(f"('{m}')" for m in MONTHS[:-1])}) AS v(month) LEFT JOIN months m ON m.sku = s.sku AND m.month = v.month"""


def _flat(spark, sf_dir):
    return fc.forecast_flat(_series(spark, sf_dir, "order"))


def _features(spark, sf_dir):
    weekly = h.weekly_totals(h.trim_to_first_sale(daily(spark, sf_dir, "supplier"), END), END)
    return h.weekly_features(weekly)


def _weekly_ml(spark, sf_dir):
    return fc.forecast_weekly_ml(staged(_features(spark, sf_dir), "features"))


def _model_sums(spark, sf_dir):
    sums = fc.weekly_model_sums(_features(spark, sf_dir))
    return sums.unpivot([], sums.columns, "pair", "value")


#: Given coefficients of the weekly model, for a forecast that SQL can repeat.
COEFFICIENTS = dict(zip(["one", *fc.MODEL_INPUTS], (0.02, 0.15, 0.1, 0.25, 0.3, -0.05, 0.2, 0.1, 0.03, -0.04, 0.001)))


def model_rows_sql(h: int = 27) -> str:
    """CTEs from ``features`` to ``samples`` (with label) and ``newest``, both with a row per horizon and all regressors."""
    mean = ", ".join(f"avg(qty_smooth_scaled) OVER (w ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS mean{k}" for k in (4, 13, 36))
    angle = "dayofyear((week_end + 7 * k::INTEGER)::DATE) * (2 * pi() / 365.25::DOUBLE)"
    regressors = f"""1::DOUBLE AS one, last * exp(-k / 6::DOUBLE) AS last_near, mean13 * (1 - exp(-k / 6::DOUBLE)) AS mean_far,
  sin({angle}) AS year_sin, cos({angle}) AS year_cos, k::DOUBLE AS ahead"""
    return f"""levels AS (SELECT sku, week_end, qty_smooth_scaled AS last, {mean},
  max(qty_smooth_scaled) OVER (w ROWS BETWEEN 35 PRECEDING AND CURRENT ROW) AS peak, row_number() OVER w AS n,
  count(*) OVER s AS weeks, min(qty_smooth) OVER s AS low, max(qty_smooth) OVER s AS high
  FROM features WINDOW w AS (PARTITION BY sku ORDER BY week_end), s AS (PARTITION BY sku)),
samples AS (SELECT a.*, {regressors}, label FROM (SELECT a.*, k, b.last AS label FROM levels a CROSS JOIN range(1, {h + 1}) AS r(k)
  JOIN levels b ON b.sku = a.sku AND b.n = a.n + k WHERE a.n >= 36 AND a.n + {h} <= a.weeks) AS a),
newest AS (SELECT a.*, {regressors} FROM (SELECT * FROM levels, range(1, {h + 1}) AS r(k) WHERE n >= 36 AND n = weeks) AS a)"""


def model_sums_sql() -> str:
    names = ["label", "one", *fc.MODEL_INPUTS]
    pairs = [(x, y) for i, x in enumerate(names) for y in names[i:]]
    sums = ", ".join(f"sum({x} * {y}) AS {x}__{y}" for x, y in pairs)
    columns = ", ".join(f"{x}__{y}" for x, y in pairs)
    return f"""{history_sql(WEEKLY_SQL, FEATURE_SQL)}, {model_rows_sql()},
sums AS (SELECT {sums} FROM samples) SELECT pair, value FROM sums UNPIVOT (value FOR pair IN ({columns}))"""


def weekly_forecast_sql() -> str:
    """``learned``: predictions with the given coefficients, after ``newest``."""
    scaled = " + ".join(f"{name} * {weight}::DOUBLE" for name, weight in COEFFICIENTS.items())
    return f"""learned AS (SELECT sku, (week_end + 7 * k::INTEGER)::DATE AS month_end,
  greatest(({scaled}) * (high - low) + low, 0) AS forecast FROM newest)"""


#: Given trees, for a forecast that SQL can repeat.
TREES = [
    (1.0, ("last", 0.4, ("ahead", 9.0, 0.03, -0.02), ("year_sin", 0.0, ("peak", 0.9, 0.01, -0.04), 0.05))),
    (0.15, ("mean36", 0.25, 0.2, ("last_near", 0.125, -0.1, ("year_cos", -0.5, 0.3, -0.25)))),
]


def tree_forecast_sql() -> str:
    """``learned`` as in ``weekly_forecast_sql``, with the given trees added."""
    return weekly_forecast_sql().replace(") * (high - low) + low, 0)", f" + {fc.trees_sql(TREES)}) * (high - low) + low, 0)")


def _split(spark, sf_dir):
    rows = fc.weekly_model_rows(_features(spark, sf_dir))
    return rows.groupBy("sku", "held_back").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("label_sum"))


def _processed(spark, sf_dir):
    monthly = staged(_monthly(spark, sf_dir, "supplier"), "monthly")
    pred = fc.forecast_ets(fc.monthly_series(monthly), grid=FIXED)
    return fc.postprocess_forecast(pred, h.select_model(monthly))


def processed_sql(source):
    """``processed``: faded and rounded whole quantities from ``source(sku, month_end, forecast)``."""
    return f"""processed AS (SELECT sku, month_end AS date, model_type, CAST(CASE WHEN mean_daily <= 5 THEN ceil(v) ELSE round_even(v, 0) END AS BIGINT) AS predicted_qty
  FROM (SELECT sku, month_end, model_type, mean_daily, greatest(forecast, 0)
          * CASE WHEN i = n - 1 THEN 0.95::DOUBLE ELSE i * ((0.95::DOUBLE - 1) / (n - 1)) + 1 END AS v
        FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY month_end) - 1 AS i, count(*) OVER (PARTITION BY sku) AS n FROM {source}) JOIN models USING (sku)))"""


PROCESSED_SQL = f"{ets_sql('supplier', FIXED)}, {MODEL_SQL}, {processed_sql('ets')}"
ROUTES_SQL = f"""{ets_sql('order', FIXED)}, {MODEL_SQL}, {FLAT_SQL},
routes AS (SELECT sku, month_end, forecast FROM ets JOIN models USING (sku) WHERE model_type = 0
           UNION ALL SELECT sku, month_end, forecast FROM flat JOIN models USING (sku) WHERE model_type = -1),
{processed_sql('routes')}"""
WIDE_SQL = f"""{PROCESSED_SQL}, months AS (SELECT sku, model_type, strftime(date, '%Y-%m') AS month, sum(predicted_qty)::BIGINT AS value
  FROM processed GROUP BY 1, 2, 3)"""


def _routes(spark, sf_dir):
    """Young and slow SKUs: flat and smoothed forecasts in one table, post-processed."""
    series = staged(_series(spark, sf_dir, "order"), "series")
    flat = fc.forecast_flat(series.where("model_type = -1"))
    ets = fc.forecast_ets(series.where("model_type = 0"), grid=FIXED)
    return fc.postprocess_forecast(flat.unionByName(ets), series)


def _wide(spark, sf_dir):
    wide = fc.forecast_wide(_processed(spark, sf_dir), MONTHS, drop_last=True)
    return wide.select("sku", "model_type", *[F.col(f"`{m}`").alias("m" + m.replace("-", "_")) for m in MONTHS[:-1]])


def _long(spark, sf_dir):
    return fc.forecast_long(fc.forecast_wide(_processed(spark, sf_dir), MONTHS))


def _published(spark, sf_dir):
    """An earlier run of constant forecasts gives way to the new one after the cut date."""
    new = _processed(spark, sf_dir).select(
        "sku", F.lit(b.PLATFORM).alias("platform"), F.col("date").alias("predict_date"), "predicted_qty", "model_type"
    )
    new = staged(new, "forecast")
    old = new.withColumn("predicted_qty", F.lit(-1).cast("bigint"))
    return fc.forecast_publish(old, new.where(F.col("predict_date") > F.lit(AS_OF).cast("date")), AS_OF)


def _published_twice(spark, sf_dir):
    """A stored table with past and future rows, and SKUs that are not forecast again, published to twice."""
    new = _processed(spark, sf_dir).select(
        "sku", F.lit(b.PLATFORM).alias("platform"), F.col("date").alias("predict_date"), "predicted_qty", "model_type"
    )
    new = staged(new, "forecast")
    earlier = new.withColumns(
        {"predict_date": F.last_day(F.add_months("predict_date", -3)), "predicted_qty": F.lit(-1).cast("bigint")}
    )
    gone = earlier.withColumns({"sku": -F.col("sku"), "platform": F.lit("Ebay")})
    path = stage_path(spark, "published")
    tb.overwrite(earlier.unionByName(gone), path)
    for _ in range(2):
        tb.rewrite(spark, path, lambda old: fc.forecast_publish(old, new, END))
    return spark.read.parquet(path)


QUERIES = {
    "forecast_flat": Query(
        _flat, "sku:l date:s forecast:d4",
        f"{history_sql(MONTHLY_SQL, FLAT_SQL, sku='order')} SELECT sku, month_end AS date, forecast FROM flat",
    ),
    "forecast_ets": Query(
        lambda s, d: fc.forecast_ets(_series(s, d, "supplier")), "sku:l date:s forecast:d4",
        f"{ets_sql('supplier', fc.GRID)} SELECT sku, month_end AS date, forecast FROM ets",
    ),
    "forecast_ets_fixed_parameters": Query(
        lambda s, d: fc.forecast_ets(_series(s, d, "order"), grid=FIXED), "sku:l date:s forecast:d4",
        f"{ets_sql('order', FIXED)} SELECT sku, month_end AS date, forecast FROM ets",
    ),
    "forecast_weekly_ml": Query(_weekly_ml, "sku:l date:s forecast:d3"),
    "weekly_model_sums": Query(_model_sums, "pair:s value:d4", model_sums_sql()),
    "forecast_weekly_fixed_coefficients": Query(
        lambda s, d: fc.forecast_weekly(_features(s, d), COEFFICIENTS), "sku:l date:s forecast:d4",
        f"""{history_sql(WEEKLY_SQL, FEATURE_SQL)}, {model_rows_sql()}, {weekly_forecast_sql()}
            SELECT sku, month_end AS date, forecast FROM learned""",
    ),
    "weekly_model_split": Query(
        _split, "sku:l held_back:b n_rows:l label_sum:d4",
        f"""{history_sql(WEEKLY_SQL, FEATURE_SQL)}, {model_rows_sql()}
            SELECT sku, ('0x' || substr(md5(sku::VARCHAR), 1, 8))::BIGINT % {fc.VALIDATION} = 0 AS held_back, count(*) AS n_rows, sum(label) AS label_sum
            FROM samples GROUP BY 1, 2""",
    ),
    "forecast_weekly_boosted": Query(
        lambda s, d: fc.forecast_weekly_boosted(staged(_features(s, d), "features")), "sku:l date:s forecast:d3"
    ),
    "forecast_weekly_fixed_trees": Query(
        lambda s, d: fc.forecast_weekly(_features(s, d), COEFFICIENTS, trees=TREES), "sku:l date:s forecast:d4",
        f"""{history_sql(WEEKLY_SQL, FEATURE_SQL)}, {model_rows_sql()}, {tree_forecast_sql()}
            SELECT sku, month_end AS date, forecast FROM learned""",
    ),
    "postprocess_forecast": Query(
        _processed, "sku:l date:s predicted_qty:l model_type:l", f"{PROCESSED_SQL} SELECT * FROM processed"
    ),
    "forecast_routes": Query(
        _routes, "sku:l date:s predicted_qty:l model_type:l", f"{ROUTES_SQL} SELECT * FROM processed"
    ),
    "forecast_by_month": Query(
        lambda s, d: fc.forecast_months(_processed(s, d)), "sku:l model_type:l month:s value:l", f"{WIDE_SQL} SELECT * FROM months"
    ),
    "forecast_wide": Query(
        _wide,
        "sku:l model_type:l " + " ".join("m" + m.replace("-", "_") + ":d0" for m in MONTHS[:-1]),
        f"{WIDE_SQL} SELECT sku, model_type, "
        + ", ".join(f"sum(CASE WHEN month = '{m}' THEN value END) AS m{m.replace('-', '_')}" for m in MONTHS[:-1])
        + " FROM months GROUP BY 1, 2",
    ),
    "forecast_long": Query(
        _long,
        "sku:l model_type:l variable:s value:d0",
        f"""{WIDE_SQL} SELECT s.sku, s.model_type, v.month AS variable, m.value FROM (SELECT DISTINCT sku, model_type FROM months) s
            CROSS JOIN (VALUES {", ".join(f"('{m}')" for m in MONTHS)}) AS v(month)
            LEFT JOIN months m ON m.sku = s.sku AND m.month = v.month""",
    ),
    "forecast_publish": Query(
        _published,
        "sku:l platform:s predict_date:s predicted_qty:l model_type:l",
        f"""{PROCESSED_SQL} SELECT sku, '{b.PLATFORM}' AS platform, date AS predict_date, model_type,
            CASE WHEN date <= DATE '{AS_OF}' THEN -1 ELSE predicted_qty END AS predicted_qty FROM processed""",
    ),
    "forecast_publish_rerun": Query(
        _published_twice,
        "sku:l platform:s predict_date:s predicted_qty:l model_type:l",
        f"""{PROCESSED_SQL}, earlier AS (SELECT sign * sku AS sku, platform, last_day((date - INTERVAL 3 MONTH)::DATE) AS predict_date,
            -1 AS predicted_qty, model_type FROM processed CROSS JOIN (VALUES (1, '{b.PLATFORM}'), (-1, 'Ebay')) AS v(sign, platform))
            SELECT * FROM earlier WHERE predict_date <= DATE '{END}'
            UNION ALL SELECT sku, '{b.PLATFORM}', date, predicted_qty, model_type FROM processed""",
    ),
    "forecast_pipeline_fixed": Query(
        _fixed_pipeline, "sku:l kind:l platform:s model_type:l variable:s value:d0", _fixed_pipeline_sql()
    ),
    "forecast_pipeline": Query(_pipeline, "sku:s date:s predicted_qty:l model_type:l"),
}
