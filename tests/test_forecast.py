import hashlib
from datetime import date, timedelta
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from merch.operators import boosting
from merch.operators import forecast as fc
from merch.operators import history as h
from merch.session import staged


def series(spark, histories):
    rows = [(sku, [float(x) for x in y], date(2024, 6, 30)) for sku, y in histories.items()]
    return spark.createDataFrame(rows, "sku string, y array<double>, last_month date")


def forecasts(df):
    out = {}
    for r in df.orderBy("sku", "date").collect():
        out.setdefault(r["sku"], []).append(r["forecast"])
    return out


def smooth_by_hand(y, h_out, grid):
    """Plain loop over the grid for one history."""
    seasonal = len(y) >= 24
    best = None
    for alpha, beta, phi, gamma in product(grid["alpha"], grid["beta"], grid["phi"], grid["gamma"] if seasonal else (0.0,)):
        if seasonal:
            level, trend = np.mean(y[:12]), (np.mean(y[12:24]) - np.mean(y[:12])) / 12
            season = [v - level for v in y[:12]]
        else:
            level, trend, season = y[0], y[1] - y[0] if len(y) > 1 else 0.0, [0.0]
        sse = 0.0
        for t, value in enumerate(y):
            k = t % len(season)
            error = value - (level + phi * trend + season[k])
            sse += error**2
            level, trend = level + phi * trend + alpha * error, phi * trend + alpha * beta * error
            season[k] += gamma * error
        ahead = [
            level + sum(phi**j for j in range(1, k + 1)) * trend + season[(len(y) + k - 1) % len(season)]
            for k in range(1, h_out + 1)
        ]
        if best is None or round(sse, 6) < best[0]:
            best = (round(sse, 6), ahead)
    return best[1]


def test_monthly_lists_hold_the_months_without_a_row_each(spark):
    """The same series as from a row per month, also with odd days, and no row per month in the plan."""
    days = [("a", "2023-11-20", 3), ("a", "2024-02-03", 5), ("a", "2024-02-04", -2), ("b", "2024-05-30", 1), ("c", "2024-01-01", 0), ("c", "2024-03-09", 7),
            ("d", "2024-01-01", 0), (None, "2024-04-30", 4), ("e", "2024-07-01", 9), ("e", "2024-01-31", 2), ("f", "2024-01-31", 2), ("f", "2024-02-28", None), ("g", None, 2)]
    frame = spark.createDataFrame([(s, date.fromisoformat(d) if d else None, q) for s, d, q in days], "sku string, sales_date date, total_sales_qty long")
    lists = h.monthly_lists(frame, "2024-05-30")
    got, want = (sorted(map(str, fc.monthly_series(m).collect())) for m in (lists, h.monthly_totals(frame, "2024-05-30")))
    assert got == want and len(got) == 6
    assert "Generate" not in lists._jdf.queryExecution().toString()


def test_smoothing_equals_a_plain_loop(spark):
    rng = np.random.default_rng(5)
    histories = {f"s{n}": rng.integers(0, 40, n).tolist() for n in (6, 7, 17, 18, 23, 24, 30, 60)}
    got = forecasts(fc.forecast_ets(series(spark, histories)))
    for sku, y in histories.items():
        assert got[sku] == pytest.approx(smooth_by_hand(y, 6, fc.GRID), abs=1e-6)


def test_few_grid_points_are_smoothed_for_series_of_few_sales(monkeypatch):
    """Series of few sales are smoothed for the points that may be their best alone, and get the forecasts of the whole grid, bit by bit."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(4000):
        y = np.zeros(rng.integers(1, 60))
        sold = rng.integers(0, len(y), rng.integers(0, 6))
        y[sold] = rng.integers(-1, 50, len(sold)) if i % 4 else rng.normal(0, 1, len(sold)) * 10.0 ** rng.integers(-5, 6)
        rows.append(y)
    rows += [rng.integers(0, 40, 50).astype(float), np.array([1.0, np.nan, 2.0])]
    values, lengths = np.concatenate(rows), np.array([len(y) for y in rows])
    pairs, smooth = [], fc._smooth
    monkeypatch.setattr(fc, "_smooth", lambda y, row, point, points, h: pairs.append(len(row)) or smooth(y, row, point, points, h))
    got = fc._smooth_lists(values, lengths, fc.GRID, 6)
    few = sum(pairs)
    monkeypatch.setattr(fc, "PAIRS", 0)
    assert np.array_equal(got, fc._smooth_lists(values, lengths, fc.GRID, 6), equal_nan=True)
    assert few < 40 * len(rows) < (sum(pairs) - few) / 2
    for i in (1, 2, 3, 4000):
        assert got[i] == pytest.approx(smooth_by_hand(rows[i].tolist(), 6, fc.GRID), abs=1e-6)


def test_short_history_stays_in_bounds(spark):
    got = forecasts(fc.forecast_ets(series(spark, {"up": [2, 4, 30, 90, 400], "none": [0, 0, 0]})))
    y = np.array([2, 4, 30, 90, 400.0])
    assert max(got["up"]) <= max(y.max() * 1.3, np.quantile(y, 0.75) * 1.6) + 1e-9
    assert min(got["up"]) >= min(y.mean() * 0.8, y.min() * 0.9) - 1e-9
    assert got["none"] == [0.0] * 6


def test_flat_repeats_the_only_month(spark):
    got = forecasts(fc.forecast_flat(series(spark, {"one": [7], "late": [0, 9], "many": [3, 4], "none": [0]})))
    assert got == {"one": [7.0] * 6, "late": [9.0] * 6, "none": [0.0] * 6}


def test_post_processing_rounds_by_sales_level(spark):
    pred = spark.createDataFrame(
        [(s, date(2024, m, 1), v) for s in ("slow", "busy") for m, v in ((1, -3.0), (2, 10.5), (3, 10.0))],
        "sku string, date date, forecast double",
    )
    models = spark.createDataFrame([("slow", 5.0, 0), ("busy", 5.1, 1)], "sku string, mean_daily double, model_type int")
    rows = fc.postprocess_forecast(pred, models).orderBy("sku", "date").collect()
    # fading 1, 0.975, 0.95: 10.5 -> 10.2375 and 10 -> 9.5
    assert [r["predicted_qty"] for r in rows] == [0, 10, 10, 0, 11, 10]


def test_fading_ends_exactly_at_its_last_weight(spark):
    pred = spark.createDataFrame([("a", date(2024, m, 1), 100.0) for m in range(1, 7)], "sku string, date date, forecast double")
    models = spark.createDataFrame([("a", 1.0, 0)], "sku string, mean_daily double, model_type int")
    rows = fc.postprocess_forecast(pred, models).orderBy("date").collect()
    assert [r["predicted_qty"] for r in rows] == np.ceil(100 * np.linspace(1.0, 0.95, 6)).astype(int).tolist()


def test_wide_and_long(spark):
    pred = spark.createDataFrame(
        [("a", 0, date(2024, 1, 31), 3), ("a", 0, date(2024, 1, 7), 2), ("b", 1, date(2024, 2, 4), 5)],
        "sku string, model_type int, date date, predicted_qty bigint",
    )
    months = fc.month_labels("2024-01", 3)
    assert months == ["2024-01", "2024-02", "2024-03"]
    wide = fc.forecast_wide(pred, months)
    assert wide.columns == ["sku", "model_type", *months]
    assert fc.forecast_wide(pred, months, drop_last=True).columns == ["sku", "model_type", *months[:2]]
    long = {(r["sku"], r["variable"]): r["value"] for r in fc.forecast_long(wide).collect()}
    assert long[("a", "2024-01")] == 5 and long[("b", "2024-01")] is None and len(long) == 6


def test_publish_keeps_the_past(spark):
    schema = "sku string, predict_date date, predicted_qty bigint"
    old = spark.createDataFrame([("a", date(2024, 1, 31), 1), ("a", date(2024, 2, 29), 1)], schema)
    new = spark.createDataFrame([("a", date(2024, 2, 29), 2), ("a", date(2024, 3, 31), 2)], schema)
    rows = fc.forecast_publish(old, new, "2024-01-31").orderBy("predict_date").collect()
    assert [r["predicted_qty"] for r in rows] == [1, 2, 2]


def test_model_sums_equal_those_of_rows_also_with_unknown_weeks(spark):
    """No row per horizon is made; products that are unknown count in no sum, and without samples the sums are unknown."""
    weeks = [(None if s == 3 else s, date(2020, 1, 5) + timedelta(days=7 * w), None if 8 < (w + s) % 60 < 15 else (w * w + s) % 41) for s in range(4) for w in range(90)]
    weekly = spark.createDataFrame(weeks, "sku long, week_end date, qty long")
    features = staged(h.weekly_features(weekly), "odd-weeks")
    found = fc.weekly_model_sums(features)
    want = fc._product_sums(fc.weekly_model_rows(features)).first().asDict()
    assert want["one__one"] > 0 and features.where("qty_smooth_scaled IS NULL").count() > 0
    assert found.columns == list(want) and found.first().asDict() == pytest.approx(want, rel=1e-9)
    assert "Expand" not in (plan := found._jdf.queryExecution().toString()) and "stack" not in plan
    assert set(fc.weekly_model_sums(features.where("false")).first().asDict().values()) == {None}


def test_a_forecast_reads_the_last_weeks_of_a_sku_alone(spark):
    """The windows of the newest week run over ``n_in`` weeks of each SKU, with the forecast of the whole history; fewer weeks give none."""
    weeks = [(s, date(2020, 1, 5) + timedelta(days=7 * w), (w * w + s) % 41) for s, many in enumerate((35, 36, 37, 150)) for w in range(many)]
    features = staged(h.weekly_features(spark.createDataFrame(weeks, "sku long, week_end date, qty long")), "weeks")
    model = dict.fromkeys(["one", *fc.MODEL_INPUTS], 0.1)
    found = fc.forecast_weekly(features, model)
    assert "_further" in found._jdf.queryExecution().toString()
    last = features.groupBy("sku").agg(F.max("week_end").alias("sample_end"))
    whole = fc._regressors(fc.model_weeks(features, 0).join(last, ["sku", "sample_end"]).withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(27)))))
    value = F.greatest(fc._linear(model) * (F.col("qty_max") - F.col("qty_min")) + F.col("qty_min"), F.lit(0.0))
    wanted = whole.select("sku", F.date_add("sample_end", F.col("horizon") * 7).alias("date"), value.alias("forecast"))
    assert {r["sku"] for r in found.collect()} == {1, 2, 3}
    assert [r["forecast"] for r in found.orderBy("sku", "date").collect()] == pytest.approx([r["forecast"] for r in wanted.orderBy("sku", "date").collect()])


def test_weekly_model_beats_last_year_on_held_out_weeks(spark):
    weeks, skus, hold = 160, 30, 27
    t = F.col("w").cast("double")
    level = 40 + F.col("sku") + 0.15 * t + 15 * F.sin(t * 2 * np.pi / 52.18)
    noise = (F.abs(F.hash("sku", "w")) % 100) / 4.0
    weekly = (
        spark.range(skus).withColumnRenamed("id", "sku").withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(weeks - 1))))
        .select("sku", F.date_add(F.lit(date(2020, 1, 5)), F.col("w")* 7).alias("week_end"), F.round(level + noise).cast("bigint").alias("qty"), "w")
    )
    known = h.weekly_features(weekly.where(F.col("w") < weeks - hold).drop("w"))
    pred = fc.forecast_weekly_ml(known, hold)
    assert pred.count() == skus * hold and pred.where("forecast < 0").count() == 0
    smooth = h.smooth_weeks(weekly.drop("w")).select("sku", "week_end", "qty_smooth")
    year_ago = smooth.select("sku", F.date_add("week_end", 364).alias("week_end"), F.col("qty_smooth").alias("naive"))
    both = pred.withColumnRenamed("date", "week_end").join(smooth, ["sku", "week_end"]).join(year_ago, ["sku", "week_end"])
    row = both.agg(F.avg(F.abs(F.col("forecast") - F.col("qty_smooth"))).alias("m"), F.avg(F.abs(F.col("naive") - F.col("qty_smooth"))).alias("n")).first()
    assert row["m"] < row["n"]


def test_weekly_model_solves_its_sums_and_needs_full_samples(spark):
    weeks = spark.range(3).withColumnRenamed("id", "sku").withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(79))))
    weekly = weeks.where("sku > 0 OR w < 20").select(
        "sku", F.date_add(F.lit(date(2020, 1, 5)), F.col("w") * 7).alias("week_end"), (F.abs(F.hash("sku", "w")) % 50).cast("bigint").alias("qty"))
    features = h.weekly_features(weekly)
    sums = fc.weekly_model_sums(features).first().asDict()
    assert sums["one__one"] == 2 * (80 - 36 - 27 + 1) * 27
    model = fc.solve_weekly_model(sums, ridge=0.0)
    names = list(model)
    for i, a in enumerate(names):
        fitted = sum(model[b] * sums[f"{a}__{b}" if i <= j else f"{b}__{a}"] for j, b in enumerate(names))
        assert fitted == pytest.approx(sums[f"label__{a}"], rel=1e-6, abs=1e-6)
    got = {r["sku"]: r["n"] for r in fc.forecast_weekly(features, model).groupBy("sku").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 27, 2: 27}
    few = h.weekly_features(weekly.where("sku = 0"))
    assert set(fc.fit_weekly_model(few).values()) == {0.0} and fc.forecast_weekly_ml(few).count() == 0


def bent_weeks(spark, skus, weeks):
    """Sales with a season that only busy SKUs have, and a step, which no sum of the regressors follows."""
    t, sku = F.col("w").cast("double"), F.col("sku")
    season = F.when(F.sin(t * 2 * np.pi / 52.18) > 0.4, 40.0).otherwise(0.0) * (sku % 3)
    noise = (F.abs(F.hash("sku", "w")) % 100) / 20.0
    rows = spark.range(skus).withColumnRenamed("id", "sku").withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(weeks - 1))))
    return rows.select("sku", F.date_add(F.lit(date(2020, 1, 5)), F.col("w") * 7).alias("week_end"), F.round(30 + season + noise).cast("bigint").alias("qty"), "w")


def test_boosted_trees_beat_the_linear_model_on_held_out_weeks(spark):
    weeks, skus, hold = 190, 40, 27
    weekly = bent_weeks(spark, skus, weeks)
    known = staged(h.weekly_features(weekly.where(F.col("w") < weeks - hold).drop("w")), "known")
    linear, trees = fc.fit_weekly_trees(known, hold, rounds=30)
    assert 1 < len(trees) <= 30
    truth = h.smooth_weeks(weekly.drop("w")).select("sku", F.col("week_end").alias("date"), "qty_smooth")

    def error(found):
        return found.join(truth, ["sku", "date"]).agg(F.avg(F.pow(F.col("forecast") - F.col("qty_smooth"), 2)), F.count(F.lit(1))).first()

    boosted, plain = error(fc.forecast_weekly(known, linear, hold, trees=trees)), error(fc.forecast_weekly_ml(known, hold))
    assert boosted[1] == plain[1] == skus * hold
    assert boosted[0] < 0.9 * plain[0]
    # the rounds ended, or the best ones were kept, by the SKUs held back: more trees than kept do not help them
    again = fc.fit_weekly_trees(known, hold, rounds=30)
    assert again == (linear, trees)


def test_split_by_sku_and_fits_without_one_side(spark):
    weekly = bent_weeks(spark, 30, 70)
    features = h.weekly_features(weekly.drop("w"))
    rows = fc.weekly_model_rows(features)
    sides = {r["sku"]: r["sides"] for r in rows.groupBy("sku").agg(F.count_distinct("held_back").alias("sides")).collect()}
    assert set(sides.values()) == {1} and len(sides) == 30
    held = {r["sku"] for r in rows.where("held_back").select("sku").distinct().collect()}
    assert 0 < len(held) < 15
    assert {s for s in range(30) if int(hashlib.md5(str(s).encode()).hexdigest()[:8], 16) % 5 == 0} == held
    for side in (features.where(F.col("sku").isin(*held)), features.where(~F.col("sku").isin(*held)), features.where("false")):
        linear, trees = fc.fit_weekly_trees(side, rounds=3)
        assert trees == [] and set(linear) == {"one", *fc.MODEL_INPUTS}


def spark_trees(rows, linear, rounds):
    """What Spark's own gradient boosting learns from a row per sample and horizon."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rest = rows.withColumn("rest", F.col("label") - fc._linear(linear))
    inputs = VectorAssembler(inputCols=fc.MODEL_INPUTS, outputCol="inputs").transform(rest)
    model = GBTRegressor(
        featuresCol="inputs", labelCol="rest", validationIndicatorCol="held_back", maxIter=rounds, maxDepth=4, stepSize=0.15,
        validationTol=1e-3, seed=1, minInstancesPerNode=20,
    ).fit(inputs)

    def plain(node):
        if node.subtreeDepth() == 0:
            return float(node.prediction())
        return (fc.MODEL_INPUTS[node.split().featureIndex()], float(node.split().threshold()), plain(node.leftChild()), plain(node.rightChild()))

    return [(float(w), plain(tree.rootNode())) for w, tree in zip(model.treeWeights, model._java_obj.trees())]


def test_boosting_without_a_row_per_horizon_grows_the_trees_of_spark(spark, monkeypatch):
    weeks = 96
    features = staged(h.weekly_features(bent_weeks(spark, 12, weeks).drop("w")), "few")
    samples = fc.weekly_model_samples(features)
    rows = staged(fc.weekly_model_rows(features), "rows")
    assert samples.count() == 12 * (weeks - 36 - 27 + 1) and rows.count() == 27 * samples.count()
    assert rows.where("NOT held_back").count() <= 10_000  # so Spark, too, cuts its bins by all rows
    sums, want = boosting.product_sums(samples, 27), fc._product_sums(rows.where("NOT held_back")).first().asDict()
    assert sums == pytest.approx(want, rel=1e-9)
    monkeypatch.setattr(boosting, "PENDING", 2)  # residuals are written down between rounds
    linear, trees = fc.fit_weekly_trees(features, rounds=6)
    expected = spark_trees(rows, linear, 6)
    assert len(trees) == len(expected) > 1

    assert [w for w, _ in trees] == [w for w, _ in expected] and trees[0][1][:2] == pytest.approx(expected[0][1][:2])
    # two regressors that part the rows alike may stand for each other, so the trees are compared by what they tell the rows
    told = rows.where("NOT held_back").select(F.expr(fc.trees_sql(trees)).alias("a"), F.expr(fc.trees_sql(expected)).alias("b"))
    row = told.agg(F.max(F.abs(F.col("a") - F.col("b"))).alias("apart"), F.max(F.abs("b")).alias("most"), F.count("a").alias("n")).first()
    assert row["apart"] < 1e-7 < row["most"] and row["n"] > 1000


def test_samples_of_no_sku_and_null_labels(spark):
    features = h.weekly_features(bent_weeks(spark, 6, 80).drop("w"))
    unnamed = features.withColumn("sku", F.nullif("sku", F.lit(1)))
    assert fc.weekly_model_samples(unnamed).where("sku IS NULL").count() == 0
    broken = features.withColumn("qty_smooth_scaled", F.when(F.col("week_end") != date(2020, 12, 6), F.col("qty_smooth_scaled")))
    with pytest.raises(Exception, match="null or not finite"):
        fc.fit_weekly_trees(broken, rounds=1)


def test_trees_as_text(spark):
    tree = ("last", 0.5, 1.0, ("ahead", 3.0, -2.0, 1e-7))
    rows = spark.createDataFrame([(0.5, 9.0), (0.6, 3.0), (0.6, 3.5)], "last double, ahead double")
    got = [r[0] for r in rows.select(F.expr(fc.trees_sql([(1.0, tree), (0.5, 4.0)]))).collect()]
    assert got == [3.0, 0.0, 2.0 + 1e-7]
