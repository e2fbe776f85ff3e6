"""Monthly demand forecasts: flat, exponential smoothing, a global weekly model, and publication."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merch.functions import dates as dt
from merch.functions.numbers import half_even, line_weight
from merch.operators import boosting
from merch.operators.history import model_type
from merch.session import staged

SEASON = 12
BLOCK = 128  # rows compared with a whole grid together; keeps the working arrays in cache
TOGETHER = 50_000  # series from which equally long ones are gathered
SAMPLES = 2_000  # samples of the weekly model multiplied together
PAIRS = 2_000_000  # sums of pairs of months held at once
# Smoothing candidates: level, trend share, damping, season.
GRID = {"alpha": (0.1, 0.3, 0.5, 0.7, 0.9), "beta": (0.0, 0.1, 0.3), "phi": (0.8, 0.9, 0.98), "gamma": (0.05, 0.15, 0.3)}


def monthly_series(monthly: DataFrame) -> DataFrame:
    """One row per SKU with its months in order (bounded by the calendar) and its forecast route.

    Takes the rows of ``monthly_totals`` or, without a row per month, the lists of ``monthly_lists``.
    """
    if "mean_daily" in monthly.columns:
        lists = monthly.select("sku", "y", "last_month", "mean_daily")
        return lists.withColumn("model_type", model_type(F.size("y"), F.col("mean_daily")))
    month = F.struct("month_end", F.col("qty").cast("double").alias("qty"))
    skus = monthly.groupBy("sku").agg(
        F.array_sort(F.collect_list(month)).alias("_m"), F.avg("daily_mean").alias("mean_daily")
    )
    return skus.select(
        "sku",
        F.col("_m.qty").alias("y"),
        F.element_at("_m", -1)["month_end"].alias("last_month"),
        "mean_daily",
        model_type(F.size("_m"), F.col("mean_daily")).alias("model_type"),
    )


def _explode_months(df: DataFrame, values: str, h: int) -> DataFrame:
    """One row per forecast month from an array of ``h`` values."""
    pairs = F.arrays_zip(dt.next_month_ends(F.col("last_month"), h).alias("date"), F.col(values).alias("value"))
    return df.withColumn("_p", F.explode(pairs)).select(
        "sku", F.col("_p.date").alias("date"), F.col("_p.value").alias("forecast")
    )


def forecast_flat(series: DataFrame, h: int = 6) -> DataFrame:
    """Repeat the only month with sales (0 if there is none) for ``h`` months.

    Meant for histories with at most one such month; the others are left out.
    """
    sold = F.filter("y", lambda x: x > 0)
    level = F.when(F.size(sold) == 0, F.lit(0.0)).otherwise(F.get(sold, F.lit(0)))
    flat = series.where(F.size(sold) <= 1).withColumn("_values", F.array_repeat(level, F.lit(h)))
    return _explode_months(flat, "_values", h)


def _start_values(y: np.ndarray, seasonal: bool):
    """Level, trend and season of each row before its first month."""
    if seasonal:
        level = y[:, :SEASON].mean(axis=1)
        trend = (y[:, SEASON : 2 * SEASON].mean(axis=1) - level) / SEASON
        return level, trend, y[:, :SEASON] - level[:, None]
    trend = y[:, 1] - y[:, 0] if y.shape[1] > 1 else np.zeros(len(y))
    return y[:, 0].copy(), trend, np.zeros((len(y), 1))


def _points(grid: dict, seasonal: bool) -> np.ndarray:
    """The grid points: a row of alpha, beta, phi and gamma each."""
    season = grid["gamma"] if seasonal else (0.0,)
    return np.array(list(product(grid["alpha"], grid["beta"], grid["phi"], season)), dtype=float)


def _months(values, level, trend, season, points: np.ndarray):
    """Damped additive smoothing by parameters of their own for every column, month by month: the error and the state after it."""
    alpha, beta, phi, gamma = points.T
    step = alpha * beta
    for t, value in enumerate(values):
        damped = phi * trend
        base = level + damped
        now = season[t % len(season)]
        error = value - (base + now)
        level = base + alpha * error
        trend = damped + step * error
        now += gamma * error
        yield error, level, trend


def _smooth(y: np.ndarray, row: np.ndarray, point: np.ndarray, points: np.ndarray, h: int) -> np.ndarray:
    """Forecasts of equally long rows, each by the best of its grid points.

    ``row`` and ``point`` pair every row with its points, both in order. All pairs advance together, month by month.
    """
    n = y.shape[1]
    level, trend, season = _start_values(y, n >= 2 * SEASON)
    level, trend, season, own = level[row], trend[row], np.ascontiguousarray(season.T)[:, row], points[point]
    sse = np.zeros(len(row))
    for error, level, trend in _months(np.ascontiguousarray(y.T)[:, row], level, trend, season, own):
        sse += error * error
    sse = np.round(sse, 6)
    sse[np.isnan(sse)] = -np.inf
    least = np.minimum.reduceat(sse, np.flatnonzero(np.diff(row, prepend=-1)))
    found = np.flatnonzero(sse == least[row])
    best = found[np.diff(row[found], prepend=-1) > 0]
    steps = np.cumsum(own[best, 2][:, None] ** np.arange(1, h + 1), axis=1)
    turn = (n + np.arange(h)) % len(season)
    return level[best][:, None] + steps * trend[best][:, None] + season[turn][:, best].T


def _few_sales(y: np.ndarray) -> np.ndarray:
    """Rows with so few months of sales that pairs of them are quicker to look up than all months are smoothed."""
    sold = np.count_nonzero(y, axis=1)
    return (sold * (sold + 1) <= 4 * y.shape[1]) & np.isfinite(y).all(axis=1)


def _pair_sums(cells: np.ndarray, longest: int, points: np.ndarray):
    """After every month, the sums of products of the errors that single units of sales in two months (of ``cells``) leave at every grid point.

    Errors are linear in the months of a series, so its squared error is the sum of these over the pairs of its months with sales.
    """
    units = np.zeros((len(cells), longest))
    units[np.arange(len(cells)), cells] = 1.0
    many = len(points)
    level, trend, season = _start_values(units, longest >= 2 * SEASON)
    values, start = np.repeat(units.T, many, axis=1), (np.repeat(level, many), np.repeat(trend, many))
    sums = np.zeros((len(cells), len(cells), many))
    for error, _, _ in _months(values, *start, np.repeat(season.T, many, axis=1), np.tile(points, (len(cells), 1))):
        at = error.reshape(len(cells), many)
        yield np.add(sums, at[:, None] * at, out=sums)


def _candidates(y: np.ndarray, cells: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of few sales, paired with the grid points that may be their best.

    The sums are rounded otherwise than those that are smoothed month by month. The points left out are worse by more than both
    can be off and by more than the six decimals that decide, so the best of the others is the best of all.
    """
    sold = np.count_nonzero(y, axis=1)
    most = max(int(sold.max()), 1)
    months = np.argsort(y == 0, axis=1, kind="stable")[:, :most]
    values = np.take_along_axis(y, months, axis=1)
    months = np.where(values != 0, np.searchsorted(cells, months), 0)
    sse, scale = np.zeros((2, len(y), sums.shape[2]))
    single = np.sqrt(np.diagonal(sums).T)
    for i in range(most):
        scale += np.abs(values[:, i, None]) * single[months[:, i]]
        for j in range(i + 1):
            sse += (values[:, i] * values[:, j] * (1 + (j < i)))[:, None] * sums[months[:, i], months[:, j]]
    off = 1e-10 * scale * scale
    return np.nonzero(sse - off <= (sse + off).min(axis=1)[:, None] + 2e-6)


def _blocks(kind: np.ndarray, size: int) -> list[np.ndarray]:
    """The places where ``kind`` holds, at most ``size`` together."""
    places = np.flatnonzero(kind)
    return [places[i : i + size] for i in range(0, len(places), size)]


def _smooth_lists(values: np.ndarray, lengths: np.ndarray, grid: dict, h: int) -> np.ndarray:
    """Forecasts of series that stand one after the other in ``values``; equally long ones are smoothed together."""
    out = np.empty((len(lengths), h))
    begins = np.cumsum(lengths) - lengths
    groups = {}
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        y = values[begins[rows][:, None] + np.arange(n)]
        few = _few_sales(y) if n > 1 else np.zeros(len(rows), dtype=bool)
        groups.setdefault(n >= 2 * SEASON, []).append((rows, y, few))
    for seasonal, parts in groups.items():
        points = _points(grid, seasonal)
        longest = parts[-1][1].shape[1]
        sold = np.zeros(longest, dtype=bool)
        for _, y, few in parts:
            sold[: y.shape[1]] |= (y[few] != 0).any(axis=0)
        cells = np.flatnonzero(sold)
        # sums of pairs are worth it for many series only, and while they stay small
        paired = 10 * sum(few.sum() for _, _, few in parts) > len(cells) ** 2 and 0 < len(cells) ** 2 * len(points) <= PAIRS and len(points) > 1
        sums, month, state = _pair_sums(cells, longest, points), 0, None
        for rows, y, few in parts:
            n = y.shape[1]
            few = few & paired
            while few.any() and month < n:
                state, month = next(sums), month + 1
            if few.any():
                pairs = [(block, *_candidates(y[block], cells, state)) for block in _blocks(few, BLOCK)]
                row = np.concatenate([block[row] for block, row, _ in pairs])
                whole = np.flatnonzero(few)
                out[rows[whole]] = _smooth(y[whole], np.searchsorted(whole, row), np.concatenate([point for _, _, point in pairs]), points, h)
            for block in _blocks(~few, max(BLOCK * 100 // len(points), 1)):
                row, point = np.divmod(np.arange(len(block) * len(points)), len(points))
                out[rows[block]] = _smooth(y[block], row, point, points, h)
    return out


def smoothing_udf(h: int, grid: dict):
    def smoothed(held: list[pa.Array]):
        lengths = np.concatenate([pc.list_value_length(a).to_numpy(zero_copy_only=False) for a in held])
        values = np.concatenate([a.flatten().to_numpy(zero_copy_only=False) for a in held]).astype(float)
        out, at = _smooth_lists(values, lengths, grid, h), 0
        for a in held:
            part = out[at : at + len(a)]
            at += len(a)
            yield pa.ListArray.from_arrays(np.arange(len(a) + 1, dtype=np.int32) * h, pa.array(part.ravel(), pa.float64(), from_pandas=True))

    @F.arrow_udf("array<double>")
    def smooth(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= TOGETHER:
                yield from smoothed(held)
                held = []
        if held:
            yield from smoothed(held)

    return smooth


def short_history_bounds(y: Column) -> tuple[Column, Column]:
    """Lower and upper forecast bound from the months of a short history."""
    ordered = F.array_sort(y)
    n = F.size(y)
    place = F.lit(0.75) * (n - 1)
    below = F.floor(place).cast("int")
    low_q, high_q = F.get(ordered, below), F.get(ordered, F.least(below + 1, n - 1))
    q75 = low_q + (high_q - low_q) * (place - below)
    sold = F.filter(y, lambda x: x > 0)
    sold_mean = F.aggregate(sold, F.lit(0.0), lambda a, x: a + x) / F.size(sold)
    lower = F.least(sold_mean * 0.8, F.array_min(y) * 0.9)
    upper = F.greatest(F.array_max(y) * 1.3, q75 * 1.6)
    return lower, upper


def forecast_ets(series: DataFrame, h: int = 6, grid: dict | None = None, clip_below: int = 6) -> DataFrame:
    """Damped additive trend, with a yearly season from 24 months on, best of a parameter grid.

    Under ``clip_below`` months the forecast is kept inside bounds taken from
    the history, and a history without sales forecasts 0.
    """
    smooth = smoothing_udf(h, grid or GRID)
    sold = F.exists("y", lambda x: x > 0)
    lower, upper = short_history_bounds(F.col("y"))
    fitted = series.withColumns({"_raw": smooth("y"), "_short": F.size("y") < clip_below, "_sold": sold})
    bounded = fitted.withColumns(
        {
            "_low": F.when(F.col("_short") & F.col("_sold"), lower),
            "_high": F.when(F.col("_short") & F.col("_sold"), upper),
        }
    )
    values = F.transform(
        "_raw",
        lambda v: F.when(~F.col("_sold"), F.lit(0.0))
        .when(F.col("_short"), F.least(F.greatest(v, F.col("_low")), F.col("_high")))
        .otherwise(v),
    )
    return _explode_months(bounded.withColumn("_values", values), "_values", h)


# --- weekly model -----------------------------------------------------------

MODEL_INPUTS = ["last", "mean4", "mean13", "mean36", "peak", "last_near", "mean_far", "year_sin", "year_cos", "ahead"]


def model_weeks(features: DataFrame, h: int, n_in: int = 36) -> DataFrame:
    """Every week with ``n_in`` weeks up to it: levels looked back on, and the ``h`` scaled quantities after it.

    ``y1`` .. ``yh`` are NULL beyond the last week of the SKU, which ``newest`` marks.
    """
    weeks = Window.partitionBy("sku").orderBy("week_end")
    q = F.col("qty_smooth_scaled")

    def back(k):
        return weeks.rowsBetween(1 - k, 0)

    levels = {f"mean{k}": F.avg(q).over(back(k)) for k in (4, 13, 36)}
    ahead = {f"y{k}": F.lead(q, k).over(weeks) for k in range(1, h + 1)}
    return features.select(
        "sku", F.col("week_end").alias("sample_end"), "qty_min", "qty_max", F.row_number().over(weeks).alias("_n"),
        F.lead("week_end").over(weeks).isNull().alias("newest"), q.alias("last"), F.max(q).over(back(36)).alias("peak"),
        *[c.alias(name) for name, c in {**levels, **ahead}.items()],
    ).where(F.col("_n") >= n_in)


def _regressors(rows: DataFrame) -> DataFrame:
    """The regressors that depend on the horizon."""
    angle = F.dayofyear(F.date_add("sample_end", F.col("horizon") * 7)) * F.lit(2 * np.pi / 365.25)
    near = F.exp(-F.col("horizon") / F.lit(6.0))
    return rows.withColumns(
        {
            "last_near": F.col("last") * near,
            "mean_far": F.col("mean13") * (1 - near),
            "year_sin": F.sin(angle),
            "year_cos": F.cos(angle),
            "ahead": F.col("horizon").cast("double"),
        }
    )


def weekly_model_rows(features: DataFrame, h: int = 27, n_in: int = 36) -> DataFrame:
    """One row per sample and horizon: label, regressors, and whether the SKU is held back for validation.

    A sample is a week with ``n_in`` weeks up to it and ``h`` after it.
    """
    pairs = ", ".join(f"{k}, y{k}" for k in range(1, h + 1))
    whole = model_weeks(features, h, n_in).where(F.col(f"y{h}").isNotNull())
    return _regressors(whole.select("*", held_back(F.col("sku")).alias("held_back"), F.expr(f"stack({h}, {pairs}) AS (horizon, label)")))


def weekly_model_samples(features: DataFrame, h: int = 27, n_in: int = 36) -> DataFrame:
    """One row per sample with the labels of all horizons in a list: ``weekly_model_rows`` without a row per horizon, nor those of no SKU."""
    whole = model_weeks(features, h, n_in).where(F.col(f"y{h}").isNotNull())
    labels = F.array(*[F.col(f"y{k}").cast("double") for k in range(1, h + 1)]).alias("labels")
    levels = [F.col(c).cast("double").alias(c) for c in boosting.LEVELS]
    return whole.select("sku", held_back(F.col("sku")).alias("held_back"), F.unix_date("sample_end").alias("day"), *levels, labels).where(
        "held_back IS NOT NULL"
    )


def _product_sums(rows: DataFrame) -> DataFrame:
    terms = {"label": F.col("label"), "one": F.lit(1.0), **{c: F.col(c) for c in MODEL_INPUTS}}
    names = list(terms)
    return rows.agg(*[F.sum(terms[a] * terms[b]).alias(f"{a}__{b}") for i, a in enumerate(names) for b in names[i:]])


def weekly_model_sums(features: DataFrame, h: int = 27, n_in: int = 36) -> DataFrame:
    """One row ``a__b``: sums of the products of label, one and regressors over all samples and horizons.

    Every task multiplies matrices of samples by horizons and passes on one row of sums.
    """
    names = ["label", "one", *MODEL_INPUTS]
    pairs = {f"{a}__{b}": (i, j) for i, a in enumerate(names) for j, b in enumerate(names) if j >= i}

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, some = np.zeros((len(names), len(names))), False
        for batch in batches:
            for at in range(0, batch.num_rows, SAMPLES):
                part, some = batch.slice(at, SAMPLES), True
                numbers = [part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in [*boosting.LEVELS, *ahead]]
                found = boosting.regressors(np.stack(numbers[: len(boosting.LEVELS)], axis=1), part.column("day").to_numpy().astype(np.int64), h)
                found |= {"label": np.stack(numbers[len(boosting.LEVELS) :], axis=1), "one": np.ones((1, 1))}
                matrix = np.stack([np.broadcast_to(found[c], (part.num_rows, h)).ravel() for c in names])
                matrix[np.isnan(matrix)] = 0.0  # a sum passes over products that are unknown
                gram += matrix @ matrix.T
        if some:
            yield pa.RecordBatch.from_pydict({pair: [gram[at]] for pair, at in pairs.items()})

    ahead = [f"y{k}" for k in range(1, h + 1)]
    whole = model_weeks(features, h, n_in).where(F.col(f"y{h}").isNotNull())
    samples = whole.select(F.unix_date("sample_end").alias("day"), *[F.col(c).cast("double").alias(c) for c in [*boosting.LEVELS, *ahead]])
    return samples.mapInArrow(tell, ", ".join(f"{pair} double" for pair in pairs)).agg(*[F.sum(pair).alias(pair) for pair in pairs])


def solve_weekly_model(sums: dict[str, float], ridge: float = 1e-6) -> dict[str, float]:
    """Coefficients from the sums by the normal equations; all 0 without samples."""
    inputs = ["one", *MODEL_INPUTS]
    if not sums["one__one"]:
        return dict.fromkeys(inputs, 0.0)
    gram = np.array([[sums[f"{a}__{b}" if i <= j else f"{b}__{a}"] for j, b in enumerate(inputs)] for i, a in enumerate(inputs)])
    right = np.array([sums[f"label__{a}"] for a in inputs])
    weights = np.linalg.solve(gram + ridge * sums["one__one"] * np.eye(len(inputs)), right)
    return dict(zip(inputs, weights.tolist()))


def fit_weekly_model(features: DataFrame, h: int = 27, n_in: int = 36, ridge: float = 1e-6) -> dict[str, float]:
    """Coefficients of one linear model for all SKUs, direct for every horizon.

    Least squares: one pass of partial sums, of which one row comes back to the driver.
    """
    sums = staged(weekly_model_sums(features, h, n_in), "model-sums", narrow=True)
    return solve_weekly_model(sums.first().asDict(), ridge)


def _linear(model: dict[str, float]) -> Column:
    scaled = F.lit(model["one"])
    for c in MODEL_INPUTS:
        scaled = scaled + F.col(c) * F.lit(model[c])
    return scaled


def forecast_weekly(
    features: DataFrame, model: dict[str, float], h: int = 27, n_in: int = 36, trees: list[tuple[float, tuple | float]] = ()
) -> DataFrame:
    """``h`` Sundays after the newest week of every SKU with ``n_in`` weeks; quantities in sales units, not below 0.

    ``trees`` (weight, tree) add to the linear model.
    """
    # nothing before its last ``n_in`` weeks enters the forecast of a SKU
    further = F.lead("week_end", n_in).over(Window.partitionBy("sku").orderBy("week_end"))
    recent = features.withColumn("_further", further).where("_further IS NULL").drop("_further")
    newest = model_weeks(recent, 0, n_in).where("newest")
    rows = _regressors(newest.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(h)))))
    scaled = _linear(model) + F.expr(trees_sql(trees))
    value = scaled * (F.col("qty_max") - F.col("qty_min")) + F.col("qty_min")
    return rows.select(
        "sku", F.date_add("sample_end", F.col("horizon") * 7).alias("date"), F.greatest(value, F.lit(0.0)).alias("forecast")
    )


def forecast_weekly_ml(features: DataFrame, h: int = 27, n_in: int = 36) -> DataFrame:
    """``forecast_weekly`` by the model fitted to the same features."""
    return forecast_weekly(features, fit_weekly_model(features, h, n_in), h, n_in)


# --- boosted weekly model ---------------------------------------------------

VALIDATION = 5  # one SKU in so many is held back


def held_back(sku: Column) -> Column:
    """Whether a SKU validates instead of training, by a hash of its text: the same in every run and at every size."""
    return F.conv(F.substring(F.md5(sku.cast("string")), 1, 8), 16, 10).cast("bigint") % VALIDATION == 0


def tree_sql(node: tuple | float) -> str:
    """A tree as a SQL expression over the regressors: (regressor, threshold, tree up to it, tree above it) or a value."""
    if not isinstance(node, tuple):
        return f"CAST({node!r} AS DOUBLE)"
    name, threshold, low, high = node
    return f"CASE WHEN {name} <= CAST({threshold!r} AS DOUBLE) THEN {tree_sql(low)} ELSE {tree_sql(high)} END"


def trees_sql(trees: list[tuple[float, tuple | float]]) -> str:
    """The weighted sum of the trees, added from the left."""
    return " + ".join(["CAST(0 AS DOUBLE)", *[f"CAST({weight!r} AS DOUBLE) * ({tree_sql(tree)})" for weight, tree in trees]])


def fit_weekly_trees(
    features: DataFrame, h: int = 27, n_in: int = 36, rounds: int = 60, depth: int = 4, step: float = 0.15, tolerance: float = 1e-3
) -> tuple[dict[str, float], list[tuple[float, tuple | float]]]:
    """A linear model of the training SKUs and boosted trees for what it leaves, as plain data.

    After every round the trees are measured on the SKUs held back; when a round lowers their squared error by less than
    ``tolerance`` of it, boosting ends and the best round so far is kept. Trees that do not lower that error at all, and fits
    without a SKU on either side, leave the linear model. The rounds are sums over bins of the regressors, in the tasks.
    """
    samples = staged(weekly_model_samples(features, h, n_in), "model-samples")
    linear = solve_weekly_model(boosting.product_sums(samples, h), 1e-6)
    return linear, boosting.boost(samples, linear, h, rounds=rounds, depth=depth, step=step, tolerance=tolerance)


def forecast_weekly_boosted(features: DataFrame, h: int = 27, n_in: int = 36, **fit) -> DataFrame:
    """``forecast_weekly`` by the linear model with boosted trees, fitted to four in five SKUs of the same features."""
    linear, trees = fit_weekly_trees(features, h, n_in, **fit)
    return forecast_weekly(features, linear, h, n_in, trees)


# --- after the model --------------------------------------------------------


def postprocess_forecast(
    pred: DataFrame, models: DataFrame, decay_end: float = 0.95, ceil_below: float = 5.0
) -> DataFrame:
    """Whole, non-negative quantities: clamp at 0, fade along the horizon, then round.

    ``models`` carries ``mean_daily`` and ``model_type``; slow sellers round up,
    the others half-even.
    """
    by_date = Window.partitionBy("sku").orderBy("date")
    n = F.count(F.lit(1)).over(Window.partitionBy("sku"))
    fade = line_weight(F.row_number().over(by_date) - 1, n, 1.0, decay_end)
    faded = pred.withColumn("_v", F.greatest(F.col("forecast"), F.lit(0.0)) * fade)
    rounded = F.when(F.col("mean_daily") <= ceil_below, F.ceil("_v")).otherwise(half_even(F.col("_v")))
    return faded.join(models.select("sku", "mean_daily", "model_type"), "sku").select(
        "sku", "date", rounded.cast("bigint").alias("predicted_qty"), "model_type"
    )


def forecast_months(pred: DataFrame) -> DataFrame:
    """Sum of predictions by SKU and ``yyyy-MM``."""
    return pred.groupBy("sku", "model_type", dt.year_month(F.col("date")).alias("month")).agg(
        F.sum("predicted_qty").alias("value")
    )


def month_labels(first: str, periods: int) -> list[str]:
    """``periods`` consecutive yyyy-MM labels from ``first``."""
    year, month = (int(x) for x in first.split("-"))
    spots = range(year * 12 + month - 1, year * 12 + month - 1 + periods)
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in spots]


def forecast_wide(pred: DataFrame, months: list[str], drop_last: bool = False) -> DataFrame:
    """sku, model_type and one column per month in calendar order; the partial last month can go."""
    months = sorted(months)[:-1] if drop_last else sorted(months)
    cells = [F.sum(F.when(F.col("month") == m, F.col("value"))).alias(m) for m in months]
    return forecast_months(pred).groupBy("sku", "model_type").agg(*cells)


def forecast_long(wide: DataFrame) -> DataFrame:
    """Back to sku, model_type, variable, value; months without a prediction stay as NULL."""
    months = [c for c in wide.columns if c not in ("sku", "model_type")]
    return wide.unpivot(["sku", "model_type"], months, "variable", "value")


def forecast_publish(old: DataFrame, new: DataFrame, as_of: str) -> DataFrame:
    """Published rows up to ``as_of`` stay, later ones give way to the new forecast."""
    keep = old.where(F.col("predict_date") <= F.lit(as_of).cast("date"))
    return keep.unionByName(new.select(*old.columns))
