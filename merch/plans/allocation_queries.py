"""Target allocation queries: stateless shares, the ordered rounds, residual stock and attainment."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from merch.functions import numbers as num
from merch.functions import text as tx
from merch.operators import allocate as al
from merch.plans import binding as b
from merch.plans.query import Query
from merch.session import staged

PEOPLE = [f"a{i:03d}" for i in range(1, 15)]
# Larger targets where a round needs people who still have something to sell.
SOFT_SCALE, CLAMP_SCALE = 8, 4

# --- roles ------------------------------------------------------------------


def sku_dim(spark, sf_dir):
    """SKU facts with the people responsible, brand as territory, level, stock, target and forecast."""
    lines = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("sku")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("num"),
        F.array_sort(
            F.collect_set(F.concat(F.lit("a"), F.lpad((F.col("l_suppkey") % 14 + 1).cast("string"), 3, "0")))
        ).alias("principals"),
    )
    n, s = F.col("num"), F.col("size")
    return lines.join(b.part_types(spark, sf_dir), "sku").select(
        "sku", "brand", "type", "unit_price", "principals",
        (s % 6 + 1).alias("level"),
        F.floor(n * (s % 9) / 4).alias("stock"),
        F.when(s % 13 == 0, 0).otherwise(F.floor(n / 12) + s % 7).cast("bigint").alias("sku_target"),
        F.when(s % 5 == 0, 0).otherwise(F.floor(n / 24)).cast("bigint").alias("forecast"),
    )


DIM_SQL = f"""dim AS (SELECT p.sku, brand, type, unit_price, principals, size % 6 + 1 AS level, (num * (size % 9)) // 4 AS stock,
  CASE WHEN size % 13 = 0 THEN 0 ELSE num // 12 + size % 7 END AS sku_target, CASE WHEN size % 5 = 0 THEN 0 ELSE num // 24 END AS forecast,
  (unit_price * 100)::BIGINT AS price FROM ({b.PART_SQL}) p JOIN (
    SELECT l_partkey AS sku, sum(l_quantity::BIGINT)::BIGINT AS num,
           list_sort(list_distinct(list('a' || lpad((l_suppkey % 14 + 1)::VARCHAR, 3, '0')))) AS principals
    FROM lineitem GROUP BY 1) l ON l.sku = p.sku)"""


def targets(dim, keys, scale=1):
    """Falling targets that together cover 60 % (times ``scale``) of the target value of a group; high is 1.1 x low."""
    value = al.cents(F.col("unit_price")) * F.col("sku_target")
    whole = dim.groupBy(*keys).agg(F.sum(value).alias("v"))
    people = F.posexplode(F.array(*[F.lit(p) for p in PEOPLE])).alias("i", "principal")
    low = F.expr(f"v * {scale} * (14 - i) div 175")
    return whole.select(*keys, "v", people).select(
        *keys, "principal", al.money_of(low).alias("low"), al.money_of(F.expr(f"(v * {scale} * (14 - i) div 175) * 11 div 10")).alias("high")
    )


def targets_sql(group, scale=1):
    return f"""goal AS (SELECT grp, i, 'a' || lpad((i + 1)::VARCHAR, 3, '0') AS principal, v * {scale} * (14 - i) // 175 AS low, (v * {scale} * (14 - i) // 175) * 11 // 10 AS high
      FROM (SELECT {group} AS grp, sum(price * sku_target)::BIGINT AS v FROM dim GROUP BY 1), range(0, 14) AS r(i)),
    opening AS (SELECT grp, list(low ORDER BY i) AS low, list(high ORDER BY i) AS high FROM goal GROUP BY 1)"""


# --- SQL twins of the ordered rounds ----------------------------------------

_FLAGS = "list_transform(range(1, 15), lambda i: list_contains(principals, 'a' || lpad(i::VARCHAR, 3, '0')))"


def queue_sql(name, source, group="brand", where="TRUE", units="units", order="priority DESC"):
    """A numbered queue of SKUs per group with responsibility flags ``m``."""
    return f"""{name} AS (SELECT sku, grp, row_number() OVER (PARTITION BY grp ORDER BY level, {order}, sku) AS rn, price,
      {units} AS units, {_FLAGS} AS m, len(principals) AS n FROM (SELECT *, {group} AS grp FROM {source}) WHERE {where})"""


def weighted_sql(name, queue, opening):
    return f"""{name} AS (
  SELECT grp, 0::BIGINT AS rn, NULL::BIGINT AS sku, low, high, NULL::BIGINT[] AS qty, 0::BIGINT AS units FROM {opening}
  UNION ALL
  SELECT grp, rn, sku,
    list_transform(low1, lambda v, i: CASE WHEN m[i] AND v > 0 THEN greatest(v - extra[i] * price, 0) ELSE v END),
    list_transform(high1, lambda v, i: CASE WHEN m[i] AND low1[i] > 0 THEN v - extra[i] * price ELSE v END),
    list_transform(extra, lambda e, i: CASE WHEN m[i] THEN base + e END), units
  FROM (SELECT *, list_transform(low1, lambda v, i: CASE WHEN NOT m[i] THEN NULL WHEN total = 0 THEN 0
                    ELSE round_even((units - base * n) * (v::DOUBLE / total::DOUBLE), 0)::BIGINT END) AS extra
    FROM (SELECT *, list_sum(list_transform(low1, lambda v, i: CASE WHEN m[i] THEN v ELSE 0 END))::BIGINT AS total
      FROM (SELECT *, list_transform(low0, lambda v, i: CASE WHEN m[i] AND v > 0 THEN greatest(v - base * price, 0) ELSE v END) AS low1,
                   list_transform(high0, lambda v, i: CASE WHEN m[i] AND low0[i] > 0 THEN v - base * price ELSE v END) AS high1
        FROM (SELECT q.*, w.low AS low0, w.high AS high0, round_even((q.units // q.n) * 0.2::DOUBLE, 0)::BIGINT AS base
              FROM {name} w JOIN {queue} q ON q.grp = w.grp AND q.rn = w.rn + 1)))))"""


def even_sql(name, queue, opening, who="all", by_high=True, clamp=False):
    tie = "high0[j] > high0[i] OR (high0[j] = high0[i] AND j < i)" if by_high else "j < i"
    people = {"all": "n", "unmet": "CASE WHEN open = 0 THEN n ELSE open END", "unmet_only": "open"}[who]
    none = "NULL" if who == "unmet_only" else "0"
    low, high = ("greatest(v - coalesce(dealt[i], 0) * price, 0)", "greatest(v - coalesce(dealt[i], 0) * price, 0)") if clamp else (
        "v - coalesce(dealt[i], 0) * price", "v - coalesce(dealt[i], 0) * price")
    kept = "CASE WHEN high0[i] - d * price <= 0 THEN NULL ELSE d END" if clamp else "d"
    return f"""{name} AS (
  SELECT grp, 0::BIGINT AS rn, NULL::BIGINT AS sku, low, high, NULL::BIGINT[] AS qty, 0::BIGINT AS units FROM {opening}
  UNION ALL
  SELECT grp, rn, sku, list_transform(low0, lambda v, i: CASE WHEN m[i] THEN {low} ELSE v END),
    list_transform(high0, lambda v, i: CASE WHEN m[i] THEN {high} ELSE v END),
    list_transform(dealt, lambda d, i: {kept}), units
  FROM (SELECT *, list_transform(place, lambda p, i: CASE WHEN NOT m[i] THEN NULL WHEN p > people THEN {none}
                 ELSE greatest(units, 0) // people + CASE WHEN p <= greatest(units, 0) % people THEN 1 ELSE 0 END END) AS dealt
    FROM (SELECT *, {people} AS people
      FROM (SELECT *, list_sum(list_transform(low0, lambda v, i: CASE WHEN m[i] AND v > 0 THEN 1 ELSE 0 END))::BIGINT AS open,
          list_transform(range(1, 15), lambda i: 1 + list_sum(list_transform(range(1, 15), lambda j:
              CASE WHEN m[j] AND (low0[j] > low0[i] OR (low0[j] = low0[i] AND ({tie}))) THEN 1 ELSE 0 END))::BIGINT) AS place
        FROM (SELECT q.*, w.low AS low0, w.high AS high0 FROM {name} w JOIN {queue} q ON q.grp = w.grp AND q.rn = w.rn + 1)))))"""


def final_sql(name, source):
    """State after the last SKU of each group."""
    return f"{name} AS (SELECT grp, low, high FROM {source} QUALIFY row_number() OVER (PARTITION BY grp ORDER BY rn DESC) = 1)"


def rows_sql(name, source):
    """Dealt SKUs with their total."""
    return f"""{name} AS (SELECT *, coalesce(list_sum(qty), 0)::BIGINT AS assigned FROM {source} WHERE rn > 0)"""


def cells_sql(source, where="TRUE"):
    return f"""SELECT sku, 'a' || lpad(i::VARCHAR, 3, '0') AS principal, qty[i] AS qty
      FROM {source}, range(1, 15) AS r(i) WHERE qty[i] IS NOT NULL AND {where}"""


KEEP4 = "CASE WHEN forecast = 0 THEN sku_target * 4 ELSE forecast * 4 END"


def first_sql(group="brand", scale=1):
    return ", ".join([
        DIM_SQL, targets_sql(group, scale), queue_sql("q1", "dim", group, "len(principals) > 0", "sku_target", "sku_target DESC"),
        weighted_sql("w1", "q1", "opening"), final_sql("s1", "w1"), rows_sql("r1", "w1"),
        """given1 AS (SELECT d.*, coalesce(r.assigned, 0) AS assigned, r.qty FROM dim d LEFT JOIN r1 r ON r.sku = d.sku)""",
    ])


SURPLUS_SQL = f"""surplus AS (SELECT *, CASE WHEN priority > sku_target THEN sku_target ELSE priority END AS units FROM (
  SELECT *, stock - assigned - {KEEP4} AS priority FROM given1) WHERE priority > 0)"""
COVERAGE_SQL = f"""coverage AS (SELECT *, priority AS units FROM (SELECT *, stock - assigned - {KEEP4} AS priority FROM given1)
  WHERE sku_target <> 0 AND stock / sku_target > 5)"""
AVAILABLE_SQL = """available AS (SELECT *, avail - forecast AS priority, avail - forecast AS units FROM (
  SELECT *, stock - sku_target + (sku_target - assigned) - len(list_filter(qty, lambda q: q = 0)) AS avail FROM given1
  WHERE stock <> 0 AND len(list_filter(qty, lambda q: q = 0)) > 0) WHERE avail > 0 AND avail - forecast > 0)"""


def third_sql(scale=1):
    """Version three up to the forced fifth: rounds r1, r3 (levels below 6), r2 (level 6)."""
    return ", ".join([
        first_sql(scale=scale), SURPLUS_SQL,
        queue_sql("q3", "surplus", where="level <> 6 AND len(principals) > 0"), even_sql("w3", "q3", "s1", "unmet"), final_sql("s3", "w3"), rows_sql("r3", "w3"),
        queue_sql("q2", "surplus", where="level = 6 AND len(principals) > 0"), even_sql("w2", "q2", "s3", "all"), final_sql("s2", "w2"), rows_sql("r2", "w2"),
        """given3 AS (SELECT d.* EXCLUDE (assigned), d.assigned + coalesce(r3.assigned, 0) + coalesce(r2.assigned, 0) AS assigned
           FROM given1 d LEFT JOIN r3 ON r3.sku = d.sku LEFT JOIN r2 ON r2.sku = d.sku)""",
        """fifth AS (SELECT *, priority AS units FROM (SELECT *, round(stock / 5)::BIGINT - assigned AS priority FROM given3) WHERE priority > 0)""",
    ])


def last_sql(soft):
    where = "len(principals) > 0" + (" AND stock - assigned - 4 * forecast > 0" if soft else "")
    return ", ".join([
        third_sql(SOFT_SCALE if soft else 1), queue_sql("q4", "fifth", where=where),
        even_sql("w4", "q4", "s2", "unmet_only" if soft else "all", by_high=False), final_sql("s4", "w4"), rows_sql("r4", "w4"),
    ])


def attainment_sql(state):
    return f"""SELECT g.grp, g.principal, g.low / 100.0::DOUBLE AS low, g.high / 100.0::DOUBLE AS high, s.low[i + 1] / 100.0::DOUBLE AS low_left,
      s.high[i + 1] / 100.0::DOUBLE AS high_left FROM goal g JOIN {state} s USING (grp)"""


# --- Spark side -------------------------------------------------------------


TERRITORY = ["brand"]


def first_round(spark, sf_dir, scale=1):
    dim = staged(sku_dim(spark, sf_dir), "dim")
    goal = staged(targets(dim, TERRITORY, scale), "targets")
    assigned, state = al.allocate_targets(dim, goal, TERRITORY)
    return dim, goal, assigned, state


def surplus_rounds(spark, sf_dir, scale=1):
    dim, goal, first, state = first_round(spark, sf_dir, scale=scale)
    surplus = al.residual(first, "surplus")
    third, state = al.allocate_round(surplus.where(F.col("level") != al.NEW_LEVEL), state, TERRITORY, "unmet")
    second, state = al.allocate_round(surplus.where(F.col("level") == al.NEW_LEVEL), state, TERRITORY, "all")
    return dim, goal, first, second, third, state


def last_round(spark, sf_dir, soft):
    dim, goal, first, second, third, state = surplus_rounds(spark, sf_dir, SOFT_SCALE if soft else 1)
    rest = al.residual(first, "fifth", (second, third), soft, partition_cols=TERRITORY)
    return goal, *al.allocate_round(rest, state, TERRITORY, "unmet_only" if soft else "all", by_high=False)


def first_version(spark, sf_dir, scale=1):
    dim, goal, first, state = first_round(spark, sf_dir, scale)
    ones, state = al.allocate_one_each(first, state, TERRITORY)
    state = staged(state, "state")
    return goal, first, ones, *al.allocate_round(al.available_stock(first), state, TERRITORY, "all", clamp=True)


def _dealt(assigned):
    return al.cells(assigned).where(F.col("qty").isNotNull())


def _matrix(spark, sf_dir):
    return al.principal_matrix(sku_dim(spark, sf_dir), PEOPLE)


def _principal_texts(spark, sf_dir):
    """From the matrix to a list, to comma text and back."""
    listed = al.principal_list(_matrix(spark, sf_dir).drop("principals"), PEOPLE)
    text = tx.comma_list(F.col("principals"))
    return listed.withColumns({"text": text, "clean": tx.drop_trailing_commas(text)}).withColumn(
        "n", F.size(F.split("clean", ","))
    )


def _combined(spark, sf_dir):
    """Cells of three rounds added per person, NULL where nobody is responsible."""
    dim, _, first, second, third, _ = surplus_rounds(spark, sf_dir)

    def wide(assigned, suffix):
        m = al.principal_matrix(assigned, PEOPLE, "qty")
        return m.select("sku", *[F.col(p).alias(f"{p}_{suffix}") for p in PEOPLE])

    joined = wide(first, "x").join(wide(second, "y"), "sku", "left").join(wide(third, "z"), "sku", "left")
    joined = joined.join(dim.select("sku", "level", "forecast"), "sku", "left")
    both = joined.withColumns({p: num.cell_sum(F.col(f"{p}_x"), F.col(f"{p}_y"), F.col(f"{p}_z")) for p in PEOPLE})
    return both.withColumn("total", num.row_total(PEOPLE)).withColumn(
        "cells", F.concat_ws(",", *[F.coalesce(F.col(p).cast("string"), F.lit("-")) for p in PEOPLE])
    )


def _zero_cells(spark, sf_dir):
    _, _, first, _ = first_round(spark, sf_dir)
    return al.principal_matrix(first, PEOPLE, "qty").where(num.any_zero(PEOPLE) & (F.col("stock") != 0))


def _null_cells(spark, sf_dir):
    """How many SKUs each person is and is not responsible for."""
    wide = _matrix(spark, sf_dir).unpivot("sku", PEOPLE, "principal", "cell")
    return wide.groupBy("principal").agg(
        F.count_if(F.col("cell").isNull()).alias("not_responsible"), F.count_if(F.col("cell").isNotNull()).alias("responsible")
    )


def _listed_people(spark, sf_dir):
    """People of a SKU's list who have a target, with that target."""
    dim = sku_dim(spark, sf_dir)
    listed = dim.select("sku", F.explode("principals").alias("principal"))
    return listed.join(targets(dim, []), "principal").select("sku", "principal", "low")


def _ranked_people(spark, sf_dir):
    """Each SKU's people by remaining low, then high, target after the first round."""
    _, _, first, state = first_round(spark, sf_dir)
    rows = al.cells(first, "brand").join(state, ["brand", "principal"])
    by = Window.partitionBy("sku").orderBy(F.col("low").desc(), F.col("high").desc(), "principal")
    return rows.withColumn("place", F.row_number().over(by))


def _ordered_surplus(spark, sf_dir):
    """Surplus rows in serving order: level up, residual down."""
    _, _, first, _ = first_round(spark, sf_dir)
    return al.residual(first, "surplus").orderBy("level", F.col("priority").desc(), "sku")


def _sorted_lists(spark, sf_dir):
    _, _, first, _ = first_round(spark, sf_dir)
    return first.select("sku", F.array_join(F.transform(F.sort_array("qty", asc=False), lambda q: q.cast("string")), ",").alias("quantities"))


def _first_residual(rule, extra=None):
    def build(spark, sf_dir):
        _, _, first, _ = first_round(spark, sf_dir)
        return al.residual(first, rule)
    return build


def _available(spark, sf_dir):
    _, _, first, _ = first_round(spark, sf_dir)
    return al.available_stock(first)


def _fifths(spark, sf_dir, soft):
    _, _, first, second, third, _ = surplus_rounds(spark, sf_dir)
    return al.residual(first, "fifth", (second, third), soft, partition_cols=TERRITORY)


def _second_version(spark, sf_dir):
    _, _, first, state = first_round(spark, sf_dir, scale=CLAMP_SCALE)
    return al.allocate_round(al.residual(first, "coverage"), state, TERRITORY, "all", clamp=True)


def _clamped_state(spark, sf_dir):
    """What is left to each person after the clamped round; people served 0 units are clamped too."""
    return _second_version(spark, sf_dir)[1]


def _by_brand(spark, sf_dir):
    _, _, first, _ = first_round(spark, sf_dir)
    return _dealt(first)


def _brand_attainment(spark, sf_dir):
    _, goal, _, state = first_round(spark, sf_dir)
    return al.target_attainment(state, goal, TERRITORY)


def _final_attainment(spark, sf_dir):
    goal, _, state = last_round(spark, sf_dir, soft=False)
    return al.target_attainment(state, goal, TERRITORY)


CELLS = "sku:l principal:s qty:l"
LEFT = "principal:s low:d2 high:d2 low_left:d2 high_left:d2"
REST = "sku:l level:l priority:l units:l"
R = "WITH RECURSIVE "
_CELL_LIST = "list_transform(range(1, 15), lambda i: {e})"


QUERIES = {
    "principal_matrix": Query(
        _matrix, "sku:l " + " ".join(f"{p}:d0" for p in PEOPLE),
        f"WITH {DIM_SQL} SELECT sku, " + ", ".join(f"CASE WHEN list_contains(principals, '{p}') THEN 0 END AS {p}" for p in PEOPLE) + " FROM dim",
    ),
    "principal_list": Query(
        _principal_texts, "sku:l text:s clean:s n:l",
        f"WITH {DIM_SQL} SELECT sku, array_to_string(principals, ',') || ',' AS text, array_to_string(principals, ',') AS clean, len(principals) AS n FROM dim",
    ),
    "responsibility_counts": Query(
        _null_cells, "principal:s not_responsible:l responsible:l",
        f"""WITH {DIM_SQL} SELECT 'a' || lpad(i::VARCHAR, 3, '0') AS principal,
            count(*) FILTER (NOT list_contains(principals, 'a' || lpad(i::VARCHAR, 3, '0'))) AS not_responsible,
            count(*) FILTER (list_contains(principals, 'a' || lpad(i::VARCHAR, 3, '0'))) AS responsible FROM dim, range(1, 15) AS r(i) GROUP BY 1""",
    ),
    "listed_people_targets": Query(
        _listed_people, "sku:l principal:s low:d2",
        f"WITH {DIM_SQL}, {targets_sql('0')} SELECT sku, principal, low / 100.0::DOUBLE AS low FROM (SELECT sku, unnest(principals) AS principal FROM dim) JOIN goal USING (principal)",
    ),
    "base_share": Query(
        lambda s, d: al.base_share(sku_dim(s, d)), CELLS,
        f"WITH {DIM_SQL} SELECT sku, unnest(principals) AS principal, round_even((sku_target // len(principals)) * 0.2::DOUBLE, 0) AS qty FROM dim",
    ),
    "gradient_split": Query(
        lambda s, d: al.gradient_split(sku_dim(s, d), "stock"), CELLS,
        f"""WITH {DIM_SQL} SELECT sku, principals[i] AS principal, stock // n + CASE WHEN i <= stock % n THEN 1 ELSE 0 END AS qty
            FROM (SELECT *, len(principals) AS n FROM dim), range(1, 15) AS r(i) WHERE i <= n""",
    ),
    "allocate_targets": Query(lambda s, d: _dealt(first_round(s, d)[2]), CELLS, f"{R}{first_sql()} {cells_sql('r1')}"),
    "allocate_targets_leftover": Query(
        lambda s, d: first_round(s, d)[2], "sku:l sku_target:l assigned:l leftover:l",
        f"{R}{first_sql()} SELECT sku, sku_target, assigned, sku_target - assigned AS leftover FROM given1",
    ),
    "allocate_targets_by_brand": Query(_by_brand, CELLS, f"{R}{first_sql('brand')} {cells_sql('r1')}"),
    "target_attainment_by_brand": Query(
        _brand_attainment, "brand:s " + LEFT,
        f"{R}{first_sql('brand')} SELECT *, grp AS brand FROM ({attainment_sql('s1')})",
    ),
    "allocate_one_each": Query(
        lambda s, d: _dealt(first_version(s, d)[2]), CELLS,
        f"{R}{first_sql()} SELECT sku, principal, 1 AS qty FROM ({cells_sql('given1', 'stock <> 0')}) WHERE qty = 0",
    ),
    "available_stock": Query(
        _available, REST + " available:l", f"{R}{first_sql()}, {AVAILABLE_SQL} SELECT *, avail AS available FROM available",
    ),
    "allocate_clamped_first_version": Query(
        lambda s, d: _dealt(first_version(s, d, CLAMP_SCALE)[3]), CELLS,
        f"""{R}{first_sql(scale=CLAMP_SCALE)}, {AVAILABLE_SQL}, ones AS (SELECT brand AS grp, i, sum(price)::BIGINT AS paid FROM given1, range(1, 15) AS r(i)
              WHERE stock <> 0 AND list_contains(principals, 'a' || lpad(i::VARCHAR, 3, '0')) AND qty[i] = 0 GROUP BY 1, 2),
            s0 AS (SELECT grp, list(greatest(low[i] - coalesce(paid, 0), 0) ORDER BY i) AS low, list(high[i] - coalesce(paid, 0) ORDER BY i) AS high
              FROM (SELECT * FROM s1, range(1, 15) AS r(i)) LEFT JOIN ones USING (grp, i) GROUP BY 1),
            {queue_sql("q9", "available", order="priority DESC, avail DESC")}, {even_sql("w9", "q9", "s0", "all", clamp=True)}, {rows_sql("r9", "w9")}
            {cells_sql("r9")}""",
    ),
    "allocate_clamped": Query(
        lambda s, d: _dealt(_second_version(s, d)[0]), CELLS,
        f"""{R}{first_sql(scale=CLAMP_SCALE)}, {COVERAGE_SQL}, {queue_sql("q9", "coverage", where="len(principals) > 0")},
            {even_sql("w9", "q9", "s1", "all", clamp=True)}, {rows_sql("r9", "w9")} {cells_sql("r9")}""",
    ),
    "residual_surplus": Query(_first_residual("surplus"), REST, f"{R}{first_sql()}, {SURPLUS_SQL} SELECT * FROM surplus"),
    "residual_coverage": Query(_first_residual("coverage"), REST, f"{R}{first_sql()}, {COVERAGE_SQL} SELECT * FROM coverage"),
    "residual_target": Query(
        _first_residual("target"), REST,
        f"{R}{first_sql()} SELECT *, sku_target - assigned AS priority, sku_target - assigned AS units FROM given1 WHERE sku_target - assigned > 0",
    ),
    "residual_fifth": Query(lambda s, d: _fifths(s, d, False), REST, f"{R}{third_sql()} SELECT * FROM fifth"),
    "residual_fifth_soft": Query(
        lambda s, d: _fifths(s, d, True), REST, f"{R}{third_sql()} SELECT * FROM fifth WHERE stock - assigned - 4 * forecast > 0"
    ),
    "ordered_surplus": Query(_ordered_surplus, REST, f"{R}{first_sql()}, {SURPLUS_SQL} SELECT * FROM surplus"),
    "allocate_surplus_unmet": Query(lambda s, d: _dealt(surplus_rounds(s, d)[4]), CELLS, f"{R}{third_sql()} {cells_sql('r3')}"),
    "allocate_surplus_even": Query(lambda s, d: _dealt(surplus_rounds(s, d)[3]), CELLS, f"{R}{third_sql()} {cells_sql('r2')}"),
    "allocate_fifth": Query(lambda s, d: _dealt(last_round(s, d, False)[1]), CELLS, f"{R}{last_sql(False)} {cells_sql('r4')}"),
    "allocate_fifth_soft": Query(lambda s, d: _dealt(last_round(s, d, True)[1]), CELLS, f"{R}{last_sql(True)} {cells_sql('r4')}"),
    "target_attainment": Query(_final_attainment, "brand:s " + LEFT, f"{R}{last_sql(False)} SELECT *, grp AS brand FROM ({attainment_sql('s4')})"),
    "clamped_state": Query(
        _clamped_state, "brand:s principal:s low:l high:l",
        f"""{R}{first_sql(scale=CLAMP_SCALE)}, {COVERAGE_SQL}, {queue_sql("q9", "coverage", where="len(principals) > 0")},
            {even_sql("w9", "q9", "s1", "all", clamp=True)}, {final_sql("s9", "w9")}
            SELECT grp AS brand, 'a' || lpad(i::VARCHAR, 3, '0') AS principal, low[i] AS low, high[i] AS high FROM s9, range(1, 15) AS r(i)""",
    ),
    "combined_rounds": Query(
        _combined, "sku:l level:l forecast:l total:l cells:s",
        f"""{R}{third_sql()} SELECT d.sku, level, forecast, assigned AS total, array_to_string(list_transform(range(1, 15), lambda i:
              CASE WHEN d.qty[i] IS NULL THEN '-' ELSE (d.qty[i] + coalesce(r2.qty[i], 0) + coalesce(r3.qty[i], 0))::VARCHAR END), ',') AS cells
            FROM (SELECT d.* EXCLUDE (qty), g.qty FROM given3 d JOIN given1 g USING (sku)) d LEFT JOIN (SELECT sku, qty FROM r2) r2 ON r2.sku = d.sku LEFT JOIN (SELECT sku, qty FROM r3) r3 ON r3.sku = d.sku""",
    ),
    "zero_cell_skus": Query(
        _zero_cells, "sku:l stock:l",
        f"{R}{first_sql()} SELECT sku, stock FROM given1 WHERE stock <> 0 AND len(list_filter(qty, lambda q: q = 0)) > 0",
    ),
    "ranked_people": Query(
        _ranked_people, "sku:l principal:s place:l",
        f"""{R}{first_sql()} SELECT sku, principal, row_number() OVER (PARTITION BY sku ORDER BY low DESC, high DESC, principal) AS place
            FROM (SELECT r.sku, 'a' || lpad(i::VARCHAR, 3, '0') AS principal, s1.low[i] AS low, s1.high[i] AS high
                  FROM r1 r JOIN s1 USING (grp), range(1, 15) AS x(i) WHERE r.qty[i] IS NOT NULL)""",
    ),
    "sorted_quantities": Query(
        _sorted_lists, "sku:l quantities:s",
        f"{R}{first_sql()} SELECT sku, array_to_string(list_reverse_sort(list_filter(qty, lambda q: q IS NOT NULL)), ',') AS quantities FROM given1",
    ),
}
