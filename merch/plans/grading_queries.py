"""Grading queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from merch.operators import grading as g
from merch.plans import binding as b
from merch.plans.query import Query
from merch.session import staged

NON_BRAND = "red%"


def _non_brand():
    return F.col("name").ilike(NON_BRAND)


def _metrics(spark, sf_dir):
    """Staged, because grading reads the SKU sums several times but the lines only once."""
    return staged(b.metrics(spark, sf_dir), "metrics")


def _earning(spark, sf_dir):
    return _metrics(spark, sf_dir).where("profit > 0")


def _scored(spark, sf_dir):
    earning = _earning(spark, sf_dir)
    return g.sku_score(earning, g.entropy_weights(earning))


def _pooled(spark, sf_dir):
    return g.grade_pools(_scored(spark, sf_dir), b.SPECIAL, _non_brand())


def sku_grade(spark, sf_dir):
    return g.sku_grade(
        _metrics(spark, sf_dir), b.new_skus(spark, sf_dir), b.START, b.END, special=b.SPECIAL, non_brand=_non_brand()
    )


METRICS = f"metrics AS ({b.METRICS_SQL}), earning AS (SELECT * FROM metrics WHERE profit > 0)"

_SHARES = ", ".join(
    f"CASE WHEN {m} = 0 THEN 1e-10 ELSE {m}::DOUBLE / sum({m}::DOUBLE) OVER () END AS p_{m}" for m in g.MEASURES
)
_ENTROPIES = ", ".join(f"1 + sum(CASE WHEN p_{m} > 0 THEN p_{m} * ln(p_{m}) ELSE 0 END) / ln(count(*)) AS d_{m}" for m in g.MEASURES)
_WEIGHTS = ", ".join(f"d_{m} / (d_num + d_revenue + d_profit) AS w_{m}" for m in g.MEASURES)
WEIGHTS = f"""{METRICS}, shares AS (SELECT {_SHARES} FROM earning),
gains AS (SELECT {_ENTROPIES} FROM shares), weights AS (SELECT {_WEIGHTS} FROM gains)"""

_MMS = ", ".join(
    f"({m}::DOUBLE - min({m}::DOUBLE) OVER ()) / (max({m}::DOUBLE) OVER () - min({m}::DOUBLE) OVER ()) AS {m}_mms"
    for m in g.MEASURES
)
SCORED = f"""{WEIGHTS}, scaled AS (SELECT *, {_MMS} FROM earning),
scored AS (SELECT s.*, w_num * num_mms + w_revenue * revenue_mms + w_profit * profit_mms AS score
           FROM scaled s, weights)"""

_SPECIAL = ", ".join(f"'{t}'" for t in b.SPECIAL)
POOLED = f"""{SCORED}, typed AS (
  SELECT * EXCLUDE (type), CASE WHEN type IN ({_SPECIAL})
    THEN type || CASE WHEN name ILIKE '{NON_BRAND}' THEN '|other' ELSE '|brand' END ELSE type END AS type FROM scored),
pooled AS (
  SELECT *, CASE WHEN type LIKE '%|%' THEN type
                 WHEN type IS NOT NULL AND count(*) OVER (PARTITION BY type) >= 40 THEN type
                 ELSE '__rest__' END AS pool FROM typed)"""

LEVELED = f"""{POOLED},
run1 AS (SELECT *, sum(profit) OVER w AS acc, sum(profit) OVER (PARTITION BY pool) AS tot,
                row_number() OVER w AS place
         FROM pooled WINDOW w AS (PARTITION BY pool ORDER BY score DESC, sku
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
first_cut AS (SELECT *, acc <= 0.8 * tot AS in_first FROM run1),
run2 AS (SELECT *, sum(profit) OVER (PARTITION BY pool, in_first ORDER BY score DESC, sku
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc2,
                sum(profit) OVER (PARTITION BY pool, in_first) AS tot2 FROM first_cut),
leveled AS (SELECT *, CASE WHEN in_first THEN 1 WHEN acc2 <= 0.8 * tot2 THEN 2 ELSE 3 END AS level FROM run2)"""

GRADED = f"""{LEVELED}, fresh AS ({b.NEW_SKU_SQL}),
losing AS (SELECT *, CASE WHEN num < avg(num) OVER () THEN 5 ELSE 4 END AS level FROM metrics WHERE profit < 0),
graded AS (
  SELECT sku, level, type, pool, num, revenue, profit, score FROM leveled WHERE sku NOT IN (SELECT sku FROM fresh)
  UNION ALL
  SELECT sku, level, type, NULL, num, revenue, profit, NULL FROM losing WHERE sku NOT IN (SELECT sku FROM fresh)
  UNION ALL
  SELECT sku, 6, NULL, NULL, NULL, NULL, NULL, NULL FROM fresh)"""


def _profit_by_sign(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    earning = m.where("profit > 0").withColumn("side", F.lit("gain"))
    return earning.unionByName(m.where("profit < 0").withColumn("side", F.lit("loss")))


def _level_sources(spark, sf_dir):
    """One table from three differently shaped inserts, with literal level and dates."""
    m = _metrics(spark, sf_dir)
    dates = {"start_date": F.lit(b.START).cast("date"), "end_date": F.lit(b.END).cast("date")}
    six = b.new_skus(spark, sf_dir).withColumn("level", F.lit(6))
    four = m.where("profit < 0").select("sku", F.lit(4).alias("level"), "type", *g.MEASURES)
    mixed = m.where("profit > 0").select("sku", F.lit(123).alias("level"), "type", *g.MEASURES)
    return (
        six.unionByName(four, allowMissingColumns=True).unionByName(mixed, allowMissingColumns=True).withColumns(dates)
    )


def _level_update(spark, sf_dir):
    """Rows whose SKU is in a second query's result are set to level 5."""
    m = _metrics(spark, sf_dir).where("profit < 0")
    weak = m.where(g.below_mean(m)).select("sku", F.lit(True).alias("_hit"))
    return m.join(weak, "sku", "left").select("sku", F.when(F.col("_hit"), 5).otherwise(4).alias("level"))


QUERIES = {
    "sku_grade": Query(
        sku_grade,
        "sku:l level:l type:s pool:s num:l profit:d2 score:d8",
        f"WITH {GRADED} SELECT * FROM graded",
    ),
    "sku_metrics": Query(b.metrics, "sku:l type:s num:l revenue:d2 profit:d2", b.METRICS_SQL),
    "entropy_weights": Query(
        lambda s, d: g.entropy_weights(_earning(s, d)),
        "w_num:d8 w_revenue:d8 w_profit:d8",
        f"WITH {WEIGHTS} SELECT * FROM weights",
    ),
    "column_shares": Query(
        lambda s, d: g.column_shares(_earning(s, d)), "sku:l p_num:d10 p_revenue:d10 p_profit:d10",
        f"WITH {METRICS}, shares AS (SELECT sku, {_SHARES} FROM earning) SELECT * FROM shares",
    ),
    "sku_score": Query(
        _scored,
        "sku:l num_mms:d8 revenue_mms:d8 profit_mms:d8 score:d8",
        f"WITH {SCORED} SELECT * FROM scored",
    ),
    "grade_pools": Query(_pooled, "sku:l type:s pool:s", f"WITH {POOLED} SELECT * FROM pooled"),
    "large_types": Query(
        lambda s, d: g.large_types(g.brand_type(_earning(s, d), b.SPECIAL, _non_brand()), b.SPECIAL),
        "type:s type_count:l",
        f"WITH {POOLED} SELECT type, count(*) AS type_count FROM typed WHERE type NOT LIKE '%|%' GROUP BY 1 HAVING count(*) >= 40",
    ),
    "pareto_levels": Query(
        lambda s, d: g.pareto_levels(_pooled(s, d)),
        "sku:l pool:s place:l acc:d2 tot:d2 level:l",
        f"WITH {LEVELED} SELECT * FROM leveled",
    ),
    "loss_levels": Query(
        lambda s, d: g.loss_levels(_metrics(s, d)), "sku:l level:l num:l", f"WITH {GRADED} SELECT * FROM losing"
    ),
    "profit_by_sign": Query(
        _profit_by_sign,
        "sku:l side:s profit:d2",
        f"WITH {METRICS} SELECT *, CASE WHEN profit > 0 THEN 'gain' ELSE 'loss' END AS side FROM metrics WHERE profit <> 0",
    ),
    "level_sources": Query(
        _level_sources,
        "sku:l level:l type:s profit:d2 start_date:s end_date:s",
        f"""WITH {METRICS} SELECT sku, level, type, profit, DATE '{b.START}' AS start_date, DATE '{b.END}' AS end_date FROM (
            SELECT sku, 6 AS level, NULL AS type, NULL AS profit FROM ({b.NEW_SKU_SQL})
            UNION ALL SELECT sku, 4, type, profit FROM metrics WHERE profit < 0
            UNION ALL SELECT sku, 123, type, profit FROM metrics WHERE profit > 0)""",
    ),
    "level_update_by_sku": Query(
        _level_update, "sku:l level:l", f"WITH {GRADED} SELECT sku, level FROM losing"
    ),
}
