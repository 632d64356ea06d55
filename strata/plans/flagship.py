"""The flagship panel query.

orders -> one row per (customer, year) with the total, the status-F
total and the per-priority totals in ONE aggregation (conditional sums
are what a pivot compiles to) -> winning priority (row-wise arg-max) ->
nearest year in which the customer had status-F orders, carrying that
year's F ratio (nearest-period join, fill form) -> sigma band of the
yearly total -> per winning priority: count and share of each band,
with the average carried ratio and period gap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.columns import columns_with_prefix
from strata.functions.numbers import money, money_sum, ratio, row_sum
from strata.operators.nearest import nearest_join
from strata.operators.reshape import allocate_columns, discover_values, panel_sum, pivot_discovered
from strata.operators.stats import fround, sigma_bands
from strata.operators.winner import winner_wide
from strata.plans.common import MONEY, orders_by_year
from strata.session import materialize

KEYS = ["o_custkey", "year"]


def yearly_panel(spark: SparkSession, sf: str) -> DataFrame:
    """(customer, year, total_price, n_orders, f_total, f_ratio, winner)."""
    o = orders_by_year(spark, sf, "o_orderstatus", "o_orderpriority")
    prios = [v for v in discover_values(o, "o_orderpriority") if v is not None]     # a null label wins nothing
    price = money("o_totalprice")
    aggs = [money_sum("o_totalprice").alias("total_price"), F.count(F.lit(1)).alias("n_orders"),
            F.sum(F.when(F.col("o_orderstatus") == "F", price)).cast("double").alias("f_total")]
    aggs += [F.sum(F.when(F.col("o_orderpriority") == v, price)).cast("double").alias(v)
             for v in prios]
    p = o.groupBy(*KEYS).agg(*aggs)
    p = winner_wide(p, prios, "winner", None)
    return p.select(*KEYS, "total_price", "n_orders", "f_total",
                    ratio("f_total", "total_price").alias("f_ratio"), "winner")


def enriched_panel(spark: SparkSession, sf: str, form: str = "fill", panel: DataFrame | None = None) -> DataFrame:
    """Panel rows with the nearest F-year (``near_period``) and its ratio.

    The yearly panel feeds several consumers (probes, right side, bucket
    summary, main rows, band statistics).  It is written once as a table
    in the shared checkpoint folder instead of re-scanning and
    re-aggregating orders for each consumer; it has one row per
    (customer, year), far fewer than orders."""
    p = panel if panel is not None else materialize(yearly_panel(spark, sf), "yearly_panel")
    right = p.where(F.col("f_total") > 0).select("o_custkey", F.col("year").alias("f_year"), "f_ratio")
    # periods are years: one-year buckets, no range job; the panel is unique
    # per (customer, year), so its rows go through the window themselves
    # (no distinct probes, no join back)
    fill = form == "fill"
    return nearest_join(p, right, ["o_custkey"], "year", "f_year", ["f_ratio"], form=form,
                        prefix="near_", bucket_width=1 if fill else None,
                        probe_rows="rows" if fill else "distinct")


def q_panel_flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: band shares per winning priority over the enriched panel."""
    p = materialize(yearly_panel(spark, sf), "yearly_panel")
    # one enriched row per panel row: the band statistics come from the table
    b = sigma_bands(enriched_panel(spark, sf, panel=p), "total_price", stats_from=p)
    g = b.groupBy("winner", "band").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("near_f_ratio").alias("avg_f_ratio"),
        F.avg(F.abs(F.col("year") - F.col("near_period"))).alias("avg_gap"))
    g = g.withColumn("total", F.sum("count").over(Window.partitionBy("winner")))
    return g.select("winner", "band", "count", "total",
                    fround(F.col("count") / F.col("total") * 100, 2).alias("pct"),
                    fround("avg_f_ratio", 6).alias("avg_f_ratio"),
                    fround("avg_gap", 6).alias("avg_gap"))


def q_subcat_features(spark: SparkSession, sf: str) -> DataFrame:
    """The subcategory feature table (A4, P3, F4, J1, P10, C15): priority
    sums pivoted with cleaned ``Part_`` names, a ``Part_Total`` total,
    inner-joined to the yearly panel (both sides aggregated on the same
    keys, so the join adds no exchange), each part turned into its share of
    the price per order, absolute parts dropped."""
    o = orders_by_year(spark, sf, "o_orderpriority")
    piv = pivot_discovered(o, KEYS, "o_orderpriority", "o_totalprice", prefix="Part_", exact_money=MONEY)
    parts = columns_with_prefix(piv, "Part_")
    piv = piv.withColumn("Part_Total", row_sum(parts))
    panel = panel_sum(o, KEYS, "o_totalprice", "total_price", exact_money=MONEY, count_col="n_orders")
    j = panel.join(piv, KEYS, "inner").where(F.col("total_price").isNotNull())
    j = j.withColumn("price_per_order", ratio("total_price", "n_orders"))
    a = allocate_columns(j, columns_with_prefix(j, "Part_", ["Part_Total"]), "Part_Total",
                         "price_per_order", suffix="_share", drop_parts=True)
    pcs = [c for c in a.columns if c.endswith("_share")]
    return a.select(*KEYS, fround("price_per_order", 6).alias("price_per_order"),
                    *[fround(c, 6).alias(c) for c in pcs])


def q_entity_wins(spark: SparkSession, sf: str) -> DataFrame:
    """A6 per label: in how many years each priority won for
    each customer, next to the number of years with orders."""
    p = yearly_panel(spark, sf)
    w = p.groupBy("o_custkey", "winner").agg(F.count(F.lit(1)).alias("n_wins"))
    return w.withColumn("n_years", F.sum("n_wins").over(Window.partitionBy("o_custkey")))


QUERIES = {"panel_flagship": q_panel_flagship, "subcat_features": q_subcat_features,
           "entity_wins": q_entity_wins}


def _fr(x, p):
    return f"(floor(({x}) * {float(10 ** p)} + 0.5) / {float(10 ** p)})"


ORACLE = {
    "panel_flagship": f"""
WITH base AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, o_orderpriority,
         CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
p AS (
  SELECT o_custkey, year, CAST(SUM(price) AS DOUBLE) AS total_price,
         CAST(SUM(price) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS f_total
  FROM base GROUP BY 1, 2),
pr AS (SELECT o_custkey, year, o_orderpriority AS prio, SUM(price) AS s FROM base GROUP BY 1, 2, 3),
w AS (SELECT o_custkey, year, prio AS winner FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, year ORDER BY s DESC, prio) AS rn FROM pr)
      WHERE rn = 1),
pw AS (SELECT p.*, p.f_total / NULLIF(p.total_price, 0) AS f_ratio, w.winner
       FROM p JOIN w USING (o_custkey, year)),
r AS (SELECT o_custkey, year AS f_year, f_ratio FROM pw WHERE f_total > 0),
nn AS (SELECT pw.o_custkey, pw.year, r.f_year, r.f_ratio AS near_f_ratio,
              row_number() OVER (PARTITION BY pw.o_custkey, pw.year
                                 ORDER BY abs(pw.year - r.f_year), r.f_year DESC) AS rn
       FROM pw JOIN r ON pw.o_custkey = r.o_custkey),
e AS (SELECT pw.*, nn.f_year AS near_period, nn.near_f_ratio
      FROM pw LEFT JOIN (SELECT * FROM nn WHERE rn = 1) nn USING (o_custkey, year)),
s AS (SELECT avg(total_price) AS m, stddev_samp(total_price) AS sd FROM e),
b AS (SELECT e.*,
        CASE WHEN e.total_price - s.m IS NULL OR s.sd IS NULL THEN NULL
             WHEN abs(e.total_price - s.m) <= s.sd THEN 'Near Mean'
             WHEN e.total_price - s.m > s.sd AND e.total_price - s.m <= 2 * s.sd THEN 'Moderate High'
             WHEN e.total_price - s.m < -s.sd AND e.total_price - s.m >= -2 * s.sd THEN 'Moderate Low'
             WHEN e.total_price - s.m > 2 * s.sd THEN 'Extreme High'
             ELSE 'Extreme Low' END AS band
      FROM e, s),
g AS (SELECT winner, band, COUNT(*) AS count, avg(near_f_ratio) AS avg_f_ratio,
             avg(abs(year - near_period)) AS avg_gap FROM b GROUP BY 1, 2)
SELECT winner, band, count, CAST(SUM(count) OVER (PARTITION BY winner) AS BIGINT) AS total,
       {_fr('count / SUM(count) OVER (PARTITION BY winner) * 100', 2)} AS pct,
       {_fr('avg_f_ratio', 6)} AS avg_f_ratio, {_fr('avg_gap', 6)} AS avg_gap
FROM g
""",
}

_SUBCATS = [('1-URGENT', 'Part_1_URGENT'), ('2-HIGH', 'Part_2_HIGH'), ('3-MEDIUM', 'Part_3_MEDIUM'), ('4-NOT SPECIFIED', 'Part_4_NOT_SPECIFIED'), ('5-LOW', 'Part_5_LOW')]

_SUBCAT_SUMS = ",\n".join(
    f"  COALESCE(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderpriority = '{v}') AS DOUBLE), 0.0) AS {n}"
    for v, n in _SUBCATS)

ORACLE["subcat_features"] = f"""
WITH piv AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
{_SUBCAT_SUMS}
  FROM orders GROUP BY 1, 2),
tot AS (SELECT *, {' + '.join(n for _, n in _SUBCATS)} AS summe FROM piv),
pan AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
          CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price, COUNT(*) AS n_orders
        FROM orders GROUP BY 1, 2),
j AS (SELECT pan.*, tot.* EXCLUDE (o_custkey, year), pan.total_price / pan.n_orders AS ppo
      FROM pan JOIN tot USING (o_custkey, year))
SELECT o_custkey, year, {_fr('ppo', 6)} AS price_per_order,
""" + ",\n".join(f"  {_fr(f'CASE WHEN summe = 0 THEN 0.0 ELSE {n} / summe * ppo END', 6)} AS {n}_share"
                  for _, n in _SUBCATS) + """
FROM j
"""

ORACLE["entity_wins"] = """
WITH pr AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS prio,
                   SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s FROM orders GROUP BY 1, 2, 3),
w AS (SELECT o_custkey, year, prio AS winner FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, year ORDER BY s DESC, prio) AS rn FROM pr)
      WHERE rn = 1),
c AS (SELECT o_custkey, winner, COUNT(*) AS n_wins FROM w GROUP BY 1, 2)
SELECT *, CAST(SUM(n_wins) OVER (PARTITION BY o_custkey) AS BIGINT) AS n_years FROM c
"""

