"""Registered queries for statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.numbers import money, money_sum, row_sum
from strata.functions.text import slug
from strata.operators.inspect import distinct_values, profile, sample_rows, validate_keys
from strata.operators.joins import STRATEGIES, join_with_strategy
from strata.operators.reshape import allocate_columns, pivot_values
from strata.operators.stats import (box_outliers, box_stats, correlation_matrix, correlations, density_mode,
                                    distribution_stats, entity_profile, fround, histogram, kde,
                                    share_within_group, sigma_bands, trend_band, trend_line)
from strata.plans.common import MONEY
from strata.sources.tables import table


def q_share_within_group(spark: SparkSession, sf: str) -> DataFrame:
    """A7 + A8 + J6 + C19 + O1: status counts as % of each priority's total."""
    o = table(spark, sf, "orders", "o_orderpriority", "o_orderstatus")
    return share_within_group(o, "o_orderpriority", "o_orderstatus") \
        .orderBy("o_orderpriority", "o_orderstatus")


def _customer_totals(spark, sf):
    o = table(spark, sf, "orders", "o_custkey", "o_totalprice")
    return o.groupBy("o_custkey").agg(money_sum("o_totalprice").alias("total_price"))


def q_sigma_bands(spark: SparkSession, sf: str) -> DataFrame:
    """A9 + C16 + C17: customers banded by total spend at 1 and 2 sigma."""
    b = sigma_bands(_customer_totals(spark, sf), "total_price")
    return b.select("o_custkey", "total_price", fround("deviation", 6).alias("deviation"), "band")


def q_allocate_share(spark: SparkSession, sf: str) -> DataFrame:
    """C15 + P10: a customer's balance split over its status totals."""
    o = table(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_totalprice")
    parts = pivot_values(o, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], "o_totalprice",
                         "sum", names={"F": "Part_F", "O": "Part_O", "P": "Part_P"},
                         exact_money=MONEY)
    parts = parts.withColumn("Part_Total", row_sum(["Part_F", "Part_O", "Part_P"]))
    c = table(spark, sf, "customer", "c_custkey", "c_acctbal")
    j = parts.join(c, parts.o_custkey == c.c_custkey).drop("o_custkey")
    a = allocate_columns(j, ["Part_F", "Part_O", "Part_P"], "Part_Total", "c_acctbal")
    return a.select("c_custkey", *[fround(f"Part_{s}_alloc", 6).alias(f"Part_{s}_alloc")
                                   for s in "FOP"])


def _profile(spark, sf):
    """Per-customer profile in one aggregation: lines are counted per order
    first (partial aggregation), then one left join and one groupBy."""
    lines = table(spark, sf, "lineitem", "l_orderkey").groupBy("l_orderkey") \
        .agg(F.count(F.lit(1)).alias("n_lines"))
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    return entity_profile(j, "o_custkey",
                          avg_price=F.avg("o_totalprice"),
                          n_orders=F.count("o_orderkey"),
                          avg_lines=F.avg(F.coalesce(F.col("n_lines"), F.lit(0))))


def q_entity_profile(spark: SparkSession, sf: str) -> DataFrame:
    """A5 + A6 + J7."""
    p = _profile(spark, sf)
    return p.select("o_custkey", fround("avg_price", 6).alias("avg_price"), "n_orders",
                    fround("avg_lines", 6).alias("avg_lines"))


def _profile_with_balance(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    p = _profile(spark, sf)
    return p.join(c, p.o_custkey == c.c_custkey, "inner")


def q_correlations(spark: SparkSession, sf: str) -> DataFrame:
    """A10: four correlations over per-customer measures, pairwise complete."""
    return correlations(_profile_with_balance(spark, sf),
                        [("avg_price", "n_orders"), ("avg_price", "avg_lines"),
                         ("c_acctbal", "avg_price"), ("c_acctbal", "n_orders")])


MEASURES = ["avg_price", "n_orders", "avg_lines", "c_acctbal", "c_nationkey", "rare"]


def q_correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """A10: all pairs of six customer measures, one of them known only for
    customers with a balance below zero, per market segment."""
    c = table(spark, sf, "customer", "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    p = _profile(spark, sf)
    rows = p.join(c, p.o_custkey == c.c_custkey).withColumn("rare", F.when(F.col("c_acctbal") < 0, F.col("avg_price") - F.col("c_acctbal")))
    return correlation_matrix(rows, MEASURES, ["c_mktsegment"], 4)


def q_trend_line(spark: SparkSession, sf: str) -> DataFrame:
    """G1: OLS of average order price on account balance."""
    return trend_line(_profile_with_balance(spark, sf), "c_acctbal", "avg_price")


def q_trend_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """The same line per market segment."""
    return trend_line(_profile_with_balance(spark, sf), "c_acctbal", "avg_price",
                      groups=["c_mktsegment"])


def q_trend_band(spark: SparkSession, sf: str) -> DataFrame:
    """G1: fitted line and 95 % band of the mean at 20 grid points."""
    b = trend_band(_profile_with_balance(spark, sf), "c_acctbal", "avg_price", points=20)
    return b.select(F.col("i").cast("int").alias("i"),
                    *[fround(c, 6).alias(c) for c in ("x", "fit", "lower", "upper")])


def _events(spark, sf):
    return table(spark, sf, "events", "event_id", "event_type", "value")


def q_box_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Exact box summary of event values per type."""
    return box_stats(_events(spark, sf), "value", ["event_type"])


def q_box_stats_log(spark: SparkSession, sf: str) -> DataFrame:
    """The same on log10(value)."""
    return box_stats(_events(spark, sf), "value", ["event_type"], log10=True)


def q_box_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """The outlier rows themselves."""
    return box_outliers(_events(spark, sf), "value", ["event_type"], keep=["event_id"]) \
        .select("event_id", "event_type", "value")


def q_box_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """G3 with large groups: four prices of every line by return flag (half of
    the rows in one group, over 100,000 of them at sf0.01)."""
    price, net = F.col("l_extendedprice"), F.col("l_extendedprice") * (1 - F.col("l_discount"))
    rows = table(spark, sf, "lineitem", "l_returnflag", "l_extendedprice", "l_discount", "l_tax", "l_quantity")
    rows = rows.select("l_returnflag", F.explode(F.array(price, net, net * (1 + F.col("l_tax")), price / F.col("l_quantity"))).alias("value"))
    return box_stats(rows, "value", ["l_returnflag"], places=3)


def q_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """30 equal-width bins of event values."""
    h = histogram(_events(spark, sf), "value", 30)
    return h.select("bin", fround("bin_lo", 6).alias("bin_lo"), fround("bin_hi", 6).alias("bin_hi"),
                    "count")


def q_kde(spark: SparkSession, sf: str) -> DataFrame:
    """Binned Gaussian KDE, 200 bins x 200 grid points, Scott bandwidth."""
    return kde(_events(spark, sf), "value")


def q_kde_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    """A density per customer of its order prices in thousands, 50 bins x 20 grid points."""
    o = table(spark, sf, "orders", "o_custkey", "o_totalprice").withColumn("price", F.col("o_totalprice") / 1000)
    return kde(o, "price", 20, 50, ["o_custkey"])


def q_distribution_mode(spark: SparkSession, sf: str) -> DataFrame:
    """A14 with the mode: mean and the density peak of event values."""
    e = _events(spark, sf)
    m = density_mode(kde(e, "value"))
    return m.crossJoin(F.broadcast(e.agg(fround(F.avg("value"), 6).alias("mean"))))


def q_distribution_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A13 + A14: mean, sd, bias-adjusted skewness per event type."""
    return distribution_stats(_events(spark, sf), "value", ["event_type"])


def q_profile(spark: SparkSession, sf: str) -> DataFrame:
    """A12 + K2: row and null counts per column of orders, one pass."""
    return profile(table(spark, sf, "orders"))


def q_distinct_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct labels without an RDD."""
    return distinct_values(table(spark, sf, "orders", "o_orderpriority"), "o_orderpriority")


def q_sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    """L1: first rows in a stable order (the limit is the operator)."""
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    return sample_rows(o, 5, ["o_orderkey"])


SLUG_PATTERN = "^[a-z0-9]+(-[a-z0-9]+)*$"


def q_entity_audit(spark: SparkSession, sf: str) -> DataFrame:
    """H8: the part-name dimension as slugs, checked for duplicates and for
    the slug pattern before it is used as a join key."""
    p = table(spark, sf, "part", "p_name")
    return validate_keys(p.select(slug("p_name").alias("entity")), ["entity"], SLUG_PATTERN)


def q_join_strategies(spark: SparkSession, sf: str) -> DataFrame:
    """One join under each physical strategy; all checksums must agree."""
    o = table(spark, sf, "orders", "o_custkey", "o_totalprice")
    c = table(spark, sf, "customer", "c_custkey", "c_acctbal")
    outs = []
    for s in STRATEGIES:
        j = join_with_strategy(o, c, o.o_custkey == c.c_custkey, "inner", s)
        outs.append(j.agg(F.count(F.lit(1)).alias("n_rows"),
                          F.sum(money("o_totalprice")).cast("double").alias("price_sum"),
                          F.sum(money("c_acctbal")).cast("double").alias("balance_sum"))
                    .withColumn("strategy", F.lit(s)))
    u = outs[0]
    for x in outs[1:]:
        u = u.unionByName(x)
    return u.select("strategy", "n_rows", "price_sum", "balance_sum")


def _odd_events(spark, sf):
    """Events with odd values put in: NaN, both infinities, values of about
    1e14, null values, and a null group."""
    i, v = F.col("event_id"), F.col("value")
    value = (F.when(i % 97 == 0, F.lit(float("nan"))).when(i % 101 == 0, F.lit(float("inf")))
             .when(i % 103 == 0, F.lit(float("-inf"))).when(i % 107 == 0, F.lit(None).cast("double"))
             .when(i % 11 == 0, v * 1e13).otherwise(v))
    return _events(spark, sf).select("event_id", F.when(i % 7 != 0, F.col("event_type")).alias("event_type"), value.alias("value"))


def q_odd_box_stats(spark: SparkSession, sf: str) -> DataFrame:
    """G3 with missing and huge values and a null group."""
    return box_stats(_odd_events(spark, sf), "value", ["event_type"])


def q_odd_bands(spark: SparkSession, sf: str) -> DataFrame:
    """C17 by group with missing and huge values and a null group: no row is lost."""
    b = sigma_bands(_odd_events(spark, sf), "value", groups=["event_type"])
    return b.groupBy("event_type", "band").agg(F.count(F.lit(1)).alias("n"))


def q_odd_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """A13 and A10 with missing and huge values: to thousands, as sums differ in the last digits."""
    e = _odd_events(spark, sf)
    d = distribution_stats(e, "value", ["event_type"], places=-3)
    return d.select("event_type", "n", "mean", "stddev", "min", "max")


def q_odd_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """G5 by group with missing and huge values and a null group."""
    h = histogram(_odd_events(spark, sf), "value", 8, ["event_type"])
    return h.select("event_type", "bin", fround("bin_lo", -3).alias("bin_lo"), "count")


QUERIES = {
    "odd_box_stats": q_odd_box_stats,
    "odd_bands": q_odd_bands,
    "odd_distribution": q_odd_distribution,
    "odd_histogram": q_odd_histogram,
    "share_within_group": q_share_within_group,
    "sigma_bands": q_sigma_bands,
    "allocate_share": q_allocate_share,
    "entity_profile": q_entity_profile,
    "correlations": q_correlations,
    "correlation_matrix": q_correlation_matrix,
    "trend_line": q_trend_line,
    "trend_by_group": q_trend_by_group,
    "trend_band": q_trend_band,
    "box_stats": q_box_stats,
    "box_lineitem": q_box_lineitem,
    "box_stats_log": q_box_stats_log,
    "box_outliers": q_box_outliers,
    "histogram": q_histogram,
    "kde": q_kde,
    "kde_by_customer": q_kde_by_customer,
    "distribution_stats": q_distribution_stats,
    "distribution_mode": q_distribution_mode,
    "profile": q_profile,
    "distinct_labels": q_distinct_labels,
    "sample_rows": q_sample_rows,
    "join_strategies": q_join_strategies,
    "entity_audit": q_entity_audit,
}


def fr(x: str, p: int) -> str:
    """SQL twin of ``fround``."""
    return f"(floor(({x}) * {float(10 ** p)} + 0.5) / {float(10 ** p)})"


_CUST_TOTALS = """
SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders GROUP BY 1
"""

_PROFILE = """
SELECT o.o_custkey, avg(o.o_totalprice) AS avg_price, COUNT(o.o_orderkey) AS n_orders,
       avg(COALESCE(l.n_lines, 0)) AS avg_lines
FROM orders o LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n_lines FROM lineitem GROUP BY 1) l
  ON o.o_orderkey = l.l_orderkey
GROUP BY 1
"""

_PROFILE_BAL = f"SELECT p.*, c.c_acctbal, c.c_mktsegment FROM ({_PROFILE}) p JOIN customer c ON p.o_custkey = c.c_custkey"


def _corr(x: str, y: str) -> str:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    return (f"covar_pop(CASE WHEN {both} THEN {x} END, CASE WHEN {both} THEN {y} END) / "
            f"NULLIF(stddev_pop(CASE WHEN {both} THEN {x} END) * stddev_pop(CASE WHEN {both} THEN {y} END), 0)")


def _trend(groups: str) -> str:
    sel = f"{groups}, " if groups else ""
    gb = f"GROUP BY {groups}" if groups else ""
    resid_var = ("(regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / NULLIF(regr_sxx(y, x), 0))"
                 " / NULLIF(regr_count(y, x) - 2, 0)")
    return f"""
WITH t AS (SELECT c_mktsegment, c_acctbal AS x, avg_price AS y FROM ({_PROFILE_BAL}))
SELECT {sel}CAST(regr_count(y, x) AS BIGINT) AS n,
  {fr('regr_slope(y, x)', 6)} AS slope, {fr('regr_intercept(y, x)', 6)} AS intercept,
  {fr('regr_r2(y, x)', 6)} AS r2,
  {fr(f'sqrt(greatest({resid_var}, 0))', 6)} AS resid_se,
  {fr(f'sqrt(greatest(({resid_var}) / NULLIF(regr_sxx(y, x), 0), 0))', 6)} AS slope_se,
  {fr('avg(CASE WHEN y IS NOT NULL THEN x END)', 6)} AS x_mean
FROM t {gb}
"""


_ODD = """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type,
  CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 OR event_id % 103 = 0 OR event_id % 107 = 0 THEN NULL
       WHEN event_id % 11 = 0 THEN value * 1e13 ELSE value END AS value FROM events"""


def _box(expr: str, where: str, source: str = "events", places: int = 6) -> str:
    return f"""
WITH b AS (SELECT event_type, {expr} AS v FROM {source} WHERE {where}),
q AS (SELECT event_type, COUNT(*) AS n, min(v) AS mn, max(v) AS mx,
        quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3
      FROM b GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS hf FROM q),
w AS (SELECT b.event_type, min(CASE WHEN v >= lf THEN v END) AS wl, max(CASE WHEN v <= hf THEN v END) AS wh,
        SUM(CASE WHEN v < lf OR v > hf THEN 1 ELSE 0 END) AS n_out
      FROM b JOIN f ON b.event_type IS NOT DISTINCT FROM f.event_type GROUP BY 1)
SELECT f.event_type, f.n, {fr('mn', places)} AS min, {fr('q1', places)} AS q1, {fr('med', places)} AS median,
  {fr('q3', places)} AS q3, {fr('iqr', places)} AS iqr, {fr('wl', places)} AS whisker_lo, {fr('wh', places)} AS whisker_hi,
  {fr('mx', places)} AS max, CAST(w.n_out AS BIGINT) AS n_outliers
FROM f JOIN w ON f.event_type IS NOT DISTINCT FROM w.event_type
"""


ORACLE = {
    "odd_box_stats": _box("value", "value IS NOT NULL", f"({_ODD})"),
    "odd_bands": f"""
WITH e AS ({_ODD}), d AS (SELECT event_type, value - avg(value) OVER g AS dev, stddev_samp(value) OVER g AS sd
  FROM e WINDOW g AS (PARTITION BY event_type))
SELECT event_type, CASE WHEN dev IS NULL OR sd IS NULL THEN NULL WHEN abs(dev) <= sd THEN 'Near Mean'
    WHEN abs(dev) <= 2 * sd THEN 'Moderate' ELSE 'Extreme' END
  || CASE WHEN abs(dev) <= sd THEN '' WHEN dev > 0 THEN ' High' ELSE ' Low' END AS band, COUNT(*) AS n
FROM d GROUP BY 1, 2
""",
    "odd_distribution": f"""
SELECT event_type, COUNT(value) AS n, floor(avg(value) * 0.001 + 0.5) / 0.001 AS mean,
  floor(stddev_samp(value) * 0.001 + 0.5) / 0.001 AS stddev, min(value) AS min, max(value) AS max
FROM ({_ODD}) GROUP BY 1
""",
    "odd_histogram": f"""
WITH e AS ({_ODD}), s AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM e GROUP BY 1),
b0 AS (SELECT e.event_type, e.value AS x, s.lo, (s.hi - s.lo) / 8.0 AS step, least(floor((e.value - s.lo) * (8.0 / (s.hi - s.lo))), 7) AS b
  FROM e JOIN s ON e.event_type IS NOT DISTINCT FROM s.event_type WHERE e.value IS NOT NULL),
b1 AS (SELECT event_type, x, lo, step, CASE WHEN x < b * step + lo THEN b - 1 ELSE b END AS b FROM b0),
c AS (SELECT event_type, CAST(CASE WHEN b <> 7 AND x >= (b + 1) * step + lo THEN b + 1 ELSE b END AS INTEGER) AS bin, COUNT(*) AS n FROM b1 GROUP BY 1, 2),
g AS (SELECT event_type, CAST(range AS INTEGER) AS bin, lo, hi FROM s, range(8))
SELECT g.event_type, g.bin, floor((lo + g.bin * ((hi - lo) / 8)) * 0.001 + 0.5) / 0.001 AS bin_lo, COALESCE(n, 0) AS count
FROM g LEFT JOIN c ON g.bin = c.bin AND g.event_type IS NOT DISTINCT FROM c.event_type
""",
    "share_within_group": f"""
WITH c AS (SELECT o_orderpriority, o_orderstatus, COUNT(*) AS count FROM orders GROUP BY 1, 2),
t AS (SELECT *, SUM(count) OVER (PARTITION BY o_orderpriority) AS total FROM c)
SELECT o_orderpriority, o_orderstatus, count, CAST(total AS BIGINT) AS total,
       {fr('count / total * 100', 2)} AS pct
FROM t
""",
    "sigma_bands": f"""
WITH t AS ({_CUST_TOTALS}), s AS (SELECT avg(total_price) AS m, stddev_samp(total_price) AS sd FROM t),
d AS (SELECT t.*, t.total_price - s.m AS dev, s.sd FROM t, s)
SELECT o_custkey, total_price, {fr('dev', 6)} AS deviation,
  CASE WHEN dev IS NULL OR sd IS NULL THEN NULL
       WHEN abs(dev) <= sd THEN 'Near Mean'
       WHEN dev > sd AND dev <= 2 * sd THEN 'Moderate High'
       WHEN dev < -sd AND dev >= -2 * sd THEN 'Moderate Low'
       WHEN dev > 2 * sd THEN 'Extreme High'
       ELSE 'Extreme Low' END AS band
FROM d
""",
    "allocate_share": f"""
WITH p AS (
  SELECT o_custkey,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS pf,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS po,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS pp
  FROM orders GROUP BY 1),
t AS (SELECT p.*, COALESCE(pf, 0) + COALESCE(po, 0) + COALESCE(pp, 0) AS tot, c.c_custkey, c.c_acctbal
      FROM p JOIN customer c ON p.o_custkey = c.c_custkey)
SELECT c_custkey,
  {fr('CASE WHEN tot = 0 THEN 0.0 ELSE pf / tot * c_acctbal END', 6)} AS Part_F_alloc,
  {fr('CASE WHEN tot = 0 THEN 0.0 ELSE po / tot * c_acctbal END', 6)} AS Part_O_alloc,
  {fr('CASE WHEN tot = 0 THEN 0.0 ELSE pp / tot * c_acctbal END', 6)} AS Part_P_alloc
FROM t
""",
    "entity_profile": f"""
SELECT o_custkey, {fr('avg_price', 6)} AS avg_price, n_orders, {fr('avg_lines', 6)} AS avg_lines
FROM ({_PROFILE})
""",
    "correlations": f"""
SELECT {fr(_corr('avg_price', 'n_orders'), 6)} AS corr_avg_price_n_orders,
       {fr(_corr('avg_price', 'avg_lines'), 6)} AS corr_avg_price_avg_lines,
       {fr(_corr('c_acctbal', 'avg_price'), 6)} AS corr_c_acctbal_avg_price,
       {fr(_corr('c_acctbal', 'n_orders'), 6)} AS corr_c_acctbal_n_orders
FROM ({_PROFILE_BAL})
""",
    "correlation_matrix": f"""
WITH t AS (SELECT p.*, c.c_acctbal, c.c_mktsegment, c.c_nationkey, CASE WHEN c.c_acctbal < 0 THEN avg_price - c.c_acctbal END AS rare
           FROM ({_PROFILE}) p JOIN customer c ON p.o_custkey = c.c_custkey)
""" + "\nUNION ALL\n".join(
        f"""SELECT c_mktsegment, '{x}' AS x, '{y}' AS y, COUNT(*) AS n, {fr(f'covar_pop({x}, {y})', 4)} AS covariance,
       {fr(f'covar_pop({x}, {y}) / NULLIF(stddev_pop({x}) * stddev_pop({y}), 0)', 4)} AS correlation
FROM t WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1"""
        for i, x in enumerate(MEASURES) for y in MEASURES[i:]),
    "trend_line": _trend(""),
    "trend_by_group": _trend("c_mktsegment"),
    "trend_band": f"""
WITH t AS (SELECT c_acctbal AS x, avg_price AS y FROM ({_PROFILE_BAL}) WHERE c_acctbal IS NOT NULL AND avg_price IS NOT NULL),
s AS (SELECT regr_count(y, x) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx,
             regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, avg(x) AS xm, min(x) AS x0, max(x) AS x1 FROM t),
g AS (SELECT CAST(r.range AS INTEGER) AS i, s.*, s.x0 + (s.x1 - s.x0) * r.range / 19 AS gx FROM s, range(20) r),
e AS (SELECT i, gx, a + b * gx AS fit,
             sqrt((syy - sxy * sxy / sxx) / (n - 2)) * sqrt(1.0 / n + (gx - xm) * (gx - xm) / sxx) AS se FROM g)
SELECT i, {fr('gx', 6)} AS x, {fr('fit', 6)} AS fit, {fr('fit - 1.959964 * se', 6)} AS lower,
       {fr('fit + 1.959964 * se', 6)} AS upper
FROM e
""",
    "box_stats": _box("value", "value IS NOT NULL"),
    "box_lineitem": _box("value", "value IS NOT NULL", """(SELECT l_returnflag AS event_type, unnest([l_extendedprice,
        l_extendedprice * (1 - l_discount), l_extendedprice * (1 - l_discount) * (1 + l_tax), l_extendedprice / l_quantity]) AS value FROM lineitem)""", 3)
    .replace("SELECT f.event_type,", "SELECT f.event_type AS l_returnflag,"),
    "box_stats_log": _box("log10(value)", "value > 0"),
    "box_outliers": """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
           FROM events WHERE value IS NOT NULL GROUP BY 1)
SELECT e.event_id, e.event_type, e.value FROM events e JOIN q USING (event_type)
WHERE e.value < q.q1 - 1.5 * (q.q3 - q.q1) OR e.value > q.q3 + 1.5 * (q.q3 - q.q1)
""",
    "histogram": f"""
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE value IS NOT NULL),
b0 AS (SELECT e.value AS x, s.lo, s.hi, (s.hi - s.lo) / 30.0 AS step,
             least(floor((e.value - s.lo) * (30.0 / (s.hi - s.lo))), 29) AS b
      FROM events e, s WHERE e.value IS NOT NULL AND s.hi - s.lo > 0),
b1 AS (SELECT x, lo, step, CASE WHEN x < b * step + lo THEN b - 1 ELSE b END AS b FROM b0),
b2 AS (SELECT CASE WHEN b <> 29 AND x >= (b + 1) * step + lo THEN b + 1 ELSE b END AS b FROM b1),
c AS (SELECT CAST(b AS INTEGER) AS bin, COUNT(*) AS n FROM b2 GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin, s.lo, s.hi FROM range(30), s)
SELECT g.bin, {fr('g.lo + g.bin * ((g.hi - g.lo) / 30)', 6)} AS bin_lo,
       {fr('g.lo + (g.bin + 1) * ((g.hi - g.lo) / 30)', 6)} AS bin_hi, COALESCE(c.n, 0) AS count
FROM g LEFT JOIN c USING (bin)
""",
    "kde": f"""
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, COUNT(*) AS n, stddev_samp(value) AS sd
           FROM events WHERE value IS NOT NULL),
b AS (SELECT CASE WHEN s.hi - s.lo > 0 THEN least(floor((e.value - s.lo) / (s.hi - s.lo) * 200), 199)
                  ELSE 0 END AS bin, COUNT(*) AS c
      FROM events e, s WHERE e.value IS NOT NULL GROUP BY 1),
k AS (SELECT g.range AS j, s.lo + (s.hi - s.lo) * g.range / 199 AS x,
             b.c, s.lo + (b.bin + 0.5) * (s.hi - s.lo) / 200 AS centre,
             s.sd * pow(CAST(s.n AS DOUBLE), -0.2) AS h, s.n
      FROM b, s, range(200) g)
SELECT CAST(j AS INTEGER) AS point, {fr('min(x)', 8)} AS x,
       {fr('sum(c * exp(-0.5 * ((x - centre) / h) * ((x - centre) / h)) / (n * h * sqrt(2 * pi())))', 8)} AS density
FROM k GROUP BY j
""",
    "kde_by_customer": f"""
WITH v AS (SELECT o_custkey, o_totalprice / 1000 AS value FROM orders WHERE o_totalprice IS NOT NULL),
s AS (SELECT o_custkey, min(value) AS lo, max(value) AS hi, COUNT(*) AS n, stddev_samp(value) AS sd FROM v GROUP BY 1),
b AS (SELECT o_custkey, CASE WHEN s.hi - s.lo > 0 THEN least(floor((v.value - s.lo) / (s.hi - s.lo) * 50), 49) ELSE 0 END AS bin, COUNT(*) AS c
      FROM v JOIN s USING (o_custkey) GROUP BY 1, 2),
k AS (SELECT o_custkey, g.range AS j, s.lo + (s.hi - s.lo) * g.range / 19 AS x, b.c, s.lo + (b.bin + 0.5) * (s.hi - s.lo) / 50 AS centre,
             NULLIF(s.sd * pow(CAST(s.n AS DOUBLE), -0.2), 0) AS h, s.n
      FROM b JOIN s USING (o_custkey), range(20) g)
SELECT o_custkey, CAST(j AS INTEGER) AS point, {fr('min(x)', 8)} AS x,
       {fr('sum(c * exp(-0.5 * ((x - centre) / h) * ((x - centre) / h)) / (n * h * sqrt(2 * pi())))', 8)} AS density
FROM k GROUP BY o_custkey, j
""",
    "distribution_mode": None,   # filled in below from the KDE SQL
    "distribution_stats": f"""
SELECT event_type, COUNT(value) AS n, {fr('avg(value)', 6)} AS mean, {fr('stddev_samp(value)', 6)} AS stddev,
       {fr('skewness(value)', 6)} AS skewness, min(value) AS min, max(value) AS max
FROM events GROUP BY 1
""",
    "profile": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS n_rows, "
        f"COUNT(*) - COUNT({c}) AS n_nulls FROM orders"
        for c, t in [('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'), ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string')]),
    "distinct_labels": "SELECT DISTINCT o_orderpriority FROM orders",
    "entity_audit": """
WITH e AS (SELECT regexp_replace(trim(lower(p_name)), '\\s+', '-', 'g') AS entity FROM part),
g AS (SELECT entity, COUNT(*) AS n_rows,
             COALESCE(regexp_matches(entity, '^[a-z0-9]+(-[a-z0-9]+)*$'), false) AS pattern_ok
      FROM e GROUP BY 1)
SELECT * FROM g WHERE n_rows > 1 OR NOT pattern_ok
""",
    "sample_rows": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5
""",
    "join_strategies": """
WITH j AS (SELECT COUNT(*) AS n_rows,
             CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price_sum,
             CAST(SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance_sum
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT s.strategy, j.* FROM j, (VALUES ('auto'), ('broadcast'), ('shuffle_hash'), ('merge')) s(strategy)
""",
}

ORACLE["distribution_mode"] = f"""
WITH k AS ({ORACLE["kde"]})
SELECT arg_max(x, density) AS mode, max(density) AS max_density,
       (SELECT {fr('avg(value)', 6)} FROM events) AS mean
FROM k
"""
