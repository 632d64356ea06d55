"""Registered queries for panel sums, pivots, winners, panel joins and the
nearest-period join (A1-A4, C8-C13, J1-J5, W1, W2, F2), with their DuckDB
twins.  Every query reads whole driver tables; nothing is filtered by id,
sampled or truncated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import columns_excluding
from strata.functions.numbers import money, pct, ratio, row_sum
from strata.operators.joins import panel_join
from strata.operators.nearest import Side, dedupe_right, nearest_enrich, nearest_join
from strata.operators.reshape import discover_values, panel_sum, pivot_discovered, pivot_sparse, pivot_values, ratio_of_sums
from strata.operators.winner import winner_long, winner_wide
from strata.plans.common import MONEY, events_by_day, orders_by_year, r6
from strata.sources.tables import table

PANEL = ["o_custkey", "year"]
LINES_PER_TASK = 250_000


# ---- A1, A3, A4, C8-C11 ---------------------------------------------------

def q_panel_sum(spark: SparkSession, sf: str) -> DataFrame:
    """A1: sum of order price per customer and year."""
    return panel_sum(orders_by_year(spark, sf), PANEL, "o_totalprice", "total_price",
                     exact_money=MONEY, count_col="n_orders")


def q_pivot_first_pct(spark: SparkSession, sf: str) -> DataFrame:
    """A3 + C9: explicit-value pivot on status, F as a percentage of O."""
    o = orders_by_year(spark, sf, "o_orderstatus")
    p = pivot_values(o, PANEL, "o_orderstatus", ["F", "O"], "o_totalprice", "sum",
                     names={"F": "F_total", "O": "O_total"}, exact_money=MONEY)
    return p.withColumn("F_pct", r6(pct("F_total", "O_total")))


def q_pivot_dynamic(spark: SparkSession, sf: str) -> DataFrame:
    """A4 + P3 + F4: discovered priorities become cleaned, zero-filled columns."""
    o = orders_by_year(spark, sf, "o_orderpriority")
    return pivot_discovered(o, PANEL, "o_orderpriority", "o_totalprice", prefix="Cat_", exact_money=MONEY)


def q_pivot_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """A4 with a value per part: quantities per supplier and part as maps in
    blocks, taken apart again cell by cell."""
    li = table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_quantity")
    parts = table(spark, sf, "part", "p_partkey", "p_name")
    named = li.join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumn("part", F.concat_ws("/", "p_name", "p_partkey"))
    p = pivot_sparse(named, ["l_suppkey"], "part", "l_quantity", blocks=4, exact_money=MONEY)
    return p.select("l_suppkey", F.explode("cells").alias("part", "quantity"))


def q_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Per-line ratios; a zero denominator gives null, not an error."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice",
               "l_quantity", "l_discount", "l_tax")
    return li.select("l_orderkey", "l_linenumber",
                     ratio("l_extendedprice", "l_quantity").alias("unit_price"),
                     ratio("l_discount", "l_tax").alias("discount_per_tax"))


def q_ratio_of_sums(spark: SparkSession, sf: str) -> DataFrame:
    """A2: discount amount over gross amount per supplier (exact sums)."""
    li = table(spark, sf, "lineitem", "l_suppkey", "l_extendedprice", "l_discount")
    g = li.groupBy("l_suppkey").agg(
        F.sum(money("l_extendedprice") * money("l_discount")).cast("double").alias("discount_amount"),
        F.sum(money("l_extendedprice")).cast("double").alias("gross_amount"))
    return g.withColumn("discount_ratio", F.round(ratio("discount_amount", "gross_amount"), 8))


def q_row_sum(spark: SparkSession, sf: str) -> DataFrame:
    """C10 + C11: null-as-zero row-wise sum over a column list."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_tax",
               "l_discount")
    return li.select("l_orderkey", "l_linenumber",
                     r6(row_sum(["l_quantity", "l_tax", "l_discount"])).alias("row_total"))


# ---- C12, C13, P9 ------------------------------------------------------------

def _priority_counts(spark, sf):
    return table(spark, sf, "orders", "o_custkey", "o_orderpriority") \
        .groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


def q_winner_wide(spark: SparkSession, sf: str) -> DataFrame:
    """C12 + C13 + P9: wide counts per priority, arg-max across the columns."""
    o = table(spark, sf, "orders", "o_custkey", "o_orderpriority")
    prios = discover_values(o, "o_orderpriority")
    wide = pivot_values(o, ["o_custkey"], "o_orderpriority", prios, "o_custkey", "count")
    label_cols = columns_excluding(wide, ["o_custkey"])
    return winner_wide(wide, label_cols, "winner", "max_value").select("o_custkey", "winner", "max_value")


def q_winner_long(spark: SparkSession, sf: str) -> DataFrame:
    """C13, long form: ``min_by`` over (count desc, label)."""
    return winner_long(_priority_counts(spark, sf), ["o_custkey"], "o_orderpriority", "n",
                       "winner", "max_value")


# ---- J1, J2 ------------------------------------------------------------------

def _line_totals(spark, sf):
    """Line totals per customer and ship year.  Lines are shuffled once, by
    order: that serves the sums per (order, year) and the join to orders.  The
    partitions follow the lines' number, so a task's sums stay small."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_shipdate")
    parts = max(1, -(-li.count() // LINES_PER_TASK))
    li = li.repartition(parts, "l_orderkey")
    per_order = li.groupBy("l_orderkey", F.year("l_shipdate").alias("year")).agg(
        F.sum(money("l_extendedprice")).alias("amt"))
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey").repartition(parts, "o_orderkey")
    j = per_order.join(o, per_order.l_orderkey == o.o_orderkey, "inner")
    return j.groupBy("o_custkey", "year").agg(F.sum("amt").cast("double").alias("line_total"))


def q_panel_inner_join(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly order totals inner-joined to yearly line totals."""
    return panel_join(q_panel_sum(spark, sf), _line_totals(spark, sf), PANEL, "inner")


def q_panel_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """The same, keeping panel rows without lines."""
    return panel_join(q_panel_sum(spark, sf), _line_totals(spark, sf), PANEL, "left")


# ---- J3-J5, W1, W2, F2, C14 --------------------------------------------------

def _errors(spark, sf):
    return events_by_day(spark, sf, "event_id", "event_type") \
        .where(F.col("event_type") == "error").drop("event_type")


def _daily(spark, sf, kind):
    e = events_by_day(spark, sf, "event_type", "value").where(F.col("event_type") == kind)
    return dedupe_right(e, ["user_id"], "day", ["value"], "max")


def _nearest(form, **kw):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        out = nearest_join(_errors(spark, sf), _daily(spark, sf, "signup"), ["user_id"],
                           "day", "day", ["value"], form=form, prefix="signup_", **kw)
        return out.select("event_id", "user_id", "day", "signup_period", "signup_value")
    q.__name__ = f"q_nearest_{form}"
    q.__doc__ = f"J4 ({form} form): each error event -> nearest-day signup of the user."
    return q


def q_enrich_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest signup, purchase and click attached in one pass.  The
    three right sides are slices of one daily aggregation, read as payload
    columns of one scan."""
    kinds = ("signup", "purchase", "click")
    e = events_by_day(spark, sf, "event_type", "value").where(F.col("event_type").isin(*kinds))
    daily = dedupe_right(e, ["user_id", "event_type"], "day", ["value"], "max")
    sides = [Side(daily, "day", ["value"], f"{k}_", rows=F.col("event_type") == k) for k in kinds]
    out = nearest_enrich(_errors(spark, sf), ["user_id"], "day", sides, form="fill")
    return out.select("event_id", "user_id", "day",
                      *[f"{k}_{c}" for k in ("signup", "purchase", "click") for c in ("period", "value")])


def _odd_orders(spark, sf):
    """Orders with three-decimal measures, a null category, and customers
    without any category value."""
    o = orders_by_year(spark, sf, "o_orderkey", "o_orderstatus")
    k = F.col("o_orderkey")
    return o.select("o_custkey", F.when(k % 5 != 0, F.col("o_orderstatus")).alias("status"),
                    F.when(F.col("o_custkey") % 4 != 0, (k % 1000) / 1000.0).alias("amount"))


def q_odd_panel(spark: SparkSession, sf: str) -> DataFrame:
    """A1, A4: plain sums of three-decimal amounts, the null status as a column."""
    o = _odd_orders(spark, sf)
    p = pivot_discovered(o, ["o_custkey"], "status", "amount", prefix="Part_", fill=None)
    j = panel_sum(o, ["o_custkey"], "amount", "total").join(p, "o_custkey")
    return j.select("o_custkey", *[F.round(c, 6).alias(c) for c in ("total", "Part_F", "Part_O", "Part_P", "Part_null")])


def q_odd_winner(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without a value keep their row, without a winner."""
    return winner_long(_odd_orders(spark, sf).where(F.col("status").isNotNull()), ["o_custkey"], "status", "amount")


def q_ratio_operator(spark: SparkSession, sf: str) -> DataFrame:
    """A2: the ratio operator on exact decimal sums."""
    li = table(spark, sf, "lineitem", "l_suppkey", "l_extendedprice", "l_discount")
    price, rate = money("l_extendedprice"), money("l_discount")
    r = ratio_of_sums(li, ["l_suppkey"], price * rate, price, "discount_ratio", "discount_amount", "gross_amount")
    return r.select("l_suppkey", *[F.col(c).cast("double").alias(c) for c in ("discount_amount", "gross_amount")],
                    F.round(F.col("discount_ratio").cast("double"), 6).alias("discount_ratio"))


QUERIES = {
    "odd_panel": q_odd_panel,
    "odd_winner": q_odd_winner,
    "ratio_operator": q_ratio_operator,
    "panel_sum": q_panel_sum,
    "pivot_first_pct": q_pivot_first_pct,
    "pivot_dynamic": q_pivot_dynamic,
    "pivot_sparse": q_pivot_sparse,
    "ratio": q_ratio,
    "ratio_of_sums": q_ratio_of_sums,
    "row_sum": q_row_sum,
    "winner_wide": q_winner_wide,
    "winner_long": q_winner_long,
    "panel_inner_join": q_panel_inner_join,
    "panel_left_join": q_panel_left_join,
    "nearest_window": _nearest("window"),
    "nearest_minby": _nearest("minby"),
    "nearest_fill": _nearest("fill"),
    "nearest_broadcast": _nearest("lookup", broadcast_rows=100_000),
    "enrich_multi": q_enrich_multi,
}


# ---- DuckDB twins --------------------------------------------------------

_YEAR_TOTALS = """
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
       COUNT(*) AS n_orders
FROM orders GROUP BY 1, 2
"""

_LINE_TOTALS = """
SELECT o.o_custkey, CAST(year(l.l_shipdate) AS INTEGER) AS year,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS line_total
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY 1, 2
"""

_DAY = "CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS INTEGER)"

_ERRORS = f"SELECT event_id, user_id, {_DAY} AS day FROM events WHERE event_type = 'error'"


def _daily_sql(kind: str) -> str:
    return (f"SELECT user_id, {_DAY} AS q, MAX(value) AS v FROM events "
            f"WHERE event_type = '{kind}' GROUP BY 1, 2")


def _nearest_sql(kind: str) -> str:
    return f"""
WITH l AS ({_ERRORS}), r AS ({_daily_sql(kind)}),
j AS (
  SELECT l.event_id, l.user_id, l.day, r.q, r.v,
         row_number() OVER (PARTITION BY l.event_id ORDER BY abs(l.day - r.q), r.q DESC) AS rn
  FROM l LEFT JOIN r ON l.user_id = r.user_id)
SELECT event_id, user_id, day, q AS {kind}_period, v AS {kind}_value FROM j WHERE rn = 1
"""


_NEAREST = _nearest_sql("signup")

_PRIO_WINNER = """
WITH c AS (SELECT o_custkey, o_orderpriority AS p, COUNT(*) AS n FROM orders GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, p) AS rn FROM c)
SELECT o_custkey, p AS winner, n AS max_value FROM r WHERE rn = 1
"""

_ODD = """SELECT o_custkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS status,
  CASE WHEN o_custkey % 4 <> 0 THEN (o_orderkey % 1000) / 1000.0::DOUBLE END AS amount FROM orders"""

ORACLE = {
    "odd_panel": f"""
SELECT o_custkey, round(sum(amount), 6) AS total, round(sum(amount) FILTER (status = 'F'), 6) AS Part_F,
  round(sum(amount) FILTER (status = 'O'), 6) AS Part_O, round(sum(amount) FILTER (status = 'P'), 6) AS Part_P,
  round(sum(amount) FILTER (status IS NULL), 6) AS Part_null FROM ({_ODD}) GROUP BY 1
""",
    "odd_winner": f"""
SELECT o_custkey, arg_min(status, (-amount, status)) FILTER (amount IS NOT NULL) AS winner, max(amount) AS max_value
FROM ({_ODD}) WHERE status IS NOT NULL GROUP BY 1
""",
    "ratio_operator": """
SELECT l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS discount_amount,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross_amount, round(discount_amount / gross_amount, 6) AS discount_ratio
FROM lineitem GROUP BY 1
""",
    "panel_sum": _YEAR_TOTALS,
    "pivot_first_pct": """
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS F_total,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS O_total,
  ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE)
      / NULLIF(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE), 0)
      * 100, 6) AS F_pct
FROM orders GROUP BY 1, 2
""",
    "pivot_dynamic": """
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
""" + ",\n".join(
        f"  COALESCE(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderpriority = '{v}') "
        f"AS DOUBLE), 0.0) AS {n}"
        for v, n in [("1-URGENT", "Cat_1_URGENT"), ("2-HIGH", "Cat_2_HIGH"),
                     ("3-MEDIUM", "Cat_3_MEDIUM"), ("4-NOT SPECIFIED", "Cat_4_NOT_SPECIFIED"),
                     ("5-LOW", "Cat_5_LOW")]) + """
FROM orders GROUP BY 1, 2
""",
    "pivot_sparse": """
SELECT l_suppkey, p_name || '/' || p_partkey AS part, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
""",
    "ratio": """
SELECT l_orderkey, l_linenumber,
       l_extendedprice / NULLIF(l_quantity, 0) AS unit_price,
       l_discount / NULLIF(l_tax, 0) AS discount_per_tax
FROM lineitem
""",
    "ratio_of_sums": """
WITH g AS (
  SELECT l_suppkey,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS discount_amount,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross_amount
  FROM lineitem GROUP BY 1)
SELECT *, ROUND(discount_amount / NULLIF(gross_amount, 0), 8) AS discount_ratio FROM g
""",
    "row_sum": """
SELECT l_orderkey, l_linenumber,
       ROUND(COALESCE(l_quantity, 0) + COALESCE(l_tax, 0) + COALESCE(l_discount, 0), 6) AS row_total
FROM lineitem
""",
    "winner_wide": _PRIO_WINNER,
    "winner_long": _PRIO_WINNER,
    "panel_inner_join": f"""
SELECT a.*, b.line_total FROM ({_YEAR_TOTALS}) a JOIN ({_LINE_TOTALS}) b USING (o_custkey, year)
""",
    "panel_left_join": f"""
SELECT a.*, b.line_total FROM ({_YEAR_TOTALS}) a LEFT JOIN ({_LINE_TOTALS}) b USING (o_custkey, year)
""",
    "nearest_window": _NEAREST,
    "nearest_minby": _NEAREST,
    "nearest_fill": _NEAREST,
    "nearest_broadcast": _NEAREST,      # J3: broadcast left join, the right side checked first
    "enrich_multi": f"""
WITH s AS ({_nearest_sql('signup')}), p AS ({_nearest_sql('purchase')}), c AS ({_nearest_sql('click')})
SELECT s.event_id, s.user_id, s.day, s.signup_period, s.signup_value,
       p.purchase_period, p.purchase_value, c.click_period, c.click_value
FROM s JOIN p USING (event_id) JOIN c USING (event_id)
""",
}
