"""Registered queries for sources, sinks and extraction."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import drop_columns, surrogate_key
from strata.functions.numbers import money
from strata.plans.common import orders_by_year
from strata.session import scratch_path
from strata.sources.csv import empty_frame, panel_periods, read_csv, replace_periods, write_csv, write_panel
from strata.sources.html import audit, nav_links, table_rows, url_frontier
from strata.sources.panel_files import discover_periods, read_period_sources
from strata.sources.tables import table

ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double",
               "o_orderpriority": "string"}


def q_multi_file_panel(spark: SparkSession, sf: str) -> DataFrame:
    """S6 + S7 + U1 + P7 + O2: orders written into one folder of CSV files per
    year.  Even years carry a priority column; odd years do not and have
    their columns in another order.  Read back by each file's own header
    for the periods found in the folder, with the year taken from the path;
    a missing source is skipped."""
    o = orders_by_year(spark, sf, "o_orderkey", "o_orderpriority")
    root = scratch_path(spark, "multi_file_panel")
    write_csv(o.where(F.col("year") % 2 == 0).select("year", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"),
              f"{root}/delivered", partition_by=["year"])
    write_csv(o.where(F.col("year") % 2 != 0).select("year", "o_totalprice", "o_custkey", "o_orderkey"),
              f"{root}/delivered", partition_by=["year"], mode="append")
    periods = discover_periods(spark, f"{root}/delivered", r"year=(\d{4})").select(F.col("period").alias("year")).distinct()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)        # the second source is missing on purpose
        df = read_period_sources(spark, [f"{root}/delivered", f"{root}/not_delivered"], ORDER_TYPES,
                                 period_pattern=r"year=(\d{4})", period_col="year")
    return df.join(periods, "year", "left_semi").select("year", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


def q_panel_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as a panel table partitioned by year
    and read again together with an empty one; a column dropped; the
    surrogate key tells rows apart."""
    o = orders_by_year(spark, sf, "o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "panel_sink")
    write_panel(o, path, "year", max_records_per_file=4_000)
    back = spark.read.parquet(path).unionByName(empty_frame(spark, "year INT, note STRING"), allowMissingColumns=True)
    kept = drop_columns(back, "o_orderstatus", "note", "never_there")
    return kept.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(money("o_totalprice")).cast("double").alias("price"),
                                    F.countDistinct(surrogate_key("o_orderkey", "year")).alias("n_keys")) \
        .withColumn("n_columns", F.lit(len(kept.columns)))


def q_panel_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """S8, rerun: a panel written, then one period written again with doubled
    prices and without its finished orders; the other periods stay."""
    o = orders_by_year(spark, sf, "o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "panel_rerun")
    replace_periods(o, path, "year", rows_per_file=2_000)
    replace_periods(o.where("year = 1995 AND o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, "year", 2_000)
    panel = spark.read.parquet(path).groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_orderkey").alias("n_orders"), F.sum(money("o_totalprice")).cast("double").alias("price"))
    return panel.join(panel_periods(spark, path), "year").withColumnRenamed("rows", "listed_rows")


STREAM_SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING"


def q_multi_file_stream(spark: SparkSession, sf: str) -> DataFrame:
    """S6 + S8 as a stream: per-year CSV folders ingested incrementally
    (file stream, availableNow, exactly-once file sink), then read back as
    a period-partitioned Parquet table."""
    from strata.streaming.ingest import ingest_available, period_file_stream
    o = orders_by_year(spark, sf, "o_orderkey", "o_orderpriority")
    root = scratch_path(spark, "multi_file_stream")
    write_csv(o.select("year", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"),
              f"{root}/incoming", partition_by=["year"])
    stream = period_file_stream(spark, f"{root}/incoming", STREAM_SCHEMA, r"year=(\d{4})", "year")
    ingest_available(stream, f"{root}/table", f"{root}/_checkpoint", "year")
    t = spark.read.parquet(f"{root}/table")
    return t.select("year", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


CSV_SCHEMA = "c_custkey BIGINT, name STRING, c_acctbal DOUBLE"


def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S1-S4 + S8: ';'-separated ISO-8859-1 CSV with accented names, written
    in parallel and read back with a declared, enforced schema."""
    c = table(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal")
    c = c.select("c_custkey", F.concat("c_name", F.lit(" Pöndorf Ö")).alias("name"), "c_acctbal")
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(c, path, sep=";", encoding="latin1")
    return read_csv(spark, path, CSV_SCHEMA, sep=";", encoding="latin1", enforce=True)


def q_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as CSV and read back with types found in the files."""
    o = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "csv_inferred")
    write_csv(o, path)
    return read_csv(spark, path, infer=True)


def q_url_frontier(spark: SparkSession, sf: str) -> DataFrame:
    """S11 + J9: customer x order-year URLs (the year range is a one-row
    aggregate, broadcast; each customer's years come from ``sequence``)."""
    c = table(spark, sf, "customer", "c_custkey", "c_name")
    yr = orders_by_year(spark, sf).agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    x = c.crossJoin(F.broadcast(yr))
    u = url_frontier(x, "c_name", F.col("lo"), F.col("hi"), "https://example.org/spending/", "year")
    return u.select("c_custkey", "year", "url")


def q_html_rows(spark: SparkSession, sf: str) -> DataFrame:
    """S12 on navigation lists of the raw pages."""
    return nav_links(table(spark, sf, "pages", "page_id", "html"), ["page_id"])


def _tasks(spark) -> int:
    """Pages are long and slow to parse: their narrow order rows are dealt
    evenly over the shuffle partitions before the pages are built."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _order_pages(spark, sf):
    """One HTML page per order (container per year, header row, a status
    row, a total row with two classes, a short row)."""
    o = table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice").repartition(_tasks(spark))
    amt = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    html = F.concat(
        F.lit('<html><body><div id="treemap-table-'), F.year("o_orderdate").cast("string"),
        F.lit('" class="t"><table><tr><th>Nr</th><th>Abschnitt</th><th>Betrag</th></tr>'),
        F.lit('<tr class="status-'), F.lower("o_orderstatus"), F.lit('"><td>1</td><td>'),
        F.col("o_orderpriority"), F.lit(' &amp; more</td><td><span class="value-value">'), amt,
        F.lit("</span> EUR</td></tr>"),
        F.lit('<tr class="sum total"><td>2</td><td><b>Summe</b></td><td><span class="value-value">'),
        amt, F.lit("</span></td></tr><tr><td>3</td><td>short</td></tr></table></div></body></html>"))
    return o.select(F.col("o_orderkey").alias("page_id"), html.alias("html"))


def q_html_table_rows(spark: SparkSession, sf: str) -> DataFrame:
    """S12 + S13: rows with class ``status-f`` or ``sum``."""
    return table_rows(_order_pages(spark, sf), ["page_id"], classes=["status-f", "sum"])


def q_html_table_rows_py(spark: SparkSession, sf: str) -> DataFrame:
    """S12 + S13 with the container chosen by the page's period, same result."""
    pages = _order_pages(spark, sf).withColumn("year", F.regexp_extract("html", r"treemap-table-(\d+)", 1))
    return table_rows(pages, ["page_id"], classes=["status-f", "sum"], period="year")


def q_html_table_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every data row with at least three cells, header skipped."""
    return table_rows(_order_pages(spark, sf), ["page_id"])


def _hard_pages(spark, sf):
    """Order pages in markup as it is found: nested and decoy containers,
    attributes in any order and quoting, several classes, unclosed cells and
    rows, named entities, comments; some pages fail in each possible way."""
    o = table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice").repartition(_tasks(spark))
    k = F.col("o_orderkey")
    year = F.year("o_orderdate")
    ident = F.concat(F.lit("treemap-table-"), year.cast("string"))
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    row = F.concat(F.lit("<TR data-x=1 class='r status-"), F.lower("o_orderstatus"), F.lit("'><td>1<td>F&ouml;rderung &amp;lt; "),
                   F.col("o_orderpriority"), F.lit("<td>EUR <span id=v class='a value-value'>"), amount, F.lit("</span><!-- <td>no</td> -->"))
    table_ = F.when(k % 11 == 1, F.lit("<p>none</p>")).when(k % 11 == 2, F.lit("<table></table>")).otherwise(
        F.concat(F.lit("<table border=0><tr><th>Nr<th>Abschnitt<th>Betrag"), row,
                 F.lit("<tr class=sum><td>2</td><td><b>Sum</b>me<td><span class=value-value>0</span></table>")))
    html = F.concat(F.lit('<html><script>"<div id=treemap-table-0>"</script><div id="treemap-table-0"><table><tr><td>a<td>b<td>c</table></div>'),
                    F.lit('<div class="box" id="'), F.when(k % 11 == 3, F.lit("other")).otherwise(ident),
                    F.lit('"><div class=inner><div>&nbsp;</div>'), table_, F.lit("</div></div></html>"))
    return o.select(k.alias("page_id"), year.alias("year"), F.when(k % 11 == 4, 404).when(k % 11 != 5, 200).alias("status"),
                    F.when(k % 11 != 6, html).alias("html"))


def q_html_hard_rows(spark: SparkSession, sf: str) -> DataFrame:
    """S12 + S13 on hard markup: the container of the page's period."""
    return table_rows(_hard_pages(spark, sf), ["page_id"], period="year", status="status")


def q_extract_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Pages by why extraction fails, taken from the extraction."""
    a = audit(_hard_pages(spark, sf), ["page_id"], period="year", status="status")
    own = audit(table(spark, sf, "pages", "page_id", "html"), ["page_id"])
    a = a.withColumn("source", F.lit("orders")).unionByName(own.withColumn("source", F.lit("pages")))
    return a.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n_rows").alias("n_rows"))


QUERIES = {
    "panel_sink": q_panel_sink,
    "panel_rerun": q_panel_rerun,
    "multi_file_panel": q_multi_file_panel,
    "multi_file_stream": q_multi_file_stream,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_inferred": q_csv_inferred,
    "url_frontier": q_url_frontier,
    "html_rows": q_html_rows,
    "html_table_rows": q_html_table_rows,
    "html_table_rows_py": q_html_table_rows_py,
    "html_table_all": q_html_table_all,
    "extract_audit": q_extract_audit,
    "html_hard_rows": q_html_hard_rows,
}

_NAV = '<li><a href="([^"]*)">([^<]*)</a></li>'

_TABLE_ROWS = """
SELECT o_orderkey AS page_id, CAST(year(o_orderdate) AS VARCHAR) AS container, 1 AS pos,
       'status-' || lower(o_orderstatus) AS row_class, o_orderpriority || ' & more' AS section,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount
FROM orders {where}
UNION ALL
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR), 2, 'sum total', 'Summe', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
FROM orders
"""

ORACLE = {
    "panel_rerun": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n_rows, COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice * CASE WHEN year(o_orderdate) = 1995 THEN 2 ELSE 1 END AS DECIMAL(18,2))) AS DOUBLE) AS price, COUNT(*) AS listed_rows
FROM orders WHERE year(o_orderdate) <> 1995 OR o_orderstatus <> 'F' GROUP BY 1
""",
    "panel_sink": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n_rows,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price, COUNT(*) AS n_keys, 4 AS n_columns
FROM orders GROUP BY 1
""",
    "multi_file_panel": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_custkey, o_totalprice,
       CASE WHEN year(o_orderdate) % 2 = 0 THEN o_orderpriority END AS o_orderpriority
FROM orders
""",
    "multi_file_stream": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_custkey, o_totalprice, o_orderpriority
FROM orders
""",
    "csv_roundtrip": "SELECT c_custkey, c_name || ' Pöndorf Ö' AS name, c_acctbal FROM customer",
    "csv_inferred": "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "url_frontier": """
WITH s AS (SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS lo, CAST(max(year(o_orderdate)) AS INTEGER) AS hi FROM orders),
y AS (SELECT CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS year FROM s)
SELECT c.c_custkey, y.year, 'https://example.org/spending/' || url_encode(c.c_name) || '/' || y.year AS url
FROM customer c CROSS JOIN y
""",
    "html_rows": f"""
WITH t AS (SELECT page_id, regexp_extract_all(html, '{_NAV}', 1) AS h,
                  regexp_extract_all(html, '{_NAV}', 2) AS l FROM pages)
SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS pos, unnest(h) AS href, unnest(l) AS label
FROM t
""",
    "html_table_rows": _TABLE_ROWS.format(where="WHERE o_orderstatus = 'F'"),
    "html_table_rows_py": _TABLE_ROWS.format(where="WHERE o_orderstatus = 'F'"),
    "html_table_all": _TABLE_ROWS.format(where=""),
    "html_hard_rows": """
WITH o AS (SELECT o_orderkey AS page_id, CAST(year(o_orderdate) AS VARCHAR) AS container, o_orderstatus, o_orderpriority, o_totalprice
           FROM orders WHERE o_orderkey % 11 NOT IN (1, 2, 3, 4, 5, 6))
SELECT page_id, container, 1 AS pos, 'r status-' || lower(o_orderstatus) AS row_class, 'Förderung &lt; ' || o_orderpriority AS section,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount FROM o
UNION ALL SELECT page_id, container, 2, 'sum', 'Summe', '0' FROM o
""",
    "extract_audit": """
WITH o AS (SELECT 'orders' AS source, CASE o_orderkey % 11 WHEN 1 THEN 'table_missing' WHEN 2 THEN 'no_rows' WHEN 3 THEN 'container_missing'
             WHEN 4 THEN 'bad_status' WHEN 5 THEN 'bad_status' WHEN 6 THEN 'no_content' ELSE 'ok' END AS reason FROM orders
           UNION ALL SELECT 'pages', 'container_missing' FROM pages)
SELECT source, reason, COUNT(*) AS n_pages, CAST(SUM(CASE WHEN reason = 'ok' THEN 3 ELSE 0 END) AS BIGINT) AS n_rows FROM o GROUP BY ALL
""",
}
