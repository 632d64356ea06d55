"""Registered queries for cleaning and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import (clean_counts, digits_only, drop_null_keys, fill_numeric,
                                      harmonize, non_finite_to_null, normalize_headers)
from strata.functions.numbers import parse_number
from strata.functions.text import (CATEGORY_REPAIRS, MULTI_CHAR_FOLDS, fold_ascii, fold_key,
                                   recode, repair_text, slug)
from strata.operators.ids import dense_ids
from strata.operators.joins import collated_join
from strata.sources.tables import table

# Single-byte charset used to simulate the damage that the repair undoes.
DAMAGE_CODEC = "ISO-8859-1"


def q_slugify(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical slug (lower, trim, whitespace runs -> '-') of whole texts."""
    d = table(spark, sf, "documents", "doc_id", "text")
    return d.select("doc_id", slug("text").alias("slug"))


def q_slug_variants(spark: SparkSession, sf: str) -> DataFrame:
    """The three slug forms of part names with outer and repeated spaces."""
    p = table(spark, sf, "part", "p_partkey", "p_name").select("p_partkey", F.concat(F.lit("  "), "p_name", F.lit("  Z  ")).alias("t"))
    return p.select("p_partkey", slug("t").alias("runs"), slug("t", pattern=" ").alias("single"), slug("t", trim=False).alias("untrimmed"))


def q_repair_literals(spark: SparkSession, sf: str) -> DataFrame:
    """C4: the two damaged spending categories inside other text, and text without damage."""
    o = table(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    bad = F.element_at(F.array(*[F.lit(b) for b in CATEGORY_REPAIRS], F.lit("Kultur")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return o.select("o_orderkey", repair_text(F.concat("o_orderstatus", F.lit(": "), bad, F.lit(" / "), bad)).alias("category"))


def q_fold_ascii(spark: SparkSession, sf: str) -> DataFrame:
    """Accent folding of whole texts, as a native expression."""
    d = table(spark, sf, "documents", "doc_id", "text")
    return d.select("doc_id", fold_ascii("text").alias("folded"))


def q_repair_text(spark: SparkSession, sf: str) -> DataFrame:
    """C4: damage whole texts the way a wrong charset does (UTF-8 bytes read
    as ISO-8859-1), repair them (charset round trip, then the literal
    category repairs), and fingerprint the result: the md5 must equal the
    original text's."""
    d = table(spark, sf, "documents", "doc_id", "text")
    damaged = F.decode(F.encode("text", "UTF-8"), DAMAGE_CODEC)
    x = d.select("doc_id", damaged.alias("damaged"))
    fixed = repair_text(recode("damaged", DAMAGE_CODEC, "UTF-8"), CATEGORY_REPAIRS)
    return x.select("doc_id", F.char_length("damaged").alias("damaged_chars"),
                    F.md5(fixed).alias("repaired_md5"))


def _word_keys(df: DataFrame, text: str) -> DataFrame:
    """Fold and clean the whole text once, then split into words (same words
    as splitting first and cleaning each word, with one expression per text)."""
    clean = F.regexp_replace(fold_key(text), r"[^\p{L}\p{N}\s]", "")
    w = df.select(F.explode(F.split(clean, r"\s+")).alias("word"))
    return w.where(F.col("word") != "")


def q_collated_join(spark: SparkSession, sf: str) -> DataFrame:
    """C5 as a join key: words of documents and of benchmark items matched
    ignoring case and accents.  Both sides are counted per key first, so
    the join sees one row per word and no pair of rows is ever emitted."""
    dw = _word_keys(table(spark, sf, "documents", "text"), "text") \
        .groupBy("word").agg(F.count(F.lit(1)).alias("doc_count"))
    bw = _word_keys(table(spark, sf, "benchmark", "text"), "text") \
        .groupBy("word").agg(F.count(F.lit(1)).alias("bench_count"))
    return dw.join(bw, "word", "inner")


def q_collated_words(spark: SparkSession, sf: str) -> DataFrame:
    """C5 without a key column: spellings of words in documents and in
    benchmark items that are equal under a case- and accent-insensitive
    collation.  Both sides are counted per spelling first."""
    def spellings(name: str, word: str, count: str) -> DataFrame:
        words = F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias(word)
        return table(spark, sf, name, "text").select(words).groupBy(word).agg(F.count(F.lit(1)).alias(count))

    return collated_join(spellings("documents", "word", "doc_count"), spellings("benchmark", "bench_word", "bench_count"), "word", "bench_word")


def q_dense_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids 1, 2, 3, ... of the lines by ship date, order and line number."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return dense_ids(li, li.columns[2:3] + li.columns[:2] + li.columns[3:], "line_id").select("line_id", "l_orderkey", "l_linenumber")


def _price_text(o):
    base = F.concat(F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(",")),
                    F.lit(" %"))
    return (F.when(F.col("o_orderkey") % 97 == 0, F.lit("n/a"))
            .when(F.col("o_orderkey") % 89 == 0, F.concat(F.lit("-"), base))
            .otherwise(base))


def q_parse_number(spark: SparkSession, sf: str) -> DataFrame:
    """C6 + C7: locale text ('1234,50 %', '-…', 'n/a') back to a number."""
    o = table(spark, sf, "orders", "o_orderkey", "o_totalprice")
    t = o.select("o_orderkey", _price_text(o).alias("raw"))
    return t.withColumn("parsed", parse_number("raw"))


MESSY_CUSTOMER = [" Künden Nr ", "Name ", "Nation.Key", "Kontö Stand", "Märkt Segment"]


def q_normalize_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Strip, fold, space -> underscore; a dotted name stays usable."""
    c = table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal",
              "c_mktsegment").toDF(*MESSY_CUSTOMER)
    return normalize_headers(c)


def q_harmonize_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Rename when present, derive when missing."""
    c = table(spark, sf, "customer", "c_custkey", "c_name")
    h = harmonize(c, aliases={"c_name": "Customer_Name", "Municipality": "Customer_Name"},
                  derive={"Customer_Slug": lambda df: slug("Customer_Name"),
                          "c_custkey": F.lit(None)})
    return h.select("c_custkey", "Customer_Name", "Customer_Slug")


def q_filter_numeric_id(spark: SparkSession, sf: str) -> DataFrame:
    """pages whose last URL path segment is an all-digit id."""
    p = table(spark, sf, "pages", "page_id", "url")
    t = p.select("page_id", F.regexp_extract("url", "[^/]*$", 0).alias("url_id"))
    return t.where(digits_only("url_id"))


def _injected(spark, sf):
    e = table(spark, sf, "events", "event_id", "user_id", "event_type", "value")
    x = (F.when(F.col("event_id") % 11 == 0, F.lit(float("inf")))
         .when(F.col("event_id") % 13 == 0, F.lit(float("-inf")))
         .when(F.col("event_id") % 17 == 0, F.lit(float("nan")))
         .when(F.col("event_id") % 19 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value")))
    return e.select("event_id", "user_id", "event_type", x.alias("x"))


def q_clean_features(spark: SparkSession, sf: str) -> DataFrame:
    """F3 + F6: non-finite -> null, then drop rows with a null feature."""
    e = non_finite_to_null(_injected(spark, sf), ["x"])
    return drop_null_keys(e, ["x"]).select("event_id", "user_id", "x")


def q_clean_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows before cleaning, with a null, with a non-finite value, kept."""
    return clean_counts(_injected(spark, sf), ["x"])


def q_fill_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """F5 + P11: zero-fill every numeric column (strings untouched)."""
    e = table(spark, sf, "events", "event_id", "user_id", "event_type", "value")
    e = e.select("event_id",
                 F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("uid"),
                 F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("kind"),
                 F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("x"))
    return fill_numeric(e, 0, cols=None)


QUERIES = {
    "slug_variants": q_slug_variants,
    "repair_literals": q_repair_literals,
    "slugify": q_slugify,
    "fold_ascii": q_fold_ascii,
    "repair_text": q_repair_text,
    "collated_join": q_collated_join,
    "collated_words": q_collated_words,
    "dense_ids": q_dense_ids,
    "parse_number": q_parse_number,
    "normalize_headers": q_normalize_headers,
    "harmonize_schema": q_harmonize_schema,
    "filter_numeric_id": q_filter_numeric_id,
    "clean_features": q_clean_features,
    "clean_counts": q_clean_counts,
    "fill_numeric": q_fill_numeric,
}


def _fold_sql(x: str) -> str:
    for k, v in MULTI_CHAR_FOLDS.items():
        x = f"replace({x}, '{k}', '{v}')"
    return f"strip_accents({x})"




def _words_sql(tbl: str, out: str) -> str:
    return f"""
SELECT word, COUNT(*) AS {out} FROM (
  SELECT regexp_replace(lower({_fold_sql('w')}), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS word
  FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS w FROM {tbl}))
WHERE word <> '' GROUP BY 1
"""


ORACLE = {
    "slug_variants": """
WITH p AS (SELECT p_partkey, lower('  ' || p_name || '  Z  ') AS t FROM part)
SELECT p_partkey, regexp_replace(trim(t), '\\s+', '-', 'g') AS runs, replace(trim(t), ' ', '-') AS single,
       regexp_replace(t, '\\s+', '-', 'g') AS untrimmed FROM p
""",
    "repair_literals": """
WITH o AS (SELECT o_orderkey, o_orderstatus, CASE o_orderkey % 3 WHEN 0 THEN 'Förderung'
             WHEN 1 THEN 'Sport und außerschulische Leibeserziehung' ELSE 'Kultur' END AS c FROM orders)
SELECT o_orderkey, o_orderstatus || ': ' || c || ' / ' || c AS category FROM o
""",
    "slugify": "SELECT doc_id, regexp_replace(trim(lower(text)), '\\s+', '-', 'g') AS slug FROM documents",
    "fold_ascii": f"SELECT doc_id, {_fold_sql('text')} AS folded FROM documents",
    "repair_text": "SELECT doc_id, CAST(strlen(text) AS INTEGER) AS damaged_chars, md5(text) AS repaired_md5 FROM documents",
    "dense_ids": """
SELECT row_number() OVER (ORDER BY l_shipdate NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS line_id,
       l_orderkey, l_linenumber FROM lineitem
""",
    "collated_words": r"""
WITH d AS (SELECT word, count(*) AS doc_count FROM (SELECT unnest(regexp_extract_all(text, '\pL+')) AS word FROM documents) GROUP BY word),
b AS (SELECT word AS bench_word, count(*) AS bench_count FROM (SELECT unnest(regexp_extract_all(text, '\pL+')) AS word FROM benchmark) GROUP BY word)
SELECT * FROM d JOIN b ON replace(strip_accents(lower(word)), 'ß', 'ss') = replace(strip_accents(lower(bench_word)), 'ß', 'ss')
""",
    "collated_join": f"""
SELECT d.word, d.doc_count, b.bench_count
FROM ({_words_sql('documents', 'doc_count')}) d JOIN ({_words_sql('benchmark', 'bench_count')}) b USING (word)
""",
    "parse_number": """
WITH t AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
         WHEN o_orderkey % 89 = 0 THEN '-' || replace(printf('%.2f', o_totalprice), '.', ',') || ' %'
         ELSE replace(printf('%.2f', o_totalprice), '.', ',') || ' %' END AS raw
  FROM orders)
SELECT o_orderkey, raw,
  TRY_CAST(regexp_replace(replace(replace(raw, '%', ''), ',', '.'), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS parsed
FROM t
""",
    "normalize_headers": """
SELECT c_custkey AS Kunden_Nr, c_name AS Name, c_nationkey AS "Nation.Key",
       c_acctbal AS Konto_Stand, c_mktsegment AS Markt_Segment
FROM customer
""",
    "harmonize_schema": """
SELECT c_custkey, c_name AS Customer_Name,
       regexp_replace(trim(lower(c_name)), '\\s+', '-', 'g') AS Customer_Slug
FROM customer
""",
    "filter_numeric_id": """
SELECT page_id, regexp_extract(url, '[^/]*$', 0) AS url_id FROM pages
WHERE regexp_matches(regexp_extract(url, '[^/]*$', 0), '^[0-9]+$')
""",
    "clean_features": """
SELECT event_id, user_id, value AS x FROM events
WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0
  AND value IS NOT NULL
""",
    "clean_counts": """
WITH t AS (SELECT CASE WHEN event_id % 11 = 0 THEN 'inf' WHEN event_id % 13 = 0 THEN '-inf'
                       WHEN event_id % 17 = 0 THEN 'nan' WHEN event_id % 19 = 0 OR value IS NULL THEN 'null'
                       ELSE 'ok' END AS kind FROM events)
SELECT COUNT(*) AS n_rows,
       CAST(SUM(CASE WHEN kind = 'null' THEN 1 ELSE 0 END) AS BIGINT) AS n_null,
       CAST(SUM(CASE WHEN kind IN ('inf', '-inf', 'nan') THEN 1 ELSE 0 END) AS BIGINT) AS n_non_finite,
       CAST(SUM(CASE WHEN kind = 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS n_kept
FROM t
""",
    "fill_numeric": """
SELECT event_id,
  CASE WHEN event_id % 5 <> 0 THEN user_id ELSE 0 END AS uid,
  CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind,
  CASE WHEN event_id % 7 <> 0 THEN value ELSE 0.0 END AS x
FROM events
""",
}
