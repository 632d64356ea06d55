"""Queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe_stream import round_trip
from strata.llm.decontaminate import contamination
from strata.llm.embedding_dedup import near_duplicate_vectors
from strata.llm.language_id import identify_documents, identify_pages
from strata.llm.license_scan import TEMPLATES, scan_licenses
from strata.llm.merkle import lowered_where_due, merkle_manifest
from strata.llm.mixing import mix, n_words
from strata.llm.ngram_join import jaccard_components
from strata.llm.periodic_runs import periodic_runs
from strata.llm.substring_dedup import remove_repeats
from strata.llm.token_counts import token_counts
from strata.llm.token_files import read_token_files, write_token_files
from strata.llm.warc import capture_histories, write_warc
from strata.session import scratch_path


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return token_counts(docs, tokenizer("byte_bpe_50k.json"))


def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf}/documents.parquet"), path, tokenizer("word_bpe_49k.json"))
    return read_token_files(spark, path)


def op2_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf}/documents.parquet"))


def op5_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = remove_repeats(spark.read.parquet(f"{sf}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", n_words("text").alias("size"))
    return mix(docs, F.col("size")).select("row.doc_id", "size", "source_size", "target",
                                           (F.col("copies") * F.col("size")).alias("taken"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, (CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS weight FROM s),
l AS (SELECT *, row_number() OVER r AS room,
       (sum(source_size) OVER () - 3 * (sum(source_size) OVER r - source_size))::DOUBLE
       / (sum(weight) OVER () - (sum(weight) OVER r - weight))::DOUBLE AS level
      FROM w WINDOW r AS (ORDER BY source_size / weight::DOUBLE, rank ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, 3 * source_size <= level * weight AS "full" FROM l),
t AS (SELECT source, source_size, CASE WHEN "full" THEN (3 * source_size)::DOUBLE
       ELSE (SELECT level FROM f WHERE NOT "full" ORDER BY room LIMIT 1) * weight END AS target FROM f),
k AS (SELECT d.doc_id, d.size, t.source_size, t.target,
       row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS FIRST) AS rank,
       CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS each,
       ('0x' || substr(md5(coalesce(d.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(each * rank + u) - floor(each * (rank - 1) + u)) * size)::BIGINT AS taken FROM k"""


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf}/pages.parquet"), path)
    return capture_histories(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                                 "position")


OP9_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS payload_digest,
       regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)', 1) AS host,
       regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)', 2) AS rest FROM pages),
r AS (SELECT *, strlen(payload)::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY payload_digest) AS first,
       array_to_string(list_reverse(string_split(lower(host), '.')), ',') || ')' || CASE WHEN rest = '' THEN '/' ELSE rest END AS url_key FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to,
       row_number() OVER (ORDER BY url_key, page_id % 1000000000, page_id) - 1 AS position FROM r"""


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return found.select("doc_id", "contaminated", "n_items", "containment")


OP7_SQL = r"""
WITH t AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x20\x09-\x0D]+') AS words FROM t),
s AS (SELECT DISTINCT kind, id, array_to_string(words[i + 1:i + 5], ' ') AS shingle
      FROM (SELECT kind, id, words, unnest(range(greatest(len(words) - 4, 1))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT id AS item, count(*) AS size FROM s WHERE kind = 'i' GROUP BY id),
c AS (SELECT d.id, i.id AS item, count(*) AS common FROM s d JOIN s i ON d.shingle = i.shingle AND d.kind = 'd' AND i.kind = 'i' GROUP BY ALL),
f AS (SELECT c.id, count(*) AS n_items, max(common / size) AS containment FROM c JOIN n USING (item)
      WHERE 100 * common >= 80 * size GROUP BY c.id)
SELECT doc_id, f.id IS NOT NULL AS contaminated, coalesce(n_items, 0)::BIGINT AS n_items, containment
FROM documents LEFT JOIN f ON doc_id = f.id"""


def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    found = identify_documents(spark.read.parquet(f"{sf}/documents.parquet"), ["doc_id"])
    return found.select("row.doc_id", "declared", "text_language", "language", "confidence", "accepted")


def page_languages(spark: SparkSession, sf: str) -> DataFrame:
    found = identify_pages(spark.read.parquet(f"{sf}/pages.parquet"), spark.read.parquet(f"{sf}/documents.parquet"), ["page_id"])
    return found.select("row.page_id", "declared", "host", "text_language", "language", "confidence", "accepted")


def op3_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op6_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = scan_licenses(spark.read.parquet(f"{sf}/documents.parquet"))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join("licenses", ",").alias("licenses"),
                        F.array_max(F.transform("matches", lambda m: m["containment"])).alias("containment"))


OP6_SQL = r"""
WITH t AS (SELECT 'd' AS kind, doc_id AS id, text, '' AS license FROM documents
           UNION ALL SELECT 't', row_number() OVER (), text, license FROM (VALUES %s) v(license, text)),
w AS (SELECT kind, id, license, regexp_extract_all(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[!-/:-@\[-`{-~]', ' ', 'g'), '[^\x20\x09-\x0D]+') AS words FROM t),
s AS (SELECT DISTINCT kind, id, license, array_to_string(words[i + 1:i + 5], ' ') AS shingle
      FROM (SELECT *, unnest(range(greatest(len(words) - 4, 1))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT id AS template, license, count(*) AS size FROM s WHERE kind = 't' GROUP BY ALL),
c AS (SELECT d.id, i.id AS template, count(*) AS common FROM s d JOIN s i ON d.shingle = i.shingle AND d.kind = 'd' AND i.kind = 't' GROUP BY ALL),
f AS (SELECT c.id, license, max(common / size) AS containment FROM c JOIN n USING (template) WHERE 100 * common >= 80 * size GROUP BY ALL),
g AS (SELECT id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS licenses, max(containment) AS containment FROM f GROUP BY id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_licenses, coalesce(licenses, '') AS licenses, containment
FROM documents LEFT JOIN g ON doc_id = id""" % ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES)


def op11_merkle(spark: SparkSession, sf: str) -> DataFrame:
    rows = merkle_manifest(spark.read.parquet(f"{sf}/documents.parquet"), ["doc_id", "source", "lang", "n_chars", "text"],
                           {"text": lowered_where_due()})
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


# the CRC-32 of the decimal id, byte by byte and bit by bit
OP11_SQL = r"""
WITH RECURSIVE v AS (SELECT doc_id, source, lang, n_chars, text,
       xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda crc, b:
           list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, b)), 4294967295::BIGINT), 4294967295) AS crc
      FROM documents),
e AS (SELECT doc_id, source, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
       coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head, text,
       CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS now FROM v),
d AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(now) || ':' || now, '-')) AS found FROM e),
t AS (SELECT *, row_number() OVER () AS id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
       row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, found) - 1 AS no, count(*) OVER (PARTITION BY source) AS n FROM d),
low AS (SELECT tree, 0 AS level, no, leaf AS digest, n FROM t
      UNION ALL SELECT tree, level + 1, no // 16, sha256(string_agg(digest, '' ORDER BY no)), (max(n) + 15) // 16
      FROM low WHERE n > 1 GROUP BY tree, level, no // 16),
top AS (SELECT 0 AS level, tree AS no, digest, count(*) OVER () AS n FROM low WHERE n = 1
      UNION ALL SELECT level + 1, no // 16, sha256(string_agg(digest, '' ORDER BY no)), (max(n) + 15) // 16 FROM top WHERE n > 1 GROUP BY level, no // 16),
k AS (SELECT tree, level, no // 16 AS up, string_agg(digest, '' ORDER BY no) AS run FROM low WHERE n > 1 GROUP BY ALL
      UNION ALL SELECT -1, level, no // 16, string_agg(digest, '' ORDER BY no) FROM top WHERE n > 1 GROUP BY level, no // 16),
c AS (SELECT id, tree, 0 AS level, no, n, found AS folded, '' AS proof FROM t
      UNION ALL SELECT id, c.tree, c.level + 1, no // 16, (n + 15) // 16,
       sha256(left(run, 64 * (no % 16)) || folded || substr(run, 64 * (no % 16) + 65)), proof || left(run, 64 * (no % 16)) || substr(run, 64 * (no % 16) + 65)
      FROM c JOIN k ON k.tree = c.tree AND k.level = c.level AND k.up = c.no // 16 WHERE n > 1),
u AS (SELECT id, 0 AS level, tree AS no, (SELECT max(n) FROM top) AS n, folded, proof FROM c WHERE n = 1
      UNION ALL SELECT id, u.level + 1, no // 16, (n + 15) // 16,
       sha256(left(run, 64 * (no % 16)) || folded || substr(run, 64 * (no % 16) + 65)), proof || left(run, 64 * (no % 16)) || substr(run, 64 * (no % 16) + 65)
      FROM u JOIN k ON k.tree = -1 AND k.level = u.level AND k.up = u.no // 16 WHERE n > 1)
SELECT doc_id, leaf, low.digest AS subroot, top.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = top.digest AS verified
FROM t JOIN u USING (id) JOIN low ON low.tree = t.tree AND low.n = 1 CROSS JOIN top WHERE u.n = 1 AND top.n = 1"""


def op12_bpe_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = round_trip(spark.read.parquet(f"{sf}/documents.parquet"), tokenizer("word_bpe_49k.json"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_digest(docs: DataFrame) -> DataFrame:
    """The runs of documents of which one in ten (by the CRC-32 of the decimal
    id) is made periodic from some word on; null ids are left as they are."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    parts = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = (docs.select("doc_id", "text", F.when(crc % 10 == 0, parts).alias("words"), F.floor(crc / 10).alias("g"))
            .withColumn("n", F.size("words"))
            .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
            .withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1))
    a, p = F.col("a"), F.col("p")
    again = F.transform(F.sequence(F.lit(0), F.col("n") - 1),
                        lambda i: F.get("words", F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
    rows = rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
    item = "struct<start: bigint, length: bigint, period: bigint>"
    found = periodic_runs(rows).withColumn("best", F.aggregate("runs", F.lit(None).cast(item), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.floor(F.lit(1000).cast("long") * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return op13_digest(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op1_token_counts": op1_token_counts, "op2_ngram_join": op2_ngram_join,
           "op3_embedding_dedup": op3_embedding_dedup, "op4_language_id": op4_language_id, "page_languages": page_languages,
           "op5_substring_dedup": op5_substring_dedup,
           "op6_license_scan": op6_license_scan, "op7_decontamination": op7_decontamination, "op8_mixing": op8_mixing, "op9_warc": op9_warc,
           "op10_token_files": op10_token_files, "op11_merkle": op11_merkle, "op12_bpe_stream": op12_bpe_stream,
           "op13_periodic_runs": op13_periodic_runs}
ORACLE: dict[str, str] = {"op6_license_scan": OP6_SQL, "op7_decontamination": OP7_SQL, "op8_mixing": OP8_SQL, "op9_warc": OP9_SQL,
                          "op11_merkle": OP11_SQL}
