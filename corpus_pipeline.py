"""The corpus pipeline: documents in, token files out, stage by stage.

Each stage takes (spark, docs, sf_dir), works on every row that its
predecessor kept and returns a DataFrame; it is written as Parquet in the
shared folder and read again as the next stage's ``docs``; then its shuffle
files are deleted.  All but the last
return the columns of documents.  Nulls: a row without text is rejected by
the first stage; a row without an id is never a duplicate of another; rows
that repeat an id and the text are one document to the second stage, which
keeps one of them, rows with another text are another; an empty table passes
through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.decontaminate import clean
from strata.llm.language_id import identify_documents
from strata.llm.mixing import mixed_rows, n_words
from strata.llm.ngram_join import jaccard_components
from strata.llm.token_files import read_token_files, write_token_files
from strata.session import free_shuffles, materialize, scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages."""
    return identify_documents(docs).where("accepted").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Rows that share an id but not the text are documents of their own: one
    of the texts (the least by hash) goes by the id, the others by a number
    from 2^62 up.  Of rows with equal id and text one is kept."""
    text = F.xxhash64("text")
    several = (docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(text).alias("__low"), F.max(text).alias("__high"))
               .where("__low < __high").select(F.col("doc_id").alias("__several"), "__low"))
    several = materialize(several, "ids-of-several-texts")      # by its files' size Spark knows whether to broadcast it
    other = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    named = (docs.join(several, F.col("doc_id") == F.col("__several"), "left")
             .withColumn("__id", F.when(F.col("__low") != text, other).otherwise(F.col("doc_id"))).drop("__several", "__low"))
    first = jaccard_components(named, "__id").where("component_id = __id").select("__id").distinct()
    once = W.partitionBy("__id").orderBy(F.xxhash64(*docs.columns))
    kept = (named.join(first, "__id", "left_semi").withColumn("__row", F.row_number().over(once))
            .where("__row = 1").drop("__row", "__id"))
    return kept.unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_rows(docs, n_words("text"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the documents, and one row per document from them."""
    path = scratch_path(spark, "pipeline-token-files")
    write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mixing", mixing), ("token_ids", token_ids)]
ORACLE_SQL = None       # language model scores and byte-pair merges are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        free_shuffles(spark)
    return docs
