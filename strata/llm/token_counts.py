"""Token counts of whole texts by a map-side two-tier lookup.

Tier one is a broadcast table of the lengths (in tokens) of frequent
pre-token units, at most ``table_size`` entries, fitted on at most
``sample_docs`` texts.  Tier two is a cache in each Python worker that
encodes a missed unit with the tokenizers library.  The table only saves
encoding: counts are the library's for every text, and no pre-token is
ever shuffled.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.units import UnitCache, encoder
from strata.llm.worker import kept
from strata.session import ship

OPERATOR = "token_counts"
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 8_000
TABLE_SIZE = 32_768


def frequent_lengths(df: DataFrame, text_col: str, spec: str, key: str,
                     sample_docs: int = SAMPLE_DOCS, table_size: int = TABLE_SIZE) -> dict[str, int]:
    """Tokens of the most frequent units of at most ``sample_docs`` texts of
    at most SAMPLE_CHARS characters, taken from the first partitions."""
    enc, seen = encoder(OPERATOR, spec, key), Counter()
    if enc.kind == "whole":
        return {}
    text = F.col(f"`{text_col}`")
    for row in df.where(F.length(text).between(1, SAMPLE_CHARS)).select(text).limit(sample_docs).collect():
        for part in enc.segments(row[0]):
            seen.update(u for u in enc.units(part) if len(u) <= 64)
    return {u: len(enc.unit(u)) for u, _ in seen.most_common(table_size)}


def n_tokens(df: DataFrame, text_col: str, tokenizer_path: str, sample_docs: int = SAMPLE_DOCS,
             table_size: int = TABLE_SIZE) -> Column:
    """A long column: tokens of ``text_col``; null and empty texts have 0."""
    ship(df.sparkSession)
    spec = Path(tokenizer_path).read_text()
    key = hashlib.sha256(spec.encode()).hexdigest()
    sc = df.sparkSession.sparkContext
    shared_spec = sc.broadcast(spec)
    table = sc.broadcast(frequent_lengths(df, text_col, spec, key, sample_docs, table_size))

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(OPERATOR, shared_spec.value, key)
        lengths = _lengths(enc, key, table.value)
        for texts in batches:
            yield pd.Series([_count(t, enc, lengths) if t else 0 for t in texts], dtype="int64")

    return count(F.col(f"`{text_col}`"))


def _lengths(enc, key: str, table: dict[str, int]) -> UnitCache:
    return kept(OPERATOR, ("lengths", key), lambda: UnitCache(enc, len, lambda a, b: a + b, table))


def _count(text: str, enc, lengths: UnitCache) -> int:
    if enc.kind == "whole":
        return len(enc.encode(text))
    return sum(1 if part in enc.specials else sum(map(lengths.__getitem__, enc.units(part)))
               for part in enc.segments(text))


def token_counts(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, sample_docs: int = SAMPLE_DOCS, table_size: int = TABLE_SIZE) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit), one row per input row.

    Null and empty texts have 0 bytes and 0 tokens; a null id stays null;
    repeated rows give repeated rows; an empty table gives no rows; other
    columns, whatever their names, are not read.  Special strings inside a
    text count as the library counts them by default (one token each).
    """
    d = df.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text"))
    return (d.select(id_col, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                     n_tokens(d, "text", tokenizer_path, sample_docs, table_size).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))
