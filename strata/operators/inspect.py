"""Inspection (A11, A12, K2, L1): results are DataFrames, not prints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import q


def profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, n_rows, n_nulls) for every column.

    One aggregation pass computes every count; the one-row result is then
    unpivoted with ``stack``.  Types come from the schema (metadata).
    """
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_n"),
                    *[(F.count(F.lit(1)) - F.count(F.col(q(c)))).alias(f"_z{i}")
                      for i, c in enumerate(cols)])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = ", ".join(f"'{c}', '{types[c]}', _z{i}" for i, c in enumerate(cols))
    return counts.selectExpr(f"stack({len(cols)}, {rows}) AS (column_name, data_type, n_nulls)", "_n") \
        .select("column_name", "data_type", F.col("_n").alias("n_rows"), "n_nulls")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values (partial aggregation, no RDD, nothing collected)."""
    return df.select(col).distinct()


def sample_rows(df: DataFrame, n: int, order_by) -> DataFrame:
    """L1: the first ``n`` rows in a stable order (top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(n)


def validate_keys(df: DataFrame, keys, pattern: str | None = None) -> DataFrame:
    """SURVEY H8: an entity dimension is a table, checked before use.  Keys
    that occur more than once (they would fan out every join on them) or
    whose first key column does not match ``pattern`` are returned with
    their row count; an empty result means the dimension is clean.  One
    aggregation with partial aggregation, so a hot key costs nothing extra."""
    keys = list(keys)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    ok = F.col(q(keys[0])).rlike(pattern) if pattern else F.lit(True)
    g = g.withColumn("pattern_ok", F.coalesce(ok, F.lit(False)))
    return g.where((F.col("n_rows") > 1) | ~F.col("pattern_ok"))
