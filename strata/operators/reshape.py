"""Aggregation and reshaping.

All aggregates here are algebraic (sum, count, min/max, min_by/max_by),
so Spark runs them as partial aggregation before the shuffle: a key that
holds a third of all rows is folded map-side into one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import q
from strata.functions.numbers import allocate
from strata.functions.text import header, unique_names
from strata.operators.stats import join_groups

NULL_CATEGORY = "null"


def _sum(measure: str, exact: str | None) -> Column:
    m = F.col(q(measure))
    return F.sum(m.cast(exact)).cast("double") if exact else F.sum(m)


def panel_sum(df: DataFrame, keys, measure: str, out: str = "total",
              exclude_categories=None, category_col: str | None = None,
              exact_money: str | None = None, count_col: str | None = None) -> DataFrame:
    """A1: one row per key with the summed measure.

    ``exclude_categories`` drops rows whose ``category_col`` is, e.g., a
    total row that the source already contains (avoids double counting); a
    null category is kept.  The sum is the plain one; ``exact_money`` names a
    decimal type, e.g. "decimal(18,2)", in which rows are summed exactly.
    """
    if exclude_categories:
        df = df.where(~F.coalesce(F.col(category_col).isin(list(exclude_categories)), F.lit(False)))
    aggs = [_sum(measure, exact_money).alias(out)]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(*keys).agg(*aggs)


def ratio_of_sums(df: DataFrame, keys, num: Column, den: Column, out: str = "ratio",
                  num_out: str = "num", den_out: str = "den") -> DataFrame:
    """A2: sum(num) / sum(den) per key, null on a zero denominator."""
    return (df.groupBy(*keys)
            .agg(F.sum(num).alias(num_out), F.sum(den).alias(den_out))
            .withColumn(out, F.try_divide(F.col(num_out), F.col(den_out))))


def pivot_values(df: DataFrame, keys, pivot_col: str, values, measure: str,
                 agg: str = "sum", names: dict | None = None,
                 exact_money: str | None = None) -> DataFrame:
    """A3: pivot on an explicit value list (no extra job to discover values);
    null may be one of the values, its column is named "null".

    ``agg`` defaults to a deterministic function; the reference's ``first``
    depends on row order when a cell has duplicates.
    """
    m = F.col(q(measure))
    fn = {"sum": lambda c: _sum(measure, exact_money), "max": F.max, "min": F.min, "avg": F.avg, "count": F.count,
          "first": F.first}[agg]
    out = df.groupBy(*keys).pivot(pivot_col, [v for v in values if v is not None]).agg(fn(m))
    if None in values:
        # the null category as one more column, null-safe on the keys
        rest = df.where(F.col(q(pivot_col)).isNull()).groupBy(*keys).agg(fn(m).alias(NULL_CATEGORY))
        out = join_groups(out, rest, list(keys), "left")
    if names:
        out = out.withColumnsRenamed({str(k): v for k, v in names.items()})
    return out


def discover_values(df: DataFrame, col: str, limit: int = 10000) -> list:
    """Distinct values of a low-cardinality column, sorted.

    This is the extra job Spark's pivot runs when no values are given; it
    is a distinct aggregation (partial + final), and only the distinct
    values reach the driver.  More than ``limit`` values is an error, as
    with ``spark.sql.pivotMaxValues``; ``pivot_sparse`` has no limit.
    """
    vals = [r[0] for r in df.select(col).distinct().limit(limit + 1).collect()]
    if len(vals) > limit:
        raise ValueError(f"{col} has more than {limit} distinct values: use pivot_sparse")
    return sorted((v for v in vals if v is not None)) + [None] * (None in vals)


def pivot_discovered(df: DataFrame, keys, pivot_col: str, measure: str,
                     prefix: str = "Cat_", fill: float | None = 0.0,
                     exact_money: str | None = None) -> DataFrame:
    """A4 + P3 + F4: pivot on discovered values (null included), clean the
    new column names and fill empty cells."""
    values = discover_values(df, pivot_col)
    names = {NULL_CATEGORY if v is None else str(v): header(NULL_CATEGORY if v is None else str(v), prefix=prefix) for v in values}
    unique_names(list(keys) + list(names.values()))
    out = pivot_values(df, keys, pivot_col, values, measure, "sum", names, exact_money)
    if fill is not None:
        out = out.fillna(fill, subset=list(names.values()))
    return out


def pivot_sparse(df: DataFrame, keys, pivot_col: str, measure: str, blocks: int = 1,
                 exact_money: str | None = None, out: str = "cells", null_out: str = "null_cell",
                 block_out: str = "block") -> DataFrame:
    """A4 for any number of values: one row per key with a map from value to
    summed measure, for columns that no wide table can hold.

    No value reaches the driver and none is a column, so there is no limit
    on them.  With ``blocks`` > 1 a key has one row per block of its values
    (by hash, named ``block_out``), so a key with very many values is spread
    and no row holds them all.  Cells that have no row are absent from the
    map; a cell whose measures are all null is null, as in the wide form.
    A null value's sum is ``null_out``, in block 0, and apart from a value
    "null".  Null keys are keys.  An empty table gives no rows.
    """
    if blocks < 1:
        raise ValueError("blocks must be at least 1")
    keys = list(keys)
    unique_names([*keys, block_out, out, null_out])
    value = F.col(q(pivot_col)).cast("string")
    block = F.when(value.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(value), F.lit(blocks))).cast("int")
    ids = [F.col(q(k)) for k in keys]
    cells = (df.groupBy(*ids, block.alias(block_out), value.alias("__value"))
             .agg(_sum(measure, exact_money).alias("__cell")))
    cell = F.when(F.col("__value").isNotNull(), F.struct("__value", "__cell"))     # the list leaves nulls out
    wide = cells.groupBy(*ids, block_out).agg(
        F.map_from_entries(F.sort_array(F.collect_list(cell))).alias(out),
        F.max(F.when(F.col("__value").isNull(), F.col("__cell"))).alias(null_out))
    return wide if blocks > 1 else wide.drop(block_out)


def unpivot(df: DataFrame, keys, value_cols, var: str = "label", value: str = "value") -> DataFrame:
    """Wide -> long (the inverse of a pivot)."""
    return df.unpivot(list(keys), [q(c) for c in value_cols], var, value)


def allocate_columns(df: DataFrame, part_cols, total_col: str, measure_col: str,
                     suffix: str = "_alloc", drop_parts: bool = False) -> DataFrame:
    """C15 + P10: part/total * measure for every part column, one projection."""
    new = {c + suffix: allocate(F.col(q(c)), F.col(q(total_col)), F.col(q(measure_col)))
           for c in part_cols}
    out = df.withColumns(new)
    return out.drop(*part_cols) if drop_parts else out
