"""Column-set and null-handling helpers.

Column selection works on ``df.columns`` / ``df.schema`` (driver metadata);
the data-touching parts are one ``select`` or one ``fillna`` each, so
Catalyst collapses them into a single projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from strata.functions.text import header, unique_names


def q(name: str) -> str:
    """Back-tick a column name so dots and spaces are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def normalize_headers(df: DataFrame, split: str = " ", sep: str = "_") -> DataFrame:
    """Rename every column by the header rule; collisions raise."""
    new = unique_names([header(c, split, sep) for c in df.columns])
    return df.toDF(*new)


def harmonize(df: DataFrame, aliases: dict[str, str] | None = None,
              derive: dict[str, object] | None = None) -> DataFrame:
    """Rename ``alias -> canonical`` when the alias is present and the
    canonical name is not; add ``derive[name]`` (a Column or a function of
    the DataFrame) only when ``name`` is still missing."""
    aliases = aliases or {}
    renames = {a: c for a, c in aliases.items() if a in df.columns and c not in df.columns}
    if renames:
        df = df.withColumnsRenamed(renames)
    adds = {}
    for name, expr in (derive or {}).items():
        if name not in df.columns:
            adds[name] = expr(df) if callable(expr) else expr
    return df.withColumns(adds) if adds else df


def drop_columns(df: DataFrame, *cols: str, strict: bool = False) -> DataFrame:
    """Drop; absent names are ignored unless ``strict``."""
    missing = [c for c in cols if c not in df.columns]
    if strict and missing:
        raise ValueError(f"cannot drop missing columns {missing}")
    return df.drop(*[c for c in cols if c in df.columns])


def columns_excluding(df: DataFrame, known, numeric_only: bool = True) -> list[str]:
    """The columns not in ``known`` (e.g. the party columns)."""
    out = [c for c in df.columns if c not in set(known)]
    if numeric_only:
        types = dict((f.name, f.dataType) for f in df.schema.fields)
        out = [c for c in out if isinstance(types[c], NumericType)]
    return out


def columns_with_prefix(df: DataFrame, prefix: str, exclude=()) -> list[str]:
    """P10."""
    return [c for c in df.columns if c.startswith(prefix) and c not in set(exclude)]


def numeric_columns(df: DataFrame) -> list[str]:
    """Every numeric column (the reference missed doubles)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def fill_numeric(df: DataFrame, value=0, cols=None) -> DataFrame:
    """one ``fillna`` over the numeric columns."""
    cols = numeric_columns(df) if cols is None else list(cols)
    return df.fillna(value, subset=cols) if cols else df


def non_finite_to_null(df: DataFrame, cols=None) -> DataFrame:
    """+-infinity and NaN -> null in floating columns, one projection."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    cols = [c for c in (cols or df.columns) if c in floating]
    if not cols:
        return df
    fixed = {}
    for c in cols:
        x = F.col(q(c))
        fixed[c] = F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)
    return df.withColumns(fixed)


def drop_null_keys(df: DataFrame, cols) -> DataFrame:
    """F3."""
    return df.dropna(subset=list(cols))


def digits_only(c: str):
    """predicate for all-digit ids."""
    return F.col(q(c)).rlike("^[0-9]+$")


def surrogate_key(*cols: str):
    """A row key that does not depend on partitioning or recomputation
    (``monotonically_increasing_id`` does, SURVEY H4): xxhash64 of the
    natural key columns.  Prefer joining on the natural key itself."""
    return F.xxhash64(*[F.col(q(c)) for c in cols])


def clean_counts(df: DataFrame, cols) -> DataFrame:
    """SURVEY H16: how many rows a cleaning step keeps, in one aggregation:
    rows, rows with a null / a non-finite (NaN, +-inf) value in ``cols``,
    and rows that survive (every value present and finite)."""
    cols = list(cols)
    nan_or_inf = [F.isnan(F.col(q(c))) | (F.abs(F.col(q(c))) == F.lit(float("inf"))) for c in cols]
    null = [F.col(q(c)).isNull() for c in cols]
    any_null = null[0]
    any_bad = nan_or_inf[0]
    for a, b in zip(null[1:], nan_or_inf[1:]):
        any_null, any_bad = any_null | a, any_bad | b
    bad = F.coalesce(any_bad, F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(any_null.cast("long")).alias("n_null"),
                  F.sum(bad.cast("long")).alias("n_non_finite"),
                  F.sum((~any_null & ~bad).cast("long")).alias("n_kept"))
