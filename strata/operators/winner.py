"""Row-wise winner selection.

Rules kept from the reference: null counts as 0 for the maximum; a tie
goes to the first column (wide) / the label that sorts first in the
given order (long); a row whose counts are all null has no winner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import q


def winner_wide(df: DataFrame, label_cols, out: str = "winner", max_out: str | None = "max_value",
                tie_out: str | None = None) -> DataFrame:
    """Arg-max across columns of one row, in one projection.

    Every candidate is ``named_struct(v, -position, name)``; ``array_max``
    compares structs field by field, so the largest value wins and, among
    equal values, the lowest position.  Null values sort below every
    number, which reproduces "null counts as 0 but is never the winner".
    """
    label_cols = list(label_cols)
    if not label_cols:
        raise ValueError("no label columns")
    cands = [F.named_struct(F.lit("v"), F.col(q(c)), F.lit("k"), F.lit(-i), F.lit("n"), F.lit(c))
             for i, c in enumerate(label_cols)]
    best = F.array_max(F.array(*cands))
    cols = {out: F.when(best["v"].isNotNull(), best["n"])}
    if max_out:
        cols[max_out] = F.coalesce(best["v"], F.lit(0))
    if tie_out:
        n_at_max = sum(F.coalesce((F.col(q(c)) == best["v"]).cast("int"), F.lit(0))
                       for c in label_cols)
        cols[tie_out] = F.coalesce(n_at_max > 1, F.lit(False))
    return df.withColumns(cols)


def winner_long(df: DataFrame, keys, label_col: str, value_col: str, out: str = "winner",
                max_out: str | None = "max_value", order_col: str | None = None) -> DataFrame:
    """Arg-max per key over long rows ``(keys, label, value)``.

    ``min_by(label, struct(-value, order))`` is an algebraic aggregate:
    partial aggregation per task, so a hot key is pre-reduced before the
    shuffle and never gathered in one place.  Ties go to the smallest
    ``order_col`` (default: the label itself).  A key whose values are all
    null keeps its row, with a null winner and maximum.
    """
    order = F.col(order_col) if order_col else F.col(label_col)
    value = F.col(q(value_col))
    rank = F.when(value.isNotNull(), F.struct((-value).alias("nv"), order.alias("o")))
    aggs = [F.min_by(F.col(q(label_col)), rank).alias(out)]
    if max_out:
        aggs.append(F.max(value).alias(max_out))
    return df.groupBy(*keys).agg(*aggs)
