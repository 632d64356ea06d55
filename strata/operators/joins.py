"""Equi-joins on panel keys and physical join strategies.

A broadcast is only requested after a check proves the side is small: its
rows and bytes are counted by one partial aggregation, which no task holds.
Without that proof the join is left to the planner, where AQE turns it into a
broadcast hash join only when the measured size of a shuffle stage is
below ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRATEGIES = ("auto", "broadcast", "shuffle_hash", "merge")

# Largest side we broadcast on request.  The build side lives in every
# executor's memory, so rows and bytes are checked before hinting.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20


@dataclass
class Size:
    rows: int
    bytes: int          # as JSON text
    longest: int        # rows of the key that has the most


def measured(df: DataFrame, keys=()) -> Size:
    """Size of ``df`` by one job of partial aggregations; three numbers reach
    the driver."""
    width = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), width.alias("b"))
    r = per_key.agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.max("n").alias("longest")).first()
    return Size(r.n or 0, r.b or 0, r.longest or 0)


def rows_at_most(df: DataFrame, n: int, max_bytes: int | None = None) -> bool:
    """True iff ``df`` has at most ``n`` rows (and, written as JSON, at most
    ``max_bytes`` bytes)."""
    if max_bytes is None:
        return df.agg(F.count(F.lit(1))).first()[0] <= n
    size = measured(df)
    return size.rows <= n and size.bytes <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when the bounds on rows and bytes hold, else the frame
    unchanged.  The check runs ``df`` once; it is for sides read from a table."""
    return F.broadcast(df) if rows_at_most(df, max_rows, max_bytes) else df


def join_with_strategy(left: DataFrame, right: DataFrame, on, how: str = "inner",
                       strategy: str = "auto",
                       max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """One equi-join under a chosen physical strategy.

    ``broadcast`` falls back to ``auto`` when the right side is not proven
    small; ``shuffle_hash`` and ``merge`` are plain planner hints.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if strategy == "broadcast":
        right = bounded_broadcast(right, max_broadcast_rows)
    elif strategy in ("shuffle_hash", "merge"):
        right = right.hint(strategy)
    return left.join(right, on, how)


def panel_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join two panels on (entity, period).  When both sides come
    out of aggregations on the same keys, Spark keeps their hash
    partitioning and plans no further exchange for the join."""
    return left.join(right, list(keys), how)


def collated_join(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
                  how: str = "inner", collation: str = "UNICODE_CI_AI") -> DataFrame:
    """C5 without a folded key column: an equi-join that compares the two
    strings under a case- and accent-insensitive collation (``Straße`` =
    ``STRASSE``, ``Pöndorf`` = ``pondorf``).  Spark plans it as a hash-
    partitioned join on collation keys, so it scales like any equi-join."""
    cond = F.collate(left[left_col], collation) == F.collate(right[right_col], collation)
    return left.join(right, cond, how)
