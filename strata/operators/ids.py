"""Dense surrogate ids (P8): 1, 2, 3, ... in a given order.

``row_number`` over an unpartitioned window sends every row to one task, and
hashes of 64 bits neither count up nor exclude collisions.  Here the rows are
range-partitioned by the order and sorted inside each task; a row's id is its
place in its task plus the rows of the tasks before, which come from one row
per task.  The ordered rows are written once, so a rerun of a lost task reads
what was numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize


def dense_ids(df: DataFrame, order: list[str | Column], out: str = "id", start: int = 1) -> DataFrame:
    """``df`` with ``out`` = ``start``, ``start`` + 1, ... by the columns
    or expressions of ``order``, ascending, nulls first.  The ids are the same in every run if the order tells all rows
    apart; rows that it does not tell apart get neighbouring ids.  A column
    named ``out`` is replaced."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c for c in order]
    rows = df.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c != out]).alias("row"),
                     *[c.alias(f"by{i}") for i, c in enumerate(by)])
    keys = [f"by{i}" for i in range(len(by))]
    placed = (rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop(*keys)
              .withColumn("at", F.monotonically_increasing_id()))
    # the number holds the task above bit 33 and the row's place in it below
    placed = materialize(placed.withColumn("task", F.shiftright("at", 33)).withColumn("place", F.col("at") % (1 << 33)), "dense-ids")
    tasks = placed.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    before = tasks.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    numbered = placed.join(F.broadcast(before), "task")         # one row per task
    return numbered.select((F.col("before") + F.col("place") + start).alias(out), "row.*")
