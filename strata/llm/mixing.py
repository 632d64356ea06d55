"""Mixing sources to target weights by systematic sampling.

Targets: the sources, in code point order with null last, weigh 5, 2, 1,
5, 2, 1 ... and share the total size by weight; a target stops at ``cap``
times its source's size and the excess is shared by the others.

Sampling: every document of a source is expected target / source size
times.  The documents of a source are ordered by size, the expected copies
summed up in that order, one offset (from the source's name) is added, and a
document is emitted once for each whole number its sum crosses.  Because
neighbours in the order have nearly the same size, the words taken come
close to the target.

The order is one range partitioning over (source, size, id), so a source
with a third of all rows is spread over many tasks; ranks come from each
task's row numbers and one row per task and source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.session import materialize

WEIGHTS = (5, 2, 1)
CAP = 3
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> with target; one row per source throughout."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by_room = W.orderBy(F.col("source_size") / F.col("weight"), "rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    t = sizes.withColumn("rank", F.row_number().over(order) - 1)
    t = t.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    # the level of weight that is left when all sources with less room are at their caps
    t = (t.withColumn("room", F.row_number().over(W.orderBy(F.col("source_size") / F.col("weight"), "rank")))
         .withColumn("level", (F.sum("source_size").over(every) - cap * (F.sum("source_size").over(by_room) - F.col("source_size")))
                     / (F.sum("weight").over(every) - (F.sum("weight").over(by_room) - F.col("weight")))))
    t = t.withColumn("full", F.lit(cap) * F.col("source_size") <= F.col("level") * F.col("weight"))
    t = t.withColumn("final", F.min(F.when(~F.col("full"), F.struct("room", "level"))).over(every)["level"])
    return t.select("source", "source_size", F.when(F.col("full"), (F.lit(cap) * F.col("source_size")).cast("double"))
                    .otherwise(F.col("final") * F.col("weight")).alias("target"))


def mix(df: DataFrame, size: Column, source_col: str = "source", id_col: str = "doc_id",
        weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(row, size, source_size, target, copies), one row per input row;
    ``row`` holds the input columns, ``copies`` says how often the mix emits it.

    A null or zero size weighs nothing; a null source is a source of its
    own, the last; null ids come first in the order, rows with equal
    ids and sizes follow a hash of the row; repeated rows are rows like any other.  Sources without words have the target 0 and no copies.
    Reruns agree: order and offset depend on the rows alone.
    """
    rows = df.select(F.col(f"`{source_col}`").alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
                     F.col(f"`{id_col}`").alias("id"), F.struct("*").alias("row"),
                     F.xxhash64(*(F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t)).alias("tie"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("id"), F.col("tie")]
    placed = materialize(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("id", "tie")
                         .withColumn("at", F.monotonically_increasing_id())
                         .withColumn("part", F.shiftright("at", 33)), "mix-order")
    heads = placed.groupBy("part", "source").agg(F.min("at").alias("first"), F.count("*").alias("n"), F.sum("size").alias("s"))
    heads = materialize(heads, "mix-heads")
    before = heads.withColumn("before", F.sum("n").over(W.partitionBy("source").orderBy("part")) - F.col("n"))
    aims = targets(heads.groupBy("source").agg(F.sum("s").alias("source_size")), weights, cap)
    start = (before.join(aims.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
             .select(F.col("part").alias("p"), "name", "first", "before", "source_size", "target"))
    offset = F.conv(F.substring(F.md5(F.coalesce("source", F.lit(""))), 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)
    rank = F.col("before") + F.col("at") - F.col("first")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(each * (rank + 1) + offset) - F.floor(each * rank + offset)
    return (placed.join(start, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("name")))
            .select("row", "size", "source_size", "target", copies.cast("long").alias("copies")))


def mixed_rows(df: DataFrame, size: Column, source_col: str = "source", id_col: str = "doc_id",
               weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself: each input row as often as it is emitted."""
    return (mix(df, size, source_col, id_col, weights, cap).where("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*"))
