"""Exact running sums over sorted values, without one task per group.

``Window.partitionBy(group).orderBy(value)`` sends every row of a group to
one task; with a group holding a third of the data that task is the job.
``running_sums`` gets the same exact prefix sums from bounded pieces:

1. the input has one row per (group, value) (duplicates already counted,
   so repeats of a hot value cost nothing);
2. each group's range is cut into ``buckets`` equal-width buckets on the
   axis sign(x) * log(1 + |x|) (heavy tails spread out), and any bucket
   that still holds more than ``split_over`` distinct values is cut again
   into ``buckets`` linear sub-buckets over its own [min, max];
3. bucket totals are prefix-summed by a window over the bucket table (at
   most ``buckets`` squared rows per group, usually about ``buckets``);
4. inside each (group, bucket, sub-bucket) a running window adds the rest.

Used by the rank-based AUC (M10), whose scores are finite and of which a
group is a class.  A null group is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.stats import join_groups


def _cut(x, lo, hi, buckets: int):
    span = hi - lo
    return F.when(span > 0, F.least(F.floor((x - lo) / span * buckets), F.lit(buckets - 1))) \
        .otherwise(F.lit(0))


def running_sums(vc: DataFrame, groups, value: str, cols, buckets: int = 1024,
                 split_over: int = 100_000) -> DataFrame:
    """``vc`` plus ``cum_<c>``: the sum of ``c`` over rows of the same group
    with value <= this row's value, for every ``c`` in ``cols``."""
    groups = list(groups)
    x = F.col(value)
    # level 1 on a sign-preserving log axis, so heavy tails do not push most
    # values into the first bucket; the map is monotone, so bucket order
    # follows value order and the sums stay exact
    t = F.signum(x) * F.log1p(F.abs(x))
    st = vc.groupBy(*groups).agg(F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    j = (vc.crossJoin(F.broadcast(st)) if not groups else join_groups(vc, st, groups))
    j = j.withColumn("_b1", _cut(t, F.col("_lo"), F.col("_hi"), buckets)).drop("_lo", "_hi")
    # second level only where a bucket is still crowded with distinct values
    s1 = j.groupBy(*groups, "_b1").agg(F.count(F.lit(1)).alias("_nd"), F.min(value).alias("_lo2"),
                                       F.max(value).alias("_hi2"))
    j = join_groups(j, s1, groups + ["_b1"])
    j = j.withColumn("_b2", F.when(F.col("_nd") > split_over,
                                   _cut(x, F.col("_lo2"), F.col("_hi2"), buckets)).otherwise(F.lit(0))) \
        .drop("_nd", "_lo2", "_hi2")
    part = groups + ["_b1", "_b2"]
    bt = j.groupBy(*part).agg(*[F.sum(c).alias(f"_bt_{c}") for c in cols])
    before = Window.partitionBy(*groups).orderBy("_b1", "_b2") \
        .rowsBetween(Window.unboundedPreceding, -1)
    off = bt.select(*part, *[F.coalesce(F.sum(f"_bt_{c}").over(before), F.lit(0)).alias(f"_off_{c}")
                             for c in cols])
    j = join_groups(j, off, part)
    run = Window.partitionBy(*part).orderBy(value).rowsBetween(Window.unboundedPreceding,
                                                               Window.currentRow)
    return j.select(*vc.columns, *[(F.col(f"_off_{c}") + F.sum(c).over(run)).alias(f"cum_{c}")
                                   for c in cols])
