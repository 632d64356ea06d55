"""Skew check: one key holds a third of all rows.

Runs the nearest-period join (fill form) and, for contrast, a plain
``Window.partitionBy(key)`` fill on the same data with the event log on,
then reports for each run the largest share of shuffled records that a
single task read.  With a hot key the plain window gives that key's rows
to one task; the bucketed fill form spreads them.

    python scripts/skew_check.py [rows]

A local diagnostic: the event log goes to a fresh local folder (it must be
set before the session starts); the generated tables go under the
session's checkpoint folder like every other intermediate table.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402
from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.operators.nearest import nearest_join  # noqa: E402
from strata.session import local_session, scratch_path  # noqa: E402


def task_shares(log_dir: str, metric: str = "Total Records Read", floor: int = 10_000) -> dict:
    """Per job group: max over stages of (max task shuffle-read amount /
    stage shuffle-read amount), for stages that read at least ``floor``."""
    out = {}
    for f in glob.glob(f"{log_dir}/*/events_*"):
        with open(f, "rb") as fh:
            lines = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            stage_tasks, stage_group, job_group = {}, {}, {}
            for line in lines:
                e = json.loads(line)
                ev = e["Event"]
                if ev == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.job.description", "")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif ev == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    sr = m.get("Shuffle Read Metrics") or {}
                    r = (sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                         if metric == "bytes" else sr.get(metric, 0))
                    stage_tasks.setdefault(e["Stage ID"], []).append(r)
            for sid, recs in stage_tasks.items():
                total = sum(recs)
                if total < floor:
                    continue
                g = stage_group.get(sid, "?")
                out[g] = max(out.get(g, 0.0), max(recs) / total)
    return out


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 300_000
    log = tempfile.mkdtemp(prefix="skew-log-")
    spark = local_session(8, 32, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log,
                                        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ids = spark.range(n)
    hot = F.when(F.rand(1) < 1 / 3, F.lit(0)).otherwise((F.rand(2) * 1000).cast("int") + 1)
    left = ids.select(F.col("id"), hot.alias("k"), (F.rand(3) * 50_000).cast("int").alias("p"))
    right = ids.limit(n // 3).select(hot.alias("k"), (F.rand(4) * 50_000).cast("int").alias("q"),
                                     F.rand(5).alias("v")).dropDuplicates(["k", "q"])
    # inputs are tables: write the generated rows once (rand() is not repeatable)
    data = scratch_path(spark, "skew-data")
    left.write.parquet(f"{data}/left")
    right.write.parquet(f"{data}/right")
    left, right = spark.read.parquet(f"{data}/left"), spark.read.parquet(f"{data}/right")

    spark.sparkContext.setJobDescription("fill form")
    nearest_join(left, right, ["k"], "p", "q", ["v"], form="fill").write.format("noop") \
        .mode("overwrite").save()

    # the hot key's periods all lie close together, one other period far away
    near = F.when(F.col("k") == 0, F.col("p") % 40 + 10 ** 6).otherwise(F.col("p"))
    spark.sparkContext.setJobDescription("clustered fill")
    nearest_join(left.withColumn("p", near), right, ["k"], "p", "q", ["v"], form="fill", probe_rows="rows").write.format("noop") \
        .mode("overwrite").save()

    spark.sparkContext.setJobDescription("window by key")
    u = (left.select("k", F.col("p").alias("t"), F.lit(None).cast("double").alias("v"))
         .unionByName(right.select("k", F.col("q").alias("t"), "v")))
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    u.select("k", "t", F.last("v", ignorenulls=True).over(w).alias("prev")).write.format("noop") \
        .mode("overwrite").save()

    # exact quantiles of a value whose group 0 holds a third of the rows
    from strata.operators.stats import exact_quantiles
    vals = spark.read.parquet(f"{data}/left").select(F.col("k").alias("g"),
                                                     (F.col("id") * 7919 % 1_000_003).alias("x"))
    spark.sparkContext.setJobDescription("exact quantiles")
    exact_quantiles(vals, "x", [0.5], ["g"]).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription("percentile aggregate")
    vals.groupBy("g").agg(F.percentile("x", 0.5)).write.format("noop").mode("overwrite").save()
    spark.stop()
    recs = task_shares(log)
    byts = task_shares(log, "bytes", 100_000)
    keep = ("fill form", "clustered fill", "window by key", "exact quantiles", "percentile aggregate")
    print(json.dumps({k: {"records": round(recs.get(k, 0), 3), "bytes": round(byts.get(k, 0), 3)}
                      for k in keep}))


if __name__ == "__main__":
    main()
