"""Session helpers, join strategies, streaming ingest, inspection and split."""

import time

import pytest
from pyspark.sql import functions as F

from strata.operators.inspect import profile, sample_rows
from strata.operators.joins import bounded_broadcast, join_with_strategy, rows_at_most
from strata.operators.ml import hash_split
from strata.session import checkpoint_dir, cut_lineage, free_shuffles, materialize, scratch_path
from strata.sources.csv import write_csv
from strata.streaming.ingest import ingest_available, period_file_stream
from tests.conftest import rows


def test_scratch_under_checkpoint_dir(spark):
    d = checkpoint_dir(spark)
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1.startswith(d) and p1 != p2


def test_materialize_and_checkpoint_keep_rows(spark):
    df = spark.range(100).withColumn("y", F.col("id") * 2)
    m = materialize(df, "t")
    assert "LocalTableScan" not in m._jdf.queryExecution().executedPlan().toString()
    assert rows(m) == rows(df)
    c = cut_lineage(df)
    assert rows(c) == rows(df)


def test_scratch_can_be_dropped(spark):
    import os

    from strata.session import _scratch_root, drop_scratch
    other = spark.newSession()
    path = scratch_path(other, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path) and path.startswith(_scratch_root(spark))
    assert drop_scratch.__doc__


def test_broadcast_bound_counts_bytes(spark):
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) s")
    assert rows_at_most(wide, 10) and rows_at_most(wide, 10, 20_000) and not rows_at_most(wide, 10, 5_000)


def test_join_strategies_agree_and_bound(spark):
    left = spark.createDataFrame([(i % 7, i) for i in range(200)], "k int, v int")
    right = spark.createDataFrame([(k, k * 10) for k in range(7)], "k int, w int")
    outs = [rows(join_with_strategy(left, right, "k", "inner", s)) for s in
            ("auto", "broadcast", "shuffle_hash", "merge")]
    assert all(o == outs[0] for o in outs)
    assert rows_at_most(right, 7) and not rows_at_most(right, 6)
    plan = bounded_broadcast(right, 3)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan.lower()
    with pytest.raises(ValueError):
        join_with_strategy(left, right, "k", "inner", "nested")


def test_stream_ingest_is_incremental(spark):
    root = scratch_path(spark, "stream")
    a = spark.createDataFrame([(2013, 1, "x"), (2017, 2, "y")], "year int, id bigint, s string")
    write_csv(a, f"{root}/in", partition_by=["year"])
    schema = "id bigint, s string"
    ingest_available(period_file_stream(spark, f"{root}/in", schema, r"year=(\d{4})", "year"),
                     f"{root}/table", f"{root}/ck", "year")
    b = spark.createDataFrame([(2019, 3, "z")], "year int, id bigint, s string")
    write_csv(b, f"{root}/in", partition_by=["year"], mode="append")
    ingest_available(period_file_stream(spark, f"{root}/in", schema, r"year=(\d{4})", "year"),
                     f"{root}/table", f"{root}/ck", "year")
    t = spark.read.parquet(f"{root}/table")
    assert rows(t, "year", "id", "s") == [(2013, 1, "x"), (2017, 2, "y"), (2019, 3, "z")]


def test_profile_and_sample(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, None)], "a int, b string")
    p = {r.column_name: (r.data_type, r.n_rows, r.n_nulls) for r in profile(df).collect()}
    assert p == {"a": ("int", 3, 0), "b": ("string", 3, 2)}
    assert [r.a for r in sample_rows(df, 2, [F.col("a").desc()]).collect()] == [3, 2]


def test_hash_split_is_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    s1 = rows(hash_split(df, ["k"]), "k", "split")
    s2 = rows(hash_split(df.repartition(7), ["k"]), "k", "split")
    assert s1 == s2
    share = sum(1 for _, s in s1 if s == "train") / len(s1)
    assert 0.7 < share < 0.9


def test_validate_keys(spark):
    from strata.operators.inspect import validate_keys
    df = spark.createDataFrame([("st-florian",), ("st-florian",), ("linz",), ("Bad Name",)], "e string")
    got = rows(validate_keys(df, ["e"], "^[a-z0-9]+(-[a-z0-9]+)*$"), "e", "n_rows", "pattern_ok")
    assert got == [("Bad Name", 1, False), ("st-florian", 2, True)]


def test_collated_join(spark):
    from strata.operators.joins import collated_join
    a = spark.createDataFrame([(1, "Straße"), (2, "Pöndorf"), (3, "Linz")], "id int, name string")
    b = spark.createDataFrame([("STRASSE", "x"), ("pondorf", "y"), ("Wels", "z")], "name2 string, tag string")
    assert rows(collated_join(a, b, "name", "name2"), "id", "tag") == [(1, "x"), (2, "y")]
    assert rows(collated_join(a, b, "name", "name2", "left"), "id", "tag") == [(1, "x"), (2, "y"), (3, None)]


def test_shuffles_of_dropped_frames_are_deleted(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: [f for f in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f]       # noqa: E731
    free_shuffles(spark)
    time.sleep(3)
    before = set(held())
    df = spark.range(1000).repartition(4, "id")
    df.write.format("noop").mode("overwrite").save()
    made = set(held()) - before
    assert made
    del df
    spark.range(10).count()                     # Spark still holds the last job
    free_shuffles(spark)
    for _ in range(40):
        if not made & set(held()):
            break
        time.sleep(0.5)
    assert not made & set(held())
