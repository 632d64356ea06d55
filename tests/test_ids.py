import random

from pyspark.sql import functions as F

from strata.operators.ids import dense_ids


def test_ids_follow_the_order(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, 0, 0, 1, rng.randrange(90)]), f"n{i}", i) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, `a.b` string, id long").repartition(7)
    got = dense_ids(df, ["k", "a.b"]).collect()
    want = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(((r.id, r.k, r["a.b"]) for r in got), key=lambda r: r[0]) == [(i + 1, k, n) for i, (k, n, _) in enumerate(want)]
    again = dense_ids(df.repartition(3), ["k", "a.b"], out="nr", start=10)
    assert again.columns == ["nr", "k", "a.b", "id"]
    assert {(r.nr - 9, r["a.b"]) for r in again.collect()} == {(r.id, r["a.b"]) for r in got}


def test_ties_and_nothing(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"))
    got = dense_ids(df, [-F.col("k")])
    assert sorted(r.id for r in got.collect()) == list(range(1, 1001))
    assert [tuple(r) for r in got.groupBy("k").agg(F.min("id"), F.max("id")).orderBy("k").collect()] == [(0, 667, 1000), (1, 334, 666), (2, 1, 333)]
    assert dense_ids(df.where("false"), ["k"]).count() == 0
