"""The three nearest-period forms agree, edge rules hold (H5)."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.nearest import Side, dedupe_right, nearest_enrich, nearest_join
from tests.conftest import rows

LEFT = [(1, "a", 2010), (2, "a", 2012), (3, "a", 2020), (4, "b", 2015), (5, "z", 2015),
        (6, "a", 2014), (7, "a", None), (8, "a", 2010)]
RIGHT = [("a", 2010, 1.0), ("a", 2013, 2.0), ("a", 2011, 3.0), ("a", None, 9.0), ("b", 2001, 4.0),
         ("b", 2029, 5.0)]


@pytest.mark.parametrize("form", ["fill", "window", "minby", "lookup"])
def test_edges(spark, form):
    left = spark.createDataFrame(LEFT, "id int, k string, p int")
    right = spark.createDataFrame(RIGHT, "k string, q int, v double")
    out = nearest_join(left, right, ["k"], "p", "q", ["v"], form=form, buckets=4)
    got = {r.id: (r.match_period, r.v) for r in out.collect()}
    assert got[1] == (2010, 1.0)          # exact hit
    assert got[2] == (2013, 2.0)          # 2011 and 2013 equidistant -> later
    assert got[3] == (2013, 2.0)          # beyond the last right period
    assert got[4] == (2029, 5.0)          # 14 vs 14 -> later
    assert got[5] == (None, None)         # no right row for the key
    assert got[6] == (2013, 2.0)
    assert got[7] == (None, None)         # null left period
    assert got[8] == (2010, 1.0)          # duplicate left (k, p) kept as its own row
    assert out.count() == len(LEFT)


def test_forms_agree_on_random_panels(spark):
    rnd = random.Random(7)
    left = [(i, rnd.randrange(6), rnd.randrange(0, 400)) for i in range(600)]
    right = [(k, q, float(rnd.randrange(1000))) for k in range(5) for q in rnd.sample(range(0, 400), 25)]
    ldf = spark.createDataFrame(left, "id int, k int, p int")
    rdf = spark.createDataFrame(right, "k int, q int, v double")
    res = [rows(nearest_join(ldf, rdf, ["k"], "p", "q", ["v"], form=f, buckets=b), "id", "match_period", "v")
           for f, b in [("window", 0), ("minby", 0), ("lookup", None), ("fill", 1), ("fill", 7), ("fill", 1024)]]
    res.append(rows(nearest_join(ldf, rdf, ["k"], "p", "q", ["v"], form="fill", bucket_width=13),
                    "id", "match_period", "v"))
    for r in res[1:]:
        assert r == res[0]


def test_enrich_multi_one_pass(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 9)], "id int, k string, p int")
    s1 = spark.createDataFrame([("a", 4, 1.0), ("a", 10, 2.0)], "k string, q int, v double")
    s2 = spark.createDataFrame([("a", 7, 3.0)], "k string, q int, v double")
    out = nearest_enrich(left, ["k"], "p", [Side(s1, "q", ["v"], "x_"), Side(s2, "q", ["v"], "y_")])
    assert rows(out, "id", "x_period", "x_v", "y_period", "y_v") == [(1, 4, 1.0, 7, 3.0), (2, 10, 2.0, 7, 3.0)]


def test_dedupe_right_and_window_plan(spark):
    r = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 5.0), ("a", None, 7.0)], "k string, q int, v double")
    d = dedupe_right(r, ["k"], "q", ["v"])
    assert rows(d) == [("a", 1, 5.0)]
    left = spark.createDataFrame([(1, "a", 3)], "id int, k string, p int")
    plan = nearest_join(left, d, ["k"], "p", "q", ["v"], form="window")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan or "Window" in plan
    fill_plan = nearest_join(left, d, ["k"], "p", "q", ["v"], form="fill")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "CartesianProduct" not in fill_plan
    assert F is not None


@pytest.mark.parametrize("probe_rows", ["distinct", "rows"])
def test_pieces_share_the_rows_of_a_key_clustered_on_periods(spark, probe_rows):
    """One key, few neighbouring periods and a stray one: no piece gets much
    more than its share of the rows, and the answers stay right."""
    t = spark.range(20_000).select((F.floor(F.col("id") / 4) + 10 ** 9).alias("p"), F.col("id").alias("i"))
    left = t.select(F.lit("b").alias("k"), "p", "i").union(spark.createDataFrame(
        [("a", 0, -1), ("a", 10 ** 9 + 5, -2), ("a", 10 ** 9 + 99_999, -3), ("a", None, -4)], "k string, p long, i long"))
    right = spark.createDataFrame([("a", 10 ** 9 + 7, 1.0), ("a", 3, 2.0), ("b", 10 ** 9 + 2600, 3.0), ("b", 10 ** 9 + 7, 4.0)],
                                  "k string, q long, v double")
    out = nearest_join(left, right, ["k"], "p", "q", ["v"], probe_rows=probe_rows)
    assert rows(out.where("k = 'a'"), "p", "match_period", "v") == sorted(
        [(0, 3, 2.0), (10 ** 9 + 5, 10 ** 9 + 7, 1.0), (10 ** 9 + 99_999, 10 ** 9 + 7, 1.0), (None, None, None)], key=repr)
    assert out.where("k = 'b'").groupBy("v").count().orderBy("v").collect() == [(3.0, 20_000 - 4 * 1304), (4.0, 4 * 1304)]
    written = [f for f in out.inputFiles() if "nearest-pieces" in f]
    per_piece = [r[0] for r in spark.read.parquet(*written).groupBy("_b").count().select("count").collect()]
    assert len(per_piece) > 16 and max(per_piece) < 3 * sum(per_piece) / len(per_piece)


def test_one_period_with_most_rows_spreads_over_pieces(spark):
    left = spark.range(8_000).select(F.lit(1).alias("k"), F.lit(5).alias("p"), "id")
    right = spark.createDataFrame([(1, 2, 1.0), (1, 5, 2.0), (1, 6, 3.0)], "k int, q int, v double")
    out = nearest_join(left, right, ["k"], "p", "q", ["v"], probe_rows="rows")
    assert out.groupBy("match_period", "v").count().collect() == [(5, 2.0, 8_000)]
    per_piece = spark.read.parquet(*out.inputFiles()).groupBy("_b").count().collect()
    assert len(per_piece) > 16 and max(r[1] for r in per_piece) < 1_000


def test_lookup_makes_one_row_per_left_row_and_falls_back(spark):
    left = spark.createDataFrame([(i, i % 5 or None, i % 37) for i in range(300)], "id int, k int, p int")
    right = spark.createDataFrame([(k, q, float(q)) for k in range(4) for q in range(0, 37, 1 + k)] + [(None, 3, 1.0)],
                                  "k int, q int, v double")
    out = nearest_join(left, right, ["k"], "p", "q", ["v"], form="lookup")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("BroadcastHashJoin") == 1 and "Window" not in plan and "Python" not in plan
    want = rows(nearest_join(left, right, ["k"], "p", "q", ["v"]))
    assert rows(out) == want
    assert rows(nearest_join(left, right, ["k"], "p", "q", ["v"], form="lookup", broadcast_rows=20)) == want
    assert nearest_join(left, right.where("false"), ["k"], "p", "q", ["v"], form="lookup").where("v is null").count() == 300


def test_shared_sides_equal_separate_sides(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 9), (3, "b", 1)], "id int, k string, p int")
    r = spark.createDataFrame([("a", 4, "x", 1.0), ("a", 10, "x", 2.0), ("a", 7, "y", 3.0), ("b", 3, "y", 4.0)],
                              "k string, q int, t string, v double")
    shared = nearest_enrich(left, ["k"], "p", [Side(r, "q", ["v"], "x_", rows=F.col("t") == "x"),
                                               Side(r, "q", ["v"], "y_", rows=F.col("t") == "y")])
    sep = nearest_enrich(left, ["k"], "p", [Side(r.where("t = 'x'"), "q", ["v"], "x_"),
                                            Side(r.where("t = 'y'"), "q", ["v"], "y_")])
    cols = ["id", "x_period", "x_v", "y_period", "y_v"]
    assert rows(shared, *cols) == rows(sep, *cols)
    assert rows(shared, *cols) == [(1, 4, 1.0, 7, 3.0), (2, 10, 2.0, 7, 3.0), (3, None, None, 3, 4.0)]
    win = nearest_enrich(left, ["k"], "p", [Side(r, "q", ["v"], "x_", rows=F.col("t") == "x")], form="window")
    assert rows(win, "id", "x_period") == [(1, 4), (2, 10), (3, None)]


@pytest.mark.parametrize("width", [None, 5])
def test_probe_rows_equal_distinct(spark, width):
    rnd = random.Random(17)
    left = [(i, rnd.choice([None, 1, 2, 3]) if i % 17 else None,
             None if i % 11 == 0 else rnd.randrange(0, 60), f"x{i}") for i in range(400)]
    left += [(1000 + i, 1, 30, "dup") for i in range(20)]          # duplicated (key, period)
    right = [(k, q, float((k or 0) * 100 + q)) for k in [1, 2, None] for q in rnd.sample(range(0, 60), 9)]
    ldf = spark.createDataFrame(left, "id int, k int, p int, tag string")
    rdf = spark.createDataFrame(right, "k int, q int, v double")
    a = nearest_join(ldf, rdf, ["k"], "p", "q", ["v"], bucket_width=width)
    b = nearest_join(ldf, rdf, ["k"], "p", "q", ["v"], bucket_width=width, probe_rows="rows")
    assert b.columns == a.columns
    assert rows(b) == rows(a)
    assert b.count() == len(left)


@pytest.mark.parametrize("probe_rows", ["distinct", "rows"])
def test_no_periods_and_null_keys(spark, probe_rows):
    left = spark.createDataFrame([(1, None, None), (2, "a", None)] + [(10 + i, None, 5) for i in range(30)],
                                 "id int, k string, p int")
    right = spark.createDataFrame([("a", None, 1.0), (None, 5, 2.0)], "k string, q int, v double")
    out = nearest_join(left, right, ["k"], "p", "q", ["v"], probe_rows=probe_rows)
    assert out.count() == 32
    assert {(r.match_period, r.v) for r in out.collect()} == {(None, None)}
    empty = spark.createDataFrame([], "id int, k string, p int")
    assert nearest_join(empty, right, ["k"], "p", "q", ["v"], probe_rows=probe_rows).count() == 0


@pytest.mark.parametrize("probe_rows", ["distinct", "rows"])
def test_fill_windows_the_union_once(spark, probe_rows):
    left = spark.createDataFrame([(i, i % 3, i % 40) for i in range(200)], "id int, k int, p int")
    right = spark.createDataFrame([(k, q, float(q)) for k in range(3) for q in range(0, 40, 7)],
                                  "k int, q int, v double")
    out = nearest_join(left, right, ["k"], "p", "q", ["v"], probe_rows=probe_rows, buckets=8)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    windows = [ln for ln in plan.splitlines() if "Window [" in ln]
    # one ascending + one descending pass over the union, two small carry passes
    assert len(windows) == 4
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
