"""A9, A10, A13, C17, G3, G5, G6, M10 against brute force on small fixtures."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators.ml import auc_by_class
from strata.operators.stats import (box_stats, correlation_matrix, correlations, distribution_stats, exact_quantiles,
                                    histogram, kde, share_within_group, sigma_bands)


@pytest.mark.parametrize("sizes", [{"k": 8, "cells": 3, "few": 1}, {"k": 20, "cells": 16, "few": 5}, {}])
def test_exact_quantiles_match_numpy(spark, sizes):
    rnd = random.Random(3)
    data = [(g, float(rnd.choice(range(40))) + (0.5 if rnd.random() < 0.3 else 0.0))
            for g in "abc" for _ in range(rnd.randrange(1, 200))]
    df = spark.createDataFrame(data, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    q = {r.g: r for r in exact_quantiles(df, "x", probs, ["g"], **sizes).collect()}
    for g in "abc":
        xs = np.array([x for gg, x in data if gg == g])
        for p in probs:
            assert q[g][f"q{int(p * 100):02d}"] == pytest.approx(np.percentile(xs, p * 100), abs=1e-9)


def test_exact_quantiles_of_hard_ranges(spark):
    """Both ends of the doubles, neighbouring subnormal numbers, a cluster far
    from an outlier, a value with most of the rows, one row and no row."""
    rnd = random.Random(2)
    data = {"ends": [1.7e308, -1.7e308] * 40 + [rnd.uniform(-1e300, 1e300) for _ in range(300)],
            "subnormal": [5e-324 * (i % 3) for i in range(400)],
            "cluster": [1e15] + [1 + 1e-12 * rnd.randrange(900) for _ in range(2000)],
            "value": [7.0] * 3000 + [rnd.random() * 20 for _ in range(500)], "one": [3.5], "two": [1.0, 2.0]}
    df = spark.createDataFrame([(g, x) for g, xs in data.items() for x in xs] + [("none", None), (None, 2.0)], "g string, x double").repartition(6)
    probs = [0.0, 0.03, 0.5, 0.977, 1.0]
    got = {r.g: r for r in exact_quantiles(df, "x", probs, ["g"], k=16, cells=8, few=4).collect()}
    assert set(got) == {*data, None}
    for g, xs in data.items():
        ordered = sorted(xs)
        for p in probs:
            h = p * (len(xs) - 1)
            low, high = ordered[math.floor(h)], ordered[math.ceil(h)]
            assert got[g][f"q{int(round(p * 100)):02d}"] == low + (high - low) * (h - math.floor(h))
        assert (got[g].n, got[g].min, got[g].max) == (len(xs), ordered[0], ordered[-1])
    assert exact_quantiles(df.where("g = 'none'"), "x", [0.5], ["g"]).count() == 0
    alone = exact_quantiles(df.where("g = 'cluster'"), "x", [0.5]).collect()
    assert len(alone) == 1 and alone[0].q50 == pytest.approx(np.percentile(data["cluster"], 50), abs=1e-15)


def test_box_whiskers(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    b = box_stats(spark.createDataFrame([(x,) for x in xs], "v double"), "v").first()
    q1, q3 = np.percentile(xs, 25), np.percentile(xs, 75)
    assert b.q1 == pytest.approx(q1) and b.q3 == pytest.approx(q3)
    assert b.whisker_hi == 5.0 and b.n_outliers == 1


def test_bands_edges(spark):
    # mean 0, sample sd 1 for [-1, 1] repeated; exact +-1 sd is Near Mean
    df = spark.createDataFrame([(i, v) for i, v in enumerate([-1.0, 1.0, -1.0, 1.0])] + [(9, None)],
                               "id int, v double")
    b = {r.id: r.band for r in sigma_bands(df, "v").collect()}
    sd = float(np.std([-1, 1, -1, 1], ddof=1))
    assert sd > 1 and b[0] == "Near Mean" and b[9] is None
    df2 = spark.createDataFrame([(float(x),) for x in [0] * 20 + [10]], "v double")
    labels = {r.band for r in sigma_bands(df2, "v").collect()}
    assert "Extreme High" in labels and "Near Mean" in labels


def test_share_sums_to_100(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "y"), ("A", "y"), ("B", "x")], "g string, c string")
    s = share_within_group(df, "g", "c").groupBy("g").agg(F.sum("pct").alias("t")).collect()
    assert all(abs(r.t - 100.0) < 0.02 for r in s)


def test_corr_edges(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (None, 9.0), (3.0, 5.9)], "x double, y double")
    c = correlations(df, [("x", "y")]).first()[0]
    assert c == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1], abs=1e-6)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert correlations(flat, [("x", "y")]).first()[0] is None
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert correlations(one, [("x", "y")]).first()[0] is None


def test_correlation_matrix(spark):
    rnd = random.Random(8)
    nan = float("nan")
    odd = lambda v: rnd.choice([v, v, v, None, nan, float("inf")])      # noqa: E731
    data = [(rnd.choice(["a", "b", None]), odd(rnd.gauss(0, 1)), odd(rnd.gauss(2, 3)), rnd.randrange(5), 4.0, None) for _ in range(400)]
    names = ["p.q", "x", "b", "flat", "none"]
    df = spark.createDataFrame(data, "g string, `p.q` double, x double, b int, flat double, none double").repartition(5)
    got = {(r.g, r.x, r.y): r for r in correlation_matrix(df, names, ["g"]).collect()}
    assert len(got) == 3 * 10
    for (g, x, y), r in got.items():
        i, j = names.index(x) + 1, names.index(y) + 1
        both = [(d[i], d[j]) for d in data if d[0] == g and all(v is not None and math.isfinite(v) for v in (d[i], d[j]))]
        a, b = np.array(both, float).T
        assert i <= j and r.n == len(both) and r.covariance == pytest.approx(np.cov(a, b, bias=True)[0, 1], abs=1e-5)
        if "flat" in (x, y):
            assert r.correlation is None
        else:
            assert r.correlation == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-5)
    assert correlation_matrix(df.limit(0), names).count() == 0
    assert {r.n for r in correlation_matrix(df, ["b", "flat"]).collect()} == {400}


def test_skew_hist_kde(spark):
    rnd = random.Random(5)
    xs = [rnd.expovariate(1.0) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    d = distribution_stats(df, "v").first()
    n = len(xs)
    m = np.mean(xs)
    g1 = np.mean((np.array(xs) - m) ** 3) / np.mean((np.array(xs) - m) ** 2) ** 1.5
    assert d.skewness == pytest.approx(g1 * math.sqrt(n * (n - 1)) / (n - 2), abs=1e-5)
    h = histogram(df, "v", 30).collect()
    assert len(h) == 30 and sum(r["count"] for r in h) == n
    counts, _ = np.histogram(xs, bins=30)
    assert [r["count"] for r in sorted(h, key=lambda r: r.bin)] == list(counts)
    k = sorted(kde(df, "v").collect(), key=lambda r: r.point)
    width = (max(xs) - min(xs)) / 199
    assert sum(r.density for r in k) * width == pytest.approx(1.0, abs=0.1)


def test_auc_matches_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rnd = random.Random(11)
    data = [(rnd.choice("AB"), float(rnd.randrange(10))) for _ in range(400)]
    df = spark.createDataFrame(data, "label string, s double")
    ours = auc_by_class(df, "label", {"A": "s"}, buckets=3).first().auc
    split = auc_by_class(df, "label", {"A": "s"}, buckets=2, split_over=2).first().auc
    assert split == ours
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    ref = ev.evaluate(df.withColumn("y", (F.col("label") == "A").cast("double")))
    assert ours == pytest.approx(ref, abs=1e-9)


def test_degenerate_inputs_do_not_raise(spark):
    one = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    k = kde(one, "v").collect()
    assert len(k) == 200 and all(r.density is None for r in k)
    assert [r["count"] for r in histogram(one, "v", 3).collect() if r.bin == 0] == [2]
    assert distribution_stats(one, "v").first().skewness is None


def test_fround_neither_saturates_nor_hides_nan(spark):
    from strata.operators.stats import fround
    xs = [2e13, 2e11, 1e300, -1e300, 1.0000005, -1.5, float("nan"), float("inf"), None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(fround("x", 6)).collect()]
    want = [math.floor(x * 1e6 + 0.5) / 1e6 if x is not None and abs(x) < 1e9 else x for x in xs]
    assert repr(got) == repr(want)


def test_missing_values_and_null_groups(spark):
    nan, inf = float("nan"), float("inf")
    data = [(None, 1.0, 2.0), (None, 3.0, 5.0), (None, nan, 4.0), ("a", 1e14, 1.0), ("a", 3e14, 2.0), ("a", inf, 9.0), ("a", 5e14, -inf), ("a", 2e14, None)]
    df = spark.createDataFrame(data, "g string, v double, w double")
    good = {g: [v for h, v, _ in data if h == g and math.isfinite(v)] for g in (None, "a")}
    b = sigma_bands(df, "v", groups=["g"]).collect()
    assert len(b) == len(data) and sum(r.band is None for r in b) == 2
    box = {r.g: r for r in box_stats(df, "v", ["g"]).collect()}
    hist = histogram(df, "v", 4, ["g"]).collect()
    for g in (None, "a"):
        assert box[g].n == len(good[g]) and box[g].median == np.median(good[g]) and box[g].max == max(good[g])
        assert [r["count"] for r in sorted((r for r in hist if r.g == g), key=lambda r: r.bin)] == np.histogram(good[g], 4)[0].tolist()
    d = {r.g: r for r in distribution_stats(df, "v", ["g"]).collect()}
    assert d["a"].n == 4 and d["a"].mean == np.mean(good["a"]) and d[None].max == 3.0
    c = correlations(df.where("g is null"), [("v", "w")]).first()[0]
    assert c == pytest.approx(1.0)
    assert all(r.density > 0 for r in kde(df.where("g = 'a'"), "v", grid=5, places=30).collect())
