"""Hot keys: one key holds a third of all rows; results stay exact."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators.ml import auc_by_class
from strata.operators.nearest import nearest_join
from strata.operators.stats import exact_quantiles
from strata.operators.winner import winner_long
from tests.conftest import rows


def _hot(rnd, n, hot_share=1 / 3, keys=50):
    return [0 if rnd.random() < hot_share else rnd.randrange(1, keys) for _ in range(n)]


def test_nearest_hot_key_matches_brute_force(spark):
    rnd = random.Random(21)
    lk = _hot(rnd, 3000)
    left = [(i, k, rnd.randrange(0, 5000)) for i, k in enumerate(lk)]
    # the hot key also has a long history on the right
    right = {}
    for k in _hot(rnd, 1500):
        right[(k, rnd.randrange(0, 5000))] = float(rnd.randrange(10 ** 6))
    rrows = [(k, q, v) for (k, q), v in right.items()]
    ldf = spark.createDataFrame(left, "id int, k int, p int")
    rdf = spark.createDataFrame(rrows, "k int, q int, v double")
    got = rows(nearest_join(ldf, rdf, ["k"], "p", "q", ["v"], form="fill", buckets=16),
               "id", "match_period", "v")
    by_key = {}
    for k, q, v in rrows:
        by_key.setdefault(k, []).append((q, v))
    want = []
    for i, k, p in left:
        cands = by_key.get(k, [])
        if not cands:
            want.append((i, None, None))
            continue
        q, v = min(cands, key=lambda c: (abs(p - c[0]), -c[0]))
        want.append((i, q, v))
    assert got == sorted(want, key=repr)


def test_quantiles_hot_group(spark):
    rnd = random.Random(5)
    g = _hot(rnd, 4000, keys=4)
    data = [(k, float(rnd.randrange(0, 10 ** 5)) / 100) for k in g]
    df = spark.createDataFrame(data, "g int, x double")
    q = {r.g: r for r in exact_quantiles(df, "x", [0.1, 0.5, 0.9], ["g"], k=20, few=8).collect()}
    for k in set(g):
        xs = np.array([x for kk, x in data if kk == k])
        for p in (0.1, 0.5, 0.9):
            assert q[k][f"q{int(p * 100):02d}"] == pytest.approx(np.percentile(xs, p * 100), abs=1e-9)


def test_auc_hot_class_brute_force(spark):
    rnd = random.Random(9)
    data = [(rnd.choice("AAAB"), float(rnd.randrange(50))) for _ in range(2000)]
    df = spark.createDataFrame(data, "label string, s double")
    got = auc_by_class(df, "label", {"A": "s"}, buckets=4, split_over=5).first().auc
    pos = [s for c, s in data if c == "A"]
    neg = [s for c, s in data if c != "A"]
    u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert got == pytest.approx(u / (len(pos) * len(neg)), abs=1e-12)


def test_winner_long_hot_entity(spark):
    rnd = random.Random(2)
    ents = _hot(rnd, 5000, keys=20)
    df = spark.createDataFrame([(e, rnd.choice("xyz"), 1) for e in ents], "e int, lab string, one int")
    counts = df.groupBy("e", "lab").agg(F.sum("one").alias("n"))
    got = dict(rows(winner_long(counts, ["e"], "lab", "n"), "e", "winner"))
    tally = {}
    for r in counts.collect():
        tally.setdefault(r.e, []).append((r.n, r.lab))
    want = {e: sorted(v, key=lambda t: (-t[0], t[1]))[0][1] for e, v in tally.items()}
    assert got == want


def test_quantiles_heavy_tail_spread_and_exact(spark):
    rnd = random.Random(12)
    xs = [rnd.paretovariate(0.7) * (1 if rnd.random() < 0.8 else -1) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    q = exact_quantiles(df, "x", [0.01, 0.5, 0.99], k=20, few=8).first()
    for p in (0.01, 0.5, 0.99):
        assert q[f"q{int(p * 100):02d}"] == pytest.approx(np.percentile(xs, p * 100), rel=1e-12)


@pytest.mark.parametrize("shape", ["infinite", "clustered", "one value"])
def test_bracketed_quantiles_stay_small(spark, shape):
    """Few values are ranked, whatever the distribution."""
    rnd = random.Random(1)
    xs = {"infinite": [float("inf"), float("-inf"), float("nan")] + [rnd.random() for _ in range(20_000)],
          "clustered": [1e15] + [1 + rnd.random() * 1e-9 for _ in range(20_000)],
          "one value": [7.0] * 15_000 + [rnd.random() for _ in range(5_000)]}[shape]
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(8)
    q = exact_quantiles(df, "x", [0.25, 0.5, 0.75])
    want = [x for x in xs if np.isfinite(x)]
    assert [q.first()[c] for c in ("q25", "q50", "q75")] == pytest.approx([np.percentile(want, p) for p in (25, 50, 75)], rel=1e-15)
    # only what is left in the brackets is ranked, in the JVM
    plan = q._jdf.queryExecution().executedPlan()
    q.collect()
    text = plan.toString()
    assert text.count("Window") >= 1 and "BatchEvalPython" not in text
