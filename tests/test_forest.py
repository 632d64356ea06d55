"""Forests grown by aggregation against the same rules in plain Python."""

import hashlib
import math
import random

import pytest

from strata.operators import forest
from strata.operators.forest import WEIGHTS, forest_importance, forest_scores, grow_forest

FEATURES = ["a", "b", "c d"]


def table():
    rng, rows = random.Random(4), []
    for i in range(400):
        a, b = rng.random() * 10, float(rng.randrange(6))
        label = "x" if a > 6 else "y" if b > 2.5 else "z"
        label = rng.choice("xyz") if rng.random() < 0.1 else label
        rows.append((i, label, a if i % 13 else None, b if i % 17 else float("nan"), 7.0))
    return rows + [(1000, None, 1.0, 1.0, 7.0), (1001, "other", 1.0, 1.0, 7.0), (None, "x", 9.0, float("inf"), 7.0)] + [(5, "x", 9.5, 1.0, 7.0)] * 3


def grow(rows, classes, trees, depth, bins, tried, least, positive=None, first=0):
    """{(tree, node): (feature, bin)} and {(tree, node): counts} by the module's rules."""
    good = lambda v: v is not None and math.isfinite(v)                                                       # noqa: E731
    lo = [min(r[2 + i] for r in rows if good(r[2 + i])) for i in range(3)]
    hi = [max(r[2 + i] for r in rows if good(r[2 + i])) for i in range(3)]

    def bin_of(v, i):
        if not good(v):
            return -1
        return max(0, min(bins - 1, math.floor((v - lo[i]) * bins / (hi[i] - lo[i])))) if hi[i] > lo[i] else 0

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()                                                       # noqa: E731
    kinds = len(classes) if positive is None else 2
    cuts, leaves, walked = {}, {}, {}
    for t in range(first, first + trees):
        members = {1: []}
        for r in rows:
            if r[1] in classes:
                w = int(WEIGHTS[int(md5(f"{'' if r[0] is None else r[0]}|{t}")[0], 16)])
                y = classes.index(r[1]) if positive is None else int(r[1] == positive)
                members[1].append((w, y, [bin_of(r[2 + i], i) for i in range(3)]))
        def counts(ms): return [sum(w for w, y, _ in ms if y == k) for k in range(kinds)]
        def square(c): return sum(x * x for x in c) / sum(c)
        leaves[t, 1] = counts(members[1])
        for node in range(1, 1 << depth):
            if node not in members:
                continue
            ms, best = members[node], None
            open_ = sorted(range(3), key=lambda f: md5(f"{t}:{node}:{f}"))[:tried]
            for f in sorted(open_):
                for cut in sorted({b[f] for w, _, b in ms if w}):
                    left, right = counts([m for m in ms if m[2][f] <= cut]), counts([m for m in ms if m[2][f] > cut])
                    if sum(left) >= least and sum(right) >= least:
                        score = square(left) + square(right)
                        if score > square(counts(ms)) + 1e-9 and (best is None or score > best[0]):
                            best = score, f, cut, left, right
            if best:
                _, f, cut, left, right = best
                cuts[t, node] = f, cut
                del leaves[t, node]
                for side, (child, c) in enumerate(((2 * node, left), (2 * node + 1, right))):
                    members[child] = [m for m in ms if (m[2][f] > cut) == bool(side)]
                    leaves[t, child] = c
    for r in rows:
        walked[r] = {}
        for t in range(first, first + trees):
            node = 1
            while (t, node) in cuts:
                f, cut = cuts[t, node]
                node = 2 * node + (bin_of(r[2 + f], f) > cut)
            walked[r][t] = leaves[t, node]
    return cuts, leaves, walked


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, label string, a double, b double, `c d` double").repartition(3)


@pytest.mark.parametrize("one_vs_rest", [False, True])
def test_every_cut_leaf_and_score(spark, one_vs_rest):
    rows, classes, trees, sizes = table(), ["x", "y", "z"], 3, {"depth": 3, "bins": 8, "tried": 2, "least": 4}
    f = grow_forest(frame(spark, rows), "label", FEATURES, ["k"], classes, trees=trees, one_vs_rest=one_vs_rest, **sizes)
    parts = [grow(rows, classes, trees, positive=c, first=i * trees, **sizes) for i, c in enumerate(classes)] if one_vs_rest \
        else [grow(rows, classes, trees, **sizes)]
    assert {k: v[:2] for k, v in f.cuts.items()} == {k: v for p in parts for k, v in p[0].items()} and len(f.cuts) > 8
    assert f.leaves == {k: v for p in parts for k, v in p[1].items()}
    for r in forest_scores(frame(spark, rows), f).collect():
        same = [q for q in rows if q[:2] == (r.k, r.label) and repr(q[2:4]) == repr((r.a, r.b))][0]
        if one_vs_rest:
            want = [sum(c[1] / sum(c) for c in parts[i][2][same].values()) / trees for i in range(3)]
        else:
            want = [sum(c[k] / sum(c) for c in parts[0][2][same].values()) / trees for k in range(3)]
        assert r.scores == pytest.approx(want, abs=2e-9)
        assert r.prediction == classes[r.scores.index(max(r.scores))]
    shares = forest_importance(spark, f).collect()
    assert len(shares) == 3 * f.ensembles
    for e in {s.ensemble for s in shares}:
        assert sum(s.importance for s in shares if s.ensemble == e) == pytest.approx(1, abs=1e-8)
    assert all(s.importance == 0 for s in shares if s.feature == "c d")


def test_one_job_per_level_whatever_the_classes(spark):
    df, runs = frame(spark, table()), []
    for classes in (["x", "y"], ["x", "y", "z"]):
        group = f"forest-{len(classes)}"
        spark.sparkContext.setJobGroup(group, group)
        grow_forest(df, "label", FEATURES, ["k"], classes, trees=2, depth=3, one_vs_rest=True)
        runs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setJobGroup("other", "other")
    assert runs[0] == runs[1]


def test_nothing_to_learn(spark):
    df = frame(spark, table())
    f = grow_forest(df.where("label = 'x'"), "label", FEATURES, ["k"], ["x", "y"], trees=2, depth=3)
    assert not f.cuts and {r.prediction for r in forest_scores(df, f).collect()} == {"x"}
    f = grow_forest(df.where("false"), "label", FEATURES, ["k"], ["x", "y"], trees=2, depth=3)
    assert not f.cuts and forest_scores(df, f).where("scores[0] = 0").count() == df.count()
    assert forest_importance(spark, f).agg({"importance": "sum"}).first()[0] == 0


@pytest.mark.parametrize("one_vs_rest", [False, True])
def test_tasks_sum_weights_before_the_shuffle(spark, monkeypatch, one_vs_rest):
    monkeypatch.setattr(forest, "HELD", 200)        # sums are passed on in several parts
    rows, classes, sizes = table(), ["x", "y", "z"], {"depth": 3, "bins": 8, "tried": 2, "least": 4}
    plans, inner = [], forest._best_cuts
    monkeypatch.setattr(forest, "_best_cuts", lambda counts, *a: (plans.append(counts._jdf.queryExecution().analyzed().toString()), inner(counts, *a))[1])
    f = grow_forest(frame(spark, rows), "label", FEATURES, ["k"], classes, trees=3, one_vs_rest=one_vs_rest, **sizes)
    parts = [grow(rows, classes, 3, positive=c, first=i * 3, **sizes) for i, c in enumerate(classes)] if one_vs_rest else [grow(rows, classes, 3, **sizes)]
    assert {k: v[:2] for k, v in f.cuts.items()} == {k: v for p in parts for k, v in p[0].items()}
    assert f.leaves == {k: v for p in parts for k, v in p[1].items()}
    assert len(plans) == 3 and not any("Generate" in p for p in plans)      # no row per tree and feature
