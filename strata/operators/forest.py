"""Forests whose every split can be recomputed.

Trees grow as Spark aggregations over binned features, all trees of all
ensembles in one job per level: a row's node in every tree follows from the
splits so far, weighted class counts are grouped by (tree, node, feature,
bin), and each node takes the cut with the greatest score, the sum over both
sides of (squared class counts) / (rows).  Nothing is drawn at random:

* a row's weight in a tree is a digit that the MD5 of (key, tree) picks from
  ``WEIGHTS`` (a bootstrap by rule);
* a node may cut the ``tried`` features with the least MD5 of (tree, node,
  feature);
* equal scores go to the first feature, then the lowest bin.

So SQL can recompute the forest split by split.  An ensemble is either over
all classes or of one class against the rest; a one-vs-rest forest is one set
of grouped counts, as many jobs as levels whatever the number of classes.

A feature's bins are ``bins`` equal ones over its range in the training rows;
values outside go to the outermost bins, and a missing value (null, NaN,
infinity) is a bin of its own below them.  The model (at most trees x 2^depth
splits) reaches the driver and goes back to the tasks; rows never leave the
executors.  A task walks its rows and sums their weights with numpy, so only
sums by (tree, node, feature, bin, class) are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators.stats import finite, fround
from strata.session import materialize, ship

WEIGHTS = "0000001111112223"        # the weight for each hexadecimal digit
GAIN = 1e-9                         # a cut must score this much more than its node
PLACES = 9
HELD = 1 << 20                      # sums a task holds before it passes them on


@dataclass
class Forest:
    """``cuts``: (tree, node) -> (feature, bin, gain); ``leaves``: (tree, node)
    -> weighted counts of classes (of the rest and the class, one-vs-rest)."""

    features: list[str]
    classes: list
    keys: list[str]
    ranges: list[tuple[float, float]]
    trees: int                      # of an ensemble
    depth: int
    bins: int
    one_vs_rest: bool
    cuts: dict[tuple[int, int], tuple[int, int, float]]
    leaves: dict[tuple[int, int], list[int]]

    @property
    def ensembles(self) -> int:
        return len(self.classes) if self.one_vs_rest else 1


def _bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    at = F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)) if hi > lo else F.lit(0)
    return F.when(x.isNull(), -1).otherwise(F.greatest(F.lit(0), F.least(F.lit(bins - 1), at))).cast("int")


def _binned(df: DataFrame, f: Forest) -> Column:
    return F.array(*[_bin(finite(c), lo, hi, f.bins) for c, (lo, hi) in zip(f.features, f.ranges)])


def _weight(key: Column, tree: Column) -> Column:
    digit = F.substring(F.md5(F.concat(key, F.lit("|"), tree.cast("string"))), 1, 1)
    return F.translate(digit, "0123456789abcdef", WEIGHTS).cast("int")


def _places(f: Forest) -> tuple[np.ndarray, np.ndarray]:
    """The cut feature (-1: a leaf) and bin of every place
    tree * 2^(depth + 1) + node."""
    size = f.trees * f.ensembles << f.depth + 1
    feature, cut = np.full(size, -1, np.int32), np.zeros(size, np.int32)
    for (tree, node), (which, at, _) in f.cuts.items():
        feature[(tree << f.depth + 1) + node], cut[(tree << f.depth + 1) + node] = which, at
    return feature, cut


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """A column of lists of ``width`` numbers each."""
    return lists.flatten().to_numpy().reshape(-1, width)


def _walk(bins: np.ndarray, tree: int, depth: int, levels: int, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The rows' nodes in a tree after at most ``levels`` cuts (the root is 1)."""
    node, row = np.ones(len(bins), np.int64), np.arange(len(bins))
    for _ in range(levels):
        at = (tree << depth + 1) + node
        which = feature[at]
        node = np.where(which < 0, node, 2 * node + (bins[row, which] > cut[at]))
    return node


def _merged(cells: list[np.ndarray], sums: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The same sums with every cell once."""
    if not cells:
        return [], []
    once, place = np.unique(np.concatenate(cells), return_inverse=True)
    total = np.zeros(len(once), np.int64)
    np.add.at(total, place, np.concatenate(sums))
    return [once], [total]


def _level_counts(rows: DataFrame, f: Forest, level: int, kinds: int) -> DataFrame:
    """Weighted class counts by (tree, node, feature, bin) of a level's nodes;
    rows that rest in leaves above are left out."""
    ship(rows.sparkSession)
    feature, cut = _places(f)
    first, n_features, n_bins = 1 << level, len(f.features), f.bins + 1          # a bin more for missing values
    trees, total, depth, one_vs_rest = f.trees, f.trees * f.ensembles, f.depth, f.one_vs_rest
    span, most = first * n_features * n_bins * kinds, HELD                       # cells of a tree

    def batch(cells: list[np.ndarray], sums: list[np.ndarray]) -> pa.RecordBatch:
        at, parts = cells[0], []
        for size in (kinds, n_bins, n_features, first):
            at, part = np.divmod(at, size)
            parts.append(part)
        y, bin_, which, node = parts
        return pa.record_batch([pa.array(c.astype("i4")) for c in (at, node + first, which, bin_ - 1, y)] + [pa.array(sums[0])],
                               ["tree", "node", "feature", "bin", "y", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, sums, held = [], [], 0
        for b in batches:
            y, bins, weights = b.column("y").to_numpy(), _matrix(b.column("bins"), n_features), _matrix(b.column("weights"), total)
            for tree in range(total):
                drawn = np.flatnonzero(weights[:, tree])
                node = _walk(bins[drawn], tree, depth, level, feature, cut)
                drawn, node = drawn[node >= first], node[node >= first] - first
                kind = (y[drawn] == tree // trees).astype(np.int64) if one_vs_rest else y[drawn].astype(np.int64)
                at = ((node[:, None] * n_features + np.arange(n_features)) * n_bins + bins[drawn] + 1) * kinds + kind[:, None]
                once, place = np.unique(at, return_inverse=True) if span > most else (np.arange(span), at)
                n = np.bincount(place.ravel(), np.repeat(weights[drawn, tree], n_features), len(once))
                found = np.flatnonzero(n)
                cells.append(tree * span + once[found])
                sums.append(n[found].astype(np.int64))
                held += len(found)
                if held > most:
                    cells, sums = _merged(cells, sums)
                    held = len(cells[0])
                    if held > most // 2:
                        yield batch(cells, sums)
                        cells, sums, held = [], [], 0
        if held:
            yield batch(*_merged(cells, sums))

    counted = rows.select("y", "bins", "weights").mapInArrow(count, "tree int, node int, feature int, bin int, y int, n long")
    return counted.groupBy("tree", "node", "feature", "bin").agg(
        *[F.sum(F.when(F.col("y") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(kinds)])


def _tried(tree: Column, node: Column, feature: int, features: int, tried: int) -> Column:
    """Whether the feature is among the ``tried`` ones of a node."""
    mark = lambda g: F.md5(F.concat_ws(":", tree.cast("string"), node.cast("string"), F.lit(str(g))))       # noqa: E731
    return sum(((mark(g) < mark(feature)).cast("int") for g in range(features)), F.lit(0)) < tried


def _best_cuts(counts: DataFrame, kinds: int, features: int, tried: int, least: int) -> DataFrame:
    """The cut of each (tree, node) that has one, with the counts beside it."""
    by = Window.partitionBy("tree", "node", "feature")
    upto = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = counts.withColumns({**{f"l{k}": F.sum(f"c{k}").over(upto) for k in range(kinds)},
                            **{f"t{k}": F.sum(f"c{k}").over(by) for k in range(kinds)}})
    c = c.withColumns({f"r{k}": F.col(f"t{k}") - F.col(f"l{k}") for k in range(kinds)})
    rows = {s: sum((F.col(f"{s}{k}") for k in range(kinds)), F.lit(0)) for s in "lrt"}
    square = {s: sum((F.col(f"{s}{k}") * F.col(f"{s}{k}") for k in range(kinds)), F.lit(0)).cast("double") / rows[s] for s in "lrt"}
    open_ = F.when(F.col("feature") == 0, _tried(F.col("tree"), F.col("node"), 0, features, tried))
    for g in range(1, features):
        open_ = open_.when(F.col("feature") == g, _tried(F.col("tree"), F.col("node"), g, features, tried))
    c = c.where((rows["l"] >= least) & (rows["r"] >= least)).withColumns({"score": square["l"] + square["r"], "whole": square["t"]})
    c = c.where((F.col("score") > F.col("whole") + GAIN) & open_)
    best = F.max_by(F.struct("feature", "bin", (F.col("score") - F.col("whole")).alias("gain"),
                             F.array(*[f"l{k}" for k in range(kinds)]).alias("left"), F.array(*[f"r{k}" for k in range(kinds)]).alias("right")),
                    F.struct("score", -F.col("feature"), -F.col("bin")))
    return c.groupBy("tree", "node").agg(best.alias("b")).select("tree", "node", "b.*")


def grow_forest(train: DataFrame, label: str, features: list[str], keys: list[str], classes: list, trees: int = 10,
                depth: int = 4, bins: int = 32, tried: int | None = None, least: int = 2,
                one_vs_rest: bool = False) -> Forest:
    """Grow a forest on ``train``, whose rows ``keys`` identify.  Rows with
    another label than ``classes`` (or none) are left out."""
    at = [F.struct(F.min(finite(c)).alias("lo"), F.max(finite(c)).alias("hi")).alias(f"r{i}") for i, c in enumerate(features)]
    found = train.agg(*at).first()
    ranges = [(r.lo if r.lo is not None else 0.0, r.hi if r.hi is not None else 0.0) for r in found]
    f = Forest(list(features), list(classes), list(keys), ranges, trees, depth, bins, one_vs_rest, {}, {})
    tried = tried or max(1, round(math.sqrt(len(features))))
    kinds = 2 if one_vs_rest else len(classes)
    place = F.coalesce(*[F.when(F.col(label) == F.lit(c), F.lit(i)) for i, c in enumerate(classes)])
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    weights = F.array(*[_weight(key, F.lit(tree)) for tree in range(trees * f.ensembles)])
    rows = materialize(train.select(place.alias("y"), _binned(train, f).alias("bins"), weights.alias("weights"))
                       .where("y is not null"), "forest-rows")
    for level in range(depth):
        counts = _level_counts(rows, f, level, kinds)
        if not level:
            counts = materialize(counts, "forest-root")
            root = counts.where("feature = 0").groupBy("tree").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(kinds)])
            f.leaves = {(r.tree, 1): [r[f"c{k}"] for k in range(kinds)] for r in root.collect()}
        grown = _best_cuts(counts, kinds, len(features), tried, least).collect()
        for r in grown:
            f.cuts[r.tree, r.node] = r.feature, r.bin, r.gain
            f.leaves[r.tree, 2 * r.node], f.leaves[r.tree, 2 * r.node + 1] = r.left, r.right
            del f.leaves[r.tree, r.node]
        if not grown:
            break
    return f


def forest_scores(df: DataFrame, f: Forest, out: str = "prediction", scores: str = "scores") -> DataFrame:
    """``df`` with the classes' mean scores over the trees (rounded to PLACES)
    and the class with the highest, the first of equal ones."""
    ship(df.sparkSession)
    feature, cut = _places(f)
    width, trees, total, depth, one_vs_rest = len(f.features), f.trees, f.trees * f.ensembles, f.depth, f.one_vs_rest
    n_classes = len(f.classes)
    share = np.zeros((len(feature), 2 if one_vs_rest else n_classes))
    for (tree, node), counts in f.leaves.items():
        share[(tree << depth + 1) + node] = [c / sum(counts) for c in counts]

    @F.arrow_udf("array<double>")
    def means(lists: pa.Array) -> pa.Array:
        bins = _matrix(lists, width)
        sums = np.zeros((len(bins), n_classes))
        for tree in range(total):
            leaf = share[(tree << depth + 1) + _walk(bins, tree, depth, depth, feature, cut)]
            if one_vs_rest:
                sums[:, tree // trees] += leaf[:, 1]
            else:
                sums += leaf
        return pa.ListArray.from_arrays(np.arange(len(bins) + 1, dtype="i4") * n_classes, (sums / trees).ravel())

    here = df.withColumn("_means", means(_binned(df, f)))
    here = here.withColumn(scores, F.array(*[fround(F.get("_means", F.lit(k)), PLACES) for k in range(n_classes)]))
    best = F.array_position(scores, F.array_max(scores)).cast("int")
    return here.withColumn(out, F.element_at(F.array(*[F.lit(c) for c in f.classes]), best)).drop("_means")


def forest_importance(spark: SparkSession, f: Forest) -> DataFrame:
    """(ensemble, feature, importance): a feature's share of each tree's gain,
    averaged over the ensemble's trees that have cuts."""
    gain: dict[int, list[float]] = {}
    for (tree, _), (which, _, g) in sorted(f.cuts.items()):
        gain.setdefault(tree, [0.0] * len(f.features))[which] += g
    rows = []
    for e in range(f.ensembles):
        own = [[g / sum(v) for g in v] for t, v in sorted(gain.items()) if t // f.trees == e]
        name = str(f.classes[e]) if f.one_vs_rest else "all"
        rows += [(name, c, sum(v[i] for v in own) / len(own) if own else 0.0) for i, c in enumerate(f.features)]
    out = spark.createDataFrame(rows, "ensemble string, feature string, importance double")
    return out.withColumn("importance", fround("importance", PLACES))


def forest_sql(base: str, features: int, classes: int, trees: int, depth: int, bins: int, tried: int, least: int,
               one_vs_rest: bool) -> str:
    """DuckDB common table expressions that grow the same forest: ``base``
    selects (key, part, y, x0, x1, ...), with part 'train' or 'test'.  Ends with
    ``scored`` (key, tree, k, s: a test row's share of class k in a tree) and
    ``cuts`` (tree, feature, gain)."""
    kinds, total = (2, classes * trees) if one_vs_rest else (classes, trees)
    ks, fs = range(kinds), range(features)

    def bin_of(i: int) -> str:
        return (f"CASE WHEN x{i} IS NULL THEN -1 WHEN hi{i} > lo{i} THEN greatest(0, least({bins - 1}, "
                f"floor((x{i} - lo{i}) * {bins}::DOUBLE / (hi{i} - lo{i})))) ELSE 0 END::INTEGER")

    y = f"(y = tree // {trees})::INTEGER" if one_vs_rest else "y"
    mark = lambda g: f"md5(tree || ':' || node || ':' || {g})"                                              # noqa: E731
    rank = " + ".join(f"({mark(g)} < {mark('f')})::INTEGER" for g in fs)
    n = {s: "(" + " + ".join(f"{s}{k}" for k in ks) + ")" for s in "lrt"}
    sq = {s: "(" + " + ".join(f"{s}{k} * {s}{k}" for k in ks) + f")::DOUBLE / {n[s]}" for s in "lrt"}
    parts = [f"base AS ({base})",
             "lim AS (SELECT " + ", ".join(f"min(x{i}) AS lo{i}, max(x{i}) AS hi{i}" for i in fs) + " FROM base WHERE part = 'train')",
             f"b AS (SELECT key, part, y, [{', '.join(bin_of(i) for i in fs)}] AS b FROM base, lim WHERE part = 'test' OR y IS NOT NULL)",
             f"n0 AS (SELECT key, {y} AS y, b, tree::INTEGER AS tree, 1 AS node, translate(substr(md5(key || '|' || tree), 1, 1), "
             f"'0123456789abcdef', '{WEIGHTS}')::INTEGER AS w FROM b, range({total}) r(tree) WHERE part = 'train')",
             f"p0 AS (SELECT key, b, tree::INTEGER AS tree, 1 AS node FROM b, range({total}) r(tree) WHERE part = 'test')"]
    for v in range(depth):
        parts += [
            f"h{v} AS (SELECT tree, node, f, b[f + 1] AS bin, " + ", ".join(f"sum(CASE WHEN y = {k} THEN w ELSE 0 END)::BIGINT AS c{k}" for k in ks)
            + f" FROM n{v}, range({features}) r(f) WHERE w > 0 GROUP BY ALL)",
            f"a{v} AS (SELECT tree, node, f, bin, " + ", ".join(f"(sum(c{k}) OVER u)::BIGINT AS l{k}, (sum(c{k}) OVER e)::BIGINT AS t{k}" for k in ks)
            + f" FROM h{v} WINDOW u AS (PARTITION BY tree, node, f ORDER BY bin ROWS UNBOUNDED PRECEDING), e AS (PARTITION BY tree, node, f))",
            f"g{v} AS (SELECT *, {sq['l']} + {sq['r']} AS score, {sq['t']} AS whole FROM (SELECT *, " + ", ".join(f"t{k} - l{k} AS r{k}" for k in ks)
            + f" FROM a{v}) WHERE {n['l']} >= {least} AND {n['r']} >= {least})",
            f"s{v} AS (SELECT * FROM g{v} WHERE score > whole + {GAIN}::DOUBLE AND {rank} < {tried} "
            "QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY score DESC, f, bin) = 1)",
            f"n{v + 1} AS (SELECT key, y, b, tree, 2 * n.node + (b[f + 1] > s.bin)::INTEGER AS node, w FROM n{v} n JOIN s{v} s USING (tree, node))",
            f"p{v + 1} AS (SELECT key, b, p.tree, CASE WHEN s.tree IS NULL THEN p.node ELSE 2 * p.node + (b[f + 1] > s.bin)::INTEGER END AS node "
            f"FROM p{v} p LEFT JOIN s{v} s ON s.tree = p.tree AND s.node = p.node)"]
    sides = "".join(f" UNION ALL SELECT tree, 2 * node, {', '.join(f'l{k}' for k in ks)} FROM s{v}"
                    f" UNION ALL SELECT tree, 2 * node + 1, {', '.join(f'r{k}' for k in ks)} FROM s{v}" for v in range(depth))
    parts += [f"leaves AS (SELECT tree, 1 AS node, {', '.join(f'sum(c{k})::BIGINT AS c{k}' for k in ks)} FROM h0 WHERE f = 0 GROUP BY tree{sides})",
              "scored AS (SELECT key, p.tree, k, [" + ", ".join(f"c{k}" for k in ks) + "][k + 1] / (" + " + ".join(f"c{k}" for k in ks)
              + f")::DOUBLE AS s FROM p{depth} p JOIN leaves l ON l.tree = p.tree AND l.node = p.node, range({kinds}) r(k))",
              "cuts AS (" + " UNION ALL ".join(f"SELECT tree, f AS feature, score - whole AS gain FROM s{v}" for v in range(depth)) + ")"]
    return ",\n".join(parts)
