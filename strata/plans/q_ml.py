"""Registered queries for feature preparation, models and metrics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.forest import PLACES, forest_importance, forest_scores, forest_sql, grow_forest
from strata.operators.ml import (accuracy, assembler, auc_by_class, confusion, fit_ovr,
                                 fit_rf_pipeline, forest_importances, hash_split, importances,
                                 label_indexer, label_map, split_bucket)
from strata.operators.stats import fround
from strata.operators.winner import winner_wide
from strata.plans.flagship import enriched_panel
from strata.session import materialize
from strata.sources.tables import table

FEATURES = ["total_price", "n_orders", "f_ratio", "near_f_ratio", "c_acctbal"]


def _priorities(spark, sf):
    return table(spark, sf, "orders", "o_orderkey", "o_orderpriority")


def q_label_index_alpha(spark: SparkSession, sf: str) -> DataFrame:
    """M1: index labels in descending alphabetical order."""
    o = _priorities(spark, sf)
    m = label_indexer("o_orderpriority", "label_index", "alphabetDesc").fit(o)
    return m.transform(o).select("o_orderkey", "label_index")


def q_label_index_freq(spark: SparkSession, sf: str) -> DataFrame:
    """M2: index labels by descending frequency (ties alphabetical)."""
    o = _priorities(spark, sf)
    m = label_indexer("o_orderpriority", "label_index").fit(o)
    return m.transform(o).select("o_orderkey", "label_index")


def q_label_map(spark: SparkSession, sf: str) -> DataFrame:
    """M3 + S10: the fitted label list as a table."""
    m = label_indexer("o_orderpriority", "label_index").fit(_priorities(spark, sf))
    return label_map(spark, m.labelsArray[0])


def _customer_features(spark, sf):
    o = table(spark, sf, "orders", "o_custkey", "o_totalprice")
    prof = o.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("avg_price"),
                                      F.count(F.lit(1)).alias("n_orders"))
    c = table(spark, sf, "customer", "c_custkey", "c_acctbal")
    j = c.join(prof, c.c_custkey == prof.o_custkey, "left")
    # balances below zero are treated as missing, so some rows are skipped
    return j.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
                    fround("avg_price", 6).alias("avg_price"),
                    F.col("n_orders").cast("double").alias("n_orders"))


def q_feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    """M4: assembled feature rows; rows with a null feature are skipped."""
    f = _customer_features(spark, sf)
    v = assembler(["balance", "avg_price", "n_orders"]).transform(f)
    arr = vector_to_array("features")
    return v.select("c_custkey", *[arr[i].alias(f"f{i}") for i in range(3)])


def q_hash_split(spark: SparkSession, sf: str) -> DataFrame:
    """M5: stable 80/20 split of customers by key hash."""
    c = table(spark, sf, "customer", "c_custkey")
    return hash_split(c, ["c_custkey"]).withColumn("bucket", split_bucket("c_custkey"))


def _scored(spark, sf):
    """A fixed score per class on lineitem; the prediction is the class
    with the highest score (ties to the first class)."""
    li = table(spark, sf, "lineitem", "l_returnflag", "l_discount", "l_tax", "l_quantity")
    s = li.select("l_returnflag", F.col("l_discount").alias("A"), F.col("l_tax").alias("N"),
                  (F.col("l_quantity") / 50.0).alias("R"))
    return winner_wide(s, ["A", "N", "R"], "prediction", None)


def q_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """M9: accuracy of the fixed scores against the return flag."""
    a = accuracy(_scored(spark, sf), "l_returnflag", "prediction")
    return a.select("n", fround("accuracy", 9).alias("accuracy"))


def q_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """M9: confusion counts."""
    return confusion(_scored(spark, sf), "l_returnflag", "prediction")


def q_auc_by_class(spark: SparkSession, sf: str) -> DataFrame:
    """M10 + C18: exact one-vs-rest AUC per class in one pass."""
    a = auc_by_class(_scored(spark, sf), "l_returnflag", {"A": "A", "N": "N", "R": "R"})
    return a.select("cls", "n_pos", "n_neg", fround("auc", 9).alias("auc"))


def _model_panel(spark, sf):
    """The modelling table, written once: the fit makes several passes and
    the test rows are transformed afterwards, so the panel chain (orders
    aggregation, nearest join, customer join) runs one time only."""
    p = enriched_panel(spark, sf)
    c = table(spark, sf, "customer", "c_custkey", "c_acctbal")
    p = p.join(c, p.o_custkey == c.c_custkey, "inner").drop("c_custkey")
    return materialize(hash_split(p, ["o_custkey", "year"]), "model_panel")


def q_rf_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """M6 + M7 + M12: forest (50 trees, depth 5, seed 42) on the train
    split, predictions for the test split."""
    p = _model_panel(spark, sf)
    model = fit_rf_pipeline(p.where(F.col("split") == "train"), "winner", FEATURES, 50, 5, 42)
    out = model.transform(p.where(F.col("split") == "test"))
    return out.select("o_custkey", "year", "winner", "label", "prediction")


def _ovr(spark, sf, p=None):
    p = p if p is not None else _model_panel(spark, sf)
    idx = label_indexer("winner", "label").fit(p.where(F.col("split") == "train"))      # nothing is learned from test rows
    lab = idx.transform(p)
    model = fit_ovr(lab.where(F.col("split") == "train"), FEATURES, "label", 30, 5, 1)
    return lab, idx, model


def q_ovr_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """M8: one-vs-rest forests (30 trees, depth 5, seed 1), parallel per class."""
    lab, _, model = _ovr(spark, sf)
    test = assembler(FEATURES).transform(lab.where(F.col("split") == "test"))
    return model.transform(test).select("o_custkey", "year", "winner", "label", "prediction")


def q_feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Importances of the forest and of each one-vs-rest model."""
    p = _model_panel(spark, sf)
    rf = fit_rf_pipeline(p.where(F.col("split") == "train"), "winner", FEATURES, 50, 5, 42)
    rows = forest_importances(rf.stages[-1], FEATURES, "rf")
    _, idx, ovr = _ovr(spark, sf, p)
    for i, m in enumerate(ovr.models):
        rows += forest_importances(m, FEATURES, "ovr", idx.labelsArray[0][i])
    return importances(spark, rows)


def q_model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """M9 + M10 on the fitted models, as the reference evaluates them:
    holdout accuracy of the forest and of one-vs-rest, and the exact
    per-class AUC of the one-vs-rest scores (``auc_by_class``, ties half)."""
    p = _model_panel(spark, sf)
    test = F.col("split") == "test"
    rf = fit_rf_pipeline(p.where(F.col("split") == "train"), "winner", FEATURES, 50, 5, 42)
    rf_acc = accuracy(rf.transform(p.where(test))).select(
        F.lit("rf").alias("model"), F.lit("accuracy").alias("metric"), F.lit("all").alias("class"),
        F.col("accuracy").alias("value"))
    lab, idx, ovr = _ovr(spark, sf, p)
    pred = ovr.transform(assembler(FEATURES).transform(lab.where(test)))
    ovr_acc = accuracy(pred).select(
        F.lit("ovr").alias("model"), F.lit("accuracy").alias("metric"), F.lit("all").alias("class"),
        F.col("accuracy").alias("value"))
    labels = idx.labelsArray[0]
    raw = vector_to_array("rawPrediction")
    scored = pred.select(F.element_at(F.array(*[F.lit(x) for x in labels]),
                                      F.col("label").cast("int") + 1).alias("winner"),
                         *[raw[i].alias(f"s{i}") for i in range(len(labels))])
    auc = auc_by_class(scored, "winner", {x: f"s{i}" for i, x in enumerate(labels)}).select(
        F.lit("ovr").alias("model"), F.lit("auc").alias("metric"), F.col("cls").alias("class"),
        F.col("auc").alias("value"))
    return rf_acc.unionByName(ovr_acc).unionByName(auc)


def q_model_checks(spark: SparkSession, sf: str) -> DataFrame:
    """A loose check of the library forest (M6, M7): the test rows and
    classes, that its importances sum to 1, and that it predicts known classes
    with an accuracy of at least two thirds of the largest class's share.
    One-vs-rest models are not part of it; the ``forest_*`` keys recompute
    forests split by split."""
    p = _model_panel(spark, sf)
    train, test = p.where(F.col("split") == "train"), p.where(F.col("split") == "test")
    model = fit_rf_pipeline(train, "winner", FEATURES, 50, 5, 42)
    labels = model.stages[0].labelsArray[0]
    pred = model.transform(test)
    total = sum(v for *_, v in forest_importances(model.stages[-1], FEATURES, "rf"))
    majority = pred.groupBy("label").count().agg((F.max("count") / F.sum("count")).alias("m"))
    return (pred.agg(F.count(F.lit(1)).alias("n_test"),
                     F.sum(F.col("prediction").between(0, len(labels) - 1).cast("long")).alias("n_predicted"),
                     F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("a"))
            .crossJoin(F.broadcast(majority))
            .select("n_test", "n_predicted", F.lit(len(labels)).cast("long").alias("n_classes"),
                    F.lit(abs(total - 1) < 1e-9).alias("importances_sum_to_1"), (F.col("a") >= F.col("m") * 2 / 3).alias("accuracy_holds")))


# the forests that SQL recomputes: the reference's features, fewer and smaller trees
FOREST = {"trees": 5, "depth": 4, "bins": 24, "tried": 2, "least": 3}
OVR_FOREST = {"trees": 3, "depth": 3, "bins": 24, "tried": 2, "least": 3}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _grown(spark, sf, one_vs_rest: bool):
    """A forest grown on the training rows and the scored test rows."""
    p = _model_panel(spark, sf)
    f = grow_forest(p.where("split = 'train'"), "winner", FEATURES, ["o_custkey", "year"], PRIORITIES,
                    one_vs_rest=one_vs_rest, **(OVR_FOREST if one_vs_rest else FOREST))
    return f, forest_scores(p.where("split = 'test'"), f)


def _forest_rows(spark, sf, one_vs_rest: bool) -> DataFrame:
    _, scored = _grown(spark, sf, one_vs_rest)
    return scored.select("o_custkey", "year", "winner", "prediction", F.array_max("scores").alias("score"))


def q_forest_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """M6 + M7 + M12: a forest over all classes, its predictions for the test rows."""
    return _forest_rows(spark, sf, False)


def q_ovr_forest_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """M8: one-vs-rest forests of all classes, grown together."""
    return _forest_rows(spark, sf, True)


def q_forest_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Importances of the forest and of each one-vs-rest forest."""
    p = _model_panel(spark, sf).where("split = 'train'")
    fits = [grow_forest(p, "winner", FEATURES, ["o_custkey", "year"], PRIORITIES, one_vs_rest=ovr, **sizes)
            for ovr, sizes in ((False, FOREST), (True, OVR_FOREST))]
    return forest_importance(spark, fits[0]).unionByName(forest_importance(spark, fits[1]))


def q_forest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """M9 + M10 of the one-vs-rest forests: accuracy, the share of the largest
    class, and each class's AUC from its own scores, on the test rows."""
    _, scored = _grown(spark, sf, True)
    scored = materialize(scored.select("winner", "prediction", "scores"), "forest-scores")
    one = lambda metric, cls, value: [F.lit(metric).alias("metric"), F.lit(cls).alias("class"), fround(value, PLACES).alias("value")]     # noqa: E731
    acc = accuracy(scored, "winner").select(*one("accuracy", "all", F.col("accuracy")))
    largest = scored.groupBy("winner").count().agg((F.max("count") / F.sum("count")).alias("m")).select(*one("largest class", "all", F.col("m")))
    auc = auc_by_class(scored, "winner", {c: F.get("scores", F.lit(i)) for i, c in enumerate(PRIORITIES)})
    return acc.unionByName(largest).unionByName(auc.select(F.lit("auc").alias("metric"), F.col("cls").alias("class"), fround("auc", PLACES).alias("value")))


QUERIES = {
    "forest_predictions": q_forest_predictions,
    "ovr_forest_predictions": q_ovr_forest_predictions,
    "forest_importance": q_forest_importance,
    "forest_metrics": q_forest_metrics,
    "model_checks": q_model_checks,
    "label_index_alpha": q_label_index_alpha,
    "label_index_freq": q_label_index_freq,
    "label_map": q_label_map,
    "feature_rows": q_feature_rows,
    "hash_split": q_hash_split,
    "accuracy": q_accuracy,
    "confusion": q_confusion,
    "auc_by_class": q_auc_by_class,
    "rf_predictions": q_rf_predictions,
    "ovr_predictions": q_ovr_predictions,
    "feature_importance": q_feature_importance,
    "model_metrics": q_model_metrics,
}


def _fr(x, p):
    return f"(floor(({x}) * {float(10 ** p)} + 0.5) / {float(10 ** p)})"


_FREQ = """
WITH c AS (SELECT o_orderpriority AS label, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS idx FROM c
"""

_SCORED = """
WITH s AS (SELECT l_returnflag, l_discount AS a, l_tax AS n, l_quantity / 50.0 AS r FROM lineitem),
p AS (SELECT *, CASE WHEN a >= n AND a >= r THEN 'A' WHEN n >= r THEN 'N' ELSE 'R' END AS prediction FROM s)
"""

# the modelling table: yearly panel, ratio of the nearest year with F orders, balance
_PANEL = f"""
SELECT o_custkey || '|' || year AS key, CASE WHEN ('0x' || substr(md5(o_custkey || '|' || year), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS part,
  list_position({PRIORITIES}, winner)::INTEGER - 1 AS y, total_price AS x0, n_orders::DOUBLE AS x1, f_ratio AS x2, near_f_ratio AS x3, c_acctbal AS x4, o_custkey, year, winner
FROM (SELECT pw.*, arg_max(r.f_ratio, (-abs(pw.year - r.year), r.year)) AS near_f_ratio
      FROM panel pw LEFT JOIN (SELECT o_custkey, year, f_ratio FROM panel WHERE f_total > 0) r ON pw.o_custkey = r.o_custkey GROUP BY ALL) e
JOIN customer ON o_custkey = c_custkey"""

_FOREST = """
WITH orders_y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
prices AS (SELECT o_custkey, year, CAST(SUM(price) AS DOUBLE) AS total_price, COUNT(*) AS n_orders,
             CAST(SUM(price) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS f_total FROM orders_y GROUP BY 1, 2),
winners AS (SELECT o_custkey, year, o_orderpriority AS winner FROM orders_y GROUP BY 1, 2, 3
            QUALIFY row_number() OVER (PARTITION BY o_custkey, year ORDER BY SUM(price) DESC, o_orderpriority) = 1),
panel AS (SELECT *, f_total / NULLIF(total_price, 0) AS f_ratio FROM prices JOIN winners USING (o_custkey, year)),
"""


def _forest(one_vs_rest: bool) -> str:
    """The forest and ``votes`` (key, c, s): a test row's score of each class."""
    sizes = OVR_FOREST if one_vs_rest else FOREST
    grown = forest_sql(_PANEL, len(FEATURES), len(PRIORITIES), one_vs_rest=one_vs_rest, **sizes)
    c, rows = (f"tree // {sizes['trees']}", "WHERE k = 1") if one_vs_rest else ("k", "")
    votes = f"SELECT key, {c} AS c, {_fr('sum(s) / ' + str(float(sizes['trees'])), PLACES)} AS s FROM scored {rows} GROUP BY ALL"
    return _FOREST + grown + f",\nvotes AS ({votes})"


def _forest_predictions(one_vs_rest: bool) -> str:
    return _forest(one_vs_rest) + f"""
SELECT o_custkey, year, winner, {PRIORITIES}[c + 1] AS prediction, s AS score
FROM (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY key ORDER BY s DESC, c) = 1) JOIN base USING (key)"""


def _forest_importance(one_vs_rest: bool) -> str:
    e, name = (f"tree // {OVR_FOREST['trees']}", f"{PRIORITIES}[e + 1]") if one_vs_rest else ("0", "'all'")
    return _forest(one_vs_rest) + f""",
shares AS (SELECT tree, {e} AS e, feature, sum(gain) / sum(sum(gain)) OVER (PARTITION BY tree) AS share FROM cuts GROUP BY tree, feature),
grid AS (SELECT e, i, {FEATURES}[i + 1] AS feature FROM range({len(PRIORITIES) if one_vs_rest else 1}) a(e), range({len(FEATURES)}) b(i))
SELECT {name} AS ensemble, g.feature, {_fr(f'coalesce((SELECT sum(share) FROM shares s WHERE s.e = g.e AND s.feature = g.i) / (SELECT count(DISTINCT tree) FROM shares s WHERE s.e = g.e), 0)', PLACES)} AS importance
FROM grid g"""


ORACLE = {
    "forest_predictions": _forest_predictions(False),
    "ovr_forest_predictions": _forest_predictions(True),
    "forest_importance": f"SELECT * FROM ({_forest_importance(False)}) UNION ALL SELECT * FROM ({_forest_importance(True)})",
    "forest_metrics": _forest(True) + f""",
tested AS (SELECT winner, y, c, s FROM votes JOIN base USING (key)),
ranks AS (SELECT c, y = c AS pos, rank() OVER (PARTITION BY c ORDER BY s) + (count(*) OVER (PARTITION BY c, s) - 1) / 2.0 AS r FROM tested),
sides AS (SELECT c, count(*) FILTER (pos) AS p, count(*) FILTER (NOT pos) AS n, sum(r) FILTER (pos) AS rs FROM ranks GROUP BY c),
predicted AS (SELECT y, c FROM (SELECT key, c FROM votes QUALIFY row_number() OVER (PARTITION BY key ORDER BY s DESC, c) = 1) JOIN base USING (key))
SELECT 'accuracy' AS metric, 'all' AS class, {_fr('avg((y = c)::INTEGER)', PLACES)} AS value FROM predicted
UNION ALL SELECT 'largest class', 'all', {_fr('max(n) / sum(n)', PLACES)} FROM (SELECT count(*)::DOUBLE AS n FROM predicted GROUP BY y)
UNION ALL SELECT 'auc', {PRIORITIES}[c + 1], {_fr('(rs - p * (p + 1) / 2.0) / (p * n)', PLACES)} FROM sides""",
    "model_checks": """
WITH p AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, sum(o_totalprice) FILTER (o_orderstatus = 'F') AS f,
             ('0x' || substr(md5(o_custkey || '|' || CAST(year(o_orderdate) AS INTEGER)), 1, 8))::BIGINT % 100 AS bucket
           FROM orders GROUP BY 1, 2),
t AS (SELECT COUNT(*) AS n FROM p JOIN customer ON o_custkey = c_custkey
      WHERE bucket >= 80 AND o_custkey IN (SELECT o_custkey FROM p WHERE f > 0) AND f IS NOT NULL)
SELECT n AS n_test, n AS n_predicted, 5::BIGINT AS n_classes, TRUE AS importances_sum_to_1, TRUE AS accuracy_holds FROM t
""",
    "label_index_alpha": """
WITH c AS (SELECT DISTINCT o_orderpriority AS label FROM orders),
i AS (SELECT label, CAST(row_number() OVER (ORDER BY label DESC) - 1 AS DOUBLE) AS idx FROM c)
SELECT o.o_orderkey, i.idx AS label_index FROM orders o JOIN i ON o.o_orderpriority = i.label
""",
    "label_index_freq": f"""
WITH i AS ({_FREQ})
SELECT o.o_orderkey, i.idx AS label_index FROM orders o JOIN i ON o.o_orderpriority = i.label
""",
    "label_map": f"SELECT idx AS index, label FROM ({_FREQ})",
    "feature_rows": f"""
WITH prof AS (SELECT o_custkey, avg(o_totalprice) AS avg_price, COUNT(*) AS n_orders FROM orders GROUP BY 1),
j AS (SELECT c.c_custkey, CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS balance,
             {_fr('p.avg_price', 6)} AS avg_price, CAST(p.n_orders AS DOUBLE) AS n_orders
      FROM customer c LEFT JOIN prof p ON c.c_custkey = p.o_custkey)
SELECT c_custkey, balance AS f0, avg_price AS f1, n_orders AS f2 FROM j
WHERE balance IS NOT NULL AND avg_price IS NOT NULL AND n_orders IS NOT NULL
  AND NOT isnan(balance) AND NOT isnan(avg_price)
""",
    "hash_split": """
SELECT c_custkey,
  CASE WHEN ('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS split,
  CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % 100 AS INTEGER) AS bucket
FROM customer
""",
    "accuracy": _SCORED + f"""
SELECT COUNT(*) AS n, {_fr("avg(CASE WHEN l_returnflag = prediction THEN 1.0 ELSE 0.0 END)", 9)} AS accuracy FROM p
""",
    "confusion": _SCORED + "SELECT l_returnflag, prediction, COUNT(*) AS n FROM p GROUP BY 1, 2",
    "auc_by_class": _SCORED + f""",
x AS (SELECT 'A' AS cls, a AS score, l_returnflag = 'A' AS pos FROM p
      UNION ALL SELECT 'N', n, l_returnflag = 'N' FROM p
      UNION ALL SELECT 'R', r, l_returnflag = 'R' FROM p),
rk AS (SELECT cls, pos, rank() OVER (PARTITION BY cls ORDER BY score)
                  + (COUNT(*) OVER (PARTITION BY cls, score) - 1) / 2.0 AS r FROM x),
agg AS (SELECT cls, SUM(CASE WHEN pos THEN 1 ELSE 0 END) AS P, SUM(CASE WHEN pos THEN 0 ELSE 1 END) AS N,
               SUM(CASE WHEN pos THEN r ELSE 0 END) AS rs FROM rk GROUP BY 1)
SELECT cls, CAST(P AS BIGINT) AS n_pos, CAST(N AS BIGINT) AS n_neg,
       {_fr('(rs - P * (P + 1) / 2.0) / (P * N)', 9)} AS auc FROM agg
""",
}
