"""Feature preparation, classification and evaluation.

Training uses ``pyspark.ml`` (distributed tree induction over aggregated
histograms).  Everything that can be a DataFrame computation is one:
the split is a key hash (stable under repartitioning, unlike
``randomSplit`` on an unordered input), metrics are aggregates, and the
per-class AUC is an exact Mann-Whitney statistic from value counts and a
bucketed prefix sum - no per-class evaluator loop, no sort of a whole
class in one task.  Only label lists and importances reach the driver.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import OneVsRest, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.numbers import one_vs_rest
from strata.operators.ranks import running_sums
from strata.operators.stats import finite
from strata.session import materialize


def label_indexer(label: str, out: str = "label", order: str = "frequencyDesc") -> StringIndexer:
    """M1/M2: ``frequencyDesc`` (ties alphabetical) or ``alphabetDesc``;
    unseen or null labels are skipped."""
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType=order, handleInvalid="skip")


def label_map(spark: SparkSession, labels) -> DataFrame:
    """M3 + S10: (index, label) from a fitted indexer's label list."""
    return spark.createDataFrame([(float(i), str(v)) for i, v in enumerate(labels)],
                                 "index double, label string")


def assembler(cols, out: str = "features") -> VectorAssembler:
    """M4: rows with a null or NaN feature are skipped."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip")


def split_bucket(*keys) -> Column:
    """M5: bucket 0-99 from the first 32 bits of md5 over the key columns."""
    k = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
    return (F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def hash_split(df: DataFrame, keys, train_pct: int = 80, out: str = "split") -> DataFrame:
    """M5: deterministic train/test split by key hash."""
    b = split_bucket(*keys)
    return df.withColumn(out, F.when(b < train_pct, F.lit("train")).otherwise(F.lit("test")))


def random_forest(num_trees: int, depth: int, seed: int, label: str = "label", features: str = "features",
                  max_memory_mb: int = 256, subsampling: float = 1.0) -> RandomForestClassifier:
    """M6.  ``max_memory_mb`` bounds the histograms of one pass (more nodes a
    pass with more memory); ``subsampling`` is each tree's share of rows."""
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=num_trees, maxDepth=depth, seed=seed,
                                  maxMemoryInMB=max_memory_mb, subsamplingRate=subsampling)


def fit_rf_pipeline(train: DataFrame, label: str, feature_cols, num_trees: int = 50,
                    depth: int = 5, seed: int = 42, order: str = "alphabetDesc"):
    """M7: indexer -> assembler -> forest, fitted on ``train``.  The input is
    persisted for the iterative fit and released afterwards (K1)."""
    train = train.persist()
    try:
        model = Pipeline(stages=[label_indexer(label, "label", order), assembler(feature_cols),
                                 random_forest(num_trees, depth, seed)]).fit(train)
    finally:
        train.unpersist()
    return model


def fit_ovr(train: DataFrame, feature_cols, label_col: str = "label", num_trees: int = 30,
            depth: int = 5, seed: int = 1, parallelism: int = 4):
    """M8: one binary forest per class, ``parallelism`` of them at a time
    (threads on the driver; the work runs on the executors)."""
    feats = assembler(feature_cols).transform(train).persist()
    try:
        model = OneVsRest(classifier=random_forest(num_trees, depth, seed, label_col),
                          labelCol=label_col, featuresCol="features",
                          parallelism=parallelism).fit(feats)
    finally:
        feats.unpersist()
    return model


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M9: one row (n, accuracy)."""
    return pred.agg(F.count(F.lit(1)).alias("n"),
                    F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M9: counts per (label, prediction)."""
    return pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def auc_by_class(df: DataFrame, label: str, scores: dict, buckets: int = 1024,
                 split_over: int = 100_000) -> DataFrame:
    """M10 + C18: one-vs-rest area under the ROC curve per class, exact,
    with tied scores counted half (the Mann-Whitney U statistic).

    AUC_c = sum over score values v of pos_v * (neg_below_v + neg_v / 2) / (P * N),
    where ``neg_below_v`` is a prefix sum over the sorted distinct scores.
    The prefix sum runs per (class, score bucket), offset by a window over
    the bucket totals, so no window partition holds a whole class.
    """
    items = [F.struct(F.lit(str(c)).alias("cls"), finite(s).alias("score"),
                      one_vs_rest(label, c).cast("long").alias("pos"))
             for c, s in scores.items()]
    x = df.select(F.explode(F.array(*items)).alias("i")).select("i.*").where(F.col("score").isNotNull())
    # one row per (class, distinct score), written once: the ranking reads it
    # several times and the scored input is scanned a single time
    vc = materialize(x.groupBy("cls", "score").agg(F.sum("pos").alias("pos_v"),
                                                   F.sum(1 - F.col("pos")).alias("neg_v")),
                     "score_counts")
    r = running_sums(vc, ["cls"], "score", ["neg_v"], buckets, split_over)
    u = r.groupBy("cls").agg(
        F.sum(F.col("pos_v") * (F.col("cum_neg_v") - F.col("neg_v") + F.col("neg_v") / 2.0)).alias("u"),
        F.sum("pos_v").alias("n_pos"), F.sum("neg_v").alias("n_neg"))
    return u.select("cls", "n_pos", "n_neg",
                    F.try_divide(F.col("u"), F.col("n_pos") * F.col("n_neg")).alias("auc"))


def importances(spark: SparkSession, rows) -> DataFrame:
    """(model, class, feature, importance) rows as a DataFrame."""
    return spark.createDataFrame(rows, "model string, class string, feature string, importance double")


def forest_importances(model, feature_cols, name: str, cls: str = "all"):
    vec = model.featureImportances
    return [(name, cls, f, float(vec[i])) for i, f in enumerate(feature_cols)]

