"""M4-M12 invariants."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strata.operators.ml import accuracy, confusion, fit_ovr, fit_rf_pipeline, label_indexer
from tests.conftest import SF_SMALL


def test_separable_label_is_learned(spark):
    rnd = random.Random(4)
    data = [(x, rnd.random(), "hi" if x > 0.5 else "lo") for x in (rnd.random() for _ in range(600))]
    df = spark.createDataFrame(data, "x double, noise double, y string")
    m = fit_rf_pipeline(df, "y", ["x", "noise"], num_trees=10, depth=3, seed=1)
    acc = accuracy(m.transform(df)).first().accuracy
    majority = max(sum(1 for *_, y in data if y == c) for c in ("hi", "lo")) / len(data)
    assert acc > max(0.95, majority)
    imp = m.stages[-1].featureImportances
    assert imp[0] > imp[1] and sum(imp) == pytest.approx(1.0)


def test_ovr_and_confusion(spark):
    rnd = random.Random(8)
    data = [(x, ["a", "b", "c"][min(int(x * 3), 2)]) for x in (rnd.random() for _ in range(600))]
    df = spark.createDataFrame(data, "x double, y string")
    lab = label_indexer("y", "label").fit(df).transform(df)
    m = fit_ovr(lab, ["x"], "label", num_trees=5, depth=3, seed=1)
    from strata.operators.ml import assembler
    pred = m.transform(assembler(["x"]).transform(lab))
    assert accuracy(pred).first().accuracy > 0.9
    assert sum(r.n for r in confusion(pred).collect()) == 600


def test_registered_model_keys(spark):
    q = entry.queries()
    fi = q["feature_importance"](spark, SF_SMALL).collect()
    by_model = {}
    for r in fi:
        by_model.setdefault((r.model, r["class"]), 0.0)
        by_model[(r.model, r["class"])] += r.importance
    assert len(by_model) == 1 + 5 and all(v == pytest.approx(1.0) for v in by_model.values())
    mm = q["model_metrics"](spark, SF_SMALL).collect()
    assert {r.metric for r in mm} == {"accuracy", "auc"}
    assert all(r.value is None or 0.0 <= r.value <= 1.0 for r in mm)
    rf = q["rf_predictions"](spark, SF_SMALL)
    assert rf.where(F.col("prediction").isNull()).count() == 0
