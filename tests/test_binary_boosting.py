"""One boosted model per class, fitted together, against Spark's own fits one by one."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.sql import functions as F

from flowmill.operators import binary_boosting, models

CLASSES = ["a", "b", "c"]
PARAMS = {"rounds": 3, "max_depth": 3, "max_bins": 16}


def frame(spark, n=900, seed=3):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 4))
    x[:, 3] = draw.integers(0, 4, n)
    y = np.where(x[:, 0] + 0.5 * draw.normal(size=n) > 0.4, 2, (x[:, 1] + 0.5 * draw.normal(size=n) > 0).astype(int))
    rows = [(*map(float, r), int(c), float(w)) for r, c, w in zip(x, y, draw.uniform(0.5, 2.0, n))]
    df = spark.createDataFrame(rows, "f0 double, f1 double, f2 double, f3 double, label_code int, class_weight double").repartition(3)
    data = models.model_input(df, [f"f{i}" for i in range(4)], "label_code", CLASSES, ["class_weight"])
    return data


def of_spark(data, weight):
    one = GBTClassifier(featuresCol="features", labelCol="label", maxIter=3, maxDepth=3, stepSize=0.1, maxBins=16, seed=42)
    many = OneVsRest(classifier=one, featuresCol="features", labelCol="label")
    return (many.setWeightCol(weight) if weight else many).fit(data)


@pytest.mark.parametrize("weight", [None, "class_weight"])
def test_models_equal_those_of_spark(spark, weight, tmp_path):
    data = frame(spark)
    own = models.train_boosted_trees(data, PARAMS | {"rate": 0.1}, 42, weight)
    theirs = of_spark(data, weight)
    for a, b in zip(own.models, theirs.models, strict=True):
        assert a.treeWeights == b.treeWeights and [t.numNodes for t in a.trees] == [t.numNodes for t in b.trees]
        assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray(), atol=1e-9)
    margins = lambda rows: np.array([r["rawPrediction"].toArray() for r in rows.collect()])
    found, told = models.transformed(own, data), theirs.transform(data)
    assert np.allclose(margins(found), margins(told), atol=1e-9)
    assert [r[0] for r in found.select("prediction").collect()] == [r[0] for r in told.select("prediction").collect()]
    bundle = models.Bundle(own, models.BOOSTED, [f"f{i}" for i in range(4)], CLASSES)
    models.save_bundle(spark, bundle, f"{tmp_path}/bundle")
    again = models.load_bundle(spark, f"{tmp_path}/bundle").model
    assert np.array_equal(margins(models.transformed(again, data)), margins(found))


def test_a_level_of_all_classes_takes_one_pass(spark, monkeypatch):
    passes, at = [], binary_boosting._sums
    monkeypatch.setattr(binary_boosting, "_sums", lambda *a: passes.append(1) or at(*a))
    monkeypatch.setattr(OneVsRest, "fit", lambda *a: pytest.fail("the classes were fitted one by one"))
    models.train_boosted_trees(frame(spark), PARAMS)
    assert len(passes) == PARAMS["rounds"] * PARAMS["max_depth"]


def test_pure_and_constant_data(spark):
    """A class that one split tells apart, and features without a split."""
    rows = [(float(i % 2), 1.0, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "f0 double, f1 double, label_code int")
    model = models.train_boosted_trees(models.model_input(df, ["f0", "f1"], "label_code", ["a", "b"]), PARAMS)
    assert [[t.numNodes for t in m.trees] for m in model.models] == [[3, 3, 3]] * 2
    flat = models.train_boosted_trees(models.model_input(df, ["f1"], "label_code", ["a", "b"]), PARAMS)
    assert [[t.numNodes for t in m.trees] for m in flat.models] == [[1, 1, 1]] * 2
    assert {r["prediction"] for r in models.transformed(flat, models.model_input(df, ["f1"], "label_code", ["a", "b"])).collect()} == {0.0}
    with pytest.raises(ValueError, match="no rows"):
        models.train_boosted_trees(models.model_input(df.limit(0), ["f0", "f1"], "label_code", ["a", "b"]), PARAMS)
