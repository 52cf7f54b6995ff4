"""Tree ensembles on Spark ML: fitting, scoring vectors, importances, stored bundles."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import (
    GBTClassifier,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmill.functions.columns import q, small_table
from flowmill.operators import binary_boosting, softmax_boosting
from flowmill.operators.balance import with_class_weight
from flowmill.operators.softmax_boosting import SoftmaxModel

FOREST, BOOSTED, SOFTMAX = "random_forest", "boosted_trees", "softmax_trees"
FEATURES, LABEL, WEIGHT = "features", "label", "class_weight"
MAX_DEPTH = 30  # Spark's own limit; stands for "no limit"

# The defaults of the two models.
FOREST_DEFAULTS = {"trees": 100, "max_depth": None, "max_bins": 32, "memory_mb": 512}
BOOSTED_DEFAULTS = {"rounds": 100, "max_depth": 8, "rate": 0.1, "max_bins": 32}


def feature_vector(features: Sequence[Column]) -> Column:
    """One dense vector; reads columns by position, so any column name will do."""
    return array_to_vector(F.array(*[c.cast("double") for c in features]))


def model_input(
    df: DataFrame, features: Sequence[str], code: str, classes: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """(features vector, label) with the class names as label metadata, plus columns to keep."""
    meta = {"ml_attr": {"type": "nominal", "vals": list(classes), "name": LABEL}}
    return df.select(
        *[q(c) for c in keep],
        feature_vector([q(c) for c in features]).alias(FEATURES),
        q(code).cast("double").alias(LABEL, metadata=meta),
    )


def train_random_forest(data: DataFrame, params: Mapping, seed: int = 42, weight: str | None = None):
    options = {**FOREST_DEFAULTS, **params}
    forest = RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        numTrees=options["trees"],
        maxDepth=options["max_depth"] or MAX_DEPTH,
        maxBins=options["max_bins"],
        maxMemoryInMB=options["memory_mb"],  # more memory per task means fewer passes for deep trees
        featureSubsetStrategy="sqrt",
        seed=seed,
    )
    return (forest.setWeightCol(weight) if weight else forest).fit(data)


def train_boosted_trees(data: DataFrame, params: Mapping, seed: int = 42, weight: str | None = None):
    """One boosted binary model per class (Spark's boosting knows two classes only)."""
    options = {**BOOSTED_DEFAULTS, **params}
    binary = GBTClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        maxIter=options["rounds"],
        maxDepth=options["max_depth"],
        stepSize=options["rate"],
        maxBins=options["max_bins"],
        seed=seed,
    )
    many = OneVsRest(classifier=binary, featuresCol=FEATURES, labelCol=LABEL, parallelism=2)
    many = many.setWeightCol(weight) if weight else many
    return many.fit(data) if options["max_bins"] > binary_boosting.MOST_BINS else binary_boosting.fit(data, many, weight)


def train_softmax_trees(data: DataFrame, params: Mapping, seed: int = 42, weight: str | None = None) -> SoftmaxModel:
    """One tree per class and round for a common softmax objective; nothing in it is drawn, so the seed has no effect."""
    classes = data.schema[LABEL].metadata["ml_attr"]["vals"]
    return softmax_boosting.fit(data, len(classes), params, weight)


TRAINERS = {FOREST: train_random_forest, BOOSTED: train_boosted_trees, SOFTMAX: train_softmax_trees}


def train_model(
    name: str,
    train: DataFrame,
    features: Sequence[str],
    code: str,
    classes: Sequence[str],
    params: Mapping | None = None,
    seed: int = 42,
    class_weight: bool = False,
):
    """Fit one configured model; returns (model, seconds). An unknown name is an error."""
    if name not in TRAINERS:
        raise ValueError(f"unknown model '{name}'; choose from {list(TRAINERS)}")
    data = model_input(train, features, code, classes)
    if class_weight:
        data = with_class_weight(data, LABEL, WEIGHT)
    start = time.perf_counter()
    model = TRAINERS[name](data, params or {}, seed, WEIGHT if class_weight else None)
    return model, time.perf_counter() - start


def transformed(model, df: DataFrame) -> DataFrame:
    """``df`` with what the model says of its vectors.

    For one model per class the margins meet in one array of plain columns, which is what Spark's own chain of appended
    arrays amounts to: the first of equal largest margins is the prediction.
    """
    if not isinstance(model, OneVsRestModel):
        return model.transform(df)
    kept, margins = [q(c) for c in df.columns], []
    for i, binary in enumerate(model.models):
        margin = F.get(vector_to_array(binary.getRawPredictionCol()), F.lit(1)).alias(f"__margin{i}")
        df = binary.transform(df).select(*kept, *margins, margin)
        margins.append(F.col(f"__margin{i}"))
    both = F.array(*margins)
    prediction = (F.array_position(both, F.greatest(*margins)) - 1).cast("double") if len(margins) > 1 else F.lit(0.0)
    return df.select(*kept, array_to_vector(both).alias("rawPrediction"), prediction.alias("prediction"))


def model_name(model) -> str:
    kinds = {OneVsRestModel: BOOSTED, SoftmaxModel: SOFTMAX}
    return kinds.get(type(model), FOREST)


def probabilities(model, scored: DataFrame) -> Column:
    """Class probabilities as an array in class order; they always sum to 1.

    One-per-class boosted models give a margin m per class; 1 / (1 + exp(-2 m)) is each one's own probability. Their
    shares are formed from the logarithms with the largest subtracted, so that no margin is too large or too small.
    """
    if "probability" in scored.columns:
        return vector_to_array("probability")
    own = F.transform(
        vector_to_array("rawPrediction"), lambda m: F.least(2.0 * m, F.lit(0.0)) - F.log1p(F.exp(-F.abs(2.0 * m)))
    )
    weights = F.transform(own, lambda x: F.exp(x - F.array_max(own)))
    total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
    return F.transform(weights, lambda w: w / total)


def feature_importances(model, features: Sequence[str], spark: SparkSession, top_n: int | None = 15) -> DataFrame:
    """(feature, importance), largest first, 5 decimals; the mean over classes for boosted models."""
    if isinstance(model, OneVsRestModel):
        vectors = [m.featureImportances.toArray() for m in model.models]
        values = sum(vectors) / len(vectors)
    elif hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        values = []
    ranked = sorted(zip(features, values), key=lambda pair: -pair[1])
    rows = [(name, round(float(value), 5)) for name, value in ranked[:top_n]]
    return small_table(spark, rows, "feature string, importance double")


@dataclass(frozen=True)
class Bundle:
    """A fitted model with what scoring needs to use it."""

    model: object
    name: str
    feature_columns: list[str]
    class_names: list[str]


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def save_bundle(spark: SparkSession, bundle: Bundle, path: str) -> None:
    """Spark ML's own format (small tables for softmax boosting) plus a one-row JSON table of names."""
    if isinstance(bundle.model, SoftmaxModel):
        bundle.model.save(spark, f"{path}/model")
    else:
        bundle.model.write().overwrite().save(f"{path}/model")
    facts = {"name": bundle.name, "feature_columns": bundle.feature_columns, "class_names": bundle.class_names}
    small_table(spark, [(json.dumps(facts),)], "facts string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    if not _exists(spark, f"{path}/facts"):
        raise FileNotFoundError(f"no model bundle at {path}: train a model and save it there first")
    facts = json.loads(spark.read.text(f"{path}/facts").first()["value"])
    if facts["name"] == SOFTMAX:
        model = SoftmaxModel.load(spark, f"{path}/model")
    else:
        loader = OneVsRestModel if facts["name"] == BOOSTED else RandomForestClassificationModel
        model = loader.load(f"{path}/model")
    return Bundle(model, facts["name"], facts["feature_columns"], facts["class_names"])
