"""Training several models on prepared tables, comparing them and keeping the best."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import q, small_table
from flowmill.operators import evaluate, models
from flowmill.operators.selection import stratified_split, subsample
from flowmill.plans.prepare import CODE, ROW_KEY, PrepState
from flowmill.sources.prepared import check_order


@dataclass(frozen=True)
class Trained:
    best: models.Bundle
    bundles: dict[str, models.Bundle]
    seconds: dict[str, float]
    comparison: DataFrame
    counts: dict[str, DataFrame]
    selection_metric: str
    train_rows: int = 0
    class_weight: bool = False


def predicted_codes(df: DataFrame, bundle: models.Bundle) -> DataFrame:
    """(label code, predicted code) per row."""
    vectors = df.select(
        q(CODE).alias("truth"), models.feature_vector([q(c) for c in bundle.feature_columns]).alias(models.FEATURES)
    )
    return models.transformed(bundle.model, vectors).select("truth", F.col("prediction").cast("int").alias("predicted"))


def test_counts(df: DataFrame, bundle: models.Bundle) -> DataFrame:
    """Outcome counts by class name, brought to the driver and back: at most classes^2 rows."""
    spark = df.sparkSession
    rows = evaluate.outcome_counts(predicted_codes(df, bundle), "truth", "predicted").collect()
    name = dict(enumerate(bundle.class_names)).get  # no name for rows without label or prediction
    told = [(name(r["label"]), name(r["prediction"]), r["n"]) for r in rows]
    return small_table(spark, told, "label string, prediction string, n bigint")


def train_and_compare(
    train: DataFrame,
    test: DataFrame,
    state: PrepState,
    names: Sequence[str] = (models.FOREST, models.BOOSTED),
    params: Mapping[str, Mapping] | None = None,
    selection_metric: str = "macro_f1",
    seed: int = 42,
    max_train_rows: int | None = None,
    class_weight: bool | None = None,
    validation_share: float | None = None,
) -> Trained:
    """Fit the named models one after the other on the same rows and pick the best.

    The choice is made on the test rows, or on a share of the train rows set aside for it. Without a word on
    ``class_weight`` the fits are weighted if the rows were prepared with balancing "class_weight".
    """
    if class_weight is None:
        class_weight = state.balancing == "class_weight"
    unknown = [n for n in names if n not in models.TRAINERS]
    if unknown:
        raise ValueError(f"unknown model '{unknown[0]}'; choose from {list(models.TRAINERS)}")
    check_order(train, state)
    judged = test
    if validation_share is not None:
        split = stratified_split(train, state.target, ROW_KEY, validation_share, seed + 1)
        train, judged = split.train(train), split.test(train)
    train = subsample(train, max_train_rows, ROW_KEY, seed)
    rows = train.count()
    bundles, seconds, results, counts = {}, {}, {}, {}
    for name in names:
        model, took = models.train_model(
            name, train, state.feature_columns, CODE, state.classes, (params or {}).get(name), seed, class_weight
        )
        bundles[name] = models.Bundle(model, name, state.feature_columns, list(state.classes))
        seconds[name] = took
        counts[name] = test_counts(judged, bundles[name])
        results[name] = evaluate.overall_from_counts(counts[name], state.classes)
    comparison = evaluate.compare_models(results)
    best = evaluate.best_model(comparison, selection_metric)
    if validation_share is not None:
        counts = {n: test_counts(test, b) for n, b in bundles.items()}
    return Trained(bundles[best], bundles, seconds, comparison, counts, selection_metric, rows, class_weight)


def training_summary(trained: Trained, top_n: int = 15) -> DataFrame:
    """One row per model: metrics on the test rows, rows and seconds of the fit, whether it was chosen and by what, and
    its most important features. ``files.write_json`` stores it."""
    spark, parts = trained.comparison.sparkSession, None
    for name, bundle in trained.bundles.items():
        overall = evaluate.overall_from_counts(trained.counts[name], bundle.class_names)
        ranked = models.feature_importances(bundle.model, bundle.feature_columns, spark, top_n).collect()
        told = [F.struct(F.lit(r["feature"]).alias("feature"), F.lit(r["importance"]).alias("importance")) for r in ranked]
        part = overall.select(
            F.lit(name).alias("model"),
            F.lit(bundle is trained.best).alias("is_best"),
            F.lit(trained.selection_metric).alias("selection_metric"),
            F.lit(trained.train_rows).cast("bigint").alias("train_rows"),
            F.lit(trained.class_weight).alias("class_weight"),
            F.lit(round(trained.seconds[name], 3)).alias("seconds"),
            "accuracy",
            "macro_f1",
            "weighted_f1",
            "unscored",
            F.array(*told).alias("top_features"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts

