"""The reports of one run, written beside each other: preparation, training, metrics per class, confusion, examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmill.operators import evaluate
from flowmill.plans.explain_examples import explained_examples
from flowmill.plans.prepare import Prepared, preparation_summary
from flowmill.plans.train import Trained, training_summary
from flowmill.sources import files

NAMES = ("preparation", "training", "class_metrics", "confusion", "examples")


def run_reports(prepared: Prepared, trained: Trained, per_class: int = 1) -> dict[str, DataFrame]:
    """Every report as a table of a few rows; metrics and confusion have a row per model and class or cell."""
    metrics, cells = None, None
    for name, counts in trained.counts.items():
        classes, model = trained.bundles[name].class_names, F.lit(name).alias("model")
        told = evaluate.metrics_from_counts(counts, classes).where(F.col("code").isNotNull())
        told = told.select(model, "code", "label", "precision", "recall", "f1", "support")
        own = evaluate.confusion_from_counts(counts, classes).select(model, "label", "prediction", "n")
        metrics = told if metrics is None else metrics.unionByName(told)
        cells = own if cells is None else cells.unionByName(own)
    examples = explained_examples(prepared.test, trained.best, prepared.state, per_class)
    tables = (preparation_summary(prepared), training_summary(trained), metrics, cells, examples)
    return dict(zip(NAMES, tables, strict=True))


def write_reports(reports: dict[str, DataFrame], folder: str) -> None:
    for name, table in reports.items():
        files.write_json(table, f"{folder}/{name}")


def read_report(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """A report of a run; None if it was not written."""
    path = f"{folder}/{name}"
    return spark.read.json(path) if files.exists(spark, path) else None
