"""Classification metrics from one grouped count of (label, prediction).

Whatever the table size, everything after that count works on at most classes^2 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from flowmill.functions.columns import q, small_table

LOW_SUPPORT = 30


def outcome_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n), also for rows without label or prediction."""
    both = df.select(q(label).alias("label"), q(prediction).alias("prediction"))
    return both.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def _class_table(counts: DataFrame, classes: Sequence) -> DataFrame:
    kind = counts.schema["label"].dataType.simpleString()
    return small_table(counts.sparkSession, [(i, c) for i, c in enumerate(classes)], f"code int, label {kind}")


def confusion_from_counts(counts: DataFrame, classes: Sequence) -> DataFrame:
    table = _class_table(counts, classes)
    # classes^2 cells from a literal array: the class list is the model's own, not data
    cells = table.select("code", "label", F.explode(F.array(*[F.lit(c) for c in classes])).alias("prediction"))
    places = table.select(F.col("code").alias("prediction_code"), F.col("label").alias("prediction"))
    filled = cells.join(counts, ["label", "prediction"], "left").join(F.broadcast(places), "prediction")
    n = F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    return filled.select("label", "prediction", "code", "prediction_code", n).orderBy("code", "prediction_code")


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """(label, prediction, n) for every pair of known classes, zeros included, in class order."""
    cells = confusion_from_counts(outcome_counts(df, label, prediction), classes)
    return cells.select("label", "prediction", "n")


def normalised_confusion(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """Confusion cells divided by their row sum; a class without rows gives 0."""
    cells = confusion_from_counts(outcome_counts(df, label, prediction), classes)
    row_sum = F.sum("n").over(W.partitionBy("label"))  # over classes^2 cells
    share = F.coalesce(F.try_divide(F.col("n"), row_sum), F.lit(0.0))
    return cells.select("label", "prediction", share.alias("share"))


def metrics_from_counts(counts: DataFrame, classes: Sequence) -> DataFrame:
    """Sums and scores per class. Classes outside the list keep a null code.

    A row without a prediction counts for its label and is no hit. Rows without a label can't be judged and count for
    nothing here; ``overall_from_counts`` tells how many there are of both.
    """
    counts = counts.where(F.col("label").isNotNull())
    hit = F.when(F.col("label").eqNullSafe(F.col("prediction")), F.col("n")).otherwise(0).cast("bigint")
    none = F.lit(0).cast("bigint")
    # a cell counts as support for its label and as a prediction for its predicted class
    as_label = F.struct(F.col("label").alias("label"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("hits"))
    as_guess = F.struct(F.col("prediction").alias("label"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits"))
    sides = counts.select(F.inline(F.array(as_label, as_guess)))
    sums = sides.where(F.col("label").isNotNull()).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    every = _class_table(counts, classes).join(sums, "label", "full_outer").fillna(0, ["support", "predicted", "hits"])
    zero = F.lit(0.0)
    return every.select(
        "code",
        "label",
        F.coalesce(F.try_divide(F.col("hits"), F.col("predicted")), zero).alias("precision"),
        F.coalesce(F.try_divide(F.col("hits"), F.col("support")), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hits"), F.col("predicted") + F.col("support")), zero).alias("f1"),
        "support",
        "hits",
    )


def per_class_metrics(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """Precision, recall, F1 and support of every known class; nothing to divide by gives 0."""
    metrics = metrics_from_counts(outcome_counts(df, label, prediction), classes)
    return metrics.where(F.col("code").isNotNull()).orderBy("code").select("label", "precision", "recall", "f1", "support")


def overall_from_counts(counts: DataFrame, classes: Sequence) -> DataFrame:
    known = F.when(F.col("code").isNotNull(), F.col("f1"))
    none = F.lit(0).cast("bigint")
    left_out = counts.agg(
        F.coalesce(F.sum(F.when(F.col("label").isNotNull() & F.col("prediction").isNull(), F.col("n"))), none).alias("unscored"),
        F.coalesce(F.sum(F.when(F.col("label").isNull(), F.col("n"))), none).alias("unlabelled"),
    )
    facts = metrics_from_counts(counts, classes).unionByName(left_out, allowMissingColumns=True)
    return facts.agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg(known).alias("macro_f1"),
        F.try_divide(F.sum(known * F.col("support")), F.sum(F.when(F.col("code").isNotNull(), F.col("support")))).alias(
            "weighted_f1"
        ),
        F.max("unscored").alias("unscored"),
        F.max("unlabelled").alias("unlabelled"),
    )


def overall_metrics(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """Accuracy, macro F1 over all known classes and support-weighted F1, as one row (unrounded).

    ``unscored`` rows have a label and no prediction: they count as wrong. ``unlabelled`` rows are not judged.
    """
    return overall_from_counts(outcome_counts(df, label, prediction), classes)


def low_support(df: DataFrame, label: str, prediction: str, classes: Sequence, threshold: int = LOW_SUPPORT) -> DataFrame:
    """Classes with some, but fewer than ``threshold``, rows."""
    metrics = per_class_metrics(df, label, prediction, classes)
    return metrics.where((F.col("support") > 0) & (F.col("support") < threshold)).select("label", "support")


def compare_models(results: dict[str, DataFrame]) -> DataFrame:
    """One row per model: (position, model, accuracy, macro_f1, weighted_f1)."""
    table = None
    for position, (name, overall) in enumerate(results.items()):
        row = overall.select(
            F.lit(position).alias("position"), F.lit(name).alias("model"), "accuracy", "macro_f1", "weighted_f1"
        )
        table = row if table is None else table.unionByName(row)
    return table


def best_model(comparison: DataFrame, metric: str = "macro_f1") -> str:
    """The model with the highest metric; the first one configured wins a tie."""
    if metric not in ("accuracy", "macro_f1", "weighted_f1"):
        raise ValueError(f"unknown selection metric '{metric}'")
    return comparison.orderBy(F.desc(F.round(F.col(metric), 4)), "position").first()["model"]
