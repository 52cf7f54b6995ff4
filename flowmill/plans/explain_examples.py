"""Explanations of example rows of every class, with the class they really have."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from flowmill.functions.columns import q
from flowmill.operators.explain import DEFAULT_TOP_K, explain
from flowmill.operators.models import Bundle
from flowmill.operators.selection import per_class_sample
from flowmill.plans.prepare import ROW_KEY, PrepState

TRUE_CLASS = "true_class"


def explained_examples(
    test: DataFrame,
    bundle: Bundle,
    state: PrepState,
    per_class: int = 1,
    top_k: int = DEFAULT_TOP_K,
    only: Sequence[str] | None = None,
    seed: int = 42,
    benign: str = "BENIGN",
) -> DataFrame:
    """Up to ``per_class`` rows of each class of a prepared test table: what the model says, why, and the true class.

    The scaled features are turned back first, so that the values shown are those of the raw table. ``only`` names some
    of the classes. ``files.write_json`` stores the result.
    """
    shown = per_class_sample(test, state.target, per_class, ROW_KEY, seed, only, state.classes)
    raw = shown.select(q(ROW_KEY), q(state.target).alias(TRUE_CLASS), *state.unscaled_columns())
    return explain(raw, bundle, state, [ROW_KEY, TRUE_CLASS], top_k, benign).orderBy(TRUE_CLASS, ROW_KEY)
