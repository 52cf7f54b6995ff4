"""From a raw flow table to train and test tables, and the state that turns later rows into model inputs.

The split comes before anything is learned: no number that a test row could move is part of the state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession

from flowmill.functions.columns import choose, order_hash, numeric_columns, q, small_table
from flowmill.operators import cleaning
from flowmill.operators.balance import balance
from flowmill.operators.correlation import column_moments, correlated_drop_list
from flowmill.operators.selection import Split, stratified_split
from flowmill.session import materialize

ROW_KEY = "row_key"
CODE = "label_code"


@dataclass(frozen=True)
class Feature:
    """What the train rows say about one feature."""

    name: str
    median: float | None
    mean: float
    scale: float


@dataclass(frozen=True)
class PrepState:
    """Fitted preparation state: enough to turn a raw row into a model input."""

    target: str
    classes: tuple[str, ...]
    features: tuple[Feature, ...]
    dropped_identifiers: tuple[str, ...] = ()
    dropped_correlated: tuple[str, ...] = ()
    balancing: str = "none"  # how the train rows were balanced; "class_weight" is left to the fit

    @property
    def feature_columns(self) -> list[str]:
        return [f.name for f in self.features]

    def code(self, label: Column) -> Column:
        """The label's code: classes in sorted order, from 0."""
        return choose(label, {name: i for i, name in enumerate(self.classes)}).cast("int")

    def imputed_columns(self, value=None) -> list[Column]:
        value = value or (lambda f: q(f.name))
        return [cleaning.imputed(value(f), f.median).alias(f.name) for f in self.features]

    def scaled_columns(self, value=None) -> list[Column]:
        """Model inputs in feature order: clean, fill with the median, scale."""
        value = value or (lambda f: q(f.name))
        return [
            cleaning.scaled(cleaning.imputed(value(f), f.median), f.mean, f.scale).alias(f.name) for f in self.features
        ]

    def unscaled_columns(self) -> list[Column]:
        """Scaled features turned back into raw units."""
        return [cleaning.unscaled(q(f.name), f.mean, f.scale).alias(f.name) for f in self.features]

    def apply(self, df: DataFrame, keep: Sequence[Column | str] = ()) -> DataFrame:
        """Scaled features of a raw table plus the columns to keep. No job is started."""
        kept = [q(c) if isinstance(c, str) else c for c in keep]
        return df.select(*kept, *self.scaled_columns())

    def apply_numbers(self, df: DataFrame, keep: Sequence[Column | str], value) -> DataFrame:
        """As ``apply``, reading each feature through ``value`` (raw rows may hold text)."""
        kept = [q(c) if isinstance(c, str) else c for c in keep]
        return df.select(*kept, *self.scaled_columns(value))

    def table(self, spark: SparkSession) -> DataFrame:
        """The features as a table (pos, name, median, mean, scale)."""
        rows = [(i, f.name, f.median, f.mean, f.scale) for i, f in enumerate(self.features)]
        return small_table(spark, rows, "pos int, name string, median double, mean double, scale double")


def fit_state(
    train: DataFrame,
    target: str,
    classes: Sequence[str],
    features: Sequence[str],
    correlation_threshold: float | None = 0.90,
    dropped_identifiers: Sequence[str] = (),
    **limits,
) -> PrepState:
    """Medians, correlated columns and scaler of the train rows.

    Three kinds of job over the same columns: quantiles, then mean and deviation, then pair
    sums (which reuse the means as their centre).
    """
    medians = cleaning.column_medians(train, features, **limits)
    filled = train.select(*[cleaning.imputed(q(c), medians[c]).alias(c) for c in features])
    moments = column_moments(filled, list(features))
    dropped: list[str] = []
    if correlation_threshold is not None:
        dropped = correlated_drop_list(filled, list(features), correlation_threshold, moments)
    kept = [
        Feature(c, medians[c], moments[c]["mean"], moments[c]["std"] or 1.0) for c in features if c not in set(dropped)
    ]
    return PrepState(target, tuple(classes), tuple(kept), tuple(dropped_identifiers), tuple(dropped))


@dataclass(frozen=True)
class Prepared:
    """Train and test tables (row_key, label, label_code, scaled features) and how they came about."""

    train: DataFrame
    test: DataFrame
    state: PrepState
    split: Split
    clean: DataFrame
    rows_loaded: int
    rows_after_dedup: int
    duplicates_removed: int
    removed_classes: Mapping[str, int] = field(default_factory=dict)
    balancing: str = "none"
    unbalanced_train: DataFrame | None = None


def prepare(
    df: DataFrame,
    target: str = "Label",
    dropped_classes: Sequence[str] | None = ("Heartbleed",),
    drop_identifiers: bool = True,
    correlation_threshold: float | None = 0.90,
    test_size: float = 0.2,
    seed: int = 42,
    balancing: str = "smote",
    k_neighbors: int = 5,
    key: str | None = None,
    dedup_after_id_drop: bool = False,
    materialized: bool = True,
    on_singleton: str = "error",
    neighbour_probes: int | None = None,
    **limits,
) -> Prepared:
    """The whole chain from raw rows to model inputs.

    The deduplicated rows are written once, because every fitted statistic reads them again, and so are oversampled
    train rows, because every job of every fit does.
    Oversampling uses exact neighbours unless ``neighbour_probes`` bounds the leaves a row visits (see ``neighbours``).
    ``key`` names a unique column that decides the random order; without it the whole row does.
    """
    # one grouped count gives the rows loaded and what class removal takes away
    labels = cleaning.label_counts(df, target)
    rows_loaded = sum(r["n"] for r in labels)
    kept, removed = cleaning.drop_classes(df, target, dropped_classes, labels)
    ids = [c for c in cleaning.identifier_columns(df.columns) if c != target] if drop_identifiers else []
    if dedup_after_id_drop:
        kept = kept.select(*[q(c) for c in kept.columns if c not in ids])
        key = None if key in ids else key
    unique = cleaning.deduplicate(kept)
    hashed = order_hash(q(key) if key else [q(c) for c in unique.columns], seed)
    unique = unique.select(hashed.alias(ROW_KEY), *[q(c) for c in unique.columns if c not in ids])
    if materialized:
        unique = materialize(unique, "clean")
    split = stratified_split(unique, target, test_size=test_size, hashed=ROW_KEY)  # the key is a seeded hash already
    rows_kept = sum(split.counts.values())
    features = [c for c in numeric_columns(unique, exclude=[target])]
    raw_train, raw_test = split.train(unique), split.test(unique)
    state = fit_state(raw_train, target, list(split.counts), features, correlation_threshold, ids, **limits)
    carried = [q(ROW_KEY), q(target), state.code(q(target)).alias(CODE)]
    train, test = state.apply(raw_train, carried), state.apply(raw_test, carried)
    state = replace(state, balancing=balancing)
    options = {"on_singleton": on_singleton, "probes": neighbour_probes} if balancing == "smote" else {}
    balanced = balance(train, target, balancing, state.feature_columns, ROW_KEY, k_neighbors, seed, **options)
    if materialized and balancing == "smote":
        balanced = materialize(balanced, "balanced")
    return Prepared(
        balanced,
        test,
        state,
        split,
        unique,
        rows_loaded,
        rows_kept,
        rows_loaded - sum(removed.values()) - rows_kept,
        removed,
        balancing,
        train,
    )


def preparation_summary(prepared: Prepared) -> DataFrame:
    """Row counts of every stage and the columns that were kept or dropped, as one row."""
    state, spark = prepared.state, prepared.train.sparkSession
    before = sum(prepared.split.counts.values()) - sum(prepared.split.test_quota.values())
    after = prepared.train.count() if prepared.balancing == "smote" else before
    row = (
        prepared.rows_loaded,
        dict(prepared.removed_classes),
        prepared.rows_after_dedup,
        prepared.duplicates_removed,
        list(state.dropped_identifiers),
        list(state.dropped_correlated),
        before,
        after,
        sum(prepared.split.test_quota.values()),
        len(state.features),
        len(state.features) + len(state.dropped_correlated),
        state.feature_columns,
        list(state.classes),
        prepared.balancing,
    )
    schema = (
        "rows_loaded bigint, dropped_classes map<string, bigint>, rows_after_dedup bigint, duplicates_removed bigint, "
        "dropped_identifier_columns array<string>, dropped_correlated_columns array<string>, "
        "train_rows_before_balancing bigint, train_rows_after_balancing bigint, test_rows bigint, "
        "final_feature_count bigint, total_feature_count bigint, final_feature_columns array<string>, "
        "label_classes array<string>, balancing_method string"
    )
    return spark.createDataFrame([row], schema)
