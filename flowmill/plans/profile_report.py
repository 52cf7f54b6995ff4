"""The profile of a raw flow table as one row."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowmill.functions.columns import identifier_columns, numeric_columns
from flowmill.operators import profile
from flowmill.operators.correlation import correlated_pairs


def profile_summary(
    df: DataFrame, target: str = "Label", name: str = "flows", threshold: float = 0.90, top_n: int = 25
) -> DataFrame:
    """Counts, class sizes, affected columns, duplicates and correlated pairs.

    ``high_correlation_pair_count`` is capped by ``top_n`` as in the report list;
    ``all_correlated_pairs`` is the real number. Each part is a report of at most one row per column.
    """
    cells = profile.cell_counts(df).collect()  # one row per column
    missing = sorted((r for r in cells if r["missing_count"]), key=lambda r: (-r["missing_count"], r["column_name"]))
    infinite = sorted((r for r in cells if r["infinite_count"]), key=lambda r: (-r["infinite_count"], r["column_name"]))
    duplicates = profile.duplicate_report(df).first()
    classes = profile.class_distribution(df, target).collect()
    pairs = correlated_pairs(df, target, threshold, top_n=None).count() if len(numeric_columns(df)) > 1 else 0
    row = (
        name,
        cells[0]["rows"],
        len(df.columns),
        target,
        {str(r["label"]): r["count"] for r in classes},
        [r["column_name"] for r in missing],
        [r["column_name"] for r in infinite],
        duplicates["duplicate_count"],
        duplicates["duplicate_pct"],
        identifier_columns(df.columns),
        min(pairs, top_n),
        pairs,
    )
    schema = (
        "dataset_name string, row_count bigint, column_count bigint, target_column string, "
        "class_distribution map<string, bigint>, missing_value_columns array<string>, "
        "infinite_value_columns array<string>, duplicate_count bigint, duplicate_pct double, "
        "identifier_columns array<string>, high_correlation_pair_count bigint, all_correlated_pairs bigint"
    )
    return df.sparkSession.createDataFrame([row], schema)
