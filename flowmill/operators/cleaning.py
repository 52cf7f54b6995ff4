"""Row and column clean-up: class removal, deduplication, identifier columns, imputation, scaling."""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import BLANKS, finite, fold, identifier_columns, numeric_columns, q, strip
from flowmill.operators.duplicates import deduplicate as deduplicate
from flowmill.operators.quantiles import exact_quantiles
from flowmill.operators.selection import MAX_CLASSES, check_class_count


def _label_text(target: str) -> Column:
    """The label as text; a missing label reads 'nan', as in text-converted tables."""
    return F.coalesce(q(target).cast("string"), F.lit("nan"))


def _folded_names(names: Iterable | None) -> dict[str, str]:
    """Class names as ``fold`` writes them, each with the first given spelling."""
    found: dict[str, str] = {}
    for name in names or ():
        found.setdefault(str(name).strip(BLANKS).lower(), str(name))
    return found


def keep_classes(df: DataFrame, target: str, dropped: Iterable | None) -> DataFrame:
    """The filter of ``drop_classes`` alone: lazy and narrow."""
    listed = _folded_names(dropped)
    return df.where(~fold(_label_text(target)).isin(*listed)) if listed else df


def removed_class_counts(df: DataFrame, target: str, dropped: Iterable | None) -> DataFrame:
    """(label, removed): how many rows per listed class, ignoring case and blanks."""
    return (
        df.where(fold(_label_text(target)).isin(*_folded_names(dropped)))
        .groupBy(strip(_label_text(target)).alias("label"))
        .agg(F.count(F.lit(1)).alias("removed"))
    )


def label_counts(df: DataFrame, target: str, most: int = MAX_CLASSES) -> list:
    """(label, folded, raw, n) per label on the driver; one grouped pass over the label column.

    More than ``most`` labels are an error: such a column holds no classes.
    """
    counted = df.groupBy(
        strip(_label_text(target)).alias("label"), fold(_label_text(target)).alias("folded"), q(target).alias("raw")
    ).agg(F.count(F.lit(1)).alias("n"))
    rows = counted.limit(most + 1).collect()
    check_class_count(len(rows), target, most)
    return rows


def drop_classes(
    df: DataFrame, target: str, classes: Sequence | None, counts: list | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Rows of other classes than the listed ones, and how many rows of which label went.

    One count of the labels settles everything before a row is touched. Listed names without rows are told in one
    warning; to learn from, two labels must stay. ``counts`` takes ``label_counts`` when they are known already.
    """
    listed = _folded_names(classes)
    if not listed:
        return df, {}
    counts = label_counts(df, target) if counts is None else counts
    absent = listed.keys() - {r["folded"] for r in counts}
    if absent:
        warnings.warn(f"no rows of class {', '.join(sorted(listed[c] for c in absent))}", stacklevel=2)
    gone = Counter()
    for r in counts:
        gone[r["label"]] += r["n"] * (r["folded"] in listed)
    stay = {r["raw"] for r in counts if r["folded"] not in listed} - {None}
    if len(stay) < 2:
        raise ValueError(f"labels left without {', '.join(listed.values())}: {sorted(map(str, stay))}; two are needed")
    return keep_classes(df, target, classes), {label: n for label, n in gone.items() if n}


def drop_identifier_columns(df: DataFrame, target: str) -> tuple[DataFrame, list[str]]:
    """Drop the columns whose name marks an identifier, never the target."""
    flagged = [c for c in identifier_columns(df.columns) if c != target]
    return df.select(*[q(c) for c in df.columns if c not in flagged]), flagged


def column_medians(df: DataFrame, columns: Sequence[str] | None = None, **limits) -> dict[str, float | None]:
    """Exact medians of the finite values (None for a column without any)."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    return {c: found[0.5] for c, found in exact_quantiles(df, columns, [0.5], **limits).items()}


def imputed(c: Column, median: float | None) -> Column:
    """Infinite and missing cells replaced by the median, or by 0 when there is none."""
    return F.coalesce(finite(c), F.lit(0.0 if median is None else float(median)))


def impute(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    """Median imputation of all numeric columns; a column without a median falls back to 0."""
    numbers = set(numeric_columns(df))
    without = [c for c in df.columns if c in numbers and medians.get(c) is None]
    if without:
        warnings.warn(f"no median for {without}: missing cells become 0", stacklevel=2)
    return df.select(*[imputed(q(c), medians.get(c)).alias(c) if c in numbers else q(c) for c in df.columns])


def scaled(c: Column, mean: float, scale: float) -> Column:
    return (c - F.lit(float(mean))) / F.lit(float(scale))


def unscaled(c: Column, mean: float, scale: float) -> Column:
    return c * F.lit(float(scale)) + F.lit(float(mean))
