"""Table profiling: missing and infinite values, duplicates, class balance, spread, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from flowmill.functions.columns import (
    finite,
    is_floating,
    is_infinite,
    is_missing,
    numeric_columns,
    q,
    small_table,
)
from flowmill.operators.duplicates import duplicate_count
from flowmill.operators.quantiles import exact_quantiles


def table_shape(df: DataFrame) -> DataFrame:
    """Row count, column count and the number of columns per kind, as one row."""
    kinds = [f.dataType for f in df.schema.fields]
    numbers = sum(isinstance(k, T.NumericType) for k in kinds)
    strings = sum(isinstance(k, T.StringType) for k in kinds)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(kinds)).cast("bigint").alias("column_count"),
        F.lit(numbers).cast("bigint").alias("numeric_columns"),
        F.lit(strings).cast("bigint").alias("string_columns"),
        F.lit(len(kinds) - numbers - strings).cast("bigint").alias("other_columns"),
    )


def first_rows(df: DataFrame, n: int = 3, key: str | None = None) -> DataFrame:
    """A few rows to look at: the first by ``key``, without one any."""
    return (df.orderBy(q(key)) if key else df).limit(n)


def dtype_counts(df: DataFrame) -> dict[str, int]:
    counts: dict[str, int] = {}
    for _, kind in df.dtypes:
        counts[kind] = counts.get(kind, 0) + 1
    return counts


def cell_counts(df: DataFrame) -> DataFrame:
    """(column_name, rows, missing_count, infinite_count) for every column, in one scan."""
    bad = []
    for i, f in enumerate(df.schema.fields):
        bad.append(F.count_if(is_missing(df, f.name)).alias(f"m{i}"))
        bad.append((F.count_if(is_infinite(q(f.name))) if is_floating(f.dataType) else F.count_if(F.lit(False))).alias(f"i{i}"))
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *bad)
    long = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing_count"), F.col(f"i{i}").alias("infinite_count"))
        for i, c in enumerate(df.columns)
    ]
    return wide.select("rows", F.inline(F.array(*long)))


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with null or NaN cells: count and percentage (infinity is not missing)."""
    share = F.round(F.col("missing_count") / F.col("rows") * 100, 3)
    return (
        cell_counts(df)
        .where(F.col("missing_count") > 0)
        .select("column_name", "missing_count", share.alias("missing_pct"))
        .orderBy(F.desc("missing_count"), "column_name")
    )


def infinite_report(df: DataFrame) -> DataFrame:
    """Numeric columns holding +-infinity, and how many cells."""
    floats = [f.name for f in df.schema.fields if is_floating(f.dataType)]
    if not floats:
        return df.sparkSession.createDataFrame([], "column_name string, infinite_count bigint")
    held = cell_counts(df.select(*[q(c) for c in floats])).where(F.col("infinite_count") > 0)
    return held.select("column_name", "infinite_count").orderBy(F.desc("infinite_count"), "column_name")


def bad_cell_reports(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``missing_report`` and ``infinite_report`` from one scan."""
    spark = df.sparkSession
    counted = cell_counts(df).collect()  # one row per column
    held = small_table(
        spark, [tuple(r) for r in counted], "rows bigint, column_name string, missing_count bigint, infinite_count bigint"
    )
    share = F.round(F.col("missing_count") / F.col("rows") * 100, 3).alias("missing_pct")
    missing = held.where("missing_count > 0").select("column_name", "missing_count", share)
    infinite = held.where("infinite_count > 0").select("column_name", "infinite_count")
    return missing.orderBy(F.desc("missing_count"), "column_name"), infinite.orderBy(F.desc("infinite_count"), "column_name")


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows beyond the first of every group of identical rows; NaN equals NaN and null."""
    total = duplicate_count(df)
    share = F.col("duplicate_count") / F.nullif(F.col("rows"), F.lit(0)) * 100
    return total.select("duplicate_count", F.coalesce(F.round(share, 3), F.lit(0.0)).alias("duplicate_pct"))


def class_distribution(df: DataFrame, target: str = "Label") -> DataFrame:
    """Rows and share per label. Unlabelled rows are not listed but count in the total."""
    counts = df.groupBy(q(target).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    # the window runs over one row per label, not over the table
    total = F.sum("count").over(W.partitionBy(F.lit(0)))
    return (
        counts.select("label", "count", F.round(F.col("count") / total * 100, 3).alias("percentage"))
        .where(F.col("label").isNotNull())
        .orderBy(F.desc("count"), "label")
    )


def variance_ranking(df: DataFrame, target: str = "Label", top_n: int | None = 6) -> DataFrame:
    """Sample variance of every numeric column, largest first."""
    names = numeric_columns(df, exclude=[target])
    if not names:
        return df.sparkSession.createDataFrame([], "feature string, variance double")
    wide = df.agg(*[F.try_divide(F.var_samp(finite(q(c))), F.lit(1.0)).alias(f"v{i}") for i, c in enumerate(names)])
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance"), F.lit(i).alias("pos")) for i, c in enumerate(names)]
    ranked = (
        wide.select(F.inline(F.array(*pairs)))
        .where(F.col("variance").isNotNull() & ~F.isnan("variance"))
        .orderBy(F.desc("variance"), "pos")
        .select("feature", "variance")
    )
    return ranked if top_n is None else ranked.limit(top_n)


def clip_at_quantile(df: DataFrame, columns: list[str], p: float = 0.99) -> DataFrame:
    """Cap each column at its exact ``p`` quantile; infinities become null first."""
    caps = exact_quantiles(df, columns, [p])
    out = []
    for name in df.columns:
        if name not in columns:
            out.append(q(name))
            continue
        value, cap = finite(q(name)), caps[name][p]
        out.append((value if cap is None else F.when(value > F.lit(cap), F.lit(cap)).otherwise(value)).alias(name))
    return df.select(*out)


def feature_histogram(
    df: DataFrame, target: str = "Label", top_n: int = 6, bins: int = 50, features: list[str] | None = None
) -> DataFrame:
    """Equal-width counts of the most varied columns after capping them at the 99 % quantile.

    The last bin includes its upper edge. A column with a single value gets a range of
    one around it.
    """
    if features is None:
        features = [r["feature"] for r in variance_ranking(df, target, top_n).collect()]  # top_n names
    empty = "feature string, bin bigint, bin_start double, bin_end double, count bigint"
    if not features:
        return df.sparkSession.createDataFrame([], empty)
    clipped = clip_at_quantile(df.select(*[q(c) for c in features]), features)
    bounds = clipped.agg(
        *[F.min(q(c)).alias(f"lo{i}") for i, c in enumerate(features)],
        *[F.max(q(c)).alias(f"hi{i}") for i, c in enumerate(features)],
    ).first()
    edges = []
    for i, name in enumerate(features):
        lo, hi = bounds[f"lo{i}"], bounds[f"hi{i}"]
        if lo is not None:
            edges.append((i, name) + ((lo, hi) if hi > lo else (lo - 0.5, lo + 0.5)))
    cells = []
    for i, name, lo, hi in edges:
        bin_of = F.floor((q(name) - F.lit(lo)) / F.lit((hi - lo) / bins)).cast("bigint")
        # least() skips nulls, so an empty cell must be kept out of it
        bin_of = F.when(q(name).isNotNull(), F.least(bin_of, F.lit(bins - 1).cast("bigint")))
        cells.append(F.struct(F.lit(i).alias("pos"), bin_of.alias("bin")))
    if not edges:
        return df.sparkSession.createDataFrame([], empty)
    counts = (
        clipped.select(F.inline(F.array(*cells))).where(F.col("bin").isNotNull()).groupBy("pos", "bin").agg(F.count(F.lit(1)).alias("count"))
    )
    schema = "pos int, feature string, lo double, width double"
    table = small_table(df.sparkSession, [(i, n, lo, (hi - lo) / bins) for i, n, lo, hi in edges], schema)
    return counts.join(F.broadcast(table), "pos").select(
        "feature",
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        "count",
    )
