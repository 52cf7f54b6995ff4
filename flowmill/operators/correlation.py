"""Pearson correlation of all column pairs in two scans.

Every partition folds its rows into one small matrix of sums per statistic, so the shuffle
carries one row per pair and partition whatever the table size. Cells that are null, NaN or
infinite leave only the pairs they belong to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import finite, numeric_columns, q, small_table

_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
_BOUNDS = ("min_x", "max_x", "min_y", "max_y")
_PARTIAL = "i int, j int, " + ", ".join(f"{s} double" for s in _SUMS + _BOUNDS)


def column_moments(df: DataFrame, columns: list[str]) -> dict[str, dict[str, float | None]]:
    """Count, mean and population deviation of the finite values, all columns in one scan."""
    if not columns:
        return {}
    aggs = []
    for i, c in enumerate(columns):
        value = finite(q(c))
        aggs += [F.count(value).alias(f"n{i}"), F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {c: {"count": row[f"n{i}"], "mean": row[f"m{i}"], "std": row[f"s{i}"]} for i, c in enumerate(columns)}


def pair_correlations(
    df: DataFrame, columns: list[str], moments: dict[str, dict[str, float | None]] | None = None
) -> DataFrame:
    """(pos_1, pos_2, feature_1, feature_2, correlation) for every pair in column order.

    The value is |r|, null when a column does not vary on the rows both have.
    """
    moments = moments or column_moments(df, columns)
    used = [c for c in columns if moments[c]["count"]]
    schema = "pos_1 int, pos_2 int, feature_1 string, feature_2 string, correlation double"
    if len(used) < 2:
        return df.sparkSession.createDataFrame([], schema)
    # centred and scaled sums keep their digits
    centre = np.array([moments[c]["mean"] for c in used])
    scale = np.array([moments[c]["std"] or 1.0 for c in used])
    scale[~np.isfinite(scale) | (scale == 0)] = 1.0
    size = len(used)

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {name: np.zeros((size, size)) for name in ("n", "s", "ss", "sxy")}
        low, high = np.full((size, size), np.inf), np.full((size, size), -np.inf)
        seen = False
        for frame in frames:
            if not len(frame):
                continue
            seen = True
            raw = frame.to_numpy(dtype=float)
            have = np.isfinite(raw)
            z = np.where(have, (raw - centre) / scale, 0.0)
            mask = have.astype(float)
            # element [i, j]: statistics of column i over the rows where column j is present
            sums["n"] += mask.T @ mask
            sums["s"] += z.T @ mask
            sums["ss"] += (z * z).T @ mask
            sums["sxy"] += z.T @ z
            lows, highs = np.where(have, raw, np.inf), np.where(have, raw, -np.inf)
            full = have.all(axis=0)
            low[:, full] = np.minimum(low[:, full], lows.min(axis=0)[:, None])
            high[:, full] = np.maximum(high[:, full], highs.max(axis=0)[:, None])
            for j in np.flatnonzero(~full & have.any(axis=0)):
                low[:, j] = np.minimum(low[:, j], lows[have[:, j]].min(axis=0))
                high[:, j] = np.maximum(high[:, j], highs[have[:, j]].max(axis=0))
        if seen:
            i, j = np.triu_indices(size, k=1)
            yield pd.DataFrame(
                {
                    "i": i.astype("int32"), "j": j.astype("int32"),
                    "n": sums["n"][i, j], "sx": sums["s"][i, j], "sy": sums["s"][j, i],
                    "sxx": sums["ss"][i, j], "syy": sums["ss"][j, i], "sxy": sums["sxy"][i, j],
                    "min_x": low[i, j], "max_x": high[i, j], "min_y": low[j, i], "max_y": high[j, i],
                }
            )

    partial = df.select(*[q(c).cast("double").alias(f"f{i}") for i, c in enumerate(used)]).mapInPandas(fold, _PARTIAL)
    total = partial.groupBy("i", "j").agg(
        *[F.sum(s).alias(s) for s in _SUMS],
        *[(F.min(b) if b.startswith("min") else F.max(b)).alias(b) for b in _BOUNDS],
    )
    n = F.col("n")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / n
    var_x = F.col("sxx") - F.col("sx") * F.col("sx") / n
    var_y = F.col("syy") - F.col("sy") * F.col("sy") / n
    varies = (
        (n > 1) & (F.col("min_x") < F.col("max_x")) & (F.col("min_y") < F.col("max_y")) & (var_x > 0) & (var_y > 0)
    )
    r = F.when(varies, F.least(F.abs(cov / (F.sqrt(var_x) * F.sqrt(var_y))), F.lit(1.0)))
    places = {c: i for i, c in enumerate(columns)}
    names = small_table(df.sparkSession, [(i, places[c], c) for i, c in enumerate(used)], "k int, pos int, feature string")
    first = names.select(F.col("k").alias("i"), F.col("pos").alias("pos_1"), F.col("feature").alias("feature_1"))
    second = names.select(F.col("k").alias("j"), F.col("pos").alias("pos_2"), F.col("feature").alias("feature_2"))
    # one row per column on the right side: bounded by the table's width
    return (
        total.select("i", "j", r.alias("correlation"))
        .join(F.broadcast(first), "i")
        .join(F.broadcast(second), "j")
        .select("pos_1", "pos_2", "feature_1", "feature_2", "correlation")
    )


def correlated_pairs(
    df: DataFrame, target: str = "Label", threshold: float = 0.90, top_n: int | None = 25
) -> DataFrame:
    """The strongest numeric pairs at or above ``threshold``; ``top_n=None`` lists all."""
    pairs = pair_correlations(df, numeric_columns(df, exclude=[target]))
    kept = pairs.where(F.col("correlation") >= threshold).orderBy(F.desc("correlation"), "pos_1", "pos_2")
    kept = kept if top_n is None else kept.limit(top_n)
    return kept.select("feature_1", "feature_2", "correlation")


def correlated_drop_list(
    df: DataFrame,
    columns: list[str],
    threshold: float = 0.90,
    moments: dict[str, dict[str, float | None]] | None = None,
) -> list[str]:
    """Sorted names of the columns that correlate with any later column (at most one per column)."""
    pairs = pair_correlations(df, columns, moments)
    return sorted(r["feature_1"] for r in pairs.where(F.col("correlation") >= threshold).select("feature_1").distinct().collect())
