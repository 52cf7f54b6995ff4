"""Exact quantiles of many columns in two scans of the table.

Spark's own exact ``percentile`` keeps every distinct value of a column in one aggregation
buffer. Here the first scan folds every column into a mergeable sketch (``percentile_approx``, whose
rank error is at most 1 / accuracy), which brackets the value at a wanted rank whatever the
distribution. The second scan counts the values below each bracket and keeps, as (value, count), only those
within it: under one per cent of a column, and one row per value that is repeated. The
counts prove the bracket; a rank outside of it would be sought again between the bracket and the end of the
column. The value is then picked from that small table: while a bracket holds many different
values they are counted in bins, and the bin of the rank becomes the bracket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from flowmill.functions.columns import finite, q, small_table
from flowmill.session import materialize

GATHER_VALUES = 10_000
BINS = 4_096
#: A rank of the sketch is wrong by at most the count / ACCURACY.
ACCURACY = 1_000


@dataclass
class _Search:
    """The hunt for the value at one 0-based rank of one column, known to lie in [low, high]."""

    column: int
    rank: int
    low: float
    high: float
    least: float
    most: float
    bracket: int = -1  # number of the bracket in the table of the second scan
    below: int = 0  # values under low
    different: int = 0  # different values in [low, high]
    value: float | None = None


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    *,
    gather_values: int = GATHER_VALUES,
    bins: int = BINS,
    accuracy: int = ACCURACY,
) -> dict[str, dict[float, float | None]]:
    """``{column: {p: value}}`` with linear interpolation, over the finite values only.

    A column without finite values yields ``None``. ``accuracy`` trades the sketch's memory for narrower brackets.
    """
    if not columns:
        return {}
    values = df.select(*[finite(q(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    margin = 2.0 / accuracy
    ends = sorted({min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-margin, margin)})
    kinds = [("n", F.count), ("lo", F.min), ("hi", F.max), ("at", lambda c: F.percentile_approx(c, ends, accuracy))]
    facts = values.agg(*[of(F.col(c)).alias(kind + c) for c in values.columns for kind, of in kinds]).first()

    searches: dict[tuple[int, int], _Search] = {}
    for i in range(len(columns)):
        count, least, most = (facts[f"{kind}c{i}"] for kind in ("n", "lo", "hi"))
        for p in probabilities if count else ():
            low, high = (facts[f"atc{i}"][ends.index(min(max(p + side, 0.0), 1.0))] + 0.0 for side in (-margin, margin))
            low, high = least if p <= margin else low, most if p + margin >= 1 else high
            for rank in (math.floor(p * (count - 1)), math.ceil(p * (count - 1))):
                searches[i, rank] = _Search(i, rank, low + 0.0, high + 0.0, least + 0.0, most + 0.0)
    while missing := [s for s in searches.values() if s.value is None]:
        for s in missing:
            s.value = s.least if s.least == s.most else None
        _bracket(values, [s for s in missing if s.value is None], gather_values, bins)

    result: dict[str, dict[float, float | None]] = {}
    for i, c in enumerate(columns):
        result[c] = {}
        for p in probabilities:
            if not facts[f"nc{i}"]:
                result[c][p] = None
                continue
            spot = p * (facts[f"nc{i}"] - 1)
            lower, upper = math.floor(spot), math.ceil(spot)
            a, b = searches[i, lower].value, searches[i, upper].value
            result[c][p] = a if lower == upper else (upper - spot) * a + (spot - lower) * b
    return result


def _shared(searches: list[_Search]) -> dict[tuple, list[_Search]]:
    """Searches that share a bracket are served together."""
    shared: dict[tuple, list[_Search]] = {}
    for s in searches:
        shared.setdefault((s.column, s.bracket, s.low, s.high), []).append(s)
    return shared


def _bracket(values: DataFrame, searches: list[_Search], gather_values: int, bins: int) -> None:
    """One scan for all brackets, then the wanted values from what they hold."""
    if not searches:
        return
    shared = _shared(searches)
    keys = [(column, low, high) for column, _, low, high in shared]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = np.zeros(len(keys), np.int64)
        for batch in batches:
            held, found = {}, []
            for b, (column, low, high) in enumerate(keys):
                if column not in held:
                    held[column] = batch.column(column).drop_null().to_numpy() + 0.0
                x = held[column]
                below[b] += np.count_nonzero(x < low)
                inside = x[(x >= low) & (x <= high)]  # only these few are put in order
                if len(inside):
                    different, times = np.unique(inside, return_counts=True)
                    found.append((np.full(len(different), b), different, times))
            if found:
                yield _counted(*(np.concatenate(part) for part in zip(*found, strict=True)))
        yield _counted(np.arange(len(keys)), np.full(len(keys), -np.inf), below)

    counted = values.mapInArrow(count, "b int, x double, n long").groupBy("b", "x").agg(F.sum("n").alias("n"))
    table = materialize(counted, "brackets")
    under = F.col("x") == float("-inf")  # marks the count below: only finite values are searched
    sums = {
        r["b"]: r
        for r in table.groupBy("b")
        .agg(
            F.sum(F.when(under, F.col("n"))).alias("below"),
            F.coalesce(F.sum(F.when(~under, F.col("n"))), F.lit(0)).alias("inside"),
            F.count_if(~under).alias("different"),
        )
        .collect()
    }  # one row per bracket
    held = []
    for b, members in enumerate(shared.values()):
        for s in members:
            below = sums[b]["below"]
            if s.rank < below:
                s.low, s.high = s.least, s.low
            elif s.rank >= below + sums[b]["inside"]:
                s.low, s.high = s.high, s.most
            else:
                s.bracket, s.below, s.different = b, below, sums[b]["different"]
                held.append(s)
    while left := [s for s in held if s.value is None]:
        _narrow(table, left, gather_values, bins)


def _counted(b: np.ndarray, x: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(x), pa.array(n, pa.int64())], ["b", "x", "n"])


def _narrow(table: DataFrame, searches: list[_Search], gather_values: int, bins: int) -> None:
    """One round over the bracketed values: each search keeps the bin that holds its rank.

    A bracket of at most ``gather_values`` different values has a bin for each, so its searches end.
    """
    shared, spark = _shared(searches), table.sparkSession
    asked = []
    for g, ((_, b, low, high), members) in enumerate(shared.items()):
        # halves keep the width finite for any two doubles
        step = (high / 2 - low / 2) / bins if members[0].different > gather_values else None
        asked.append((g, b, low, high, step))
    brackets = small_table(spark, asked, "g int, b int, low double, high double, step double")
    x, half = F.col("x"), F.col("x") / 2 - F.col("low") / 2
    spot = F.when(F.col("step") > 0, F.least(F.floor(F.try_divide(half, F.col("step"))), F.lit(bins - 1)).cast("double"))
    spot = F.coalesce(F.when(F.col("step") == 0, (x > F.col("low")).cast("double")), spot, x)
    counted = (
        table.join(F.broadcast(brackets), "b")
        .where(x.between(F.col("low"), F.col("high")))
        .groupBy("g", spot.alias("bin"))
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("different"), F.min("x").alias("low"), F.max("x").alias("high"))
    )
    # from here on at most ``bins`` or ``gather_values`` rows per bracket
    upto = F.sum("n").over(W.partitionBy("g").orderBy("bin"))
    wanted = [(g, j, s.rank - s.below) for g, members in enumerate(shared.values()) for j, s in enumerate(members)]
    ranks = F.broadcast(small_table(spark, wanted, "g int, j int, want bigint"))
    hits = (
        counted.withColumn("upto", upto)
        .join(ranks, "g")
        .where((F.col("want") < F.col("upto")) & (F.col("want") >= F.col("upto") - F.col("n")))
        .collect()
    )  # one row per search
    groups = list(shared.values())
    for r in hits:
        s = groups[r["g"]][r["j"]]
        s.below += r["upto"] - r["n"]
        s.low, s.high, s.different = r["low"], r["high"], r["different"]
        s.value = s.low if s.low == s.high else None
