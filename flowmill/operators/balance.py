"""Class balancing: synthetic oversampling and balanced class weights."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import choose, order_hash, q
from flowmill.operators.neighbours import nearest_in_class
from flowmill.operators.selection import below_cut, check_labelled, class_counts, hash_counts, hash_cuts

METHODS = ("smote", "class_weight", "none")
COPIES_PER_ROW = 10_000


def class_weights(df: DataFrame, target: str = "Label") -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(q(target).alias("label")).agg(F.count(F.lit(1)).alias("n")).where(F.col("label").isNotNull())
    total = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    weight = F.lit(float(total["rows"] or 0)) / (F.lit(float(total["classes"] or 1)) * F.col("n"))
    return counts.select("label", "n", weight.alias("weight"))


def with_class_weight(df: DataFrame, target: str, out: str = "class_weight") -> DataFrame:
    """Balanced weight per row as a narrow expression over one entry per class."""
    counts = class_counts(df, target)
    total = sum(counts.values())
    return df.withColumn(out, choose(q(target), {c: total / (len(counts) * n) for c, n in counts.items()}))


def synthetic_rows(
    train: DataFrame,
    target: str,
    features: Sequence[str],
    key: str,
    k_neighbors: int = 5,
    seed: int = 42,
    **limits,
) -> DataFrame:
    """The rows that bring every class up to the largest one.

    (base_key, target, copy, base, neighbour, u, vector): ``vector`` lies on the line from a train
    row to one of its k nearest rows of the same class, at the random share ``u``. A class of n
    rows that lacks m gives every row m // n copies, and one more to the first m % n rows in a
    seeded hash order.
    """
    order = order_hash(q(key), seed + 1)
    counted = hash_counts(train, q(target), order)
    check_labelled(counted.totals, target)
    counts = counted.totals
    top = max(counts.values())
    smallest = min(counts, key=counts.get)
    if counts[smallest] < 2:
        raise ValueError(f"class {smallest!r} has a single row: no neighbour to interpolate with")
    k = min(k_neighbors, counts[smallest] - 1)
    if k != k_neighbors:
        warnings.warn(f"neighbours reduced from {k_neighbors} to {k}: class {smallest!r} is small", stacklevel=2)
    minority = {c: n for c, n in counts.items() if n < top}
    each = {c: (top - n) // n for c, n in minority.items()}
    cuts = hash_cuts(counted, {c: (top - n) % n for c, n in minority.items()})
    base = train.where(q(target).isin(list(minority))).select(
        q(key).cast("string").alias("base_key"), q(target), F.array(*[q(c).cast("double") for c in features]).alias("base")
    )
    extra = below_cut(q(target), order_hash(q("base_key"), seed + 1), cuts)
    copies = choose(q(target), each, F.lit(0)).cast("bigint") + extra.cast("bigint")
    copied = None
    # rows of a tiny class may owe billions of copies: theirs are handed out in portions, all others copied in place
    tiny = [c for c in minority if each[c] >= COPIES_PER_ROW]
    for portioned, names in ((False, [c for c in minority if c not in tiny]), (True, tiny)):
        if not names:
            continue
        part = base.where(q(target).isin(names))
        near = nearest_in_class(
            part, target, "base_key", "base", len(features), k, {c: minority[c] for c in names}, asks=copies > 0, seed=seed, **limits
        ).withColumn("copies", copies)
        if portioned:
            portions = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPIES_PER_ROW))
            near = near.withColumn("portion", F.explode(portions)).repartition("base_key", "portion")
        else:
            near = near.withColumn("portion", F.lit(0).cast("bigint"))
        start = F.col("portion") * COPIES_PER_ROW
        end = F.least(start + COPIES_PER_ROW, F.col("copies")) - 1
        more = near.withColumn("copy", F.explode(F.sequence(start, end)))
        copied = more if copied is None else copied.unionByName(more)
    if copied is None:  # all classes are of one size
        copied = base.limit(0).select(
            "*", F.array().cast("array<string>").alias("keys"), F.col("base").alias("vectors"), F.lit(0).cast("bigint").alias("copy")
        )
    slot = F.pmod(F.xxhash64("base_key", "copy", F.lit(seed)), F.size("keys")).cast("int")
    share = F.pmod(F.xxhash64("base_key", "copy", F.lit(seed + 7)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    width = len(features)
    picked = copied.select("base_key", q(target), "copy", "base", "vectors", (slot * width).alias("at"), share.alias("u"))
    # plain arithmetic per position stays in generated code, unlike a lambda over arrays
    vector = [
        F.col("base")[i] + F.col("u") * (F.col("vectors")[F.col("at") + i] - F.col("base")[i]) for i in range(width)
    ]
    neighbour = F.slice("vectors", F.col("at") + 1, F.lit(width))
    return picked.select(
        "base_key", q(target), "copy", "base", neighbour.alias("neighbour"), "u", F.array(*vector).alias("vector")
    )


def class_constants(df: DataFrame, target: str, columns: Sequence[str]) -> dict[str, dict]:
    """For each column the classes in which all rows have the same value, with that value (the label code is one)."""
    if not columns:
        return {}
    facts = [
        F.when(
            (F.count(q(c)) == F.count(F.lit(1))) & (F.min(q(c)) == F.max(q(c))),
            F.min(q(c)),
        ).alias(f"c{i}")
        for i, c in enumerate(columns)
    ]
    rows = df.groupBy(q(target).alias("label")).agg(*facts).collect()  # one row per class
    return {c: {r["label"]: r[f"c{i}"] for r in rows if r[f"c{i}"] is not None} for i, c in enumerate(columns)}


def oversample(
    train: DataFrame,
    target: str,
    features: Sequence[str],
    key: str,
    k_neighbors: int = 5,
    seed: int = 42,
    on_singleton: str = "error",
    **limits,
) -> DataFrame:
    """Train rows plus synthetic rows; every class ends at the size of the largest.

    A column that is no feature has a value in synthetic rows only where all rows of the class agree on it.
    """
    if on_singleton == "skip" and min(class_counts(train, target).values()) < 2:
        warnings.warn("a class has a single row: balancing skipped", stacklevel=2)
        return train
    made = synthetic_rows(train, target, features, key, k_neighbors, seed, **limits)
    place = {c: i for i, c in enumerate(features)}
    carried = [c for c in train.columns if c not in place and c not in (key, target)]
    codes = class_constants(train, target, carried)
    columns = []
    for c in train.columns:
        kind = train.schema[c].dataType
        if c == key:
            value = F.md5(F.concat_ws("|", F.col("base_key"), F.lit("copy"), F.col("copy").cast("string")))
        elif c == target:
            value = q(target)
        elif c in place:
            value = F.col("vector")[place[c]]
        else:
            value = choose(q(target), codes[c])  # null where rows of a class differ
        columns.append(value.cast(kind).alias(c))
    return train.unionByName(made.select(*columns))


def balance(
    train: DataFrame,
    target: str,
    method: str,
    features: Sequence[str],
    key: str,
    k_neighbors: int = 5,
    seed: int = 42,
    **options,
) -> DataFrame:
    """Dispatch on the balancing method; class weights are applied when a model is fitted."""
    if method not in METHODS:
        raise ValueError(f"unknown balancing method '{method}'; choose from {METHODS}")
    if method == "smote":
        return oversample(train, target, features, key, k_neighbors, seed, **options)
    return train
