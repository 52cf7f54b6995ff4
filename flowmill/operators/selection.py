"""Exact seeded selections by a hash order: stratified split, class samples, subsamples, shuffles.

Every row gets a seeded md5 of its key. "The first n rows of a class in hash order" is then a
single cut value per class, and selecting is a filter. The cut values come from counts per
hash prefix, which combine map-side, so a class holding most of the table never meets in one
task; only the one prefix around the cut is ranked.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from flowmill.functions.columns import choose, order_hash, q

RANKED_ROWS = 500_000
FIRST_DIGITS = 2
MAX_CLASSES = 10_000  # labels that a class-wise operation takes: each becomes a term of the plan
SALTS = (4096, 64)  # parts in which the first rows of a class are found before they meet
NOTHING, EVERYTHING = "", "~"  # sort before and after every hex digit


def hash_of(df: DataFrame, key: str | Sequence[str] | None, seed: int) -> Column:
    """The order hash: of the named key column(s), or of the whole row when there is none."""
    if isinstance(key, str):
        return order_hash(q(key), seed)
    return order_hash([q(c) for c in (key or df.columns)], seed)


def class_counts(df: DataFrame, target: str) -> dict:
    """Rows per class, on the driver: one entry per label. Rows without label are an error."""
    counted = df.groupBy(q(target).alias("label")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    counts = {r["label"]: r["n"] for r in counted}
    check_class_count(len(counts), target)
    check_labelled(counts, target)
    return dict(sorted(counts.items()))


def check_class_count(n: int, target: str, most: int | None = None) -> None:
    most = MAX_CLASSES if most is None else most
    if n > most:
        raise ValueError(f"'{target}' has more than {most} different values: too many for classes")


def check_labelled(counts: Mapping, target: str) -> None:
    if None in counts:
        raise ValueError(f"{counts[None]} rows have no label in '{target}'")


@dataclass(frozen=True)
class HashCounts:
    """Rows per class and leading hash digits: 16^digits numbers per class, from one pass."""

    rows: DataFrame  # (g, h)
    by_prefix: dict  # {class: {prefix: rows}}

    @property
    def totals(self) -> dict:
        return {g: sum(held.values()) for g, held in self.by_prefix.items()}


def hash_counts(df: DataFrame, group: Column, order: Column) -> HashCounts:
    rows = df.select(group.alias("g"), order.alias("h"))
    prefix = F.substring("h", 1, FIRST_DIGITS).alias("p")
    by_prefix: dict = {}
    groups = rows.select("g").distinct().limit(MAX_CLASSES + 1).count()
    check_class_count(groups, "the grouping column")
    for r in rows.groupBy("g", prefix).agg(F.count(F.lit(1)).alias("n")).collect():  # 256 per class
        by_prefix.setdefault(r["g"], {})[r["p"]] = r["n"]
    ordered = sorted(by_prefix, key=lambda g: (g is None, g if g is not None else ""))
    return HashCounts(rows, {g: dict(sorted(by_prefix[g].items())) for g in ordered})


def _step(held: Mapping[str, int], take: int) -> tuple[str, int, int]:
    """(prefix, rows still to take inside it, rows it holds) where the running count reaches ``take``."""
    for prefix in sorted(held):
        if take <= held[prefix]:
            return prefix, take, held[prefix]
        take -= held[prefix]
    raise AssertionError("a quota exceeds the rows counted")


def hash_cuts(counted: HashCounts, quotas: Mapping, ranked_rows: int = RANKED_ROWS) -> dict:
    """``{group: cut}`` such that ``order <= cut`` holds for exactly ``quotas[group]`` rows.

    The order values must be unique inside a group around the cut; equal ones are an error
    because no cut could then hit the quota.
    """
    totals, rows = counted.totals, counted.rows
    cuts = {g: (EVERYTHING if n >= totals[g] else NOTHING) for g, n in quotas.items()}
    edges = {g: _step(counted.by_prefix[g], n) for g, n in quotas.items() if 0 < n < totals[g]}
    if not edges:
        return cuts

    def near() -> DataFrame:
        """The rows that share the prefix around their class's cut, by lookup on the class."""
        prefix = choose(F.col("g"), {g: p for g, (p, _, _) in edges.items()})
        take = choose(F.col("g"), {g: take for g, (_, take, _) in edges.items()})
        return rows.select("g", "h", prefix.alias("p"), take.cast("bigint").alias("take")).where(
            F.startswith(F.col("h"), F.col("p"))
        )

    # a prefix still holding too many rows for one task is told apart by more digits
    while (largest := max(n for _, _, n in edges.values())) > ranked_rows:
        digits = math.ceil(math.log(largest / ranked_rows, 16))
        longer = F.expr(f"substring(h, 1, length(p) + {digits})").alias("p2")
        held: dict = {}
        for r in near().groupBy("g", longer).agg(F.count(F.lit(1)).alias("n")).collect():  # 16^digits per class
            held.setdefault(r["g"], {})[r["p2"]] = r["n"]
        finer = {g: _step(held[g], take) for g, (_, take, _) in edges.items()}
        if any(len(p) >= 32 and n > ranked_rows for p, _, n in finer.values()):
            raise ValueError("many rows share one key: no exact selection is possible")
        edges = finer

    ranked = near().select("g", "h", "take", F.row_number().over(W.partitionBy("g").orderBy("h")).alias("r"))
    picked = ranked.where(F.col("r").between(F.col("take"), F.col("take") + 1)).collect()  # two per class
    at = {(r["g"], r["r"] - r["take"]): r["h"] for r in picked}
    for g in edges:
        if at.get((g, 1)) == at[(g, 0)]:
            raise ValueError(f"the key is not unique in group {g!r}: no exact selection is possible")
        cuts[g] = at[(g, 0)]
    return cuts


def below_cut(group: Column, order: Column, cuts: Mapping) -> Column:
    """True for the selected rows, false for all others, those without a group too: a plain filter that reaches the scan."""
    terms = [
        group.eqNullSafe(F.lit(g)) if cut == EVERYTHING else group.eqNullSafe(F.lit(g)) & (order <= F.lit(cut))
        for g, cut in cuts.items()
        if cut != NOTHING
    ]
    while len(terms) > 1:  # in pairs, so that the expression stays flat
        terms = [reduce(or_, terms[i : i + 2]) for i in range(0, len(terms), 2)]
    return terms[0] if terms else F.lit(False)


@dataclass(frozen=True)
class Split:
    """A fitted stratified split: which hash cut sends a class's rows to the test side."""

    target: str
    order: Column
    counts: dict
    test_quota: dict
    cuts: dict

    def is_test(self) -> Column:
        return below_cut(q(self.target), self.order, self.cuts)

    def test(self, df: DataFrame) -> DataFrame:
        return df.where(self.is_test())

    def train(self, df: DataFrame) -> DataFrame:
        return df.where(~self.is_test())


def split_quota(counts: Mapping, test_size: float = 0.2) -> dict:
    """Test rows per class: ceil(test_size * n) in all, class shares kept by largest remainder."""
    total = sum(counts.values())
    small = [g for g, n in counts.items() if n < 2]
    if small:
        raise ValueError(f"classes with fewer than 2 rows cannot be split: {small}")
    n_test = math.ceil(test_size * total)
    if n_test < len(counts) or total - n_test < len(counts):
        raise ValueError(f"{total} rows are too few to give each of {len(counts)} classes a row on both sides")
    shares = {g: divmod(n * n_test, total) for g, n in counts.items()}
    quota = {g: whole for g, (whole, _) in shares.items()}
    by_remainder = sorted(sorted(counts), key=lambda g: -shares[g][1])
    for g in by_remainder[: n_test - sum(quota.values())]:
        quota[g] += 1
    return quota


def stratified_split(
    df: DataFrame,
    target: str = "Label",
    key: str | Sequence[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    hashed: str | None = None,
    ranked_rows: int = RANKED_ROWS,
) -> Split:
    """Fit an exact stratified split. ``key`` must be unique; the default is the whole row.

    ``hashed`` names a column that already holds a seeded order hash.
    """
    order = q(hashed) if hashed else hash_of(df, key, seed)
    counted = hash_counts(df, q(target), order)
    check_labelled(counted.totals, target)
    quota = split_quota(counted.totals, test_size)
    return Split(target, order, counted.totals, quota, hash_cuts(counted, quota, ranked_rows))


def per_class_sample(
    df: DataFrame,
    target: str = "Label",
    n: int = 1,
    key: str | Sequence[str] | None = None,
    seed: int = 42,
    only: Sequence | None = None,
    classes: Sequence | None = None,
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """Up to ``n`` random rows of each class, in class order. Unknown names in ``only`` are an error."""
    order = hash_of(df, key, seed)
    counted = hash_counts(df, q(target), order)
    totals = {c: m for c, m in counted.totals.items() if c is not None}
    known = list(classes) if classes is not None else list(totals)
    unknown = [c for c in (only or []) if c not in known]
    if unknown:
        raise ValueError(f"unknown class(es) {unknown}; choose from {known}")
    quotas = {c: min(n, totals[c]) for c in known if c in totals and (not only or c in only)}
    cuts = hash_cuts(counted, quotas, ranked_rows)
    return df.where(below_cut(q(target), order, cuts)).orderBy(q(target), order)


def first_per_class(df: DataFrame, target: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each class by an order column.

    They are found in many salted parts of a class, then in fewer, and then in the class, so that a task gets at most
    ``n`` rows from each of 64 parts, however large the class is.
    """

    def cut(rows: DataFrame, *within: Column) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*within).orderBy(q(order)))
        return rows.withColumn("rank_in_class", rank).where(F.col("rank_in_class") <= n).drop("rank_in_class")

    for salts in SALTS:
        df = cut(df, q(target), F.pmod(F.xxhash64(q(order)), F.lit(salts)))
    return cut(df, q(target))


def subsample(
    df: DataFrame,
    max_rows: int | None,
    key: str | Sequence[str] | None = None,
    seed: int = 42,
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """Exactly ``max_rows`` random rows; the table itself when it is not larger."""
    if max_rows is None:
        return df
    order = hash_of(df, key, seed)
    counted = hash_counts(df, F.lit(0), order)
    if counted.totals.get(0, 0) <= max_rows:
        return df
    return df.where(order <= F.lit(hash_cuts(counted, {0: max_rows}, ranked_rows)[0]))


def replay_order(
    df: DataFrame,
    count: int | None = 200,
    key: str | Sequence[str] | None = None,
    seed: int = 42,
    shuffle: bool = True,
) -> DataFrame:
    """Rows in a seeded random order (or by key), the first ``count`` of them."""
    if shuffle:
        return subsample(df, count, key, seed).orderBy(hash_of(df, key, seed))
    if key is None:
        raise ValueError("an unshuffled replay needs a key column to order by")
    columns = [q(key)] if isinstance(key, str) else [q(c) for c in key]
    ordered = df.orderBy(*columns)
    return ordered if count is None else ordered.limit(count)
