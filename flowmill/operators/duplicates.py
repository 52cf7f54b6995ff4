"""Duplicate rows in two phases: 64-bit row hashes are counted first, whole rows are only moved for repeated hashes.

The first phase shuffles two numbers per distinct row, however wide the table. Rows whose hash is their own cannot have
a twin, so they stay where they are; the others are compared in full. NaN and null count as the same missing value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import q, without_nan
from flowmill.session import materialize

#: Repeated hashes (8 bytes each) that may be broadcast. With more of them whole rows are grouped at once.
BROADCAST_HASHES = 4_000_000
HASH = "__row_hash"


@dataclass(frozen=True)
class Repeats:
    """``rows`` with missing values made equal, the hashes that several of them have, and how many hashes those are."""

    rows: DataFrame
    hashes: DataFrame
    n: int

    @property
    def few(self) -> bool:
        return self.n <= BROADCAST_HASHES

    def suspects(self) -> DataFrame:
        """Rows that can have a twin."""
        return _with_hash(self.rows).join(F.broadcast(self.hashes), HASH, "left_semi").drop(HASH)

    def single(self) -> DataFrame:
        """Rows that cannot."""
        return _with_hash(self.rows).join(F.broadcast(self.hashes), HASH, "left_anti").drop(HASH)


def _with_hash(rows: DataFrame) -> DataFrame:
    """The row's hash as a further column; which cells are null goes into it, because a hash of values skips them."""
    nulls = F.concat(*[F.when(q(c).isNull(), "1").otherwise("0") for c in rows.columns])
    return rows.withColumn(HASH, F.xxhash64(*[q(c) for c in rows.columns], nulls))


def repeats(df: DataFrame) -> Repeats:
    rows = without_nan(df)
    counted = _with_hash(rows).groupBy(HASH).agg(F.count(F.lit(1)).alias("n"))
    hashes = materialize(counted.where("n > 1").select(HASH), "repeated")
    return Repeats(rows, hashes, hashes.count())


def deduplicate(df: DataFrame) -> DataFrame:
    """One row of every group of identical rows."""
    found = repeats(df)
    if not found.n:
        return found.rows
    if not found.few:
        return found.rows.dropDuplicates()
    return found.single().unionByName(found.suspects().dropDuplicates())


def duplicate_count(df: DataFrame) -> DataFrame:
    """(duplicate_count, rows) as one row: rows beyond the first of every group of identical rows, and all rows."""
    found = repeats(df)
    compared = found.suspects() if found.few else found.rows
    groups = compared.groupBy(*[q(c) for c in compared.columns]).agg(F.count(F.lit(1)).alias("n"))
    extra = groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_count"))
    return extra.withColumn("rows", F.lit(df.count()).cast("bigint"))
