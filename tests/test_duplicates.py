"""Duplicates in two phases: the same rows as grouping whole rows, and far fewer shuffled bytes."""

import pytest
from pyspark.sql import functions as F

from flowmill.functions.columns import without_nan
from flowmill.operators import duplicates, profile

ROWS = [
    (1, 0.0, "a"), (1, -0.0, "a"), (1, float("nan"), "a"), (1, None, "a"), (2, 1.0, None), (2, 1.0, None), (2, 1.0, None),
    (None, 2.0, "x"), (2, None, "x"), (None, None, None), (3, 3.0, "once"),
]


@pytest.mark.parametrize("broadcast", [4_000_000, 1, 0])
def test_same_as_whole_rows(spark, monkeypatch, broadcast):
    monkeypatch.setattr(duplicates, "BROADCAST_HASHES", broadcast)
    df = spark.createDataFrame(ROWS, "a int, `b.c` double, s string").repartition(4)
    want = sorted(map(str, without_nan(df).dropDuplicates().collect()))
    assert sorted(str(r).replace("-0.0", "0.0") for r in duplicates.deduplicate(df).collect()) == [w.replace("-0.0", "0.0") for w in want]
    assert tuple(profile.duplicate_report(df).first()) == (4, round(4 / 11 * 100, 3))
    assert duplicates.deduplicate(df.limit(0)).count() == 0


def test_equal_hashes_are_compared_in_full(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "_with_hash", lambda rows: rows.withColumn(duplicates.HASH, F.lit(7).cast("long")))
    df = spark.createDataFrame(ROWS, "a int, b double, s string")
    assert duplicates.deduplicate(df).count() == 7
    assert profile.duplicate_report(df).first()["duplicate_count"] == 4


def written(spark):
    """Shuffled bytes of the session so far."""
    return spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()


def test_a_quarter_of_the_shuffled_bytes_at_79_columns(spark, tmp_path):
    wide = spark.range(20_000).select("id", *[(F.xxhash64("id", F.lit(i)) / 1e6).alias(f"c{i}") for i in range(78)])
    wide.unionByName(wide.where("id < 200")).write.parquet(str(tmp_path / "wide"))
    df = spark.read.parquet(str(tmp_path / "wide"))
    start = written(spark)
    assert df.dropDuplicates().count() == 20_000
    middle = written(spark)
    assert duplicates.deduplicate(df).count() == 20_000
    end = written(spark)
    assert 0 < end - middle < (middle - start) / 4
