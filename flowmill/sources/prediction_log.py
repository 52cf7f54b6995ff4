"""The prediction log: an append-only parquet table with one folder per date and logged batch.

A batch writes a new version of itself each time it is repeated, in a folder of its own below the batch. Readers take the
newest version that is complete (Spark's ``_SUCCESS`` file), so every prediction counts once and a reader sees
one whole version of each batch at any time. The version before stays for those who have just chosen it. Order is
(logged_at, batch_id, seq). Dates are partitions, so readers of the newest rows leave older folders alone.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmill.functions.columns import q, small_table
from flowmill.sources import files

DEFAULT_RECENT, MAX_RECENT = 50, 500
SCHEMA = T.StructType(
    [
        T.StructField("logged_at", T.TimestampType()),
        T.StructField("seq", T.StringType()),
        T.StructField("predicted_class", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("is_attack", T.BooleanType()),
        T.StructField("features_json", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("log_date", T.DateType()),
        T.StructField("batch_id", T.StringType()),
    ]
)
TIMES = T.StructType(
    [
        T.StructField("seconds", T.DoubleType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.StringType()),
    ]
)


def row_json(df: DataFrame) -> Column:
    """A row as it came, all its columns as JSON, nulls included."""
    return F.to_json(F.struct(*[q(c).alias(c) for c in df.columns]), {"ignoreNullFields": "false"})


def log_rows(scored: DataFrame, seq: str, features: str = "features_json") -> DataFrame:
    """Scored rows in the shape of the log; one UTC second-resolution time per batch."""
    return scored.select(
        F.date_trunc("second", F.current_timestamp()).alias("logged_at"),
        q(seq).cast("string").alias("seq"),
        "predicted_class",
        F.col("confidence").cast("double").alias("confidence"),
        F.col("is_attack").cast("boolean").alias("is_attack"),
        q(features).alias("features_json"),
    )


def _versions(spark: SparkSession, batches: str) -> dict[str, list[tuple[str, str]]]:
    """Per batch its complete versions as (version, folder), oldest first; ``batches`` is a pattern of batch folders.

    A batch folder that holds files itself is the oldest version, with an empty name.
    """
    found: dict[str, list[tuple[str, str]]] = {}
    for below in ("", "/v*"):
        for folder in (done.rsplit("/", 1)[0] for done in files.glob(spark, f"{batches}{below}/_SUCCESS")):
            batch, version = folder.rsplit("/", 1) if below else (folder, "")
            found.setdefault(batch.rsplit("/batch_id=", 1)[1], []).append((version, folder))
    return {batch: sorted(versions) for batch, versions in found.items()}


def _current(spark: SparkSession, batches: str) -> list[str]:
    """What to read: the newest complete version of every batch."""
    newest = (versions[-1] for versions in _versions(spark, batches).values())
    return [folder if version else f"{folder}/*.parquet" for version, folder in newest]


def _store(rows: DataFrame, batches: str, folder: str, batch: str) -> None:
    """Write a further version of a batch, then remove all but the newest two that are complete."""
    spark = rows.sparkSession
    number = max((int(v[1:7]) for v in files.folders(spark, f"{batches}/v*")), default=0) + 1
    rows.write.parquet(f"{folder}/v{number:06d}-{uuid.uuid4().hex[:8]}")
    for version, old in _versions(spark, batches)[batch][:-2]:
        files.delete(spark, old if version else f"{old}/*.parquet")
        if not version:
            files.delete(spark, f"{old}/_SUCCESS")


def append(rows: DataFrame, path: str, batch: str | None = None, run: str | None = None) -> str:
    """Store one batch of a run; repeating a batch id replaces that batch, on whatever date. Returns the id."""
    spark, batch = rows.sparkSession, batch or f"batch-{uuid.uuid4().hex}"
    today = datetime.datetime.now(datetime.timezone.utc).date()
    rows = rows.withColumn("run", F.lit(run).cast("string"))
    _store(rows, f"{path}/log_date=*/batch_id={batch}", f"{path}/log_date={today}/batch_id={batch}", batch)
    return batch


def add_time(spark: SparkSession, path: str, batch: str, run: str, seconds: float) -> None:
    """How long a batch of a run took, kept beside the log; a repeated batch replaces its time."""
    row = small_table(spark, [(seconds, run)], "seconds double, run string")
    folder = f"{path}_times/batch_id={batch}"
    _store(row.coalesce(1), folder, folder, batch)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log as it is now; an absent log reads as empty and is not created."""
    return _read(spark, path, f"{path}/log_date=*/batch_id=*", SCHEMA)


def read_times(spark: SparkSession, path: str) -> DataFrame:
    """(seconds, run, batch_id) of the batches of a log."""
    return _read(spark, f"{path}_times", f"{path}_times/batch_id=*", TIMES)


def _read(spark: SparkSession, base: str, batches: str, schema: T.StructType) -> DataFrame:
    paths = _current(spark, batches)
    if not paths:
        return small_table(spark, [], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def recent(log: DataFrame, limit: int = DEFAULT_RECENT, max_limit: int | None = None) -> DataFrame:
    """The newest predictions first, without their features.

    At least one; ``max_limit`` (``MAX_RECENT`` for requests from outside) bounds what a caller may ask for.
    """
    limit = max(1, limit if max_limit is None else min(limit, max_limit))
    newest = log.orderBy(F.desc("logged_at"), F.desc("batch_id"), F.desc("seq")).limit(limit)
    return newest.select("logged_at", "batch_id", "seq", "predicted_class", "confidence", "is_attack")


def recent_of(
    spark: SparkSession, path: str, limit: int = DEFAULT_RECENT, max_limit: int | None = None
) -> DataFrame:
    """``recent`` for a stored log, reading no older dates than it needs."""
    log, held = read_log(spark, path), 0
    wanted = max(1, limit if max_limit is None else min(limit, max_limit))
    dates = [name.removeprefix("log_date=") for name in files.folders(spark, f"{path}/log_date=*")]
    for date in reversed(dates):
        oldest = F.lit(date).cast("date")
        held += log.where(F.col("log_date") == oldest).count()
        if held >= wanted:
            return recent(log.where(F.col("log_date") >= oldest), limit, max_limit)
    return recent(log, limit, max_limit)


def class_counts(log: DataFrame) -> DataFrame:
    """(predicted_class, n, attacks)."""
    return log.groupBy("predicted_class").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_attack").alias("attacks"))


def log_stats(log: DataFrame, benign: str = "BENIGN") -> DataFrame:
    """Total, count per class and attacks (everything that is not the benign class), as one row."""
    per_class = class_counts(log)
    attack = F.lower("predicted_class") != F.lit(benign.lower())
    zero = F.lit(0).cast("bigint")
    return per_class.agg(
        F.coalesce(F.sum("n"), zero).alias("total"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("predicted_class", "n")))).alias("per_class"),
        F.coalesce(F.sum(F.when(attack, F.col("n"))), zero).alias("attacks"),
        F.coalesce(F.sum("attacks"), zero).alias("flagged"),
    )
