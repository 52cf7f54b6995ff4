"""Replaying stored flows as a stream, scoring it, logging it and counting it."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from flowmill.functions.columns import q, small_table
from flowmill.operators.models import Bundle
from flowmill.operators.scoring import score, session_summary
from flowmill.operators.selection import hash_of, subsample
from flowmill.plans.prepare import PrepState
from flowmill.sources import files, prediction_log

REPLAY_ORDER = "replay_order"
ROWS_PER_FILE = 100_000


def write_replay(
    df: DataFrame,
    path: str,
    rows_per_file: int = ROWS_PER_FILE,
    count: int | None = None,
    key: str | None = None,
    seed: int = 42,
    shuffle: bool = True,
) -> None:
    """Store the rows to replay in pieces of about ``rows_per_file`` rows for a file stream.

    Each row carries its place as ``replay_order``: a hash, or the key for an unshuffled replay. A piece holds a range of
    it, sorted. The pieces are written in parallel and a file stream takes them by their age, so a batch is in order and
    the batches are not; who needs the whole order sorts by ``replay_order``.
    """
    chosen = subsample(df, count, key, seed) if shuffle else df
    order = hash_of(chosen, key, seed) if shuffle else q(key)
    placed = chosen.withColumn(REPLAY_ORDER, order)
    pieces = max(-(-placed.count() // rows_per_file), 1)
    placed.repartitionByRange(pieces, REPLAY_ORDER).sortWithinPartitions(REPLAY_ORDER).write.mode("overwrite").parquet(path)


def replay_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    """The stored rows as a stream; ``replay_order`` only if the schema names it."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def score_stream(
    stream: DataFrame, bundle: Bundle, state: PrepState, keep: Sequence[str], benign: str = "BENIGN"
) -> DataFrame:
    """The batch scorer on a stream, with the row as received as JSON. Stateless: any rate, any order."""
    told = stream.withColumn("features_json", prediction_log.row_json(stream))
    return score(told, bundle, state, [*keep, "features_json"], benign)


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Run to the end of what is there, or keep going at an interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def log_stream(
    scored: DataFrame, log_path: str, run: str, checkpoint: str, seq: str, interval: str | None = None
) -> StreamingQuery:
    """Append a scored stream to the log, and the seconds of each batch beside it.

    A repeated micro-batch rewrites its own folder and its own time.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        began, name = time.perf_counter(), f"{run}-{batch_id:012d}"
        prediction_log.append(prediction_log.log_rows(batch, seq), log_path, name, run)
        prediction_log.add_time(batch.sparkSession, log_path, name, run, time.perf_counter() - began)

    return start(scored.writeStream.foreachBatch(store), checkpoint, interval)


def running_counts(scored: DataFrame) -> DataFrame:
    """Counts and attacks per predicted class; the state is one row per class."""
    return scored.groupBy("predicted_class").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_attack")).alias("attacks")
    )


def counts_to_table(counts: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Keep the current counts in small tables, one folder per batch, of which ``current_counts`` reads the newest.

    The two newest stay, so that a reader that has just chosen one finds it.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")
        for old in files.folders(spark, f"{path}/batch=*")[:-2]:
            files.delete(spark, f"{path}/{old}")

    return start(counts.writeStream.outputMode("complete").foreachBatch(store), checkpoint, interval)


def current_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete counts; none before the first batch."""
    complete = [p.rsplit("/", 2)[-2] for p in files.glob(spark, f"{path}/batch=*/_SUCCESS")]
    if not complete:
        return small_table(spark, [], "predicted_class string, n bigint, attacks bigint")
    return spark.read.parquet(f"{path}/{max(complete)}")


def parity_stream(left: DataFrame, right: DataFrame, key: str, time: str, within: str) -> DataFrame:
    """``score_parity`` of two running streams: (key, left_class, right_class, matches).

    Scores of one flow lie at most ``within`` (an interval, such as "10 minutes") apart in event time, and rows come at most
    that late; later ones are dropped. A pair comes out when its second score arrives. A flow that only one side has comes
    out, with a null class for the other, once both watermarks are past its time and ``within``, so the state holds
    no more than such a span of both streams. The newest rows wait for later ones of both sides.
    """
    sides = []
    for side, stream in (("left", left), ("right", right)):
        when = q(time).cast("timestamp").alias(f"{side}_time")
        told = stream.select(q(key).alias(f"{side}_key"), when, F.col("predicted_class").alias(f"{side}_class"))
        sides.append(told.withWatermark(f"{side}_time", within))
    span = F.expr(f"INTERVAL {within}")
    near = (F.col("left_time") >= F.col("right_time") - span) & (F.col("left_time") <= F.col("right_time") + span)
    met = sides[0].join(sides[1], (F.col("left_key") == F.col("right_key")) & near, "full_outer")
    same = F.col("left_class").eqNullSafe(F.col("right_class"))
    both = F.col("left_key").isNotNull() & F.col("right_key").isNotNull()
    return met.select(F.coalesce("left_key", "right_key").alias(key), "left_class", "right_class", (both & same).alias("matches"))


def differences_to_table(matched: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append what ``parity_stream`` finds different to a table, as it is found."""
    differing = matched.where(~F.col("matches")).drop("matches")
    return start(differing.writeStream.format("parquet").option("path", path), checkpoint, interval)


def run_seconds(spark: SparkSession, log_path: str, run: str) -> float:
    """Seconds that all batches of a run took, over every restart."""
    times = prediction_log.read_times(spark, log_path).where(F.col("run") == run)
    return times.agg(F.coalesce(F.sum("seconds"), F.lit(0.0))).first()[0]


def stream_session_summary(
    log: DataFrame, truth: DataFrame, key: str, label: str, seconds: float | None, run: str | None = None
) -> DataFrame:
    """Session totals of one run. Every logged flow counts; those without a known class are not correct.

    Keys that the truth has several times count as known only if they agree on the class.
    """
    told = log if run is None else log.where(F.col("run") == run)
    known = truth.groupBy(q(key).cast("string").alias("seq")).agg(F.min(q(label)).alias("low"), F.max(q(label)).alias("high"))
    known = known.select("seq", F.when(F.col("low") == F.col("high"), F.col("low")).alias("true_class"))
    return session_summary(told.join(known, "seq", "left"), "true_class", "predicted_class", "is_attack", seconds)
