import os

import pytest
from pyspark.sql import functions as F

from flowmill.operators import models, scoring, selection
from flowmill.plans.prepare import CODE, ROW_KEY, prepare
from flowmill.sources import prediction_log
from flowmill.streaming import live


def frame(spark, n=200):
    label = F.when(F.col("id") % 4 == 0, "DoS").otherwise("BENIGN")
    return spark.range(n).select(
        F.concat(F.lit("f"), F.col("id")).alias("Flow ID"),
        (F.when(label == "DoS", 10.0).otherwise(0.0) + F.col("id") % 3).alias("rate/s"),
        F.when(F.col("id") % 5 == 0, float("inf")).otherwise(F.col("id") % 11).alias("size"),
        label.alias("Label"),
    )


@pytest.fixture(scope="module")
def ready(spark):
    p = prepare(frame(spark), dropped_classes=None, balancing="none", key="Flow ID")
    model, _ = models.train_model(
        models.FOREST, p.train, p.state.feature_columns, CODE, p.state.classes, {"trees": 4, "max_depth": 3}
    )
    return p, models.Bundle(model, models.FOREST, p.state.feature_columns, list(p.state.classes))


def scored_rows(spark, n=30):
    return spark.range(n).select(
        F.format_string("%04d", "id").alias("key"),
        F.when(F.col("id") % 3 == 0, "DoS").otherwise("BENIGN").alias("predicted_class"),
        F.lit(0.9).alias("confidence"),
        (F.col("id") % 3 == 0).alias("is_attack"),
        F.lit('{"a":null}').alias("features_json"),
    )


def test_absent_log_reads_as_empty_and_stays_absent(spark, folder):
    path = folder + "/log"
    log = prediction_log.read_log(spark, path)
    assert log.count() == 0 and prediction_log.recent(log).count() == 0
    stats = prediction_log.log_stats(log).first()
    assert stats["total"] == 0 and stats["per_class"] == {} and stats["attacks"] == 0
    assert not os.path.exists(path)


def test_log_appends_and_counts(spark, folder):
    rows = prediction_log.log_rows(scored_rows(spark), "key")
    prediction_log.append(rows, folder + "/log", "b1")
    prediction_log.append(rows, folder + "/log", "b2")
    prediction_log.append(rows, folder + "/log", "b2")  # repeated after a failure
    log = prediction_log.read_log(spark, folder + "/log")
    stats = prediction_log.log_stats(log, "benign").first()
    assert stats["total"] == 60 and stats["per_class"] == {"BENIGN": 40, "DoS": 20} and stats["attacks"] == 20
    assert log.select("logged_at").distinct().count() <= 2
    assert log.where("features_json <> '{\"a\":null}'").count() == 0


def test_recent_is_newest_first_and_clamped(spark, folder):
    for b in ("b1", "b2"):
        prediction_log.append(prediction_log.log_rows(scored_rows(spark, 300), "key"), folder + "/log", b)
    log = prediction_log.read_log(spark, folder + "/log").withColumn("logged_at", F.lit("2024-01-01").cast("timestamp"))
    top = prediction_log.recent(log, 3).collect()
    assert [(r["batch_id"], r["seq"]) for r in top] == [("b2", "0299"), ("b2", "0298"), ("b2", "0297")]
    assert "features_json" not in top[0].asDict()
    assert [prediction_log.recent(log, n).count() for n in (-5, 0, 50, 9999)] == [1, 1, 50, 600]
    assert [prediction_log.recent(log, n, prediction_log.MAX_RECENT).count() for n in (0, 9999)] == [1, 500]


def test_recent_of_a_stored_log_leaves_old_dates_alone(spark, folder):
    path = folder + "/log"
    for i, date in enumerate(("2024-01-01", "2024-01-02", "2024-01-03")):
        rows = prediction_log.log_rows(scored_rows(spark, 10), "key").withColumn("run", F.lit("r"))
        rows.withColumn("logged_at", F.lit(date).cast("timestamp")).write.parquet(f"{path}/log_date={date}/batch_id=b{i}")
    newest = prediction_log.recent_of(spark, path, 15)
    assert [r["batch_id"] for r in newest.collect()] == ["b2"] * 10 + ["b1"] * 5
    plan = newest._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan and "log_date" in plan
    assert prediction_log.recent_of(spark, path, 99).count() == 30
    assert prediction_log.recent_of(spark, folder + "/none", 5).count() == 0


def test_a_batch_repeated_on_a_later_date_is_stored_once(spark, folder):
    path = folder + "/log"
    rows = prediction_log.log_rows(scored_rows(spark, 10), "key")
    rows.withColumn("run", F.lit("r")).write.parquet(f"{path}/log_date=2024-01-01/batch_id=b1")
    prediction_log.append(rows, path, "b1", "r")
    assert prediction_log.read_log(spark, path).count() == 10


def test_a_reader_sees_one_whole_version_of_a_repeated_batch(spark, folder):
    path = folder + "/log"
    rows = prediction_log.log_rows(scored_rows(spark, 10), "key")
    for confidence in (0.1, 0.2):
        prediction_log.append(rows.withColumn("confidence", F.lit(confidence)), path, "b1", "r")
    chosen = prediction_log.read_log(spark, path)  # before the repeat, read after it
    fails = F.when(F.col("seq") == "0007", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.lit(0.3))
    with pytest.raises(Exception, match="lost"):
        prediction_log.append(rows.repartition(3).withColumn("confidence", fails), path, "b1", "r")
    assert {tuple(r) for r in prediction_log.read_log(spark, path).groupBy("confidence").count().collect()} == {(0.2, 10)}
    prediction_log.append(rows.withColumn("confidence", F.lit(0.4)), path, "b1", "r")
    assert {tuple(r) for r in chosen.groupBy("confidence").count().collect()} == {(0.2, 10)}
    assert {tuple(r) for r in prediction_log.read_log(spark, path).groupBy("confidence").count().collect()} == {(0.4, 10)}
    kept = [at for at, _, held in os.walk(path) if "_SUCCESS" in held]
    assert len(kept) == 2  # the newest and the one before
    for seconds in (1.0, 2.0):
        prediction_log.add_time(spark, path, "b1", "r", seconds)
    assert [tuple(r) for r in prediction_log.read_times(spark, path).collect()] == [(2.0, "r", "b1")]


def test_parity_of_streams_survives_a_restart(spark, folder):
    def rows(part, left):
        shown = spark.range(part * 20, part * 20 + 20).where(F.col("id") % 7 != (0 if left else 1))
        late = F.when((F.col("id") % 3 == 0) & F.lit(not left), "DoS").otherwise("BENIGN")
        at = F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000)
        return shown.select(F.col("id").cast("string").alias("seq"), at.alias("at"), late.alias("predicted_class"))

    counts = []
    for part in (0, 1, 9):
        for side in ("left", "right"):
            rows(part, side == "left").coalesce(1).write.mode("append").parquet(f"{folder}/{side}")
        sides = [live.replay_stream(spark, f"{folder}/{side}", rows(0, True).schema) for side in ("left", "right")]
        matched = live.parity_stream(*sides, "seq", "at", "5 minutes")
        live.differences_to_table(matched, folder + "/found", folder + "/check").awaitTermination()
        found = spark.read.schema("seq string, left_class string, right_class string").parquet(folder + "/found")
        counts.append(found.count())
    whole = scoring.score_parity(*(spark.read.parquet(f"{folder}/{side}") for side in ("left", "right")), "seq")
    wanted = {(r["seq"], r["left_class"], r["right_class"]) for r in whole.where("not matches and int(seq) < 40").collect()}
    assert {tuple(r) for r in found.where("int(seq) < 40").collect()} == wanted
    assert counts[0] >= 6 and counts == sorted(counts) and found.distinct().count() == found.count()


def test_row_json_keeps_nulls_and_extra_columns(spark):
    df = spark.createDataFrame([(1.5, None, "more")], "`a b` double, c double, extra string")
    assert df.select(prediction_log.row_json(df)).first()[0] == '{"a b":1.5,"c":null,"extra":"more"}'


def test_stream_scores_equal_batch_scores_and_restart_is_safe(spark, ready, folder):
    p, bundle = ready
    raw = p.split.test(p.clean)
    live.write_replay(raw, folder + "/in", rows_per_file=15, key=ROW_KEY)
    for _ in range(2):  # the second run finds nothing new
        stream = live.replay_stream(spark, folder + "/in", raw.schema)
        scored = live.score_stream(stream, bundle, p.state, [ROW_KEY])
        live.log_stream(scored, folder + "/log", "run", folder + "/check", ROW_KEY).awaitTermination()
    log = prediction_log.read_log(spark, folder + "/log")
    batch = scoring.score(raw, bundle, p.state, [ROW_KEY])
    same = scoring.score_parity(log.withColumnRenamed("seq", ROW_KEY), batch, ROW_KEY)
    assert tuple(scoring.parity_counts(same).first()) == (raw.count(), raw.count(), 0)
    wrong = batch.withColumn("predicted_class", F.lit("DoS"))
    differing = scoring.parity_counts(scoring.score_parity(wrong, batch, ROW_KEY)).first()["differing"]
    assert differing == batch.where("predicted_class <> 'DoS'").count() > 0
    assert all('"Label":' in r["features_json"] for r in log.collect())  # the row as it came, not the model's part of it
    summary = live.stream_session_summary(log, p.test, ROW_KEY, "Label", 2.0, "run").first()
    assert summary["total_flows"] == raw.count() and summary["accuracy_vs_true_label"] > 0.9
    assert live.stream_session_summary(log, p.test, ROW_KEY, "Label", 2.0, "other").first()["total_flows"] == 0


def test_running_counts_and_seconds(spark, folder):
    rows = scored_rows(spark, 90)
    live.write_replay(rows, folder + "/in", rows_per_file=30, key="key")
    stream = live.replay_stream(spark, folder + "/in", rows.schema)
    assert live.current_counts(spark, folder + "/counts").count() == 0
    live.counts_to_table(live.running_counts(stream), folder + "/counts", folder + "/check").awaitTermination()
    got = sorted(tuple(r) for r in live.current_counts(spark, folder + "/counts").collect())
    assert got == [("BENIGN", 60, 0), ("DoS", 30, 30)]
    assert len(os.listdir(folder + "/counts")) == 2  # three batches, the two newest kept
    os.makedirs(folder + "/counts/batch=999999999999")  # a batch that is being written
    assert sorted(tuple(r) for r in live.current_counts(spark, folder + "/counts").collect()) == got


def test_session_of_more_than_a_hundred_batches(spark, folder):
    rows = scored_rows(spark, 220)
    live.write_replay(rows, folder + "/in", rows_per_file=2, key="key")
    pieces = len([f for f in os.listdir(folder + "/in") if f.endswith(".parquet")])
    assert pieces > 100
    for run, kept in (("run", "true"), ("run-2", "is_attack")):
        stream = live.replay_stream(spark, folder + "/in", rows.schema, 1 if run == "run" else 300).where(kept)
        live.log_stream(stream, folder + "/log", run, f"{folder}/check-{run}", "key").awaitTermination()
    log = prediction_log.read_log(spark, folder + "/log")
    times = prediction_log.read_times(spark, folder + "/log")
    assert times.where("run = 'run'").count() == pieces  # every batch is timed, not only the last hundred
    seconds = live.run_seconds(spark, folder + "/log", "run")
    assert seconds == pytest.approx(sum(r["seconds"] for r in times.where("run = 'run'").collect())) and seconds > 0
    truth = rows.where("key < '0100'").select("key", F.col("predicted_class").alias("Label"))
    truth = truth.union(truth.limit(3)).union(spark.createDataFrame([("0000", "other")], "key string, Label string"))
    got = live.stream_session_summary(log, truth, "key", "Label", seconds, "run").first()
    assert got["total_flows"] == 220 and got["attacks_detected"] == 74
    assert got["correct_predictions"] == 99  # 100 known, of which one is told twice and differently
    assert live.stream_session_summary(log, truth, "key", "Label", 1.0, "run-2").first()["total_flows"] == 74


def test_replay_keeps_count_and_tells_the_order(spark, folder):
    rows = scored_rows(spark, 50)
    live.write_replay(rows, folder + "/some", rows_per_file=7, count=20, key="key")
    some = spark.read.parquet(folder + "/some")
    wanted = [r["key"] for r in selection.replay_order(rows, 20, "key").collect()]
    assert [r["key"] for r in some.orderBy(live.REPLAY_ORDER).collect()] == wanted
    live.write_replay(rows, folder + "/all", rows_per_file=20, key="key", shuffle=False)
    everything = spark.read.parquet(folder + "/all")
    assert [r["key"] for r in everything.orderBy(live.REPLAY_ORDER).collect()] == [f"{i:04d}" for i in range(50)]
    for name in sorted(os.listdir(folder + "/all")):
        if name.endswith(".parquet"):  # in order within a piece
            keys = [r["key"] for r in spark.read.parquet(f"{folder}/all/{name}").collect()]
            assert keys == sorted(keys)


def test_a_job_on_a_cluster_needs_the_shared_folder(spark, monkeypatch):
    from flowmill import session

    class Elsewhere:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere)
