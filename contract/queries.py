"""The registered queries: one callable (spark, sf_dir) -> DataFrame per name.

Preparation and model fits are kept per session and data folder, because many queries look
at the same fitted result.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from flowmill.functions.columns import finite, identifier_columns, is_attack, numeric_columns, q, small_table
from flowmill.operators import balance, cleaning, correlation, evaluate, explain, models, profile, scoring, selection
from flowmill.plans.prepare import CODE, ROW_KEY, preparation_summary, prepare
from flowmill.plans.profile_report import profile_summary
from flowmill.plans.summaries import read_report, write_reports
from flowmill.plans.train import train_and_compare
from flowmill.session import materialize, new_path
from flowmill.sources import csv_flows, files, prediction_log, prepared as stored
from flowmill.sources.flow_view import KEY, TARGET, flows, read_table
from flowmill.streaming import live

CLASSES = ["BENIGN", "DoS GoldenEye", "DoS Hulk", "DoS Slowhttptest", "DoS slowloris"]
PARAMS = {models.FOREST: {"trees": 10, "max_depth": 6}, models.BOOSTED: {"rounds": 3, "max_depth": 3}}

_kept: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    at = (spark.sparkContext.applicationId, str(sf_dir), name)
    if at not in _kept:
        _kept[at] = make()
    return _kept[at]


def _prepared(spark, sf_dir):
    return _once(spark, sf_dir, "prepared", lambda: prepare(flows(spark, sf_dir), key=KEY, balancing="none"))


def _clean(spark, sf_dir) -> DataFrame:
    return cleaning.deduplicate(cleaning.keep_classes(flows(spark, sf_dir), TARGET, ["Heartbleed"]))


def _trained(spark, sf_dir):
    def make():
        p = _prepared(spark, sf_dir)
        return train_and_compare(materialize(p.train, "train"), p.test, p.state, params=PARAMS)

    return _once(spark, sf_dir, "trained", make)


def _softmax(spark, sf_dir):
    """Softmax boosting on the rows and with the settings of the one-per-class models, without and with class weights."""

    def make():
        p = _prepared(spark, sf_dir)
        train = materialize(p.train, "train")
        fit = lambda weighted: train_and_compare(
            train, p.test, p.state, (models.SOFTMAX,), {models.SOFTMAX: PARAMS[models.BOOSTED]}, class_weight=weighted
        )
        return fit(False), fit(True)

    return _once(spark, sf_dir, "softmax", make)


def softmax_boosting(spark, sf_dir):
    """Softmax boosting beside one model per class, over all test rows; losses are those on the train rows."""
    plain, weighted = _softmax(spark, sf_dir)
    losses = plain.best.model.losses
    accuracy = lambda trained, name: trained.comparison.where(F.col("model") == name).first()["accuracy"]
    told = evaluate.overall_from_counts(plain.counts[models.SOFTMAX], plain.best.class_names)
    counted = plain.counts[models.SOFTMAX].agg(F.sum("n").alias("rows"))
    return counted.select(
        "rows",
        F.lit(len(plain.best.model.rounds)).cast("bigint").alias("rounds"),
        F.lit(abs(losses[0] - math.log(len(plain.best.class_names))) < 1e-9).alias("starts_even"),
        F.lit(all(b < a for a, b in zip(losses, losses[1:]))).alias("losses_fall"),
        F.lit(told.first()["accuracy"] >= accuracy(_trained(spark, sf_dir), models.BOOSTED)).alias("as_good_as_one_per_class"),
        F.lit(weighted.best.model.losses[1:] != losses[1:]).alias("weights_act"),
    )


def softmax_round_trip(spark, sf_dir):
    """Stored, read again and scored over the raw test rows: the same predictions."""
    p, bundle = _prepared(spark, sf_dir), _softmax(spark, sf_dir)[0].best
    path = new_path(spark, "bundle")
    models.save_bundle(spark, bundle, path)
    raw = _raw_test(spark, sf_dir)
    before = scoring.score(raw, bundle, p.state, [ROW_KEY])
    after = scoring.score(raw, models.load_bundle(spark, path), p.state, [ROW_KEY])
    return scoring.parity_counts(scoring.score_parity(before, after, ROW_KEY))


def _raw_test(spark, sf_dir) -> DataFrame:
    p = _prepared(spark, sf_dir)
    return p.split.test(p.clean)


def _round(df: DataFrame, columns, digits: int) -> DataFrame:
    wanted = set(columns)
    return df.select(*[F.round(q(c), digits).alias(c) if c in wanted else q(c) for c in df.columns])


def _listed(column: str):
    return F.array_join(F.col(column), ",")


def _map_text(column: str):
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")


def _cells(df: DataFrame, names) -> DataFrame:
    """(column_name, cells): non-null cells of the named columns."""
    wide = df.agg(*[F.count(q(n)).alias(f"c{i}") for i, n in enumerate(names)])
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"c{i}").alias("cells")) for i, n in enumerate(names)]))
    )


# --- profile ---------------------------------------------------------------------------


def remaining_columns(spark, sf_dir):
    rest, _ = cleaning.drop_identifier_columns(flows(spark, sf_dir), TARGET)
    return _cells(rest, rest.columns)


def numeric_column_list(spark, sf_dir):
    df = flows(spark, sf_dir)
    names = numeric_columns(df, exclude=[TARGET])
    places = small_table(spark, list(enumerate(names)), "position int, column_name string")
    return _cells(df, names).join(F.broadcast(places), "column_name").select("position", "column_name", "cells")


def all_pair_correlations(spark, sf_dir):
    df = flows(spark, sf_dir)
    pairs = correlation.pair_correlations(df, numeric_columns(df, exclude=[TARGET]))
    return _round(pairs.select("feature_1", "feature_2", "correlation"), ["correlation"], 9)


def correlated_drop_list(spark, sf_dir):
    dropped = _prepared(spark, sf_dir).state.dropped_correlated
    return small_table(spark, [(c,) for c in dropped], "column_name string")


def feature_histogram(spark, sf_dir):
    return _round(profile.feature_histogram(flows(spark, sf_dir)), ["bin_start", "bin_end"], 6)


def clipped(spark, sf_dir):
    df = flows(spark, sf_dir)
    columns = numeric_columns(df, exclude=[TARGET])
    df = profile.clip_at_quantile(df.select(q(KEY), *[q(c) for c in columns]), columns)
    largest = df.agg(*[F.max(q(c)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    caps = {c: largest[f"c{i}"] for i, c in enumerate(columns)}
    return df.select(
        q(KEY), *[F.when(q(c) == caps[c], F.round(q(c), 6)).otherwise(q(c)).alias(c) for c in columns]
    )


def eda_summary(spark, sf_dir):
    summary = profile_summary(flows(spark, sf_dir))
    lists = ["missing_value_columns", "infinite_value_columns", "identifier_columns"]
    return summary.select(
        *[
            F.array_join(F.array_sort(c), ",").alias(c)
            if c in lists
            else _map_text(c).alias(c)
            if c == "class_distribution"
            else F.round(c, 3).alias(c)
            if c == "duplicate_pct"
            else F.col(c)
            for c in summary.columns
        ]
    )


# --- cleaning and split ------------------------------------------------------------------


def drop_classes(spark, sf_dir):
    return cleaning.drop_classes(flows(spark, sf_dir), TARGET, [" heartbleed ", "DOS HULK"])[0]


def clean_infinities(spark, sf_dir):
    df = flows(spark, sf_dir)
    return df.select(q(KEY), *[finite(q(c)).alias(c) for c in numeric_columns(df)])


def features_and_target(spark, sf_dir):
    rest, _ = cleaning.drop_identifier_columns(flows(spark, sf_dir), TARGET)
    return rest.select(*[q(c) for c in numeric_columns(rest)], q(TARGET).alias("target"))


def label_codes(spark, sf_dir):
    counts = selection.class_counts(_clean(spark, sf_dir), TARGET)
    return small_table(spark, [(i, c, n) for i, (c, n) in enumerate(counts.items())], "code int, label string, n bigint")


def split_quota(spark, sf_dir):
    counts = selection.class_counts(_clean(spark, sf_dir), TARGET)
    quota = selection.split_quota(counts)
    return small_table(spark, [(c, n, quota[c]) for c, n in counts.items()], "label string, n bigint, n_test bigint")


def stratified_split(spark, sf_dir):
    clean = materialize(_clean(spark, sf_dir).withColumn(ROW_KEY, selection.order_hash(q(KEY), 42)), "clean")
    split = selection.stratified_split(clean, TARGET, hashed=ROW_KEY)
    return clean.select(q(KEY), q(TARGET), F.when(split.is_test(), "test").otherwise("train").alias("side"))


# --- fitted state --------------------------------------------------------------------------


def train_medians(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    train = p.split.train(p.clean)
    medians = cleaning.column_medians(train, numeric_columns(train))
    return _round(small_table(spark, list(medians.items()), "feature string, median double"), ["median"], 8)


def scaler_state(spark, sf_dir):
    state = _prepared(spark, sf_dir).state.table(spark)
    return _round(state.select(F.col("name").alias("feature"), "mean", "scale"), ["mean", "scale"], 8)


def imputed(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    train, test = p.split.train(p.clean), p.split.test(p.clean)
    names = numeric_columns(test)
    filled = cleaning.impute(test, cleaning.column_medians(train, names))
    return filled.select(q(ROW_KEY), *[F.round(q(c), 8).alias(c) for c in names])


def scaled_test(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return _round(p.test.drop(CODE), p.state.feature_columns, 8)


def prepared_train(spark, sf_dir):
    """The whole chain from raw flows, run anew."""
    p = prepare(flows(spark, sf_dir), key=KEY, balancing="none")
    return _round(p.train, p.state.feature_columns, 8)


def unscaled(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    raw = p.test.select(q(ROW_KEY), *p.state.unscaled_columns())
    return raw.select(q(ROW_KEY), *[F.round(q(c), 7).alias(c) for c in p.state.feature_columns])


def summary_of_preparation(spark, sf_dir):
    p = prepare(flows(spark, sf_dir), key=KEY, balancing="smote")
    s = preparation_summary(p)
    return s.select(
        *[
            _map_text(c).alias(c) if c == "dropped_classes" else _listed(c).alias(c) if kind.startswith("array") else F.col(c)
            for c, kind in s.dtypes
        ]
    )


# --- balancing -------------------------------------------------------------------------------


def _weights(df, target):
    return _round(balance.class_weights(df, target), ["weight"], 10)


def row_weights(spark, sf_dir):
    weighted = balance.with_class_weight(flows(spark, sf_dir), TARGET)
    return weighted.select(q(KEY), F.round("class_weight", 10).alias("class_weight"))


def smote_class_counts(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    before = p.train.select(ROW_KEY, F.lit(True).alias("original"))
    after = balance.balance(p.train, TARGET, "smote", p.state.feature_columns, ROW_KEY)
    return (
        after.select(ROW_KEY, q(TARGET).alias("label"))
        .join(before, ROW_KEY, "left")
        .groupBy("label")
        .agg(
            F.count("original").alias("original"),
            F.count_if(F.col("original").isNull()).alias("synthetic"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def smote_bounds(spark, sf_dir):
    """Synthetic rows lie between two train rows of their own class, and every due base row is used."""
    p = _prepared(spark, sf_dir)
    made = balance.synthetic_rows(p.train, TARGET, p.state.feature_columns, ROW_KEY)
    corners = F.arrays_zip(F.col("base").alias("a"), F.col("neighbour").alias("b"), F.col("vector").alias("v"))
    inside = F.forall(
        corners,
        lambda e: (e["v"] >= F.least(e["a"], e["b"]) - 1e-9) & (e["v"] <= F.greatest(e["a"], e["b"]) + 1e-9),
    )
    train = p.train.select(
        q(TARGET), F.xxhash64(F.array(*[q(c) for c in p.state.feature_columns])).alias("point")
    ).distinct()
    checked = made.select(
        "base_key", q(TARGET), inside.alias("inside"), F.xxhash64("base").alias("base"), F.xxhash64("neighbour").alias("near")
    )
    bases = train.select(q(TARGET), F.col("point").alias("base"), F.lit(True).alias("known_base"))
    nears = train.select(q(TARGET), F.col("point").alias("near"), F.lit(True).alias("known_near"))
    return (
        checked.join(bases, [TARGET, "base"], "left")
        .join(nears, [TARGET, "near"], "left")
        .groupBy(q(TARGET).alias("label"))
        .agg(
            F.count(F.lit(1)).alias("synthetic"),
            F.count_if(~F.col("inside")).alias("outside"),
            F.count_if(F.col("known_base").isNull()).alias("foreign_base"),
            F.count_if(F.col("known_near").isNull()).alias("foreign_neighbour"),
            F.count_distinct("base_key").alias("bases"),
        )
    )


# --- selections --------------------------------------------------------------------------------


def _unique(spark, sf_dir):
    return materialize(cleaning.deduplicate(flows(spark, sf_dir)), "unique")


def subsample(spark, sf_dir):
    return selection.subsample(_unique(spark, sf_dir), 3000, KEY).select(q(KEY))


def per_class_sample(spark, sf_dir):
    return selection.per_class_sample(_unique(spark, sf_dir), TARGET, 25, KEY).select(q(KEY), q(TARGET))


def replay_order(spark, sf_dir):
    chosen = selection.replay_order(_unique(spark, sf_dir), 200, KEY).select(q(KEY))
    order = W.orderBy(selection.order_hash(q(KEY), 42))  # over the 200 chosen rows
    return chosen.select(F.row_number().over(order).cast("bigint").alias("position"), q(KEY))


# --- score preparation ---------------------------------------------------------------------------


def _text_flows(spark, sf_dir):
    """All numbers as text: hundredths, infinity with blanks around it, and no number for 13 packets."""
    df = flows(spark, sf_dir)
    texts = [
        F.when(q("Total Fwd Packets") == 13, "n/a").when(q(c) == float("inf"), " Infinity ").otherwise(_cents(q(c))).alias(c)
        for c in numeric_columns(df, exclude=[TARGET])
    ]
    return df.select(q(KEY), *texts)


def _cents(c):
    """Cents as text, null unless finite."""
    return F.when(c < float("inf"), F.round(c * 100).cast("bigint")).cast("string")


def coerce_features(spark, sf_dir):
    df = _text_flows(spark, sf_dir)
    return scoring.coerced(df, df.columns[1:])


def raw_values(spark, sf_dir):
    df = _text_flows(spark, sf_dir)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(q(KEY), *[scoring.clean_value(q(c), kinds[c]).alias(c) for c in df.columns[1:]])


def score_input(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    ready = scoring.score_input(_raw_test(spark, sf_dir), p.state, [ROW_KEY, TARGET])
    return _round(ready, p.state.feature_columns, 8)


def required_features(spark, sf_dir):
    maps = read_table(spark, sf_dir, "events").select(F.from_json("props", "map<string,string>").alias("features"))
    missing = set(scoring.missing_in_maps(maps, "features", ["k", "absent"]))
    return small_table(spark, [(f, f not in missing) for f in ("k", "absent")], "feature string, present boolean")


# --- evaluation ------------------------------------------------------------------------------------


def _label_pairs(spark, sf_dir):
    return read_table(spark, sf_dir, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


def _ruled(spark, sf_dir):
    code = F.floor((q("Packet Length Variance") + 3) / 10).cast("int")
    names = [*CLASSES, "Heartbleed"]
    return flows(spark, sf_dir).select(
        q(TARGET).alias("label"), F.coalesce(F.get(F.array(*[F.lit(c) for c in names]), code), F.lit("Heartbleed")).alias("prediction")
    )


def _metric(call, source, classes):
    def run(spark, sf_dir):
        out = call(source(spark, sf_dir), "label", "prediction", classes)
        floats = [c for c, kind in out.dtypes if kind == "double"]
        return _round(out, floats, 10)

    return run


# --- models ------------------------------------------------------------------------------------------


def _invariants(bundle_of):
    def run(spark, sf_dir):
        p = _prepared(spark, sf_dir)
        bundle = bundle_of(spark, sf_dir)
        scored = scoring.score(_raw_test(spark, sf_dir), bundle, p.state, [ROW_KEY, TARGET], decimals=None)
        shares = F.map_values("probabilities")
        total = F.aggregate(shares, F.lit(0.0), lambda a, b: a + b)
        return scored.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.abs(total - 1) > 1e-9).alias("bad_sum"),
            F.count_if(F.element_at("probabilities", F.col("predicted_class")) < F.array_max(shares)).alias("bad_class"),
            F.count_if(F.abs(F.col("confidence") - F.array_max(shares)) > 1e-12).alias("bad_confidence"),
            F.count_if(F.col("is_attack") != (F.lower("predicted_class") != "benign")).alias("bad_flag"),
            (F.avg((F.col("predicted_class") == q(TARGET)).cast("double")) > 0.8).alias("learned"),
        )

    return run


def _weighted_forest(spark, sf_dir):
    def make():
        p = _prepared(spark, sf_dir)
        model, _ = models.train_model(
            models.FOREST, p.train, p.state.feature_columns, CODE, p.state.classes, PARAMS[models.FOREST], class_weight=True
        )
        return models.Bundle(model, models.FOREST, p.state.feature_columns, list(p.state.classes))

    return _once(spark, sf_dir, "weighted", make)


def rf_importances(spark, sf_dir):
    bundle = _trained(spark, sf_dir).bundles[models.FOREST]
    table = models.feature_importances(bundle.model, bundle.feature_columns, spark).withColumn("at", F.monotonically_increasing_id())
    values = F.transform(F.array_sort(F.collect_list(F.struct("at", "importance"))), lambda e: e["importance"])
    return table.agg(
        F.count(F.lit(1)).alias("features"),
        (F.abs(F.sum("importance") - 1) < 1e-3).alias("sums_to_one"),
        (F.sort_array(F.collect_list("importance"), asc=False) == values).alias("sorted"),
        F.max_by("feature", "importance").alias("top_feature"),
    )


def _rescored(spark, sf_dir) -> DataFrame:
    """(model, rows, accuracy, macro_f1) from the scored test rows, without the library's metrics."""
    parts = None
    for name, bundle in _trained(spark, sf_dir).bundles.items():
        scored = scoring.score(_raw_test(spark, sf_dir), bundle, _prepared(spark, sf_dir).state, [TARGET])
        told = scored.select(F.lit(name).alias("model"), q(TARGET).alias("truth"), F.col("predicted_class").alias("guess"))
        parts = told if parts is None else parts.unionByName(told)
    pairs = parts.groupBy("model", "truth", "guess").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0)
    guessed = pairs.groupBy("model", F.col("guess").alias("truth")).agg(F.sum("n").alias("guessed"))
    classes = pairs.groupBy("model", "truth").agg(F.sum("n").alias("held"), F.sum(hit).alias("hits"))
    f1 = 2 * F.col("hits") / (F.col("held") + F.coalesce("guessed", F.lit(0)))
    return classes.join(guessed, ["model", "truth"], "left").groupBy("model").agg(
        F.sum("held").alias("rows"), (F.sum("hits") / F.sum("held")).alias("accuracy"), F.avg(f1).alias("macro_f1")
    )


def model_comparison(spark, sf_dir):
    compared = _trained(spark, sf_dir).comparison
    again = _rescored(spark, sf_dir).select("model", "rows", *[F.col(c).alias(f"own_{c}") for c in ("accuracy", "macro_f1")])
    agrees = [(F.abs(F.col(c) - F.col(f"own_{c}")) < 1e-9).alias(f"{c}_agrees") for c in ("accuracy", "macro_f1")]
    return compared.join(again, "model").select("model", "rows", *agrees, F.col("weighted_f1").between(0.0, 1.0).alias("valid"))


def best_model(spark, sf_dir):
    trained = _trained(spark, sf_dir)
    own = F.round("macro_f1", 4)
    chosen = F.max(F.when(F.col("model") == trained.best.name, own))
    return _rescored(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("candidates"), F.max("rows").alias("rows"), (chosen == F.max(own)).alias("is_best")
    )


def model_info(spark, sf_dir):
    info = scoring.model_info(_trained(spark, sf_dir).bundles[models.FOREST], spark)
    return info.select(*[_listed(c).alias(c) if kind.startswith("array") else F.col(c) for c, kind in info.dtypes])


def decoded_labels(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return p.test.select(ROW_KEY, scoring.decode(F.col(CODE), p.state.classes).alias("decoded"))


def bundle_round_trip(spark, sf_dir):
    p, bundle = _prepared(spark, sf_dir), _trained(spark, sf_dir).bundles[models.FOREST]
    path = new_path(spark, "bundle")
    models.save_bundle(spark, bundle, path)
    raw = _raw_test(spark, sf_dir)
    before = scoring.score(raw, bundle, p.state, [ROW_KEY])
    after = scoring.score(raw, models.load_bundle(spark, path), p.state, [ROW_KEY])
    return scoring.parity_counts(scoring.score_parity(before, after, ROW_KEY))


# --- log and sessions -----------------------------------------------------------------------------------


def _events(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").cast("string").alias("seq"),
        F.col("ts").alias("logged_at"),
        F.col("event_type").alias("predicted_class"),
        (F.col("value") / 500).alias("confidence"),
        is_attack(F.col("event_type"), "view").alias("is_attack"),
        F.col("props").alias("features_json"),
        F.lit("events").alias("batch_id"),
        "event_id",
        F.when(F.col("value") < 250, F.col("event_type")).otherwise("view").alias("true_class"),
    )


def recent_predictions(spark, sf_dir):
    return prediction_log.recent(_events(spark, sf_dir)).drop("batch_id")


def log_totals(spark, sf_dir):
    stats = prediction_log.log_stats(_events(spark, sf_dir), benign="view")
    return stats.select("total", _map_text("per_class").alias("per_class"), "attacks", "flagged")


def session_summary(spark, sf_dir):
    s = scoring.session_summary(_events(spark, sf_dir), "true_class", "predicted_class", "is_attack", 40.0)
    return s.select(*[_map_text(c).alias(c) if c == "predicted_class_counts" else F.col(c) for c in s.columns])


def outcome_flags(spark, sf_dir):
    flagged = scoring.outcome_flags(_events(spark, sf_dir), "true_class", "predicted_class")
    return flagged.select("event_id", "is_correct", "is_missed")


def log_round_trip(spark, sf_dir):
    path = new_path(spark, "log")
    events = _events(spark, sf_dir)
    prediction_log.append(prediction_log.log_rows(events.where("is_attack"), "seq"), path)
    prediction_log.append(prediction_log.log_rows(events.where("not is_attack"), "seq"), path, "calm")
    prediction_log.append(prediction_log.log_rows(events.where("not is_attack"), "seq"), path, "calm")  # a repeat
    return prediction_log.class_counts(prediction_log.read_log(spark, path))


# --- sources ----------------------------------------------------------------------------------------------


def csv_load(spark, sf_dir):
    path = new_path(spark, "csv")
    df = flows(spark, sf_dir)
    padded = df.select(*[q(c).alias(f" {c}") for c in df.columns])
    padded.write.option("header", True).csv(path)
    return csv_flows.load_flows(spark, path)


def prepared_round_trip(spark, sf_dir):
    path = new_path(spark, "prepared")
    stored.save_prepared(_prepared(spark, sf_dir), path)
    train, test, state = stored.load_prepared(spark, path)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return _round(both, state.feature_columns, 8)


def state_round_trip(spark, sf_dir):
    """The fitted state as it is read again: features with their numbers, classes, dropped columns."""
    path = new_path(spark, "state")
    stored.save_state(spark, _prepared(spark, sf_dir).state, path)
    state = stored.load_state(spark, path)
    rows = [("feature", i, f.name, f.median, f.mean, f.scale) for i, f in enumerate(state.features)]
    rows += [("class", i, c, None, None, None) for i, c in enumerate(state.classes)]
    rows += [("identifier", i, c, None, None, None) for i, c in enumerate(state.dropped_identifiers)]
    rows += [("correlated", i, c, None, None, None) for i, c in enumerate(state.dropped_correlated)]
    rows += [("target", 0, state.target, None, None, None), ("balancing", 0, state.balancing, None, None, None)]
    table = small_table(spark, rows, "kind string, pos bigint, name string, median double, mean double, scale double")
    return _round(table, ["median", "mean", "scale"], 8)


def absent_log(spark, sf_dir):
    """A log and a report that were never written read as empty, and reading them writes nothing; then they are there."""
    log, folder = new_path(spark, "log"), new_path(spark, "reports")
    events = prediction_log.log_rows(_events(spark, sf_dir), "seq")
    rows = []
    for stage in ("absent", "written"):
        if stage == "written":
            prediction_log.append(events, log)
            write_reports({"stats": prediction_log.class_counts(events)}, folder)
        told = prediction_log.log_stats(prediction_log.read_log(spark, log), benign="view").first()
        report = read_report(spark, folder, "stats")
        listed = sorted((r["predicted_class"], r["n"]) for r in report.collect()) if report else []
        newest = prediction_log.recent_of(spark, log).count()
        per_class = ",".join(f"{k}={v}" for k, v in sorted(told["per_class"].items()))
        rows.append((stage, told["total"], told["attacks"], per_class, newest, ",".join(f"{k}={n}" for k, n in listed), files.exists(spark, log)))
    return small_table(
        spark, rows, "stage string, total bigint, attacks bigint, per_class string, newest bigint, report string, there boolean"
    )


def stored_reports(spark, sf_dir):
    """The profile summary and the metrics per class of the flow table, written as JSON and read again."""
    folder = new_path(spark, "reports")
    metrics = evaluate.per_class_metrics(_ruled(spark, sf_dir), "label", "prediction", [*CLASSES, "Heartbleed"])
    write_reports({"metrics": metrics, "summary": profile_summary(flows(spark, sf_dir))}, folder)
    summary = read_report(spark, folder, "summary").select("row_count", "duplicate_count", "column_count")
    stored_metrics = read_report(spark, folder, "metrics").select("label", *[F.round(c, 10).alias(c) for c in ("precision", "recall", "f1")], "support")
    whole = summary.first()  # one row
    return stored_metrics.select("*", *[F.lit(whole[c]).cast("bigint").alias(c) for c in summary.columns])


# --- streams -------------------------------------------------------------------------------------------------


def stream_scores_match_batch(spark, sf_dir):
    p, bundle = _prepared(spark, sf_dir), _trained(spark, sf_dir).bundles[models.FOREST]
    source, log, checkpoint = (new_path(spark, n) for n in ("replay", "log", "stream"))
    raw = _raw_test(spark, sf_dir)
    live.write_replay(raw, source, max(raw.count() // 4, 1), key=ROW_KEY)
    stream = live.replay_stream(spark, source, raw.schema)
    live.log_stream(live.score_stream(stream, bundle, p.state, [ROW_KEY]), log, "run", checkpoint, ROW_KEY).awaitTermination()
    logged = prediction_log.read_log(spark, log).withColumnRenamed("seq", ROW_KEY)
    batch = scoring.score(raw, bundle, p.state, [ROW_KEY])
    return scoring.parity_counts(scoring.score_parity(logged, batch, ROW_KEY))


def _event_stream(spark, sf_dir):
    source = new_path(spark, "events")
    events = _events(spark, sf_dir)
    live.write_replay(events, source, max(events.count() // 4, 1), key="seq")
    return live.replay_stream(spark, source, events.schema)


def stream_class_counts(spark, sf_dir):
    table, checkpoint = new_path(spark, "counts"), new_path(spark, "stream")
    counts = live.running_counts(_event_stream(spark, sf_dir))
    live.counts_to_table(counts, table, checkpoint).awaitTermination()
    return live.current_counts(spark, table)


def stream_parity(spark, sf_dir):
    """Differences of two running streams of scores: some classes differ, and each side lacks some flows.

    A flow of a later time, alike on both sides, closes the streams.
    """
    events = _events(spark, sf_dir).select("seq", "logged_at", "predicted_class", "event_id")
    first, last = events.agg(F.min("logged_at"), F.max("logged_at")).first()
    days = (last - first).days + 1
    other = F.when(F.col("event_id") % 5 == 0, "other").otherwise(F.col("predicted_class"))
    sides = (events.where("event_id % 13 <> 0"), events.where("event_id % 11 <> 0").withColumn("predicted_class", other))
    closing = small_table(spark, [("closing", last + datetime.timedelta(days=3 * days), "view", 0)], events.schema)
    streams = []
    for rows in sides:
        source = new_path(spark, "scores")
        live.write_replay(rows, source, max(rows.count() // 2, 1), key="seq")
        closing.write.mode("append").parquet(source)
        streams.append(live.replay_stream(spark, source, events.schema))
    found = new_path(spark, "differences")
    matched = live.parity_stream(*streams, "seq", "logged_at", f"{days} days")
    live.differences_to_table(matched, found, new_path(spark, "stream")).awaitTermination()
    return spark.read.schema("seq string, left_class string, right_class string").parquet(found)


def _logged_events(spark, sf_dir):
    """Two runs, one name the beginning of the other: all events, and only the attacks."""
    log, stream = new_path(spark, "log"), _event_stream(spark, sf_dir)
    for run, rows in (("run", stream), ("run-2", stream.where("is_attack"))):
        live.log_stream(rows, log, run, new_path(spark, "stream"), "seq").awaitTermination()
    return log


def stream_log_rows(spark, sf_dir):
    log = prediction_log.read_log(spark, _logged_events(spark, sf_dir))
    return log.select("seq", "predicted_class", F.round("confidence", 8).alias("confidence"), "is_attack", "features_json", "run")


def stream_session_summary(spark, sf_dir):
    """The whole summary of both runs but the clock; a seventh of the flows have no known class."""
    path = _logged_events(spark, sf_dir)
    log, parts = prediction_log.read_log(spark, path), None
    known = _events(spark, sf_dir).where("event_id % 7 <> 0")
    for run in ("run", "run-2"):
        seconds = live.run_seconds(spark, path, run)
        summary = live.stream_session_summary(log, known, "seq", "true_class", seconds, run)
        part = summary.select(
            F.lit(run).alias("run"),
            "total_flows",
            "attacks_detected",
            "correct_predictions",
            "accuracy_vs_true_label",
            _map_text("predicted_class_counts").alias("predicted_class_counts"),
            (F.col("duration_seconds") > 0).alias("timed"),
            (F.col("flows_per_second") > 0).alias("rated"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


# --- explanations ----------------------------------------------------------------------------------------------


def explain_additivity(spark, sf_dir):
    """Baseline plus contributions equals the output, for every test row and all model kinds."""
    p, parts = _prepared(spark, sf_dir), None
    bundles = _trained(spark, sf_dir).bundles | {models.SOFTMAX: _softmax(spark, sf_dir)[0].best}
    for name, bundle in bundles.items():
        told = explain.attributions(p.test, bundle, [ROW_KEY])
        scored = scoring.predictions(p.test, bundle, [ROW_KEY]).select(ROW_KEY, "predicted_class")
        total = F.aggregate("contributions", F.col("baseline"), lambda a, b: a + b)
        row = (
            told.withColumn("explained", scoring.decode(F.col("code"), bundle.class_names))
            .join(scored, ROW_KEY)
            .agg(
                F.lit(name).alias("model"),
                F.count(F.lit(1)).alias("flows"),
                F.count_if(F.abs(total - F.col("output")) > 1e-6).alias("not_additive"),
                F.count_if(F.col("explained") != F.col("predicted_class")).alias("other_class"),
            )
        )
        parts = row if parts is None else parts.unionByName(row)
    return parts


def explain_topk(spark, sf_dir):
    p, bundle = _prepared(spark, sf_dir), _trained(spark, sf_dir).bundles[models.FOREST]
    k = 3
    told = explain.explain(_raw_test(spark, sf_dir), bundle, p.state, [ROW_KEY, "Flow Bytes/s"], top_k=k)
    sizes = F.transform("top_features", lambda e: F.abs(e["contribution"]))
    listed = F.aggregate("top_features", F.lit(0.0), lambda s, e: s + e["contribution"])
    total = F.col("baseline") + listed + F.col("other_features_contribution")
    rate = F.filter("top_features", lambda e: e["feature"] == "Flow Bytes/s")
    shown = F.get(rate, F.lit(0))["raw_value"]
    return told.agg(
        F.count(F.lit(1)).alias("flows"),
        F.count_if(F.size("top_features") != k).alias("wrong_length"),
        F.count_if(F.sort_array(sizes, asc=False) != sizes).alias("unsorted"),
        F.count_if(
            F.exists("top_features", lambda e: (e["direction"] == "toward") != (e["contribution"] >= 0))
        ).alias("wrong_direction"),
        # parts are shown with 4 or 5 decimals
        F.count_if(F.abs(total - F.col("confidence")) > 1e-4).alias("wrong_total"),
        F.count_if((F.size(rate) > 0) & ~shown.eqNullSafe(finite(q("Flow Bytes/s")))).alias("wrong_raw"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from_flows = lambda call: lambda spark, sf_dir: call(flows(spark, sf_dir))
    from_events = lambda call: lambda spark, sf_dir: call(_events(spark, sf_dir))
    two, six = [0, 1], [*CLASSES, "Heartbleed"]
    metrics = {
        "confusion_matrix": evaluate.confusion_matrix,
        "confusion_normalised": evaluate.normalised_confusion,
        "per_class_metrics": evaluate.per_class_metrics,
        "overall_metrics": evaluate.overall_metrics,
    }
    return {
        "table_shape": from_flows(profile.table_shape),
        "missing_report": from_flows(profile.missing_report),
        "infinite_report": from_flows(profile.infinite_report),
        "duplicate_report": from_flows(profile.duplicate_report),
        "class_distribution": from_flows(profile.class_distribution),
        "clean_class_distribution": lambda spark, sf_dir: profile.class_distribution(_clean(spark, sf_dir)),
        "identifier_columns": from_flows(lambda df: _cells(df, identifier_columns(df.columns))),
        "remaining_columns": remaining_columns,
        "numeric_columns": numeric_column_list,
        "correlated_pairs": from_flows(lambda df: _round(correlation.correlated_pairs(df), ["correlation"], 9)),
        "all_pair_correlations": all_pair_correlations,
        "correlated_drop_list": correlated_drop_list,
        "variance_ranking": from_flows(lambda df: _round(profile.variance_ranking(df), ["variance"], 3)),
        "feature_histogram": feature_histogram,
        "clipped": clipped,
        "eda_summary": eda_summary,
        "drop_classes": drop_classes,
        "removed_class_counts": from_flows(lambda df: cleaning.removed_class_counts(df, TARGET, ["heartbleed", "DoS Hulk "])),
        "dedup": from_flows(cleaning.deduplicate),
        "clean_infinities": clean_infinities,
        "features_and_target": features_and_target,
        "label_codes": label_codes,
        "split_quota": split_quota,
        "stratified_split": stratified_split,
        "train_medians": train_medians,
        "scaler_state": scaler_state,
        "imputed": imputed,
        "scaled_test": scaled_test,
        "prepared_train": prepared_train,
        "unscaled": unscaled,
        "preparation_summary": summary_of_preparation,
        "class_weights": from_flows(lambda df: _weights(df, TARGET)),
        "class_weights_labels": lambda spark, sf_dir: _weights(read_table(spark, sf_dir, "labels"), "quality"),
        "row_weights": row_weights,
        "smote_class_counts": smote_class_counts,
        "smote_bounds": smote_bounds,
        "subsample": subsample,
        "per_class_sample": per_class_sample,
        "per_class_sample_vectors": lambda spark, sf_dir: selection.per_class_sample(
            read_table(spark, sf_dir, "embeddings").select("vec_id", "label"), "label", 3, "vec_id"
        ),
        "first_per_class": lambda spark, sf_dir: selection.first_per_class(
            read_table(spark, sf_dir, "embeddings").select("vec_id", "label"), "label", "vec_id", 2
        ),
        "replay_order": replay_order,
        "coerce_features": coerce_features,
        "raw_values": raw_values,
        "score_input": score_input,
        "required_features": required_features,
        **{name: _metric(call, _label_pairs, two) for name, call in metrics.items()},
        **{f"flow_{name}": _metric(call, _ruled, six) for name, call in metrics.items()},
        "low_support": _metric(evaluate.low_support, _ruled, six),
        "rf_score_invariants": _invariants(lambda s, d: _trained(s, d).bundles[models.FOREST]),
        "gbt_score_invariants": _invariants(lambda s, d: _trained(s, d).bundles[models.BOOSTED]),
        "softmax_score_invariants": _invariants(lambda s, d: _softmax(s, d)[0].best),
        "softmax_boosting": softmax_boosting,
        "softmax_round_trip": softmax_round_trip,
        "weighted_rf_invariants": _invariants(_weighted_forest),
        "rf_importances": rf_importances,
        "model_comparison": model_comparison,
        "best_model": best_model,
        "model_info": model_info,
        "decoded_labels": decoded_labels,
        "bundle_round_trip": bundle_round_trip,
        "batch_summary": from_events(scoring.batch_summary),
        "recent_predictions": recent_predictions,
        "log_stats": from_events(prediction_log.class_counts),
        "log_totals": log_totals,
        "session_summary": session_summary,
        "attack_flags": from_events(lambda df: df.select("event_id", "is_attack")),
        "outcome_flags": outcome_flags,
        "csv_load": csv_load,
        "prepared_round_trip": prepared_round_trip,
        "state_round_trip": state_round_trip,
        "absent_log": absent_log,
        "stored_reports": stored_reports,
        "log_round_trip": log_round_trip,
        "stream_scores_match_batch": stream_scores_match_batch,
        "stream_parity": stream_parity,
        "stream_class_counts": stream_class_counts,
        "stream_log_rows": stream_log_rows,
        "stream_session_summary": stream_session_summary,
        "explain_additivity": explain_additivity,
        "explain_topk": explain_topk,
    }
