import warnings

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowmill.functions.columns import numeric_columns, q
from flowmill import session
from flowmill.operators import cleaning, models, selection
from flowmill.plans.prepare import CODE, ROW_KEY, fit_state, preparation_summary, prepare
from flowmill.plans import summaries
from flowmill.plans.train import train_and_compare
from flowmill.sources import files


def flow_table(flows=60):
    """Flows with two identifier columns, one number given in two units, a hole, an infinity and one row twice."""
    rows = []
    for i in range(flows):
        pace, span = (i * i * 7 + 3 * i) % 53 / 4, float((i * 29) % 47)
        if i == 11:
            span = float("inf")
        elif i == 20:
            span = float("nan")
        rows.append((f"flow-{i:04d}", f"10.0.{i % 5}.7", pace, span, "DoS" if i % 2 else "BENIGN", pace * 1000 + 5))
    rows.append(rows[flows // 3 + 5])
    return pd.DataFrame(rows, columns=["Flow ID", "Source IP", "pace", "span", "Label", "pace in ms"])


def labelled(spark, counts, noise=""):
    rows = [(i, label) for label, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "f int, Label string")


def test_drop_classes_trims_and_folds(spark):
    df = labelled(spark, {"A": 6, "B": 3, " rare ": 1, "RARE": 2})
    kept, removed = cleaning.drop_classes(df, "Label", ["Rare"])
    assert kept.count() == 9 and removed == {"rare": 1, "RARE": 2}


def test_drop_classes_edge_cases(spark):
    df = labelled(spark, {"A": 6, "B": 3, "C": 1})
    with pytest.warns(UserWarning, match="no rows of class Z"):
        kept, removed = cleaning.drop_classes(df, "Label", ["Z"])
    assert kept.count() == 10 and removed == {}
    for nothing in ([], None):
        assert cleaning.drop_classes(df, "Label", nothing) == (df, {})
    with pytest.raises(ValueError, match="two are needed"):
        cleaning.drop_classes(df, "Label", ["B", "C"])


def test_null_label_reads_as_nan_text(spark):
    df = spark.createDataFrame([(1, None), (2, "A"), (3, "B")], "f int, Label string")
    assert cleaning.drop_classes(df, "Label", ["nan"])[1] == {"nan": 1}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert cleaning.drop_classes(df, "Label", ["C"])[0].count() == 3


def test_dedup_and_identifiers(spark):
    df = spark.createDataFrame(flow_table())
    unique = cleaning.deduplicate(df)
    assert unique.count() == 60
    rest, dropped = cleaning.drop_identifier_columns(unique, "Label")
    assert dropped == ["Flow ID", "Source IP"] and "Flow ID" not in rest.columns
    kept, none = cleaning.drop_identifier_columns(df.select("Flow ID", "pace"), "Flow ID")
    assert none == [] and kept.columns == ["Flow ID", "pace"]


def test_medians_and_imputation(spark):
    df = spark.createDataFrame(
        [(1.0, None, 4), (3.0, None, None), (float("inf"), None, 8), (float("nan"), None, 8)], "a double, e double, i int"
    )
    medians = cleaning.column_medians(df)
    assert medians == {"a": 2.0, "e": None, "i": 8.0}
    with pytest.warns(UserWarning, match="no median"):
        filled = cleaning.impute(df, medians)
    assert [tuple(r) for r in filled.collect()] == [(1.0, 0.0, 4.0), (3.0, 0.0, 8.0), (2.0, 0.0, 8.0), (2.0, 0.0, 8.0)]


def test_quota_keeps_class_shares():
    assert selection.split_quota({"a": 50, "b": 30, "c": 20}, 0.2) == {"a": 10, "b": 6, "c": 4}
    assert sum(selection.split_quota({"a": 7, "b": 5, "c": 3}, 0.2).values()) == 3
    with pytest.raises(ValueError, match="fewer than 2 rows"):
        selection.split_quota({"a": 50, "b": 1})


@pytest.mark.parametrize("ranked_rows", [500_000, 3])
def test_split_is_exact_and_independent_of_partitions(spark, ranked_rows):
    df = spark.range(1000).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("Label")
    )
    sides = []
    for n in (1, 16):
        part = df.repartition(n)
        split = selection.stratified_split(part, "Label", "id", 0.2, 42, ranked_rows=ranked_rows)
        test = split.test(part)
        assert {r["Label"]: r["count"] for r in test.groupBy("Label").count().collect()} == {"rare": 20, "common": 180}
        assert split.train(part).count() == 800
        sides.append({r["id"] for r in test.collect()})
    assert sides[0] == sides[1]
    other = selection.stratified_split(df, "Label", "id", 0.2, 43)
    assert {r["id"] for r in other.test(df).collect()} != sides[0]


def test_split_by_whole_row_needs_no_key(spark):
    df = labelled(spark, {"A": 50, "B": 30})
    split = selection.stratified_split(df)
    assert split.test(df).count() == 16


def test_split_refuses_a_key_that_repeats(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("key"), F.lit("A").alias("Label")).unionByName(
        spark.range(100).select((F.col("id") % 2).alias("key"), F.lit("B").alias("Label"))
    )
    with pytest.raises(ValueError, match="not unique"):
        selection.stratified_split(df, "Label", "key")
    with pytest.raises(ValueError, match="share one key"):
        selection.stratified_split(df, "Label", "key", ranked_rows=5)


def test_unlabelled_rows_cannot_be_split(spark):
    df = spark.createDataFrame([(1, "A"), (2, "A"), (3, None)], "f int, Label string")
    with pytest.raises(ValueError, match="no label"):
        selection.stratified_split(df)


def test_samples_per_class(spark):
    rows = [(i, c) for c, n in {0: 50, 1: 30, 2: 2}.items() for i in range(n)]
    df = spark.createDataFrame(rows, "i int, y int")
    picked = selection.per_class_sample(df, "y", 5, classes=[0, 1, 2, 3]).collect()
    assert [r["y"] for r in picked] == [0] * 5 + [1] * 5 + [2] * 2
    again = selection.per_class_sample(df.repartition(7), "y", 5).collect()
    assert picked == again
    assert {r["y"] for r in selection.per_class_sample(df, "y", 1, only=[1]).collect()} == {1}
    assert selection.per_class_sample(df, "y", 1, only=[3], classes=[0, 1, 2, 3]).count() == 0
    with pytest.raises(ValueError, match="unknown class"):
        selection.per_class_sample(df, "y", 1, only=[9])


def test_first_rows_per_class(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "i int, y int").repartition(5)
    got = sorted(tuple(r) for r in selection.first_per_class(df, "y", "i", 2).collect())
    assert got == [(0, 0), (1, 1), (2, 2), (3, 0), (4, 1), (5, 2)]


def test_many_first_rows_per_class(spark, monkeypatch):
    monkeypatch.setattr(selection, "SALTS", (7, 3))
    df = spark.range(400).select("id", (F.col("id") % 2).alias("y")).repartition(5)
    assert sorted(r["id"] for r in selection.first_per_class(df, "y", "id", 50).collect()) == list(range(100))


def test_subsample_is_exact_or_nothing(spark):
    df = spark.range(500)
    for n in (None, 500, 900):
        assert selection.subsample(df, n, "id").count() == 500
    assert selection.subsample(df, 123, "id", ranked_rows=2).count() == 123
    assert selection.subsample(df, 0, "id").count() == 0
    few, same = selection.subsample(df, 7, "id"), selection.subsample(df.repartition(9), 7, "id")
    assert {r[0] for r in few.collect()} == {r[0] for r in same.collect()}


def test_replay_order(spark):
    df = spark.range(20)
    shuffled = [r[0] for r in selection.replay_order(df, 5, "id").collect()]
    assert len(shuffled) == 5 and shuffled == [r[0] for r in selection.replay_order(df.repartition(4), 5, "id").collect()]
    assert [r[0] for r in selection.replay_order(df, None, "id").collect()] != list(range(20))
    assert [r[0] for r in selection.replay_order(df, 3, "id", shuffle=False).collect()] == [0, 1, 2]


def test_whole_chain(spark):
    p = prepare(spark.createDataFrame(flow_table()), dropped_classes=None, balancing="none")
    assert p.state.dropped_identifiers == ("Flow ID", "Source IP")
    assert p.state.dropped_correlated == ("pace",)
    assert p.state.feature_columns == ["span", "pace in ms"]
    assert p.duplicates_removed == 1 and p.rows_after_dedup == 60
    train, test = p.train.toPandas(), p.test.toPandas()
    assert len(train) == 48 and len(test) == 12
    assert not set(train[ROW_KEY]) & set(test[ROW_KEY])
    values = train[["span", "pace in ms"]].to_numpy()
    assert np.allclose(values.mean(axis=0), 0) and np.allclose(values.std(axis=0), 1)
    assert set(zip(train["Label"], train[CODE])) == {("BENIGN", 0), ("DoS", 1)}
    s = preparation_summary(p).first()
    assert s["train_rows_before_balancing"] == 48 and s["test_rows"] == 12 and s["total_feature_count"] == 3


def test_balanced_rows_are_counted_and_written_once(spark, folder):
    df = spark.createDataFrame(flow_table(80)).withColumn("Label", F.when(q("Flow ID") < "flow-0020", "DoS").otherwise("BENIGN"))
    p = prepare(df, dropped_classes=None, balancing="smote")
    s = preparation_summary(p).first()
    assert s["train_rows_after_balancing"] == p.train.count() == 2 * 48 > s["train_rows_before_balancing"]
    assert "FileScan" in p.train._jdf.queryExecution().toString() and "CoGroup" not in p.train._jdf.queryExecution().toString()
    one = df.where((q("Label") == "BENIGN") | (q("Flow ID") < "flow-0002"))
    with pytest.warns(UserWarning, match="skipped"):
        alone = prepare(one, dropped_classes=None, balancing="smote", on_singleton="skip", test_size=0.4)
    assert preparation_summary(alone).first()["train_rows_after_balancing"] == alone.unbalanced_train.count()
    weighted = prepare(df, dropped_classes=None, balancing="class_weight")
    assert weighted.state.balancing == "class_weight"


def test_intermediate_tables_go_with_their_scope(spark):
    with session.scratch(spark):
        path = session.new_path(spark, "probe")
        spark.range(3).write.parquet(path)
        assert files.exists(spark, path)
    assert not files.exists(spark, path)
    kept = session.new_path(spark, "probe")
    with session.scratch(spark):
        pass
    spark.range(3).write.parquet(kept)
    assert files.exists(spark, kept)
    files.delete(spark, kept)


def test_constant_column_scales_by_one(spark):
    df = spark.createDataFrame([(0.1, float(i), "A") for i in range(9)], "k double, x double, Label string")
    state = fit_state(df, "Label", ["A"], ["k", "x"])
    assert [f.scale for f in state.features][0] == 1.0
    out = state.apply(spark.createDataFrame([(2.1, 4.0)], "k double, x double")).first()
    assert out["k"] == pytest.approx(2.0) and out["x"] == 0.0


def test_state_learns_nothing_from_the_test_side(spark):
    df = spark.createDataFrame(flow_table(200).drop_duplicates())
    p = prepare(df, dropped_classes=None, balancing="none", key="Flow ID")
    names = numeric_columns(p.clean)
    spoiled = p.clean.select(
        *[F.when(p.split.is_test(), q(c) * 1000 + 7).otherwise(q(c)).alias(c) if c in names else q(c) for c in p.clean.columns]
    )
    again = fit_state(p.split.train(spoiled), "Label", p.state.classes, names, 0.9, p.state.dropped_identifiers)
    assert again == p.state
    leaking = fit_state(spoiled, "Label", p.state.classes, names, 0.9, p.state.dropped_identifiers)
    assert leaking != p.state  # the check can fail


def test_scaling_is_undone(spark):
    p = prepare(spark.createDataFrame(flow_table()), dropped_classes=None, balancing="none", key="Flow ID")
    back = {r[ROW_KEY]: r["pace in ms"] for r in p.test.select(ROW_KEY, *p.state.unscaled_columns()).collect()}
    for r in p.split.test(p.clean).collect():
        assert back[r[ROW_KEY]] == pytest.approx(r["pace in ms"])


def test_dedup_after_identifiers_removes_more(spark):
    pdf = flow_table()
    twin = pdf.iloc[[5]].assign(**{"Flow ID": "other"})
    df = spark.createDataFrame(pd.concat([pdf, twin], ignore_index=True))
    assert prepare(df, dropped_classes=None, balancing="none").rows_after_dedup == 61
    assert prepare(df, dropped_classes=None, balancing="none", dedup_after_id_drop=True).rows_after_dedup == 60


def test_one_form_of_lookup_for_few_and_many_classes(spark):
    df = spark.createDataFrame([(i % 130 if i < 260 else None, f"{i:03d}") for i in range(270)], "g int, h string")
    for many in (3, 130):
        cuts = {g: selection.EVERYTHING for g in range(many)}
        assert df.where(selection.below_cut(F.col("g"), F.col("h"), cuts)).count() == 2 * many
        assert df.where(~selection.below_cut(F.col("g"), F.col("h"), cuts)).count() == 270 - 2 * many
    plan = df.where(selection.below_cut(F.col("g"), F.col("h"), {1: "100"}))
    assert plan.count() == 1


def test_a_column_with_too_many_values_has_no_classes(spark, monkeypatch):
    monkeypatch.setattr(selection, "MAX_CLASSES", 5)
    df = spark.range(20).select("id", F.col("id").cast("string").alias("y"))
    with pytest.raises(ValueError, match="too many for classes"):
        selection.class_counts(df, "y")
    with pytest.raises(ValueError, match="too many for classes"):
        cleaning.label_counts(df, "y", 5)


def test_many_classes(spark):
    df = spark.range(1200).select(F.col("id"), F.format_string("c%03d", F.col("id") % 120).alias("Label"))
    split = selection.stratified_split(df, "Label", "id")
    sizes = {r["Label"]: r["count"] for r in split.test(df).groupBy("Label").count().collect()}
    assert len(sizes) == 120 and set(sizes.values()) == {2}
    assert split.train(df).count() == 960


def test_reports_of_a_run(spark, folder):
    df = spark.createDataFrame(flow_table(120)).withColumn("span", q("span") + F.when(q("Label") == "DoS", 90.0).otherwise(0.0))
    p = prepare(df, dropped_classes=None, balancing="none", key="Flow ID")
    trained = train_and_compare(p.train, p.test, p.state, [models.FOREST], {models.FOREST: {"trees": 4, "max_depth": 3}})
    summaries.write_reports(summaries.run_reports(p, trained, per_class=2), folder)
    got = {name: summaries.read_report(spark, folder, name) for name in summaries.NAMES}
    assert got["preparation"].first()["test_rows"] == 24 and got["training"].first()["model"] == models.FOREST
    assert {r["label"]: r["support"] for r in got["class_metrics"].collect()} == {"BENIGN": 12, "DoS": 12}
    assert got["confusion"].agg(F.sum("n")).first()[0] == 24 and got["examples"].count() == 4
    assert summaries.read_report(spark, folder, "other") is None
