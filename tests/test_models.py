import itertools
import math
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowmill.functions.columns import q
from flowmill.operators import evaluate, explain, models, scoring
from flowmill.plans.prepare import CODE, ROW_KEY, Feature, PrepState
from flowmill.plans.explain_examples import explained_examples
from flowmill.plans.train import train_and_compare, training_summary
from flowmill.sources import files

CLASSES = ("BENIGN", "DoS A", "DoS B")
NAMES = ["f 1", "f/2", "f.3"]
STATE = PrepState(
    "Label", CLASSES, (Feature("f 1", 1.0, 1.0, 2.0), Feature("f/2", 0.5, 0.0, 1.0), Feature("f.3", None, 0.0, 1.0))
)
PARAMS = {models.FOREST: {"trees": 8, "max_depth": 4}, models.BOOSTED: {"rounds": 3, "max_depth": 3}}


def separable(spark, n=300, classes=3, seed=0):
    rng = np.random.default_rng(seed)
    y = np.arange(n) % classes
    pdf = pd.DataFrame({"f 1": y + rng.normal(0, 0.2, n), "f/2": rng.normal(size=n), "f.3": rng.normal(size=n)})
    pdf.insert(0, CODE, y.astype("int32"))
    pdf.insert(0, "Label", [CLASSES[i] for i in y])
    pdf.insert(0, ROW_KEY, [f"r{i:04d}" for i in range(n)])
    return spark.createDataFrame(pdf)


@pytest.fixture(scope="module")
def trained(spark):
    return train_and_compare(separable(spark), separable(spark, 90, seed=1), STATE, params=PARAMS)


def test_both_models_learn_separable_data(trained):
    rows = {r["model"]: r for r in trained.comparison.collect()}
    assert set(rows) == {models.FOREST, models.BOOSTED}
    assert all(r["accuracy"] > 0.8 and r["macro_f1"] > 0.8 for r in rows.values())
    assert all(s > 0 for s in trained.seconds.values())
    top = max(rows.values(), key=lambda r: round(r["macro_f1"], 4))
    assert round(rows[trained.best.name]["macro_f1"], 4) == round(top["macro_f1"], 4)


def test_first_configured_model_wins_a_tie(spark):
    table = spark.createDataFrame([(0, "b", 0.9, 0.9, 0.9), (1, "a", 0.9, 0.9, 0.9)], "position int, model string, accuracy double, macro_f1 double, weighted_f1 double")
    assert evaluate.best_model(table) == "b"
    with pytest.raises(ValueError, match="unknown selection metric"):
        evaluate.best_model(table, "speed")


def test_unknown_model_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown model 'svm'"):
        train_and_compare(separable(spark, 30), separable(spark, 30), STATE, ["svm"])


def test_validation_share_and_row_limit(spark):
    got = train_and_compare(
        separable(spark), separable(spark, 90, seed=1), STATE, [models.FOREST], PARAMS, max_train_rows=150,
        class_weight=True, validation_share=0.2,
    )
    assert got.counts[models.FOREST].agg(F.sum("n")).first()[0] == 90
    assert got.comparison.first()["accuracy"] > 0.8


def test_class_weights_follow_from_the_preparation(spark):
    weighted = replace(STATE, balancing="class_weight")
    got = train_and_compare(separable(spark, 60), separable(spark, 30, seed=1), weighted, [models.FOREST], PARAMS)
    assert got.class_weight and got.train_rows == 60
    assert not train_and_compare(separable(spark, 60), separable(spark, 30, seed=1), weighted, [models.FOREST], PARAMS, class_weight=False).class_weight


def test_training_summary(spark, trained, folder):
    table = training_summary(trained, 2)
    rows = {r["model"]: r for r in table.collect()}
    best = [m for m, r in rows.items() if r["is_best"]]
    assert set(rows) == set(trained.bundles) and best == [trained.best.name]
    for name, r in rows.items():
        want = next(x for x in trained.comparison.collect() if x["model"] == name)
        assert r["macro_f1"] == want["macro_f1"] and r["train_rows"] == 300 and r["seconds"] > 0
        assert r["top_features"][0]["feature"] == "f 1" and len(r["top_features"]) == 2
    files.write_json(table, folder + "/summary")
    assert files.read_json(spark, folder + "/summary", table.schema).count() == 2


def test_examples_are_explained_with_their_class(spark, trained):
    test = separable(spark, 60, seed=2)
    told = explained_examples(test, trained.best, STATE, per_class=2, top_k=2).collect()
    assert [r["true_class"] for r in told] == sorted([*CLASSES] * 2)
    raw = {r[ROW_KEY]: r for r in test.select(ROW_KEY, *STATE.unscaled_columns()).collect()}
    for r in told:
        assert len(r["top_features"]) == 2
        for f in r["top_features"]:
            assert f["raw_value"] == pytest.approx(raw[r[ROW_KEY]][f["feature"]])
    assert {r["true_class"] for r in explained_examples(test, trained.best, STATE, only=["DoS A"]).collect()} == {"DoS A"}


def test_large_models_are_explained_in_slices(spark, trained, monkeypatch):
    test = separable(spark, 20, seed=5)
    for bundle in trained.bundles.values():
        whole = {r[ROW_KEY]: r for r in explain.attributions(test, bundle, [ROW_KEY]).collect()}
        sets, _ = explain.model_leaves(spark, bundle.model)
        third = sum(a.nbytes for leaves in sets for arrays in leaves for a in arrays) // 3
        parts = explain.sliced(sets, third)
        assert len(parts) > 2
        for place, leaves in enumerate(sets):
            assert sum(len(a[0]) for a in leaves) == sum(len(a[0]) for part in parts for a in part[place])
        with monkeypatch.context() as m:
            m.setattr(explain, "SLICE_BYTES", third)
            for r in explain.attributions(test, bundle, [ROW_KEY]).collect():
                assert np.allclose(r["contributions"], whole[r[ROW_KEY]]["contributions"])


def test_importances(spark, trained):
    for bundle in trained.bundles.values():
        table = models.feature_importances(bundle.model, NAMES, spark).collect()
        assert table[0]["feature"] == "f 1" and sum(r["importance"] for r in table) == pytest.approx(1, abs=1e-3)
        assert models.feature_importances(bundle.model, NAMES, spark, 1).count() == 1
    assert models.feature_importances(object(), NAMES, spark).count() == 0


def test_bundle_round_trip(spark, trained, folder):
    with pytest.raises(FileNotFoundError, match="no model bundle"):
        models.load_bundle(spark, folder + "/none")
    for name, bundle in trained.bundles.items():
        models.save_bundle(spark, bundle, f"{folder}/{name}")
        back = models.load_bundle(spark, f"{folder}/{name}")
        assert (back.name, back.feature_columns, back.class_names) == (name, NAMES, list(CLASSES))
        test = separable(spark, 60, seed=2)
        same = scoring.score_parity(
            scoring.predictions(test, bundle, [ROW_KEY]), scoring.predictions(test, back, [ROW_KEY]), ROW_KEY
        )
        assert tuple(scoring.parity_counts(same).first()) == (60, 60, 0)


# --- evaluation ---


def outcomes(spark):
    rows = [("a", "a")] * 8 + [("a", "b")] * 2 + [("b", "b")] * 5 + [("b", "a")] * 1 + [(None, "a")]
    return spark.createDataFrame(rows, "label string, prediction string")


def test_metrics_with_an_absent_class(spark):
    rows = {r["label"]: r for r in evaluate.per_class_metrics(outcomes(spark), "label", "prediction", ["a", "b", "c"]).collect()}
    assert rows["a"]["precision"] == pytest.approx(8 / 9) and rows["a"]["recall"] == pytest.approx(0.8)
    assert rows["b"]["f1"] == pytest.approx(2 * 5 / (7 + 6))
    assert tuple(rows["c"])[1:] == (0.0, 0.0, 0.0, 0)
    total = evaluate.overall_metrics(outcomes(spark), "label", "prediction", ["a", "b", "c"]).first()
    assert total["accuracy"] == pytest.approx(13 / 16)
    assert total["macro_f1"] == pytest.approx((rows["a"]["f1"] + rows["b"]["f1"]) / 3)
    assert (total["unscored"], total["unlabelled"]) == (0, 1)
    silent = outcomes(spark).union(spark.createDataFrame([("a", None)] * 4, "label string, prediction string"))
    told = evaluate.overall_metrics(silent, "label", "prediction", ["a", "b", "c"]).first()
    assert told["accuracy"] == pytest.approx(13 / 20) and told["unscored"] == 4
    assert total["weighted_f1"] == pytest.approx((rows["a"]["f1"] * 10 + rows["b"]["f1"] * 6) / 16)


def test_confusion_keeps_class_order_and_zero_rows(spark):
    cells = [tuple(r) for r in evaluate.confusion_matrix(outcomes(spark), "label", "prediction", ["a", "b", "c"]).collect()]
    assert cells[:4] == [("a", "a", 8), ("a", "b", 2), ("a", "c", 0), ("b", "a", 1)] and len(cells) == 9
    shares = evaluate.normalised_confusion(outcomes(spark), "label", "prediction", ["a", "b", "c"]).collect()
    assert [r["share"] for r in shares if r["label"] == "c"] == [0.0, 0.0, 0.0]
    assert sum(r["share"] for r in shares if r["label"] == "a") == pytest.approx(1)


def test_low_support_leaves_out_absent_classes(spark):
    got = evaluate.low_support(outcomes(spark), "label", "prediction", ["a", "b", "c"], 10)
    assert [tuple(r) for r in got.collect()] == [("b", 6)]


# --- scoring ---


def requests(spark):
    rows = [
        ("r1", "0.0", 1.0, 3, "x"),
        ("r2", " 2.1 ", float("inf"), None, "y"),
        ("r3", "abc", float("nan"), 1, "z"),
        ("r4", None, None, 1, "z"),
    ]
    return spark.createDataFrame(rows, "id string, `f 1` string, `f/2` double, `f.3` int, extra string")


def test_score_input_repairs_every_kind_of_bad_cell(spark):
    ready = scoring.score_input(requests(spark), STATE, ["id"])
    assert ready.columns == ["id", *NAMES]
    got = {r["id"]: (r["f 1"], r["f/2"], r["f.3"]) for r in ready.collect()}
    assert got["r1"] == (-0.5, 1.0, 3.0)
    assert got["r2"] == (pytest.approx(0.55), 0.5, 0.0)  # infinity -> median, no median -> 0
    assert got["r3"] == (0.0, 0.5, 1.0) == got["r4"]


def test_scores_are_consistent(spark, trained):
    for bundle in trained.bundles.values():
        rows = scoring.score(requests(spark), bundle, STATE, ["id", "f 1"], decimals=None).collect()
        for r in rows:
            assert sum(r["probabilities"].values()) == pytest.approx(1)
            assert r["confidence"] == max(r["probabilities"].values()) == r["probabilities"][r["predicted_class"]]
            assert r["is_attack"] == (r["predicted_class"] != "BENIGN")
        assert scoring.batch_summary(scoring.score(requests(spark), bundle, STATE)).first()["count"] == 4


def test_benign_label_ignores_case(spark, trained):
    scored = scoring.score(requests(spark), trained.best, STATE, ["id"], benign="benign")
    assert all(r["is_attack"] == (r["predicted_class"] != "BENIGN") for r in scored.collect())


def test_a_feature_absent_from_all_rows_is_an_error(spark, trained):
    with pytest.raises(scoring.MissingFeatures, match="without the model's feature 'f/2'"):
        scoring.score(requests(spark).drop("f/2"), trained.best, STATE)
    assert len(str(scoring.MissingFeatures([f"f{i}" for i in range(1200)]))) < 120
    maps = spark.createDataFrame([({"f 1": "1"},), ({"f 1": "2"},)], "m map<string,string>")
    with pytest.raises(scoring.MissingFeatures) as told:
        scoring.from_maps(maps, "m", STATE)
    assert "f/2" in told.value.missing and "f 1" not in told.value.missing
    texts = spark.createDataFrame([('{"f 1": 1}',), ("no object",)], "j string")
    with pytest.raises(scoring.MissingFeatures):
        scoring.from_json(texts, "j", STATE)
    assert scoring.from_json(texts, "j", STATE, checked=False).count() == 2


def test_maps_and_json_rows(spark, trained):
    df = spark.createDataFrame(
        [("a", '{"f 1": 2.0, "f/2": "1", "other": 5}'), ("b", '{"f 1": null, "f.3": 7}')], "id string, body string"
    )
    got = scoring.from_json(df, "body", STATE, ["id"])
    assert [tuple(r) for r in got.orderBy("id").collect()] == [("a", "2.0", "1", None), ("b", None, None, "7")]
    assert scoring.score(got, trained.best, STATE, ["id"]).count() == 2
    maps = df.select(F.from_json("body", "map<string,string>").alias("m"))
    assert scoring.missing_in_maps(maps, "m", [*NAMES, "nowhere"]) == ["nowhere"]


def test_batch_guard(spark, trained):
    with pytest.raises(ValueError, match="too large"):
        scoring.score(requests(spark), trained.best, STATE, max_rows=3)
    with pytest.raises(ValueError, match="empty"):
        scoring.score(requests(spark).limit(0), trained.best, STATE, max_rows=3)


def test_state_and_model_must_agree(spark, trained):
    other = PrepState("Label", CLASSES, STATE.features[::-1])
    with pytest.raises(ValueError, match="differ"):
        scoring.score(requests(spark), trained.best, other)


def test_text_numbers(spark):
    texts = ["1", " 2.5e3 ", "-inf", "+Infinity", "NaN", "abc", "1d", "0x10", "", ".5", "5.", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["t"] for r in scoring.coerced(df, ["t"]).collect()]
    assert got[:4] == [1.0, 2500.0, float("-inf"), float("inf")] and np.isnan(got[4])
    assert got[5:] == [None, None, None, None, 0.5, 5.0, None]


def test_saturated_margins_keep_their_order(spark):
    class OnePerClass:
        pass

    margins = [[20.0, 25.0, 1.0], [-400.0, -500.0, -600.0], [0.3, 0.1, -2.0], [900.0, 900.0, -900.0]]
    df = spark.createDataFrame([(m, float(m.index(max(m)))) for m in margins], "raw array<double>, prediction double")
    scored = df.withColumn("rawPrediction", array_to_vector("raw"))
    rows = scored.select(models.probabilities(OnePerClass(), scored).alias("p"), scoring.best_code().alias("code")).collect()
    assert [r["code"] for r in rows] == [1, 0, 0, 0]
    assert all(sum(r["p"]) == pytest.approx(1) and max(r["p"]) == r["p"][r["code"]] for r in rows)
    plain = [1 / (1 + math.exp(-2 * m)) for m in margins[2]]
    assert rows[2]["p"] == pytest.approx([x / sum(plain) for x in plain])


def test_session_totals(spark):
    rows = [("BENIGN", "BENIGN", False), ("DoS", "DoS", True), ("DoS", "BENIGN", False)]
    df = spark.createDataFrame(rows, "t string, p string, a boolean")
    s = scoring.session_summary(df, "t", "p", "a", 2.0).first()
    assert (s["total_flows"], s["attacks_detected"], s["correct_predictions"]) == (3, 1, 2)
    assert s["accuracy_vs_true_label"] == 0.6667 and s["flows_per_second"] == 1.5
    assert s["predicted_class_counts"] == {"BENIGN": 2, "DoS": 1}
    assert scoring.session_summary(df, "t", "p", "a", 0.0).first()["flows_per_second"] is None
    none = scoring.session_summary(df.limit(0), "t", "p", "a", 1.0).first()
    assert none["total_flows"] == 0 and none["accuracy_vs_true_label"] == 0.0
    flags = [(r["is_correct"], r["is_missed"]) for r in scoring.outcome_flags(df, "t", "p").collect()]
    assert flags == [(True, False), (True, False), (False, True)]


# --- explanations ---


def brute_force(nodes, x, value):
    """Shapley values by enumerating all feature subsets of one tree."""
    by_id = {n.id: n for n in nodes.itertuples(index=False)}

    def expect(at, known):
        node = by_id[at]
        if node.left < 0:
            return value(node)
        if node.feature in known:
            return expect(node.left if x[node.feature] <= node.threshold else node.right, known)
        left, right = by_id[node.left], by_id[node.right]
        return (expect(node.left, known) * left.cover + expect(node.right, known) * right.cover) / node.cover

    n, out = len(x), np.zeros(len(x))
    from math import factorial

    for i in range(n):
        others = [j for j in range(n) if j != i]
        for size in range(n):
            for known in itertools.combinations(others, size):
                weight = factorial(size) * factorial(n - size - 1) / factorial(n)
                out[i] += weight * (expect(0, {*known, i}) - expect(0, set(known)))
    return out


def test_contributions_equal_brute_force(spark, trained):
    test = separable(spark, 12, seed=4)
    for name, bundle in trained.bundles.items():
        rows = explain.attributions(test, bundle, [ROW_KEY]).toPandas()
        for r in rows.itertuples():
            if name == models.FOREST:
                nodes = explain._node_table(spark, bundle.model) if r.Index == 0 else nodes
                nodes["cover"] = [float(np.sum(s)) for s in nodes["stats"]]
                weights = np.full(nodes["tree"].nunique(), 1 / nodes["tree"].nunique())
                value = lambda node: node.stats[r.code] / node.cover
            else:
                nodes = explain._node_table(spark, bundle.model.models[r.code])
                nodes["cover"] = [s[0] for s in nodes["stats"]]
                weights = bundle.model.models[r.code].treeWeights
                value = lambda node: node.prediction
            want = sum(
                weights[int(t)] * brute_force(tree, np.array(r.z), value) for t, tree in nodes.groupby("tree")
            )
            assert np.allclose(r.contributions, want, atol=1e-9)
            assert r.baseline + sum(r.contributions) == pytest.approx(r.output, abs=1e-9)
            if name == models.BOOSTED and r.Index >= 3:
                break


def test_explanation_agrees_with_the_score(spark, trained):
    df = requests(spark)
    for bundle in trained.bundles.values():
        told = {r["id"]: r for r in explain.explain(df, bundle, STATE, ["id", "f/2"], top_k=2).collect()}
        scored = {r["id"]: r for r in scoring.score(df, bundle, STATE, ["id"]).collect()}
        for name, r in told.items():
            assert r["predicted_class"] == scored[name]["predicted_class"]
            assert r["confidence"] == scored[name]["confidence"] and r["is_attack"] == scored[name]["is_attack"]
            sizes = [abs(f["contribution"]) for f in r["top_features"]]
            assert sizes == sorted(sizes, reverse=True) and len(sizes) == 2
            assert all(f["direction"] == ("toward" if f["contribution"] >= 0 else "against") for f in r["top_features"])
            total = r["baseline"] + sum(f["contribution"] for f in r["top_features"]) + r["other_features_contribution"]
            if bundle.name == models.FOREST:
                assert total == pytest.approx(r["confidence"], abs=1e-3) and r["explanation_space"] == "probability"
            else:
                assert r["explanation_space"] == "log-odds"


def test_top_k_is_clamped_and_raw_values_are_cleaned(spark, trained):
    df = requests(spark)
    assert {len(r["top_features"]) for r in explain.explain(df, trained.best, STATE, ["id"], top_k=0).collect()} == {1}
    full = {r["id"]: r for r in explain.explain(df, trained.best, STATE, ["id"], top_k=99).collect()}
    assert {len(r["top_features"]) for r in full.values()} == {3}
    raw = {name: {f["feature"]: f["raw_value"] for f in r["top_features"]} for name, r in full.items()}
    assert raw["r1"] == {"f 1": 0.0, "f/2": 1.0, "f.3": 3.0}
    assert raw["r2"] == {"f 1": 2.1, "f/2": None, "f.3": None}
    assert raw["r3"] == {"f 1": None, "f/2": None, "f.3": 1.0}
    assert all(r["other_features_contribution"] == 0.0 for r in full.values())


def test_a_shifted_contribution_breaks_additivity(spark, trained):
    rows = explain.attributions(separable(spark, 5), trained.best, [ROW_KEY])
    total = F.aggregate("contributions", F.col("baseline"), lambda a, b: a + b)
    shifted = F.aggregate(F.transform("contributions", lambda c: c + 0.01), F.col("baseline"), lambda a, b: a + b)
    assert rows.where(F.abs(total - F.col("output")) > 1e-6).count() == 0
    assert rows.where(F.abs(shifted - F.col("output")) > 1e-6).count() == 5


def test_model_facts(spark, trained):
    info = scoring.model_info(trained.bundles[models.FOREST], spark).first()
    assert info["feature_count"] == 3 and info["classes"] == list(CLASSES) and info["feature_columns"] == NAMES
    assert separable(spark, 3).select(scoring.decode(q(CODE), CLASSES)).distinct().count() == 3
