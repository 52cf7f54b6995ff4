import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowmill.functions.columns import identifier_columns
from flowmill.operators import profile
from flowmill.operators.correlation import correlated_drop_list, correlated_pairs, pair_correlations
from flowmill.operators.quantiles import exact_quantiles
from flowmill.plans.profile_report import profile_summary

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def messy(spark):
    rows = [
        (1.0, 2, "x", "A"),
        (NAN, 2, None, "A"),
        (None, 2, "x", "B"),
        (INF, None, "x", None),
        (-INF, 3, "x", "B"),
        (1.0, 2, "x", "A"),
    ]
    return spark.createDataFrame(rows, "f double, i int, s string, Label string")


def test_missing_counts_nan_and_null_but_not_infinity(messy):
    got = [tuple(r) for r in profile.missing_report(messy).collect()]
    assert got == [("f", 2, 33.333), ("Label", 1, 16.667), ("i", 1, 16.667), ("s", 1, 16.667)]


def test_infinite_counts_both_signs(messy):
    assert [tuple(r) for r in profile.infinite_report(messy).collect()] == [("f", 2)]


def test_duplicates_treat_nan_and_null_alike(spark):
    df = spark.createDataFrame([(NAN, "a"), (None, "a"), (NAN, "a"), (0.0, "a"), (-0.0, "a")], "f double, s string")
    assert tuple(profile.duplicate_report(df).first()) == (3, 60.0)


def test_duplicates_of_an_empty_table(spark):
    df = spark.createDataFrame([], "f double, s string")
    assert tuple(profile.duplicate_report(df).first()) == (0, 0.0)


def test_class_distribution_counts_unlabelled_rows_in_the_total(messy):
    got = [tuple(r) for r in profile.class_distribution(messy).collect()]
    assert got == [("A", 3, 50.0), ("B", 2, 33.333)]


def test_identifier_names_but_not_ports():
    names = ["Flow ID", "Source Port", " Src IP Addr", "DESTINATION IP", "Timestamp", "Protocol", "a"]
    assert identifier_columns(names) == ["Flow ID", " Src IP Addr", "DESTINATION IP", "Timestamp"]


def numbers(seed=0, n=400):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=n)
    df = pd.DataFrame({"a": a, "b": a * 2 + 1, "c": rng.normal(size=n) + a, "d": rng.normal(size=n) * 1e-3 + 1e3})
    df["const"], df["empty"] = 0.1, np.nan
    df.loc[df.index % 5 == 0, "c"] = np.nan
    df.loc[df.index % 7 == 0, "a"] = np.inf
    return df


def test_correlations_equal_pandas_pairwise_complete(spark):
    pdf = numbers()
    want = pdf.replace([np.inf, -np.inf], np.nan).corr().abs()
    df = spark.createDataFrame(pdf).repartition(5)
    for r in pair_correlations(df, list(pdf.columns)).collect():
        value = want.loc[r["feature_1"], r["feature_2"]]
        if r["correlation"] is None:
            assert np.isnan(value)
        else:
            assert r["correlation"] == pytest.approx(value, rel=1e-6, abs=1e-9)
    pairs = {(r["feature_1"], r["feature_2"]) for r in pair_correlations(df, list(pdf.columns)).collect()}
    assert not any("empty" in p for p in pairs) and ("a", "const") in pairs


def test_column_constant_on_the_shared_rows_has_no_correlation(spark):
    rows = [(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, None), (9.0, None)] + [(None, 7.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    assert pair_correlations(df, ["x", "y"]).first()["correlation"] is None


def test_correlated_pairs_are_ordered_and_limited(spark):
    df = spark.createDataFrame(numbers()).withColumn("Label", F.lit("x"))
    pairs = correlated_pairs(df, threshold=0.5).collect()
    assert (pairs[0]["feature_1"], pairs[0]["feature_2"]) == ("a", "b")
    assert {(r[0], r[1]) for r in pairs} == {("a", "b"), ("a", "c"), ("b", "c")}
    assert [r[2] for r in pairs] == sorted((r[2] for r in pairs), reverse=True)
    assert correlated_pairs(df, threshold=0.5, top_n=1).count() == 1


def test_dropped_columns_are_those_with_a_later_twin(spark):
    pdf = pd.DataFrame({"x": [1.0, 2, 3, 4], "y": [2.0, 4, 6, 8], "z": [1.0, -1, 1, -1], "w": [3.0, 6, 9, 12], "k": [1.0] * 4})
    assert correlated_drop_list(spark.createDataFrame(pdf), list(pdf.columns), 0.9) == ["x", "y"]


@pytest.mark.parametrize("limits", [{}, {"gather_values": 1, "bins": 3}, {"gather_values": 7, "bins": 2}])
def test_quantiles_equal_numpy(spark, limits):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(
        {
            "heavy": np.exp(rng.normal(size=301) * 8),
            "ties": rng.integers(0, 4, 301).astype(float),
            "wide": np.where(np.arange(301) % 2, 1e308, -1e308) * rng.random(301),
            "tiny": rng.integers(0, 3, 301) * 5e-324,
            "none": np.nan,
        }
    )
    pdf.loc[::9, "heavy"], pdf.loc[1::9, "ties"] = np.inf, np.nan
    probabilities = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf).repartition(3), list(pdf.columns), probabilities, **limits)
    for name in pdf.columns:
        clean = pdf[name].replace([np.inf, -np.inf], np.nan).dropna().to_numpy()
        for p in probabilities:
            if not len(clean):
                assert got[name][p] is None
            else:
                low, high = np.sort(clean)[[int(np.floor(p * (len(clean) - 1))), int(np.ceil(p * (len(clean) - 1)))]]
                assert low <= got[name][p] <= high
                assert got[name][p] == pytest.approx(np.quantile(clean, p), rel=1e-9, abs=1e-320)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "a double")
    assert exact_quantiles(df, ["a"], [0.5]) == {"a": {0.5: None}}
    assert exact_quantiles(df, [], [0.5]) == {}


def test_quantiles_of_heavy_tails_take_two_scans(spark, folder):
    rng = np.random.default_rng(11)
    n = 40_000
    pdf = pd.DataFrame({
        "tail": rng.standard_cauchy(n) ** 3,
        "spike": np.where(rng.random(n) < 0.6, 7.0, rng.lognormal(0, 30, n)),
        "zeros": np.where(rng.random(n) < 0.5, -0.0, 0.0),
    })
    spark.createDataFrame(pdf).repartition(6).write.parquet(folder + "/t")
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table = spark.read.parquet(folder + "/t")
    counted = table.mapInArrow(passed, table.schema)
    probabilities = [0.001, 0.25, 0.5, 0.99, 0.9999]
    got = exact_quantiles(counted, list(pdf.columns), probabilities, gather_values=20, bins=8)
    assert seen.value == 2 * n
    for name in pdf.columns:
        for p in probabilities:
            assert got[name][p] == pytest.approx(np.quantile(pdf[name], p), rel=1e-9)


def test_quantiles_survive_a_wrong_sketch(spark, monkeypatch):
    from flowmill.operators import quantiles

    df = spark.range(1000).select(F.col("id").cast("double").alias("a"))
    real = F.percentile_approx
    for shift in (-600.0, 600.0):
        monkeypatch.setattr(
            quantiles.F, "percentile_approx", lambda c, p, acc, by=shift: F.transform(real(c, p, acc), lambda x: x + by)
        )
        assert exact_quantiles(df, ["a"], [0.25, 0.5]) == {"a": {0.25: 249.75, 0.5: 499.5}}


def test_variance_ranking_is_the_sample_variance(spark):
    df = spark.createDataFrame([(1.0, 10.0, 5), (2.0, 30.0, 5), (INF, 20.0, 5)], "a double, b double, c int")
    assert [tuple(r) for r in profile.variance_ranking(df).collect()] == [("b", 100.0), ("a", 0.5), ("c", 0.0)]
    one = spark.createDataFrame([(1.0,)], "a double")
    assert profile.variance_ranking(one).collect() == []


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=997), [50.0, np.inf, np.nan]])
    df = spark.createDataFrame(pd.DataFrame({"x": x, "k": 3.0}))
    got = profile.feature_histogram(df, features=["x", "k"]).toPandas()
    clean = x[np.isfinite(x)]
    want, _ = np.histogram(np.minimum(clean, np.quantile(clean, 0.99)), bins=50)
    counts = got[got.feature == "x"].set_index("bin")["count"].reindex(range(50), fill_value=0)
    assert counts.tolist() == want.tolist()
    single = got[got.feature == "k"]
    assert single["count"].tolist() == [1000] and single["bin"].tolist() == [25]


def test_summary_reports_capped_and_real_pair_counts(spark, messy):
    pdf = numbers()
    df = spark.createDataFrame(pdf).withColumn("Label", F.lit("x"))
    s = profile_summary(df, threshold=0.5, top_n=1).first()
    assert s["high_correlation_pair_count"] == 1 and s["all_correlated_pairs"] == 3
    m = profile_summary(messy).first()
    assert m["row_count"] == 6 and m["class_distribution"] == {"A": 3, "B": 2}
    assert m["infinite_value_columns"] == ["f"] and m["duplicate_count"] == 1


def test_reports_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(numbers()).withColumn("Label", F.lit("x"))
    results = []
    for n in (1, 16):
        part = df.repartition(n)
        results.append(
            (
                [tuple(r) for r in profile.missing_report(part).collect()],
                tuple(profile.duplicate_report(part).first()),
                exact_quantiles(part, ["a", "c", "d"], [0.5, 0.99]),
                sorted(map(tuple, profile.feature_histogram(part, features=["a", "c"]).collect())),
            )
        )
    assert results[0] == results[1]


def test_both_bad_cell_reports_from_one_scan(spark):
    rows = [(1.0, None, "x"), (float("inf"), float("nan"), None), (None, None, "y")]
    df = spark.createDataFrame(rows, "a double, b double, c string")
    missing, infinite = profile.bad_cell_reports(df)
    assert missing.collect() == profile.missing_report(df).collect()
    assert infinite.collect() == profile.infinite_report(df).collect()
    assert [r["c"] for r in profile.first_rows(df, 2, "c").collect()] == [None, "x"] and profile.first_rows(df).count() == 3
