import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowmill.operators import balance, neighbours
from flowmill.operators.neighbours import nearest_in_class


def matrix(spark, counts, seed=0, width=2):
    rng = np.random.default_rng(seed)
    rows = [(f"k{c}-{i}", c, ord(c), *map(float, rng.normal(size=width))) for c, n in counts.items() for i in range(n)]
    names = [f"x{i}" for i in range(width)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["key", "y", "code", *names])), names


def points(n=900):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(n, 3)), 1)  # many equal distances
    x[: n // 3] = 0.0  # a third of all rows are the same point
    return x, np.where(np.arange(n) % 4 == 0, "a", "b"), np.array([f"k{i:04d}" for i in range(n)])


@pytest.mark.parametrize("limits", [{}, {"block_rows": 60, "query_rows": 25, "sample_rows": 200}])
def test_neighbours_equal_brute_force(spark, limits):
    x, g, keys = points()
    df = spark.createDataFrame(pd.DataFrame({"key": keys, "g": g, "v": list(x)})).repartition(6)
    counts = {c: int((g == c).sum()) for c in "ab"}
    got = nearest_in_class(df, "g", "key", "v", 3, 5, counts, **limits).toPandas().set_index("key")
    assert len(got) == len(x)
    for i, name in enumerate(keys):
        same = np.flatnonzero((g == g[i]) & (np.arange(len(x)) != i))
        d = ((x[same] - x[i]) ** 2).sum(axis=1)
        row = got.loc[name]
        assert np.allclose(row["distances"], np.sort(d)[:5])
        assert name not in row["keys"] and len(set(row["keys"])) == 5
        near = np.array(row["vectors"]).reshape(5, 3)
        for neighbour, vector, distance in zip(row["keys"], near, row["distances"]):
            at = int(neighbour[1:])
            assert g[at] == g[i] and np.array_equal(x[at], vector)
            assert ((vector - x[i]) ** 2).sum() == pytest.approx(distance)


def test_only_asked_rows_are_answered(spark):
    x, g, keys = points(200)
    df = spark.createDataFrame(pd.DataFrame({"key": keys, "g": g, "v": list(x)}))
    counts = {c: int((g == c).sum()) for c in "ab"}
    got = nearest_in_class(df, "g", "key", "v", 3, 2, counts, asks=F.col("key") < "k0010", block_rows=30)
    assert sorted(r["key"] for r in got.collect()) == [f"k{i:04d}" for i in range(10)]


def test_oversampling_evens_out_the_classes(spark):
    df, names = matrix(spark, {"a": 90, "b": 10, "c": 37})
    out = balance.balance(df, "y", "smote", names, "key")
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {"a": 90, "b": 90, "c": 90}
    assert out.columns == df.columns and out.select("key").distinct().count() == 270
    assert df.exceptAll(out).count() == 0  # originals are unchanged
    assert {(r["y"], r["code"]) for r in out.select("y", "code").distinct().collect()} == {(c, ord(c)) for c in "abc"}


def outside(made):
    """Synthetic rows that are not on the line between their base row and a neighbour."""
    z = F.arrays_zip(F.col("base").alias("a"), F.col("neighbour").alias("b"), F.col("vector").alias("v"))
    return made.where(
        F.exists(z, lambda e: F.abs(e["a"] + F.col("u") * (e["b"] - e["a"]) - e["v"]) > 1e-12)
        | (F.col("u") < 0)
        | (F.col("u") >= 1)
    ).count()


def test_synthetic_rows_lie_between_neighbours(spark):
    df, names = matrix(spark, {"a": 60, "b": 9})
    made = balance.synthetic_rows(df, "y", names, "key")
    assert made.count() == 51 and outside(made) == 0
    originals = {tuple(r["v"]) for r in df.where("y = 'b'").select(F.array(*names).alias("v")).collect()}
    rows = made.collect()
    assert {tuple(r["base"]) for r in rows} == originals and {tuple(r["neighbour"]) for r in rows} <= originals
    per_base = made.groupBy("base_key").count().toPandas()["count"]
    assert set(per_base) == {5, 6} and (per_base == 6).sum() == 51 % 9
    shifted = made.withColumn("vector", F.transform("vector", lambda v: v + 0.01))
    assert outside(shifted) == 51  # the check can fail


def test_oversampling_does_not_depend_on_partitions(spark):
    df, names = matrix(spark, {"a": 120, "b": 45})
    runs = [
        sorted(map(tuple, balance.balance(df.repartition(n), "y", "smote", names, "key", block_rows=10).collect())) for n in (1, 9)
    ]
    assert runs[0] == runs[1]


def test_many_copies_are_handed_out_in_portions(spark, monkeypatch):
    monkeypatch.setattr(balance, "COPIES_PER_ROW", 7)
    df, names = matrix(spark, {"a": 200, "b": 3})
    with pytest.warns(UserWarning, match="reduced from 5 to 2"):
        made = balance.synthetic_rows(df, "y", names, "key")
    assert made.count() == 197
    assert made.select("base_key", "copy").distinct().count() == 197


def test_single_row_class_is_an_error_unless_skipped(spark):
    df, names = matrix(spark, {"a": 20, "b": 1})
    with pytest.raises(ValueError, match="single row"):
        balance.balance(df, "y", "smote", names, "key")
    with pytest.warns(UserWarning, match="skipped"):
        assert balance.balance(df, "y", "smote", names, "key", on_singleton="skip").count() == 21


def test_other_columns_are_filled_only_where_a_class_agrees(spark):
    df, names = matrix(spark, {"a": 30, "b": 8})
    df = df.withColumn("code", F.when(F.col("y") == "a", 0).otherwise(1)).withColumn("port", F.col("key"))
    df = df.withColumn("gap", F.when(F.substring("key", -1, 1) == "1", F.lit(None)).otherwise("x"))
    made = balance.oversample(df, "y", names, "key").join(df.select("key"), "key", "left_anti")
    assert made.count() == 22
    assert [tuple(r) for r in made.select("code", "port", "gap").distinct().collect()] == [(1, None, None)]


def test_even_classes_stay_as_they_are(spark):
    df, names = matrix(spark, {"a": 12, "b": 12})
    assert balance.balance(df, "y", "smote", names, "key").count() == 24


def test_other_methods(spark):
    df, names = matrix(spark, {"a": 6, "b": 2})
    for method in ("none", "class_weight"):
        assert balance.balance(df, "y", method, names, "key") is df
    with pytest.raises(ValueError, match="unknown balancing method"):
        balance.balance(df, "y", "magic", names, "key")


def test_class_weights(spark):
    df, _ = matrix(spark, {"a": 6, "b": 2})
    assert {r["label"]: r["weight"] for r in balance.class_weights(df, "y").collect()} == {"a": 8 / 12, "b": 2.0}
    rows = balance.with_class_weight(df, "y").groupBy("y").agg(F.sum("class_weight").alias("w")).collect()
    assert all(r["w"] == pytest.approx(4.0) for r in rows)


def test_a_point_held_by_most_rows_is_visited_once(spark):
    """Copies of one point find each other in their own block and ask no other block."""
    n = 1200
    x = np.zeros((n, 2))
    x[:60] = np.random.default_rng(2).normal(size=(60, 2)) + 5
    df = spark.createDataFrame(pd.DataFrame({"key": [f"k{i:04d}" for i in range(n)], "g": "a", "v": list(x)}))
    got = nearest_in_class(df, "g", "key", "v", 2, 3, {"a": n}, block_rows=100, query_rows=50).toPandas().set_index("key")
    assert len(got) == n
    assert all(sum(d) == 0 for d in got.loc[[f"k{i:04d}" for i in range(60, n)], "distances"])
    for i in range(60):
        d = np.sort(((x - x[i]) ** 2).sum(axis=1))[1:4]
        assert np.allclose(got.loc[f"k{i:04d}", "distances"], d)


def test_probes_bound_the_visits_and_find_most_neighbours(spark):
    n, width, k = 1500, 46, 5
    draw = np.random.default_rng(7)
    x = draw.normal(size=(n, 6)) @ draw.normal(size=(6, width)) + 0.1 * draw.normal(size=(n, width))
    df = spark.createDataFrame(pd.DataFrame({"key": [f"k{i:04d}" for i in range(n)], "g": "a", "v": list(x)}))
    near = np.argsort(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2) + np.diag(np.full(n, np.inf)), axis=1)[:, :k]
    found = {}
    for probes in (None, 8, 2, 0):
        got = nearest_in_class(df, "g", "key", "v", width, k, {"a": n}, block_rows=60, query_rows=500, probes=probes)
        rows = got.select("key", "keys").collect()
        assert len(rows) == n
        hits = sum(len({f"k{j:04d}" for j in near[int(r["key"][1:])]} & set(r["keys"])) for r in rows)
        found[probes] = hits / (n * k)
    assert found[None] == 1.0 and 1.0 > found[8] > found[2] > found[0] and found[8] > 0.6, found


def test_bounds_leave_out_most_leaves_of_low_rank_features():
    """46 features that follow four directions: under a fifth of the leaves can hold a nearer row, and no neighbour is lost."""
    draw = np.random.default_rng(4)
    rows = draw.normal(size=(20_000, 4)) @ draw.normal(size=(4, 46)) + 1e-3 * draw.normal(size=(20_000, 46))
    shape = neighbours.Shape(rows[::7])
    tree = neighbours._grow(shape.turned(rows[::7]), 40)
    leaf = neighbours._descend(tree, shape.turned(rows))
    names = np.unique(leaf)
    told = shape.told(rows)
    low, high = (np.array([f(told[leaf == n], axis=0) for n in names]) for f in (np.min, np.max))
    asked = draw.choice(len(rows), 200, replace=False)
    apart = np.stack([((rows - rows[a]) ** 2).sum(axis=1) for a in asked])
    order = np.argsort(apart, axis=1)[:, 1:6]
    bound = np.take_along_axis(apart, order, axis=1)[:, -1]
    near = neighbours.reachable(told[asked], 46, low, high, bound, 1e-12 * np.abs(told).max() ** 2)
    assert len(names) > 60 and near.mean() < 0.2
    for r, found in enumerate(order):
        strictly = found[apart[r][found] < bound[r]]
        assert near[r][np.searchsorted(names, leaf[strictly])].all()
    boxes_only = neighbours.reachable(told[asked], 46, np.where(np.arange(78) < 46, low, -np.inf), np.where(np.arange(78) < 46, high, np.inf), bound, 0.0)
    assert near.sum() <= boxes_only.sum()
    assert not neighbours.reachable(told[asked], 46, low, high, np.zeros(len(asked)), 1.0).any()


def flow_points(n, seed=3):
    """Rows like those of a class of flows: two columns of few values, three that follow each other, one constant."""
    draw = np.random.default_rng(seed)
    quantity = draw.integers(1, 51, n).astype(float)
    price = quantity * draw.uniform(900, 2000, n)
    x = np.stack([quantity, price, price / quantity, draw.integers(0, 11, n), draw.integers(0, 9, n), np.ones(n)], axis=1).astype(float)
    return (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)


@pytest.mark.parametrize("same", [True, False])
def test_a_block_compares_only_near_tiles(monkeypatch, same):
    """The neighbours of a full comparison, without making one."""
    refs = flow_points(6_000)
    queries, k = refs if same else flow_points(1_500, 4), 5
    bound = np.full(len(queries), np.inf if same else 0.5)
    whole = neighbours._closest(queries, refs, np.arange(len(refs)), k, bound, same)
    compared, at = [], neighbours._closest
    monkeypatch.setattr(neighbours, "_closest", lambda *a, **b: compared.append(1) or at(*a, **b))
    found = neighbours.closest(queries, refs, k, bound, same)
    assert not compared
    assert all(np.array_equal(a, b) for a, b in zip(found, whole, strict=True))


def test_tiles_find_ties_copies_and_only_what_is_asked():
    draw = np.random.default_rng(5)
    for n, width, k in ((1, 2, 3), (40, 1, 5), (300, 3, 4), (700, 2, 5)):
        x = np.round(draw.normal(size=(n, width)), 1)
        x[: n // 2] = x[0]
        bound = np.where(draw.random(n) < 0.2, -np.inf, np.inf)
        row, ref, apart = neighbours.closest(x, x, k, bound, True)
        assert not np.isin(row, np.flatnonzero(bound < 0)).any() and (row != ref).all()
        for i in np.flatnonzero(bound > 0):
            d = np.delete(((x - x[i]) ** 2).sum(axis=1), i)
            assert np.allclose(apart[row == i], np.sort(d)[:k]) and len(set(ref[row == i])) == min(k, n - 1)


def test_without_near_tiles_a_block_is_compared_by_one_product(monkeypatch):
    """46 independent features: tiles would only add to the work."""
    x = np.random.default_rng(6).normal(size=(2_000, 46))
    compared, at = [], neighbours._closest
    monkeypatch.setattr(neighbours, "_closest", lambda *a, **b: compared.append(1) or at(*a, **b))
    row, ref, apart = neighbours.closest(x, x, 5, np.full(len(x), np.inf), True)
    assert compared == [1] and len(row) == 5 * len(x)


def test_leaves_are_seldom_divided():
    """Rows of a divided leaf all have to ask its other half: leaves leave room for chance."""
    x, size = flow_points(60_000), 2_000
    share = neighbours.SAMPLE_PER_BLOCK / size
    sample = x[: int(share * len(x))]
    tree = neighbours._grow(sample, int(neighbours.ROOM * size * share))
    _, held = np.unique(neighbours._descend(tree, x), return_counts=True)
    assert held[held > size].sum() < 0.1 * len(x)
