"""Softmax boosting against a plain version, and as a model of the library."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from flowmill.operators import explain, models, softmax_boosting
from flowmill.operators.softmax_boosting import SoftmaxModel

CLASSES = ["a", "b", "c"]
PARAMS = {"rounds": 4, "max_depth": 3, "max_bins": 16}


def table(n=600, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 4))
    x[:, 3] = draw.integers(0, 3, n)
    y = np.where(x[:, 0] + 0.3 * draw.normal(size=n) > 0.4, 2, (x[:, 1] * x[:, 0] > 0).astype(int))
    return x, y


def frame(spark, x, y, w=None):
    rows = [(*map(float, r), int(c), float(1.0 if w is None else v)) for r, c, v in zip(x, y, y if w is None else w)]
    return spark.createDataFrame(rows, "f0 double, f1 double, f2 double, f3 double, label_code int, w double").repartition(3)


def fitted(spark, x, y, params=PARAMS, w=None):
    df = frame(spark, x, y, w)
    data = df.select(models.feature_vector([F.col(f"f{i}") for i in range(4)]).alias("features"), F.col("label_code").cast("double").alias("label"), "w")
    return softmax_boosting.fit(data, len(CLASSES), params, "w" if w is not None else None)


def plain_margins(x, y, w, cuts, rounds, depth, rate=0.1, l2=1.0, least=1.0):
    """Margins and losses, one row mask per node."""
    margins, losses = np.zeros((len(x), 3)), []
    shares = lambda: np.exp(margins) / np.exp(margins).sum(axis=1, keepdims=True)
    loss = lambda: float((-np.log(shares()[np.arange(len(y)), y]) * w).sum() / w.sum())

    def grow(rows, g, h, level, out):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, None)
        if level < depth:
            for f in range(x.shape[1]):
                for cut in cuts[f]:
                    left = rows & (x[:, f] <= cut)
                    gl, hl = g[left].sum(), h[left].sum()
                    gr, hr = total_g - gl, total_h - hl
                    if hl >= least and hr >= least:
                        gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - total_g**2 / (total_h + l2)
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, cut))
        if best[1] is None:
            out[rows] = -rate * total_g / (total_h + l2)
        else:
            f, cut = best[1]
            grow(rows & (x[:, f] <= cut), g, h, level + 1, out)
            grow(rows & ~(x[:, f] <= cut), g, h, level + 1, out)

    for _ in range(rounds):
        losses.append(loss())
        p, step = shares(), np.zeros_like(margins)
        for k in range(3):
            grow(np.ones(len(x), bool), (p[:, k] - (y == k)) * w, 2 * p[:, k] * (1 - p[:, k]) * w, 0, step[:, k])
        margins += step
    return margins, losses + [loss()]


@pytest.mark.parametrize("weighted", [False, True])
def test_equals_a_plain_version(spark, weighted):
    x, y = table()
    w = np.where(y == 1, 3.0, 0.5) if weighted else np.ones(len(y))
    model = fitted(spark, x, y, w=w if weighted else None)
    margins, losses = plain_margins(x, y, w, model.cuts, 4, 3)
    assert np.allclose(model.margins(np.ascontiguousarray(x.T)), margins, atol=1e-9)
    assert np.allclose(model.losses, losses, atol=1e-9)
    assert all(b < a for a, b in zip(losses, losses[1:]))


def test_blocks_and_partitions_do_not_matter(spark, monkeypatch):
    x, y = table(300)
    one = fitted(spark, x, y)
    monkeypatch.setattr(softmax_boosting, "BLOCK_ROWS", 7)
    other = fitted(spark, x, y)
    assert [[t.feature for t in r] for r in one.rounds] == [[t.feature for t in r] for r in other.rounds]
    assert np.allclose(one.losses, other.losses, atol=1e-12)


def test_scores_explanations_and_storage(spark, tmp_path):
    x, y = table()
    df = frame(spark, x, y)
    features = [f"f{i}" for i in range(4)]
    model, _ = models.train_model(models.SOFTMAX, df, features, "label_code", CLASSES, {"rounds": 10, "max_depth": 4})
    bundle = models.Bundle(model, models.SOFTMAX, features, CLASSES)
    models.save_bundle(spark, bundle, str(tmp_path / "m"))
    again = models.load_bundle(spark, str(tmp_path / "m"))
    assert isinstance(again.model, SoftmaxModel) and models.model_name(again.model) == models.SOFTMAX
    vectors = df.select("label_code", *features, models.feature_vector([F.col(f) for f in features]).alias("features"))
    for m in (model, again.model):
        rows = m.transform(vectors).collect()
        assert sum(r["prediction"] == r["label_code"] for r in rows) > 0.8 * len(rows)
        for r in rows[:50]:
            want = m.margins(np.array([[r[f]] for f in features]))[0]
            assert np.allclose(r["rawPrediction"].toArray(), want) and abs(r["probability"].toArray().sum() - 1) < 1e-12
            assert r["prediction"] == want.argmax()
    told = explain.attributions(df.limit(60), again).collect()
    assert all(abs(r["baseline"] + sum(r["contributions"]) - r["output"]) < 1e-9 for r in told)
    ranked = models.feature_importances(again.model, features, spark).collect()
    assert abs(sum(r["importance"] for r in ranked) - 1) < 1e-3 and ranked[0]["feature"] in ("f0", "f1")


def test_odd_tables(spark):
    x, y = table(40)
    with pytest.raises(ValueError, match="no rows"):
        fitted(spark, x[:0], y[:0])
    with pytest.raises(ValueError, match="255"):
        fitted(spark, x, y, {"max_bins": 300})
    constant = np.zeros_like(x)
    model = fitted(spark, constant, y, {"rounds": 3, "max_depth": 2})
    assert all(f == -1 for trees in model.rounds for t in trees for f in t.feature)
    shares = np.exp(model.margins(constant[:1].T.copy())[0])
    assert (np.argsort(shares) == np.argsort(np.bincount(y, minlength=3))).all()


def test_blocks_lie_in_small_row_groups(spark, monkeypatch):
    """However many rows a task has: what writes and reads blocks holds a row group, and a batch, of about 16 MB at most."""
    written, bounds, at = [], [], softmax_boosting.materialize
    name = softmax_boosting.BATCH_BYTES[0]

    def spy(df, *told, **options):
        bounds.append(spark.conf.get(name, None))
        out = at(df, *told, **options)
        for file in out.inputFiles():
            groups = pq.ParquetFile(file.removeprefix("file:")).metadata
            written.extend(groups.row_group(i).total_byte_size for i in range(groups.num_row_groups))
        return out

    monkeypatch.setattr(softmax_boosting, "materialize", spy)
    rows = spark.range(0, 900_000, 1, 1).select(F.array(*[F.rand(i) for i in range(8)]).alias("x"), (F.col("id") % 3).cast("double").alias("label"))
    data = rows.select(models.array_to_vector("x").alias("features"), "label")
    before = spark.conf.get(name, None)
    model = softmax_boosting.fit(data, 3, {"rounds": 1, "max_depth": 1, "max_bins": 8})
    assert len(model.rounds) == 1 and sum(written) > 60_000_000
    assert max(written) < 20_000_000
    assert all(b is not None for b in bounds) and spark.conf.get(name, None) == before
