"""One boosted model per class, as Spark's gradient boosting fits it, for all classes in the same passes.

Spark fits the classes one after the other and keeps for each of them every row as an object, and its margins beside it:
more than the executors' memory on large tables, so that each pass reads them from disk. Here rows are binned once into the
blocks of ``softmax_boosting``, and a level of the trees of all classes takes one pass over them. Objective, split rule,
leaf values and weights of the trees are Spark's, and so are the fitted models.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, OneVsRest, OneVsRestModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import Identifiable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmill.operators.softmax_boosting import (
    BATCH_BYTES,
    BLOCK_FILES,
    FEATURES,
    LABEL,
    Tree,
    _advanced,
    _binned,
    _leaves,
    _unpacked,
)
from flowmill.session import materialize, scratch, setting

#: Rows from which Spark's trees choose their bins (its own rule), and the most bins of a byte.
SPLIT_ROWS, MOST_BINS = 10_000, 255


def _cuts_of(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Spark's rule: midpoints between all values, or those closest to equal shares of the rows."""
    different, at = np.unique(values, return_inverse=True)
    counts = np.bincount(at, weights, len(different))
    middles = different[:-1] / 2 + different[1:] / 2
    if len(middles) < bins:
        return middles
    reached, found, target = np.cumsum(counts), [], counts.sum() / bins
    stride = target
    for i in range(1, len(different)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found)


def _cuts(data: DataFrame, weight: str | None, rows: int, bins: int, seed: int) -> list[np.ndarray]:
    share = max(bins * bins, SPLIT_ROWS) / rows
    some = data if share >= 1 else data.sample(False, share, seed)
    table = some.select(vector_to_array(FEATURES).alias("x"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w")).toArrow()
    x, w = np.array(table["x"].to_pylist(), dtype=float), table["w"].to_numpy()
    return [_cuts_of(x[:, i], w, bins) for i in range(x.shape[1])]


def _sums(blocks: DataFrame, trees: list[Tree], active: list[list[int]], width: int, bins: int, first: bool) -> DataFrame:
    """(class, node, sums) of each task: weights, weighted residuals and their squares per feature and bin of active nodes."""
    grown = [(t.arrays(), np.array(t.bin)) for t in trees]
    slots = []
    for tree, nodes in zip(trees, active, strict=True):
        slot = np.full(len(tree.feature), -1)
        slot[nodes] = np.arange(len(nodes))
        slots.append(slot)
    schema = pa.schema([("class", pa.int32()), ("node", pa.int32()), ("sums", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = [np.zeros((3, len(nodes), width, bins)) for nodes in active], False
        for batch in batches:
            for labels, weights, x, margins in _unpacked(batch):
                seen = True
                for k, ((arrays, cuts), slot) in enumerate(zip(grown, slots, strict=True)):
                    if not len(active[k]):
                        continue
                    place = slot[_leaves(arrays, x, cuts)]
                    rows = np.flatnonzero(place >= 0)
                    held = x if len(rows) == len(place) else x[:, rows]
                    sign, w = np.where(labels[rows] == k, 1.0, -1.0), weights[rows]
                    with np.errstate(over="ignore"):  # a residual of 0 then
                        rest = sign if first else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margins[rows, k]))
                    told = (w, w * rest, w * rest * rest)
                    start = place[rows] * bins
                    for f in range(width):
                        at = start + held[f]
                        for third, values in enumerate(told):
                            sums[k][third, :, f] += np.bincount(at, values, len(active[k]) * bins).reshape(-1, bins)
        if seen:
            for k, nodes in enumerate(active):
                for i, node in enumerate(nodes):
                    row = (k, node, sums[k][:, i].tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    return blocks.mapInArrow(run, "class int, node int, sums binary")


_SPLIT = "class int, node int, feature int, bin int, gain double, n double, s double, q double, nl double, sl double, ql double"


def _variance(n, s, q):
    return (q - s * s / n) / n


def _best_splits(sums: DataFrame, width: int, bins: int) -> DataFrame:
    """The split of every (class, node) that lowers the variance most: of equal ones the first feature and the lowest bin."""
    names = [x.split(" ")[0] for x in _SPLIT.split(", ")]

    def choose(table: pa.Table) -> pa.Table:
        n, s, q = sum(np.frombuffer(x.as_py()) for x in table["sums"]).reshape(3, width, bins)
        nl, sl, ql = n.cumsum(axis=1), s.cumsum(axis=1), q.cumsum(axis=1)
        all_n, all_s, all_q = nl[0, -1], sl[0, -1], ql[0, -1]
        nr = n[:, ::-1].cumsum(axis=1)[:, ::-1] - n  # from the right, so that an empty side is exactly 0
        with np.errstate(divide="ignore", invalid="ignore"):  # of empty sides, which are no splits
            left, right = _variance(nl, sl, ql), _variance(nr, all_s - sl, all_q - ql)
            gain = _variance(all_n, all_s, all_q) - nl / all_n * left - nr / all_n * right
        gain[(nl <= 0) | (nr <= 0)] = -np.inf
        f, b = np.unravel_index(int(gain.argmax()), gain.shape)
        useful = gain[f, b] > 0
        row = (table["class"][0].as_py(), table["node"][0].as_py(), int(f) if useful else -1, int(b), float(gain[f, b]) if useful else 0.0)
        row += tuple(float(v) for v in (all_n, all_s, all_q, nl[f, b], sl[f, b], ql[f, b]))
        return pa.table({name: [value] for name, value in zip(names, row, strict=True)}).cast(
            pa.schema([(n, pa.int32() if n in ("class", "node", "feature", "bin") else pa.float64()) for n in names])
        )

    return sums.groupBy("class", "node").applyInArrow(choose, _SPLIT)


class _Built:
    """Spark's own objects for fitted trees."""

    def __init__(self, spark: SparkSession, cuts: list[np.ndarray]):
        self.gateway, self.cuts = spark.sparkContext._gateway, cuts
        self.ml = self.gateway.jvm.org.apache.spark.ml

    def doubles(self, values):
        out = self.gateway.new_array(self.gateway.jvm.double, len(values))
        for i, v in enumerate(values):
            out[i] = float(v)
        return out

    def node(self, tree: Tree, stats: dict, at: int = 0):
        n, s, q = stats[at]
        held = self.gateway.jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(self.doubles((n, s, q)), int(round(n)))
        told = (float(s / n), float(max(_variance(n, s, q), 0.0)))
        if tree.feature[at] < 0:
            return self.ml.tree.LeafNode(*told, held)
        f = tree.feature[at]
        split = self.ml.tree.ContinuousSplit(f, float(self.cuts[f][tree.bin[at]]))
        below = [self.node(tree, stats, tree.left[at] + side) for side in (0, 1)]
        return self.ml.tree.InternalNode(*told, float(tree.gain[at]), *below, split, held)

    def model(self, trees: list[tuple[Tree, dict]], weights: list[float], width: int) -> GBTClassificationModel:
        kind = self.ml.regression.DecisionTreeRegressionModel
        array = self.gateway.new_array(kind, len(trees))
        for i, (tree, stats) in enumerate(trees):
            array[i] = kind(Identifiable()._randomUID().replace("Identifiable", "dtr"), self.node(tree, stats), width)
        uid = GBTClassifier().uid
        return GBTClassificationModel(self.ml.classification.GBTClassificationModel(uid, array, self.doubles(weights), width, 2))


def fit(data: DataFrame, many: OneVsRest, weight: str | None = None) -> OneVsRestModel:
    """Fit ``many`` (one ``GBTClassifier`` per class) on ``data`` (features vector, label code)."""
    spark, binary = data.sparkSession, many.getClassifier()
    rounds, depth, rate, bins = binary.getMaxIter(), binary.getMaxDepth(), binary.getStepSize(), binary.getMaxBins()
    facts = data.agg(F.count(F.lit(1)).alias("rows"), F.max(LABEL).alias("last")).first()
    if not facts["rows"]:
        raise ValueError("no rows to train on")
    classes = int(facts["last"]) + 1
    with scratch(spark), setting(spark, *BATCH_BYTES):
        cuts = _cuts(data, weight, facts["rows"], min(bins, facts["rows"]), binary.getSeed())
        width, weights = len(cuts), [1.0] + [rate] * (rounds - 1)
        blocks = materialize(_binned(data, weight, cuts, classes), "blocks", **BLOCK_FILES)
        fitted: list[list[tuple[Tree, dict]]] = [[] for _ in range(classes)]
        for number in range(rounds):
            trees, stats = [Tree() for _ in range(classes)], [{} for _ in range(classes)]
            active = [[0] for _ in range(classes)]
            for level in range(max(depth, 1)):
                found = _best_splits(_sums(blocks, trees, active, width, bins, number == 0), width, bins).collect()  # a row per active node
                active = [[] for _ in range(classes)]
                for r in sorted(found, key=lambda r: (r["class"], r["node"])):
                    tree, held = trees[r["class"]], stats[r["class"]]
                    held[r["node"]] = r["n"], r["s"], r["q"]
                    tree.value[r["node"]] = weights[number] * r["s"] / r["n"]
                    if r["feature"] < 0 or depth < 1:
                        continue
                    sides = tree.split(r["node"], r["feature"], r["bin"], r["gain"])
                    left = r["nl"], r["sl"], r["ql"]
                    for node, told in zip(sides, (left, tuple(a - b for a, b in zip(held[r["node"]], left)))):
                        held[node] = told
                        tree.value[node] = weights[number] * told[1] / told[0]
                        if level + 1 < depth and _variance(*told) > np.finfo(float).eps:
                            active[r["class"]].append(node)
                if not any(active):
                    break
            for k in range(classes):
                fitted[k].append((trees[k], stats[k]))
            if number + 1 < rounds:
                blocks = materialize(_advanced(blocks, trees), "blocks", **BLOCK_FILES)
    build = _Built(spark, cuts)
    models = [binary._copyValues(build.model(trees, weights, width)) for trees in fitted]
    return many._copyValues(OneVsRestModel(models=models))
