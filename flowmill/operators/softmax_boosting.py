"""Gradient boosting of several classes by one softmax objective.

Every round grows one tree per class from the same gradients. Rows are binned once, by quantiles, and packed into blocks of
bytes; a level of all trees of a round takes one pass over the blocks. A task sums gradients and Hessians of its rows per
(class, node, feature, bin), the sums meet by (class, node), and the best split of a node is chosen where they meet, so the
driver sees one row per node. After a round each block's margins are written with it, once, for the next one.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmill.functions.columns import small_table
from flowmill.session import materialize, scratch, setting

# The defaults of the model.
DEFAULTS = {"rounds": 100, "max_depth": 8, "rate": 0.1, "max_bins": 64, "l2": 1.0, "min_hessian": 1.0}
#: Rows packed into a block (at most 255 bins, so a byte per feature). A block is one cell of a table, about a megabyte.
BLOCK_ROWS = 1 << 14
#: Writers and readers of blocks hold a row group, codecs a page, and Arrow a batch. By default a group ends by its compressed
#: size (zeros take nearly none), a page is looked at after 100 rows only, which are 100 blocks here, and a batch holds 64 MB.
BLOCK_FILES = {"parquet.block.row.count.limit": 16, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
FEATURES, LABEL = "features", "label"


@dataclass
class Tree:
    """Nodes as lists: a row goes left where its feature is at most the cut; a feature of -1 marks a leaf."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin: int, gain: float) -> tuple[int, int]:
        """Two new leaves below ``node``; the right one follows the left one."""
        first = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, bin, first, gain
        for name, value in (("feature", -1), ("bin", 0), ("left", 0), ("value", 0.0), ("cover", 0.0), ("gain", 0.0)):
            getattr(self, name).extend([value, value])
        return first, first + 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature), np.array(self.bin), np.array(self.left), np.array(self.value)


def _leaves(arrays: tuple[np.ndarray, ...], x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The node each row ends in; ``x`` has a row per feature and is compared with ``cuts``, one per node."""
    feature, _, left, _ = arrays
    at = np.zeros(x.shape[1], np.int64)
    moving = np.arange(x.shape[1]) if feature[0] >= 0 else np.zeros(0, np.int64)
    while len(moving):
        node = at[moving]
        node = left[node] + ~(x[feature[node], moving] <= cuts[node])  # not <=, so that NaN goes right
        at[moving] = node
        moving = moving[feature[node] >= 0]
    return at


def _softmax(margins: np.ndarray) -> np.ndarray:
    shares = np.exp(margins - margins.max(axis=1, keepdims=True))
    return shares / shares.sum(axis=1, keepdims=True)


_BLOCK = "n int, labels binary, weights binary, bins binary, margins binary"
_BLOCK_FIELDS = pa.schema([("n", pa.int32()), *((name, pa.binary()) for name in ("labels", "weights", "bins", "margins"))])


def _binned(data: DataFrame, weight: str | None, cuts: list[np.ndarray], classes: int) -> DataFrame:
    """Blocks of rows: label, weight and bins (a byte per feature, feature after feature) and margins of zero."""
    rows = data.select(
        vector_to_array(FEATURES).alias("x"), F.col(LABEL).cast("int").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                bins = np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)]).astype(np.uint8)
                parts.append((batch.column("y").to_numpy(), batch.column("w").to_numpy(), bins))
                n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block(parts, n)
                parts, n = [], 0
        if n:
            yield block(parts, n)

    def block(parts: list, n: int) -> pa.RecordBatch:
        y, w, bins = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts], axis=1)
        margins = np.zeros((n, classes))
        return pa.RecordBatch.from_pylist(
            [{"n": n, "labels": y.astype(np.int32).tobytes(), "weights": w.astype(float).tobytes(), "bins": bins.tobytes(), "margins": margins.tobytes()}],
            _BLOCK_FIELDS,
        )

    return rows.mapInArrow(run, _BLOCK)


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for row in batch.to_pylist():
        n = row["n"]
        yield (
            np.frombuffer(row["labels"], np.int32), np.frombuffer(row["weights"]),
            np.frombuffer(row["bins"], np.uint8).reshape(-1, n), np.frombuffer(row["margins"]).reshape(n, -1),
        )


def _histograms(blocks: DataFrame, trees: list[Tree], active: list[list[int]], width: int, bins: int, loss: bool) -> DataFrame:
    """(class, node, sums) of each task: gradients and Hessians per feature and bin of the rows in active nodes.

    With ``loss`` also a row of class -1: the weighted log loss and the weight.
    """
    grown = [(t.arrays(), np.array(t.bin)) for t in trees]
    slots = []
    for tree, nodes in zip(trees, active, strict=True):
        slot = np.full(len(tree.feature), -1)
        slot[nodes] = np.arange(len(nodes))
        slots.append(slot)
    schema = pa.schema([("class", pa.int32()), ("node", pa.int32()), ("sums", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((2, len(nodes), width, bins)) for nodes in active]
        lost, seen = np.zeros(2), False
        for batch in batches:
            for labels, weights, x, margins in _unpacked(batch):
                seen = True
                shares = _softmax(margins)
                if loss:
                    own = shares[np.arange(len(labels)), labels]
                    lost += (-np.log(np.maximum(own, 1e-300)) * weights).sum(), weights.sum()
                for k, ((arrays, cuts), slot) in enumerate(zip(grown, slots, strict=True)):
                    if not len(active[k]):
                        continue
                    place = slot[_leaves(arrays, x, cuts)]
                    rows = np.flatnonzero(place >= 0)
                    p = shares[rows, k]
                    gradient = (p - (labels[rows] == k)) * weights[rows]
                    hessian = np.maximum(2.0 * p * (1.0 - p), 1e-16) * weights[rows]
                    start = place[rows] * bins
                    for f in range(width):
                        at = start + x[f, rows]
                        for half, values in enumerate((gradient, hessian)):
                            sums[k][half, :, f] += np.bincount(at, values, len(active[k]) * bins).reshape(-1, bins)
        if seen:
            rows = [(k, node, sums[k][:, i].tobytes()) for k, nodes in enumerate(active) for i, node in enumerate(nodes)]
            rows += [(-1, 0, lost.tobytes())] if loss else []
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    return blocks.mapInArrow(run, "class int, node int, sums binary")


_SPLIT = "class int, node int, feature int, bin int, gain double, g double, h double, gl double, hl double"


def _best_splits(sums: DataFrame, width: int, bins: int, l2: float, min_hessian: float) -> DataFrame:
    """The best split of every (class, node): of equal gains the first feature and the lowest bin; feature -1 without any."""
    names = [x.split(" ")[0] for x in _SPLIT.split(", ")]

    def choose(table: pa.Table) -> pa.Table:
        k, node = table["class"][0].as_py(), table["node"][0].as_py()
        total = sum(np.frombuffer(x.as_py()) for x in table["sums"])
        if k < 0:
            row = (k, node, -1, 0, 0.0, float(total[0]), float(total[1]), 0.0, 0.0)
        else:
            g, h = total.reshape(2, width, bins)
            gl, hl = g.cumsum(axis=1), h.cumsum(axis=1)
            all_g, all_h = gl[0, -1], hl[0, -1]
            gr, hr = all_g - gl, all_h - hl
            gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - all_g**2 / (all_h + l2)
            gain[(hl < min_hessian) | (hr < min_hessian)] = -np.inf
            f, b = np.unravel_index(int(gain.argmax()), gain.shape)
            useful = gain[f, b] > 1e-6
            row = (k, node, int(f) if useful else -1, int(b), float(gain[f, b]) if useful else 0.0, float(all_g), float(all_h), float(gl[f, b]), float(hl[f, b]))
        return pa.table({name: [value] for name, value in zip(names, row, strict=True)}).cast(
            pa.schema([(n, pa.int32() if n in ("class", "node", "feature", "bin") else pa.float64()) for n in names])
        )

    return sums.groupBy("class", "node").applyInArrow(choose, _SPLIT)


def _advanced(blocks: DataFrame, trees: list[Tree]) -> DataFrame:
    """The blocks with the margins that the trees of a round lead to."""
    grown = [(t.arrays(), np.array(t.bin)) for t in trees]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["bins"], np.uint8).reshape(-1, row["n"])
                margins = np.frombuffer(row["margins"]).reshape(row["n"], -1).copy()
                for k, (arrays, cuts) in enumerate(grown):
                    margins[:, k] += arrays[3][_leaves(arrays, x, cuts)]
                yield pa.RecordBatch.from_pylist([{**row, "margins": margins.tobytes()}], _BLOCK_FIELDS)

    return blocks.mapInArrow(run, _BLOCK)


class SoftmaxModel:
    """Trees by round and class; scores like the models of Spark ML (``rawPrediction``, ``probability``, ``prediction``)."""

    def __init__(self, rounds: list[list[Tree]], cuts: list[list[float]], classes: int, losses: list[float]):
        self.rounds, self.cuts, self.classes, self.losses = rounds, cuts, classes, losses

    def thresholds(self, tree: Tree) -> np.ndarray:
        return np.array([self.cuts[f][b] if f >= 0 else 0.0 for f, b in zip(tree.feature, tree.bin, strict=True)])

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Margins of rows given feature after feature."""
        out = np.zeros((x.shape[1], self.classes))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                arrays = tree.arrays()
                out[:, k] += arrays[3][_leaves(arrays, x, self.thresholds(tree))]
        return out

    @property
    def featureImportances(self) -> DenseVector:
        """Each feature's share of all gains."""
        gains = np.zeros(len(self.cuts))
        for tree in (t for trees in self.rounds for t in trees):
            for f, gain in zip(tree.feature, tree.gain, strict=True):
                gains[f] += gain if f >= 0 else 0.0
        return DenseVector(gains / (gains.sum() or 1.0))

    def transform(self, df: DataFrame) -> DataFrame:
        width = len(self.cuts)
        sent = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(self))  # the model, whatever the data's size
        memory: list[SoftmaxModel] = []

        @F.arrow_udf("array<double>")
        def margins(x: pa.Array) -> pa.Array:
            if not memory:
                memory.append(cloudpickle.loads(sent.value))
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            found = memory[0].margins(np.ascontiguousarray(rows.T))
            offsets = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
            return pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))

        raw = df.withColumn("__margins", margins(vector_to_array(FEATURES)))
        top = F.array_max("__margins")
        shares = F.transform("__margins", lambda m: F.exp(m - top))
        total = F.aggregate(shares, F.lit(0.0), lambda a, b: a + b)
        return raw.select(
            *[F.col(f"`{c}`") for c in df.columns],
            array_to_vector("__margins").alias("rawPrediction"),
            array_to_vector(F.transform(shares, lambda s: s / total)).alias("probability"),
            (F.array_position("__margins", top) - 1).cast("double").alias("prediction"),
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Three small tables: nodes, cuts, losses."""
        nodes = [
            (r, k, i, t.feature[i], t.bin[i], t.left[i], t.value[i], t.cover[i], t.gain[i])
            for r, trees in enumerate(self.rounds) for k, t in enumerate(trees) for i in range(len(t.feature))
        ]
        kinds = "round int, class int, node int, feature int, bin int, left int, value double, cover double, gain double"
        small_table(spark, nodes, kinds).write.mode("overwrite").parquet(f"{path}/nodes")
        small_table(spark, list(enumerate(self.cuts)), "feature int, cuts array<double>").write.mode("overwrite").parquet(f"{path}/cuts")
        facts = [(self.classes, [float(x) for x in self.losses])]
        small_table(spark, facts, "classes int, losses array<double>").write.mode("overwrite").parquet(f"{path}/losses")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SoftmaxModel:
        facts = spark.read.parquet(f"{path}/losses").first()
        cuts = [list(r["cuts"]) for r in spark.read.parquet(f"{path}/cuts").orderBy("feature").collect()]
        rounds: list[list[Tree]] = []
        for r in spark.read.parquet(f"{path}/nodes").orderBy("round", "class", "node").collect():
            if r["round"] == len(rounds):
                rounds.append([])
            if r["class"] == len(rounds[-1]):
                rounds[-1].append(Tree([], [], [], [], [], []))
            for name in ("feature", "bin", "left", "value", "cover", "gain"):
                getattr(rounds[-1][-1], name).append(r[name])
        return cls(rounds, cuts, facts["classes"], list(facts["losses"]))


def _cuts(data: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """At most ``bins`` - 1 cut values per feature, from one pass of quantile sketches; fewer for few distinct values."""
    shares = [i / bins for i in range(1, bins)]
    x = data.select(vector_to_array(FEATURES).alias("x"))
    row = x.agg(*[F.percentile_approx(F.col("x")[i], shares, 20 * bins).alias(f"c{i}") for i in range(width)]).first()
    return [np.unique([v for v in row[f"c{i}"] or [] if np.isfinite(v)]) for i in range(width)]


def fit(data: DataFrame, classes: int, params: Mapping, weight: str | None = None) -> SoftmaxModel:
    """Boost ``data`` (features vector, label code) over ``classes`` classes.

    ``losses`` of the model are the weighted log losses on the training rows before the first round and after every
    one. A round in which no tree splits ends the fit. Leaves hold ``-rate * G / (H + l2)``.
    """
    options = {**DEFAULTS, **params}
    bins, rate, l2 = options["max_bins"], options["rate"], options["l2"]
    if not 2 <= bins <= 255:
        raise ValueError("max_bins must be from 2 to 255: a bin is a byte")
    first = data.select(F.size(vector_to_array(FEATURES)).alias("n")).first()
    if first is None:
        raise ValueError("no rows to train on")
    width = first["n"]
    with scratch(data.sparkSession), setting(data.sparkSession, *BATCH_BYTES):
        cuts = _cuts(data, width, bins)
        blocks = materialize(_binned(data, weight, cuts, classes), "blocks", **BLOCK_FILES)
        rounds, losses = [], []
        for number in range(options["rounds"] + 1):
            trees = [Tree() for _ in range(classes)]
            active = [[0] for _ in range(classes)] if number < options["rounds"] else [[] for _ in range(classes)]
            for depth in range(options["max_depth"]):
                sums = _histograms(blocks, trees, active, width, bins, loss=depth == 0)
                found = _best_splits(sums, width, bins, l2, options["min_hessian"]).collect()  # a row per active node
                active = [[] for _ in range(classes)]
                for r in sorted(found, key=lambda r: (r["class"], r["node"])):
                    if r["class"] < 0:
                        losses.append(r["g"] / r["h"] if r["h"] else 0.0)
                        continue
                    tree = trees[r["class"]]
                    tree.value[r["node"]], tree.cover[r["node"]] = -rate * r["g"] / (r["h"] + l2), r["h"]
                    if r["feature"] >= 0:
                        left, right = tree.split(r["node"], r["feature"], r["bin"], r["gain"])
                        for node, g, h in ((left, r["gl"], r["hl"]), (right, r["g"] - r["gl"], r["h"] - r["hl"])):
                            tree.value[node], tree.cover[node] = -rate * g / (h + l2), h
                        active[r["class"]] += [left, right]
                if not any(active):
                    break
            if number == options["rounds"] or all(len(t.feature) == 1 and abs(t.value[0]) < 1e-12 for t in trees):
                break
            rounds.append(trees)
            blocks = materialize(_advanced(blocks, trees), "blocks", **BLOCK_FILES)
        return SoftmaxModel(rounds, [c.tolist() for c in cuts], classes, losses)
