"""Exact top-k by inner product: a KD-tree per shard, searched best box first with a propagated k-th score.

Vectors are dealt into shards of bounded size. Each shard becomes a KD-tree by median splits with tight bounding
boxes. No point of a box scores more for a query than the box's best corner does, so a box whose bound is below the k-th
score that a query already has cannot change its result. Queries first search the shard they lie in; that k-th score goes
along to all other shards. Blocks of queries meet groups of shards, both bounded, so no task holds more for more data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from flowmill.functions.columns import q
from flowmill.session import materialize, new_path

SHARD_ROWS, LEAF_ROWS = 4096, 128
#: Rows of the shards, and queries, that meet in one task.
GROUP_ROWS, QUERY_ROWS = 8192, 8192
_LEAST = np.iinfo(np.int64).min
_NO_ID = np.iinfo(np.int64).max


@dataclass
class Tree:
    """Points in leaf order and, for every node of a complete binary tree, its range of points and its box."""

    points: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    spans: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def build(points: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF_ROWS) -> Tree:
        order = np.lexsort((rows, ids))
        depth = max(math.ceil(math.log2(max(len(points), 1) / leaf)), 0)
        spans = [(0, len(points))]
        for node in range((1 << depth) - 1):
            a, b = spans[node]
            middle = (a + b) // 2
            own = points[order[a:b]]
            if len(own) and own.shape[1]:
                widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                order[a:b] = order[a:b][np.argsort(own[:, widest], kind="stable")]
            spans += [(a, middle), (middle, b)]
        points = points[order]
        width = points.shape[1]
        low = np.array([points[a:b].min(axis=0) if b > a else np.zeros(width, np.int64) for a, b in spans])
        high = np.array([points[a:b].max(axis=0) if b > a else np.zeros(width, np.int64) for a, b in spans])
        return Tree(points, ids[order], rows[order], np.array(spans), low, high)


def _product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T of integers, exactly; beyond 64 bits the nearest 64-bit number stands for the result."""
    most = max(left.shape[1], 1)
    for side in (left, right):
        most *= int(max(abs(int(side.max())), abs(int(side.min())), 1)) if side.size else 1
    for kind, limit in ((np.float32, 1 << 24), (np.float64, 1 << 53)):
        if most < limit:
            return (left.astype(kind) @ right.astype(kind).T).astype(np.int64)
    if most < 1 << 62:
        return left @ right.T
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, _LEAST + 1, _NO_ID - 1).astype(np.int64)


class Best:
    """The k best (score, id) of each query so far; the smaller id wins at equal scores, then the smaller row."""

    def __init__(self, n: int, k: int, bound: np.ndarray):
        self.k, self.bound = k, bound  # bound: a score that at least k candidates are known to reach
        self.scores = np.full((n, k), _LEAST)
        self.ids = np.full((n, k), _NO_ID)
        self.rows = np.full((n, k), _NO_ID)

    def least(self) -> np.ndarray:
        """Scores below this cannot enter."""
        return np.maximum(self.scores[:, -1], self.bound)

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Offer the same points to several queries; ``scores`` has a row per query."""
        some = (scores >= self.least()[which][:, None]).any(axis=1)
        which, scores = which[some], scores[some]
        if not len(which):
            return
        all_scores = np.hstack([self.scores[which], scores])
        all_ids = np.hstack([self.ids[which], np.broadcast_to(ids, scores.shape)])
        all_rows = np.hstack([self.rows[which], np.broadcast_to(rows, scores.shape)])
        order = np.lexsort((all_rows, all_ids, ~all_scores), axis=1)[:, : self.k]
        self.scores[which] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[which] = np.take_along_axis(all_ids, order, axis=1)
        self.rows[which] = np.take_along_axis(all_rows, order, axis=1)


def visit(tree: Tree, queries: np.ndarray, own_rows: np.ndarray, best: Best) -> int:
    """Search one tree for all queries; the number of (query, leaf) visits.

    Bounds are found from the root down, only below boxes that some query still needs. Leaves are taken best bound
    first, each by the queries whose k-th score its bound reaches at that time.
    """
    if not len(tree.points) or not len(queries):
        return 0
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)

    def bounds(nodes: np.ndarray) -> np.ndarray:
        # two products, each exact by itself; saturating keeps the sum an upper bound
        with np.errstate(over="ignore"):
            a, b = _product(plus, tree.high[nodes]), _product(minus, tree.low[nodes])
            total = a + b
            total[(a > 0) & (b > 0) & (total < 0)] = _NO_ID
        return total

    nodes, inner = np.array([0]), len(tree.spans) // 2
    bound = bounds(nodes)
    while nodes[0] < inner:
        needed = (bound >= best.least()[:, None]).any(axis=0)
        nodes = nodes[needed]
        if not len(nodes):
            return 0
        nodes = np.concatenate([2 * nodes + 1, 2 * nodes + 2])
        bound = bounds(nodes)
    visits = 0
    for i in np.argsort(-bound.max(axis=0), kind="stable"):
        which = np.flatnonzero(bound[:, i] >= best.least())
        a, b = tree.spans[nodes[i]]
        if not len(which) or a == b:
            continue
        scores = _product(queries[which], tree.points[a:b])
        scores[own_rows[which][:, None] == tree.rows[a:b][None, :]] = _LEAST
        best.add(which, scores, tree.ids[a:b], tree.rows[a:b])
        visits += len(which)
    return visits


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, np.int64).tobytes()


def _unpack(x: bytes, *shape: int) -> np.ndarray:
    flat = np.frombuffer(x, np.int64)
    return flat.reshape(shape) if shape else flat


_PACKED = (
    "kind string, part long, width int, n long, points binary, ids binary, rows binary, spans binary, low binary, "
    "high binary, bound binary"
)


def _shards(numbered: DataFrame, parts: int, k: int) -> DataFrame:
    """Trees of the shards, and the queries in them with the k-th score that their own shard gives."""

    def packed(points: np.ndarray, ids: np.ndarray, rows: np.ndarray, asked: np.ndarray, part: int) -> pa.RecordBatch:
        tree = Tree.build(points, ids, rows)
        best = Best(int(asked.sum()), k, np.full(int(asked.sum()), _LEAST))
        visit(tree, points[asked], rows[asked], best)
        width = points.shape[1]
        own = [tree.points, tree.ids, tree.rows, tree.spans, tree.low, tree.high, np.zeros(0)]
        wanted = [points[asked], ids[asked], rows[asked], *[np.zeros(0)] * 3, best.scores[:, -1]]
        lines = [("tree", len(points), own)] + ([("queries", len(wanted[1]), wanted)] if asked.any() else [])
        columns = [[kind for kind, _, _ in lines], [part] * len(lines), [width] * len(lines), [n for _, n, _ in lines]]
        columns += [[_pack(arrays[j]) for _, _, arrays in lines] for j in range(7)]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 7]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}
        number = TaskContext.get().partitionId()
        for batch in batches:
            sizes = batch.column("width").to_numpy()
            for width in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == width))
                flat = own.column("vector").flatten().to_numpy().reshape(own.num_rows, width)
                ids = own.column("id").fill_null(_NO_ID).to_numpy()
                rows, asks = own.column("row").to_numpy(), own.column("asked").to_numpy(False)
                waiting.setdefault(width, []).append((flat, ids, rows, asks))
                while sum(len(x[1]) for x in waiting[width]) >= 2 * SHARD_ROWS:
                    all_of = [np.concatenate(x) for x in zip(*waiting[width], strict=True)]
                    yield packed(*(x[:SHARD_ROWS] for x in all_of), number)
                    number += 1
                    waiting[width] = [tuple(x[SHARD_ROWS:] for x in all_of)]
        for own in waiting.values():
            yield packed(*(np.concatenate(x) for x in zip(*own, strict=True)), number)
            number += 1

    return numbered.repartition(parts, "row").mapInArrow(run, _PACKED)


_NAMES = [x.split(" ")[0] for x in _PACKED.split(", ")]


def search(
    vectors: DataFrame, asked: Column, k: int, scale: float = 64.0, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` best candidates by inner product of floor(scale * component), for every row where ``asked`` holds.

    Returns query_id, rank (from 1), vec_id, score. Every other row is a candidate, also one with the query's id or
    vector. Ties go to the smaller id; a null id comes last and asks nothing. Vectors that are null or hold null or
    non-finite components take no part. Vectors meet those of their own length only. Without candidates a query has no
    rows. Numbers beyond 64 bits count as the nearest 64-bit number.
    """
    part = q(vector)
    usable = part.isNotNull() & F.forall(
        part, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    )
    whole = F.transform(part, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    numbered = materialize(
        vectors.filter(usable).select(
            F.monotonically_increasing_id().alias("row"),
            q(id).cast("long").alias("id"),
            whole.alias("vector"),
            F.size(part).alias("width"),
            F.coalesce(asked, F.lit(False)).alias("asked"),
        ),
        "vectors",
    )
    sizes = numbered.agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("asked")).first()
    path = new_path(vectors.sparkSession, "shards")
    _shards(numbered, max(-(-sizes["n"] // SHARD_ROWS), 1), k).write.parquet(path)
    groups, blocks = max(-(-sizes["n"] // GROUP_ROWS), 1), max(-(-sizes["asked"] // QUERY_ROWS), 1)

    def dealt(kind: str, own: int, others: int) -> DataFrame:
        mine = (F.col("part") % own).cast("int")
        all_others = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        # read for each side anew: two sides of one table would lose columns when a query needs few of the result's
        rows = vectors.sparkSession.read.parquet(path).filter(F.col("kind") == kind)
        if kind == "tree":
            return rows.select("*", mine.alias("tree_group"), all_others.alias("query_block"))
        return rows.select("*", all_others.alias("tree_group"), mine.alias("query_block"))

    keys = ["tree_group", "query_block", "width"]
    meeting = dealt("queries", blocks, groups).groupBy(*keys).cogroup(dealt("tree", groups, blocks).groupBy(*keys))

    def meet(queries: pa.Table, trees: pa.Table) -> pa.Table:
        if not queries.num_rows or not trees.num_rows:
            return _FOUND.empty_table()
        lines, width = queries.to_pylist(), queries.column("width")[0].as_py()
        points = np.concatenate([_unpack(x["points"], x["n"], width) for x in lines])
        ids, rows, bound = (np.concatenate([_unpack(x[c]) for x in lines]) for c in ("ids", "rows", "bound"))
        best = Best(len(ids), k, bound)
        for x in trees.to_pylist():
            spans = np.frombuffer(x["spans"], np.int64).reshape(-1, 2)
            boxes = [_unpack(x[c], len(spans), width) for c in ("low", "high")]
            own = Tree(_unpack(x["points"], x["n"], width), _unpack(x["ids"]), _unpack(x["rows"]), spans, *boxes)
            visit(own, points, rows, best)
        real = best.scores > _LEAST
        row, _ = np.nonzero(real)
        found = [rows[row], ids[row], best.ids[real], best.rows[real], best.scores[real]]
        return pa.Table.from_arrays([pa.array(x) for x in found], schema=_FOUND)

    found = meeting.applyInArrow(meet, "query_row long, query_id long, vec_id long, vec_row long, score long")
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    known = F.when(F.col("vec_id") != _NO_ID, F.col("vec_id"))
    return ranked.select("query_id", "rank", known.alias("vec_id"), "score")


_FOUND = pa.schema([(c, pa.int64()) for c in ("query_row", "query_id", "vec_id", "vec_row", "score")])
