"""Exact k nearest neighbours inside each class, without comparing all pairs.

A bounded seeded sample of each class gives the main directions of its rows, a tree of cuts along
them, and pivots: sample rows far from each other. The tree sends every row to a leaf; leaves holding
too many rows are divided into blocks by hash. Each block first answers its own rows, which bounds
every row's k-th distance; within a block rows lie in small tiles, and only tiles near enough are compared. A row then visits only leaves that can hold something closer: those whose
box along the main directions lies within that bound, and whose distances to every pivot differ from
the row's own by no more (the triangle inequality). Turning rows does not change distances, so with
many features that follow a few directions the boxes are as tight as if there were only those. Blocks
and the queries sent to one block are both limited in size, so neither a dense region nor a popular
block ends up in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import order_hash, q, small_table
from flowmill.operators.selection import EVERYTHING, below_cut
from flowmill.session import materialize

BLOCK_ROWS = 30_000
QUERY_ROWS = 30_000
SAMPLE_ROWS = 400_000
SAMPLE_PER_BLOCK = 128
ROOM = 0.7  # leaves aim at this share of a block, so that chance rarely divides one: its halves would have to ask each other
BROADCAST_ROWS = 200_000
SLICE = 64  # rows per distance table: small enough for the processor's cache
TILE = 32  # rows that a block compares with each other at a time
TILE_CELLS = 1 << 17  # cells of such tables at a time
FULL_SHARE = 0.125  # of all (row, tile) pairs of two blocks: where more are near, one matrix product of all is cheaper
PIVOTS = 32
REST_SPREAD = 1e-3  # share of the spread that half of the directions may hold for the others to be the main ones
PIVOT_SAMPLE = 5_000  # sample rows among which pivots are looked for


def _grow(sample: np.ndarray, leaf_rows: int) -> dict[str, list]:
    """Halve the widest column until a node holds few sample rows; equal rows stay together."""
    tree = {"column": [], "cut": [], "left": [], "right": []}

    def node(rows: np.ndarray) -> int:
        at = len(tree["column"])
        for name in tree:
            tree[name].append(-1)
        if len(rows) > leaf_rows:
            spread = rows.max(axis=0) - rows.min(axis=0)
            column = int(spread.argmax())
            cut = float(np.median(rows[:, column]))
            goes_left = rows[:, column] <= cut
            if goes_left.all():  # the median is the largest value: cut below it
                lower = rows[:, column][rows[:, column] < cut]
                cut = float(lower.max()) if len(lower) else cut
                goes_left = rows[:, column] <= cut
            if spread[column] > 0 and not goes_left.all():
                tree["column"][at], tree["cut"][at] = column, cut
                tree["left"][at] = node(rows[goes_left])
                tree["right"][at] = node(rows[~goes_left])
        return at

    node(sample)
    return {name: np.array(values) for name, values in tree.items()}


class Shape:
    """The main directions of a class and its pivots; both only bound distances, which are computed in full elsewhere.

    Where no half of the directions holds nearly all of the spread, the features themselves are the directions and there
    are no pivots: turning would only blur columns of few distinct values.
    """

    def __init__(self, sample: np.ndarray, pivots: int = PIVOTS):
        self.centre = sample.mean(axis=0)
        around = sample - self.centre
        spread, directions = np.linalg.eigh(around.T @ around)
        few = spread[: len(spread) // 2].sum() > REST_SPREAD * spread.sum()
        self.directions = None if few else directions
        self.pivots = np.zeros((0, sample.shape[1]))
        if few:
            return
        some = sample[:: max(len(sample) // PIVOT_SAMPLE, 1)]
        chosen = [some[int(((some - self.centre) ** 2).sum(axis=1).argmax())]]
        apart = ((some - chosen[0]) ** 2).sum(axis=1)
        while len(chosen) < pivots and apart.max() > 0:  # the row farthest from all that are chosen
            chosen.append(some[int(apart.argmax())])
            apart = np.minimum(apart, ((some - chosen[-1]) ** 2).sum(axis=1))
        self.pivots = np.array(chosen)

    def turned(self, rows: np.ndarray) -> np.ndarray:
        """Coordinates along the main directions."""
        return rows if self.directions is None else (rows - self.centre) @ self.directions

    def told(self, rows: np.ndarray) -> np.ndarray:
        """Those and the distances to the pivots, side by side."""
        if not len(self.pivots):
            return self.turned(rows)
        apart = np.stack([np.sqrt(((rows - p) ** 2).sum(axis=1)) for p in self.pivots], axis=1)
        return np.concatenate([self.turned(rows), apart], axis=1)


def reachable(told: np.ndarray, width: int, low: np.ndarray, high: np.ndarray, bound: np.ndarray, slack: float) -> np.ndarray:
    """(row, leaf): whether a leaf can hold something closer to a row than the square root of its ``bound``.

    ``low`` and ``high`` bound the leaf's rows in what ``Shape.told`` says. A hair of slack, relative and absolute, keeps
    rounding from hiding a leaf. Nothing is closer than a bound of 0: k copies of a point settle it.
    """
    limit = bound * (1 + 1e-9) + slack
    gap = np.zeros((len(told), len(low)))
    for column in range(width - 1, -1, -1):  # the widest direction first
        c = told[:, column][:, None]
        gap += np.maximum(np.maximum(low[:, column] - c, c - high[:, column]), 0.0) ** 2
    near = (gap < limit[:, None]) & (bound > 0)[:, None]
    if told.shape[1] == width:
        return near
    row, leaf = np.nonzero(near)
    for at in range(0, len(row), 1 << 16):
        r, f = row[at : at + (1 << 16)], leaf[at : at + (1 << 16)]
        apart = told[r, width:]
        short = np.maximum(low[f, width:] - apart, apart - high[f, width:]).max(axis=1, initial=0.0)
        near[r, f] = short**2 < limit[r]
    return near


def _descend(tree: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    at = np.zeros(len(rows), dtype=np.int64)
    while True:
        column = tree["column"][at]
        moving = np.flatnonzero(column >= 0)
        if not len(moving):
            return at
        here = at[moving]
        left = rows[moving, column[moving]] <= tree["cut"][here]
        at[moving] = np.where(left, tree["left"][here], tree["right"][here])


def _matrix(values: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Equally long lists as a matrix, without touching single values."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _vectors(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(rows, dtype=float).ravel()))


def _lists(owner: np.ndarray, owners: int, values: pa.Array) -> pa.ListArray:
    """Values grouped by their (sorted) owner position."""
    offsets = np.searchsorted(owner, np.arange(owners + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, values)


def _closest(queries, refs, ref_order, k, bound, same: bool):
    """(query, ref, squared distance) of the k closest refs per query within ``bound``.

    A matrix product proposes candidates with a safety margin; their distances are then
    computed exactly, and ties go to the smaller key.
    """
    centre = refs.mean(axis=0)
    y = refs - centre
    y_norm = (y * y).sum(axis=1)
    y_twice = -2.0 * y.T
    out = []
    for start in range(0, len(queries), SLICE):
        raw = queries[start : start + SLICE]
        x = raw - centre
        x_norm = (x * x).sum(axis=1)
        rough = x @ y_twice
        rough += y_norm
        rough += x_norm[:, None]
        if same:
            own = np.arange(start, start + len(raw))
            rough[np.arange(len(raw)), own] = np.inf
        limit = bound[start : start + SLICE].copy()
        if len(refs) - same >= k:
            limit = np.minimum(limit, np.partition(rough, k - 1, axis=1)[:, k - 1])
        limit = np.minimum(limit + 1e-9 * (x_norm + y_norm.max() + 1.0), np.finfo(float).max)  # never the row itself
        row, ref = np.divmod(np.flatnonzero(rough <= limit[:, None]), len(refs))
        exact = np.zeros(len(row))
        for column in range(refs.shape[1]):
            exact += (raw[row, column] - refs[ref, column]) ** 2
        inside = exact <= bound[start + row]
        row, ref, exact = row[inside], ref[inside], exact[inside]
        order = np.lexsort((ref_order[ref], exact, row))
        row, ref, exact = row[order], ref[order], exact[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
        out.append((row[kept] + start, ref[kept], exact[kept]))
    return tuple(np.concatenate(part) for part in zip(*out))


class Tiles:
    """Rows in tiles of nearly equal size by halving the widest column, with the box of every tile.

    ``points`` are what distances are computed from; ``place`` (the same rows, possibly turned) only decides the tiles and
    bounds distances. A tile has ``size`` places, the last of which may be empty.
    """

    def __init__(self, points: np.ndarray, place: np.ndarray, size: int):
        n = len(points)
        depth = max(int(np.ceil(np.log2(max(n, 1) / size))), 0) if n > size else 0
        starts, order = np.array([0, n]), np.arange(n)
        for _ in range(depth):
            held = place[order]
            low, high = (f.reduceat(held, starts[:-1], axis=0) for f in (np.minimum, np.maximum))
            part = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            order = order[np.lexsort((held[np.arange(n), (high - low).argmax(axis=1)[part]], part))]  # stable: rows of one value keep their order
            starts = np.sort(np.concatenate([starts, (starts[:-1] + starts[1:]) // 2]))
        at = starts[:-1, None] + np.arange(np.diff(starts).max())
        self.valid = at < starts[1:, None]
        self.rows = np.minimum(np.sort(np.where(self.valid, order[np.minimum(at, n - 1)], n), axis=1), n - 1)  # (tile, place) positions, ascending
        self.low, self.high = (f.reduceat(place[order], starts[:-1], axis=0) for f in (np.minimum, np.maximum))
        self.points, self.place = points, place


def _by_number(numbers: np.ndarray) -> np.ndarray:
    """A stable order of row numbers; short ones are sorted by radix."""
    return np.argsort(numbers.astype(np.uint16) if numbers.max(initial=0) < 1 << 16 else numbers, kind="stable")


def _tiled(queries: Tiles, refs: Tiles, k: int, bound: np.ndarray, slack: float, same: bool):
    """As ``_closest``, comparing tiles: (query, ref, squared distance) of the k closest refs per query within ``bound``.

    None where so many tiles are near that comparing everything is cheaper. Ties go to the ref of the lower position.
    A tile is compared with a query only if its box is closer than the k-th distance found so far.
    """
    bound = bound.copy()
    ends = [f([f(side, axis=0) for side in sides], axis=0) for f, sides in ((np.max, (refs.high, queries.high)), (np.min, (refs.low, queries.low)))]
    varying = np.flatnonzero(ends[0] > ends[1])  # other columns add exactly 0
    ends = [f([f(side.points, axis=0) for side in (refs, queries)], axis=0) for f in (np.max, np.min)]
    moving = np.flatnonzero(ends[0] > ends[1])
    row, ref, exact = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    tiles, size = refs.rows.shape

    def limit(b: np.ndarray) -> np.ndarray:  # nothing is closer than a bound of 0
        return np.where(b > 0, b * (1 + 1e-9) + slack, -np.inf)

    def keep(parts: list) -> None:
        """The k best of what is found, and the bounds that follow."""
        nonlocal row, ref, exact
        if not sum(len(part[0]) for part in parts):
            return
        row, ref, exact = (np.concatenate([old, *new]) for old, new in zip((row, ref, exact), zip(*parts, strict=True), strict=True))
        inside = exact <= bound[row]
        row, ref, exact = row[inside], ref[inside], exact[inside]
        order = _by_number(ref)
        order = order[np.argsort(exact[order], kind="stable")]
        order = order[_by_number(row[order])]
        row, ref, exact = row[order], ref[order], exact[order]
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, int)
        kept = np.arange(len(row)) - np.repeat(starts, np.diff(starts, append=len(row))) < k
        row, ref, exact = row[kept], ref[kept], exact[kept]
        full = np.arange(k - 1, len(row))
        full = full[row[full] == row[full - k + 1]]
        bound[row[full]] = exact[full]

    if same:
        parts, step = [], max(TILE_CELLS // size**2, 1)
        for start in range(0, tiles, step):
            own, there = refs.rows[start : start + step], refs.valid[start : start + step]
            x, apart = refs.points[own], np.zeros((len(own), size, size))
            for column in moving:
                c = x[:, :, column]
                apart += (c[:, :, None] - c[:, None, :]) ** 2
            apart[:, np.arange(size), np.arange(size)] = np.inf  # never the row itself
            apart[np.broadcast_to(~there[:, None, :], apart.shape)] = np.inf
            near = np.argsort(apart, axis=2, kind="stable")[:, :, :k]  # of equal distances the lower position first
            told = np.take_along_axis(apart, near, axis=2)
            inside = there[:, :, None] & (told <= bound[own][:, :, None]) & (told < np.inf)
            if k < size:
                bound[own[there]] = np.minimum(bound[own], told[:, :, k - 1])[there]
            tile, place, at = np.nonzero(inside)
            parts.append((own[tile, place], own[tile, near[tile, place, at]], told[inside]))
        row, ref, exact = (np.concatenate(part) for part in zip(*parts, strict=True))
        order = _by_number(row)
        row, ref, exact = row[order], ref[order], exact[order]

    most = np.where(queries.valid, limit(bound[queries.rows]), -np.inf)
    gap = np.zeros((len(queries.rows), tiles))
    for c in varying:
        gap += np.maximum(np.maximum(refs.low[:, c] - queries.high[:, c, None], queries.low[:, c, None] - refs.high[:, c]), 0.0) ** 2
    near = gap < most.max(axis=1)[:, None]
    if same:
        near[np.arange(tiles), np.arange(tiles)] = False
    if near.mean() > FULL_SHARE and near.size > 64:
        tried = most[:, : max(size // 8, 1)]  # the boxes of single rows tell more than those of tiles
        told = queries.place[queries.rows[:, : tried.shape[1]]]
        share = 0.0
        for start in range(0, len(told), 16):
            single = np.zeros((*tried[start : start + 16].shape, tiles))
            for c in varying:
                x = told[start : start + 16, :, c, None]
                single += np.maximum(np.maximum(refs.low[:, c] - x, x - refs.high[:, c]), 0.0) ** 2
            share += (single < tried[start : start + 16, :, None]).sum()
        if share > FULL_SHARE * tried.size * tiles:
            return None
    a, b = np.nonzero(near)
    first = np.argsort(gap[a, b], kind="stable")  # near tiles first, so that bounds shrink before the others come
    a, b = a[first], b[first]
    step, start = max(4 * TILE_CELLS // size, 1), 0
    while start < len(a):
        at, to = a[start : start + step], b[start : start + step]
        start += step
        mine = queries.rows[at]
        within = np.zeros(mine.shape)
        for c in varying:
            x = queries.place[mine, c]
            within += np.maximum(np.maximum(refs.low[to, c, None] - x, x - refs.high[to, c, None]), 0.0) ** 2
        pair, place = np.nonzero((within < limit(bound[mine])) & queries.valid[at])
        who, to = mine[pair, place], to[pair]
        parts = []
        for s in range(0, len(who), max(TILE_CELLS // size, 1)):
            q_rows, r_rows = who[s : s + TILE_CELLS // size], refs.rows[to[s : s + TILE_CELLS // size]]
            apart = np.zeros(r_rows.shape)
            for c in moving:
                apart += (queries.points[q_rows, c][:, None] - refs.points[r_rows, c]) ** 2
            hit = np.nonzero((apart <= bound[q_rows][:, None]) & refs.valid[to[s : s + TILE_CELLS // size]])
            parts.append((q_rows[hit[0]], r_rows[hit], apart[hit]))
        keep(parts)
    return row, ref, exact


def closest(queries, refs, k, bound, same: bool, turned=None):
    """``_closest`` for rows and refs in the order of their keys, by tiles where few are near.

    With ``same`` the queries are the refs; those of bound -inf are not asked. ``turned`` gives coordinates that preserve
    distances and follow the main directions.
    """
    size = max(TILE, 2 * (k + 1))
    if not len(refs) or not len(queries):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    places = [rows if turned is None else turned(rows) for rows in ((refs,) if same else (refs, queries))]
    slack = 0.0 if turned is None else 1e-12 * float(max(np.abs(p).max() for p in places)) ** 2
    held = Tiles(refs, places[0], size)
    found = _tiled(held if same else Tiles(queries, places[1], size), held, k, bound, slack, same)
    if found is not None:
        return found
    return _closest(queries, refs, np.arange(len(refs)), k, bound, same)


def _turned(shape: Shape | None):
    return shape.turned if shape is not None and shape.directions is not None else None


def _seekers(told, width: int, low, high, bound, slack: float, probes: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) where the leaf can hold something closer to the row than ``bound``, at most ``probes`` leaves a row."""
    tiles = Tiles(told, told[:, :width], SLICE)
    most = np.where(tiles.valid, bound[tiles.rows], 0.0).max(axis=1) * (1 + 1e-9) + slack
    seekers, leaves = [np.zeros(0, int)], [np.zeros(0, np.int64)]
    for tile in np.flatnonzero(most > slack):
        gap = (np.maximum(np.maximum(low[:, :width] - tiles.high[tile], tiles.low[tile] - high[:, :width]), 0.0) ** 2).sum(axis=1)
        some = np.flatnonzero(gap < most[tile] * (1 + 1e-9))  # the rows' own limits are looked at next
        rows = tiles.rows[tile][tiles.valid[tile]]
        near = reachable(told[rows], width, low[some], high[some], bound[rows], slack)
        if probes is not None and probes < near.shape[1]:
            c = told[rows][:, None, :width]
            apart = (np.maximum(np.maximum(low[some][None, :, :width] - c, c - high[some][None, :, :width]), 0.0) ** 2).sum(axis=2)
            apart[~near] = np.inf
            chosen = np.argsort(apart, axis=1, kind="stable")[:, :probes]
            few = np.zeros_like(near)
            np.put_along_axis(few, chosen, True, axis=1)
            near &= few
        row, leaf = np.nonzero(near)
        seekers.append(rows[row])
        leaves.append(some[leaf])
    seeker, leaf = np.concatenate(seekers), np.concatenate(leaves)
    order = np.lexsort((leaf, seeker))
    return seeker[order], leaf[order]


def nearest_in_class(
    df: DataFrame,
    group: str,
    key: str,
    vector: str,
    width: int,
    k: int,
    counts: Mapping,
    asks: Column | None = None,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    probes: int | None = None,
) -> DataFrame:
    """(key, group, vector, distances, keys, vectors) for every row where ``asks`` holds.

    ``distances`` (squared), ``keys`` and ``vectors`` describe the k nearest other rows of the same
    class, closest first; the ``width`` numbers of each neighbour follow one another in ``vectors``.
    ``counts`` holds the rows per class. Keys must be unique strings.

    The neighbours are exact unless ``probes`` says how many other leaves a row may visit at most, the nearest boxes
    first. Features that follow a few directions cost little, however many they are; with many independent features nearly
    every leaf is near enough to be visited, so exact answers then cost as much as comparing all pairs of a class.
    """
    spark = df.sparkSession
    asks = F.lit(True) if asks is None else asks
    rows = df.select(q(key).alias("k"), q(group).alias("g"), q(vector).alias("v"), asks.alias("asks"))
    group_type = rows.schema["g"].dataType.simpleString()

    # trees from a bounded sample; the sample only places the cuts, every row takes part
    large = {g: n for g, n in counts.items() if n > block_rows}
    trees: dict = {}
    shapes: dict[object, Shape] = {}
    if large:
        # the lowest order hashes: some rows per block to come, within a budget for all classes
        budget = sample_rows // len(large)
        shares = {g: min(1.0, min(SAMPLE_PER_BLOCK * -(-n // block_rows), budget) / n) for g, n in large.items()}
        cuts = {g: EVERYTHING if share == 1.0 else f"{int(share * 2**48):012x}" for g, share in shares.items()}
        low_hashes = below_cut(F.col("g"), order_hash(F.col("k"), seed), cuts)
        sample = rows.where(low_hashes).select("g", "v").toArrow()
        sampled_groups = np.array(sample["g"].to_pylist(), dtype=object)
        points = _matrix(sample["v"], width)
        for g in large:
            own = points[sampled_groups == g]
            shapes[g] = Shape(own)
            trees[g] = _grow(shapes[g].turned(own), max(k + 1, 8, int(ROOM * block_rows * shares[g])))
    offsets, used = {}, 0
    for g in counts:
        offsets[g] = used
        used += len(trees[g]["column"]) if g in trees else 1

    @F.arrow_udf("bigint")
    def leaf_of(groups: pa.Array, vectors: pa.Array) -> pa.Array:
        leaf = np.zeros(len(groups), dtype=np.int64)
        labels = groups.dictionary_encode()
        codes, points = labels.indices.to_numpy(), _matrix(vectors, width)
        for code, g in enumerate(labels.dictionary.to_pylist()):
            members = np.flatnonzero(codes == code)
            leaf[members] = offsets[g]
            if g in trees:
                leaf[members] += _descend(trees[g], shapes[g].turned(points[members]))
        return pa.array(leaf)

    placed = materialize(rows.withColumn("leaf", leaf_of("g", "v")), "placed")
    ends = f"leaf bigint, n bigint, g {group_type}, low array<double>, high array<double>"

    def ends_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("g").dictionary_encode()
            leaves, codes = batch.column("leaf").to_numpy(), labels.indices.to_numpy()
            points = _matrix(batch.column("v"), width)
            for code, g in enumerate(labels.dictionary.to_pylist()):
                mine = np.flatnonzero(codes == code)
                mine = mine[np.argsort(leaves[mine], kind="stable")]
                leaf, starts, counts = np.unique(leaves[mine], return_index=True, return_counts=True)
                told = shapes[g].told(points[mine]) if g in shapes else np.zeros((len(mine), 1))
                lists = [_vectors(f.reduceat(told, starts, axis=0)) for f in (np.minimum, np.maximum)]
                groups = batch.column("g").take(pa.array(mine[starts]))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(counts), groups, *lists], ["leaf", "n", "g", "low", "high"])

    def ends_of_leaf(table: pa.Table) -> pa.Table:
        bounds = [np.array(table[c].to_pylist(), dtype=float) for c in ("low", "high")]
        return pa.table(
            {
                "leaf": table["leaf"].slice(0, 1), "n": [pa.compute.sum(table["n"]).as_py()], "g": table["g"].slice(0, 1),
                "low": pa.array([bounds[0].min(axis=0).tolist()], pa.list_(pa.float64())),
                "high": pa.array([bounds[1].max(axis=0).tolist()], pa.list_(pa.float64())),
            }
        )

    # one row per leaf; leaves are bounded by the sample
    partial = placed.select("leaf", "g", "v").mapInArrow(ends_of_batches, ends)
    boxes = partial.groupBy("leaf").applyInArrow(ends_of_leaf, ends).toPandas().sort_values("leaf", ignore_index=True)
    leaf_groups = boxes["g"].to_numpy()
    blocks = -(-boxes["n"].to_numpy() // block_rows)
    first = np.cumsum(blocks) - blocks
    bounds: dict = {}  # by class with a tree: low and high ends of its leaves and the slack for rounding
    for g in shapes:
        mine = np.flatnonzero(leaf_groups == g)
        low, high = (np.array(boxes[c].iloc[mine].tolist(), dtype=float) for c in ("low", "high"))
        bounds[g] = low, high, 1e-12 * float(max(np.abs(low).max(), np.abs(high).max())) ** 2
    several = bool(pd.Series(blocks).groupby(boxes["g"]).sum().gt(1).any())

    leaf_table = small_table(
        spark,
        list(zip(boxes["leaf"].tolist(), first.tolist(), blocks.tolist())),
        "leaf bigint, first bigint, blocks bigint",
    )
    # (leaf, first block, blocks): bounded by the sample, like the boxes
    in_block = placed.join(F.broadcast(leaf_table), "leaf").select(
        "k", "g", "v", "asks", (F.col("first") + F.pmod(F.xxhash64("k"), F.col("blocks"))).alias("block")
    )

    own_schema = (
        f"k string, g {group_type}, v array<double>, block bigint, bound double, "
        "nd array<double>, nk array<string>, nv array<double>, targets array<bigint>"
    )

    def answer_own(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table["k"]))  # ties between equal distances go to the smaller key
        refs, asking = _matrix(table["v"], width), np.flatnonzero(table["asks"].to_numpy())
        g, count = table["g"][0].as_py(), len(asking)
        bound = np.full(len(refs), -np.inf)
        bound[asking] = np.inf
        row, ref, d = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        if count and len(refs) > 1:
            row, ref, d = closest(refs, refs, k, bound, True, _turned(shapes.get(g)))
            last = np.searchsorted(row, asking, side="right") - 1
            full = np.bincount(row, minlength=len(refs))[asking] == k
            bound[asking[full]] = d[last[full]]
            row = np.searchsorted(asking, row)
        keys, table = table["k"].combine_chunks(), table.take(pa.array(asking))
        queries, bound = refs[asking], bound[asking]
        seeker, at = np.zeros(0, int), np.zeros(0, np.int64)
        if several and count and g in bounds:
            mine = np.flatnonzero(leaf_groups == g)
            own_leaf = np.searchsorted(first, table["block"][0].as_py(), side="right") - 1
            others = (mine != own_leaf) | (blocks[mine] > 1)
            low, high, slack = bounds[g]
            seeker, at = _seekers(shapes[g].told(queries), width, low[others], high[others], bound, slack, probes)
            at = mine[others][at]
        found = pa.array(ref)
        ends = _lists(row, count, pa.array(d))
        return pa.table(
            {
                "k": table["k"],
                "g": table["g"],
                "v": _vectors(queries),
                "block": table["block"],
                "bound": pa.array(bound),
                "nd": ends,
                "nk": _lists(row, count, keys.take(found)),
                "nv": pa.ListArray.from_arrays(
                    pa.array(ends.offsets.to_numpy() * width, pa.int32()), pa.array(refs[ref].ravel())
                ),
                "targets": _lists(seeker, count, pa.array(at)),
            }
        )

    own = in_block.groupBy("block").applyInArrow(answer_own, own_schema)
    result = [F.col("k").alias(key), F.col("g").alias(group), F.col("v").alias(vector)]
    told = [F.col("nd").alias("distances"), F.col("nk").alias("keys"), F.col("nv").alias("vectors")]
    if not several:
        return own.select(*result, *told)
    own = materialize(own, "own")

    # targets are positions in the leaf list, which a small table turns into blocks
    leaf_blocks = F.broadcast(
        small_table(spark, list(zip(range(len(first)), first.tolist(), (first + blocks - 1).tolist())), "at bigint, first bigint, last bigint")
    )
    visits = (
        own.select("k", "v", "bound", F.col("block").alias("own"), F.explode("targets").alias("at"))
        .join(leaf_blocks, "at")
        .select("k", "v", "bound", "own", F.explode(F.sequence("first", "last")).alias("block"))
        .where(F.col("block") != F.col("own"))
    )
    load = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("bigint").alias("parts"))
    # one row per visited block: broadcast only while there are few blocks
    load = F.broadcast(load) if int(blocks.sum()) <= BROADCAST_ROWS else load
    asked = visits.join(load, "block").select(
        "k", "v", "bound", "block", F.pmod(F.xxhash64("k"), F.col("parts")).alias("part")
    )
    held = in_block.join(load, "block").select(
        "k", "g", "v", "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    )

    def answer_visits(queries: pa.Table, refs: pa.Table) -> pa.Table:
        refs = refs.take(pc.sort_indices(refs["k"])) if len(refs) else refs
        matrix = _matrix(refs["v"], width)
        row, ref, d = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        if len(queries) and len(refs):
            bound, g = queries["bound"].to_numpy(), refs["g"][0].as_py()
            row, ref, d = closest(_matrix(queries["v"], width), matrix, k, bound, False, _turned(shapes.get(g)))
        asked, row = np.unique(row, return_inverse=True)
        ends = _lists(row, len(asked), pa.array(d))
        return pa.table(
            {
                "k": queries["k"].combine_chunks().take(pa.array(asked)),
                "nd": ends,
                "nk": _lists(row, len(asked), refs["k"].combine_chunks().take(pa.array(ref))),
                "nv": pa.ListArray.from_arrays(
                    pa.array(ends.offsets.to_numpy() * width, pa.int32()), pa.array(matrix[ref].ravel())
                ),
            }
        )

    found = (
        asked.groupBy("block", "part")
        .cogroup(held.groupBy("block", "part"))
        .applyInArrow(answer_visits, "k string, nd array<double>, nk array<string>, nv array<double>")
    )
    # a row's own answer and those of the blocks it visited meet once, each as one row of lists
    visiting = own.where(F.size("targets") > 0).select("k", "g", "v", "nd", "nk", "nv")
    near = F.transform(
        F.arrays_zip("nd", "nk"), lambda e, i: F.struct(e["nd"].alias("nd"), e["nk"].alias("nk"), F.slice("nv", i * width + 1, F.lit(width)).alias("nv"))
    )
    merged = (
        visiting.unionByName(found, allowMissingColumns=True)
        .groupBy("k")
        .agg(
            F.first("g", ignorenulls=True).alias("g"),
            F.first("v", ignorenulls=True).alias("v"),
            F.slice(F.sort_array(F.flatten(F.collect_list(near))), 1, k).alias("near"),
        )
        .select(
            "k",
            "g",
            "v",
            F.transform("near", lambda e: e["nd"]).alias("nd"),
            F.transform("near", lambda e: e["nk"]).alias("nk"),
            F.flatten(F.transform("near", lambda e: e["nv"])).alias("nv"),
        )
    )
    settled = own.where(F.size("targets") == 0).select(*result, *told)
    return settled.unionByName(merged.select(*result, *told))
