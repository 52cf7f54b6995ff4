"""The prefix tree of all conversations, built as z-fast tries of bounded shards that are joined where they touch.

A conversation is the row of its turns, known by their hashes. Distinct conversations are dealt out in lexicographic
order, so a shard is a range of them and shares with other shards only nodes on the way to its first and its last one
("edge" nodes). A task holds its shard as a compacted trie: a node stands for all depths between its parent and its
extent, and a hash table finds it by its handle, the prefix of its extent at the two-fattest depth (the one with the
most trailing zero bits) in between. Fat binary search over a new conversation's prefix hashes finds the node where it
leaves the trie in a logarithmic number of look-ups; batches of conversations are inserted one Arrow batch after the other.
At the end the edges of the trie are expanded into nodes for every depth.

All nodes but the edge nodes are final in their shard. The others, at most two conversations' depths per shard, are
merged by a grouping, weighted, and summed up along each shard's own two ways.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import q
from flowmill.llm import sql
from flowmill.session import materialize, new_path, scratch

#: Turns of distinct conversations per shard (about 200 bytes each in a task), unless one conversation has more.
SHARD_TURNS = 200_000
#: Bytes of conversation ids packed into a row on the way to their digest.
PACKED_BYTES = 1 << 20
#: Edge nodes (about 100 bytes each) that may be broadcast to find parents; more are joined by a shuffle.
BROADCAST_NODES = 1_000_000
BATCH_ROWS = 10_000
#: Conversations of one block of so many ids begin with up to five turns of the block's first one.
BLOCK, SHARED = 100, 6
_UNIT = 20  # bytes of a turn: 16 of its hash, 4 of its text's length
_NOTHING = hashlib.sha256(b"").hexdigest()


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] with the most trailing zero bits."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Node:
    """A compacted node: all depths in (start, depth] of one conversation's way."""

    __slots__ = ("start", "depth", "way", "children", "ends", "least", "edge")

    def __init__(self, start: int, depth: int, way: Way):
        self.start, self.depth, self.way = start, depth, way
        self.children: dict[bytes, Node] = {}
        self.ends, self.least, self.edge = 0, None, set()

    def handle(self) -> bytes:
        return self.way.prefix[two_fattest(self.start, self.depth)] if self.depth else self.way.prefix[0]


class Way:
    """The turns of a conversation and a digest of each of its prefixes."""

    __slots__ = ("units", "prefix")

    def __init__(self, units: bytes):
        self.units = units
        state = hashlib.md5()
        self.prefix = [state.digest()]
        for at in range(0, len(units), _UNIT):
            state.update(units[at : at + _UNIT])
            self.prefix.append(state.digest())

    @property
    def depth(self) -> int:
        return len(self.prefix) - 1

    def unit(self, depth: int) -> bytes:
        """The turn that leads from ``depth`` to the next."""
        return self.units[depth * _UNIT : (depth + 1) * _UNIT]

    def length(self, depth: int) -> int:
        """Code points of the last text at ``depth``."""
        return int.from_bytes(self.units[depth * _UNIT - 4 : depth * _UNIT], "big") if depth else 0


class ZFastTrie:
    """Distinct conversations with a number of members and the smallest member of each."""

    def __init__(self):
        self.root: Node | None = None
        self.handles: dict[bytes, Node] = {}
        self.low: bytes | None = None
        self.high: bytes | None = None

    def exit_node(self, way: Way) -> tuple[Node, int]:
        """The node in which ``way`` leaves the trie, and up to which depth the two agree."""
        node, low, high = self.root, 0, way.depth
        while low < high:  # fat binary search: the deepest node whose handle is a prefix of the way
            at = two_fattest(low, high)
            found = self.handles.get(way.prefix[at])
            if found is None:
                high = at - 1
            else:
                node, low = found, found.depth
        if node.depth < way.depth and node.way.prefix[node.depth] == way.prefix[node.depth]:
            node = node.children.get(way.unit(node.depth), node)  # it may leave before the handle of the next one
        low, high = node.start, min(node.depth, way.depth)
        while low < high:
            middle = (low + high + 1) // 2
            if node.way.prefix[middle] == way.prefix[middle]:
                low = middle
            else:
                high = middle - 1
        return node, low

    def insert(self, units: bytes, ends: int, least: int) -> None:
        way = Way(units)
        self.low = units if self.low is None else min(self.low, units)
        self.high = units if self.high is None else max(self.high, units)
        if self.root is None:
            self.root = Node(0, 0, way)
            self.handles[self.root.handle()] = self.root
        node, depth = self.exit_node(way)
        if depth < node.depth:
            node = self._split(node, depth)
        if depth < way.depth:
            leaf = Node(depth, way.depth, way)
            node.children[way.unit(depth)] = leaf
            self.handles[leaf.handle()] = leaf
            node = leaf
        node.ends += ends
        node.least = least if node.least is None else min(node.least, least)

    def _split(self, node: Node, depth: int) -> Node:
        """A new node above ``node``, down to ``depth``; both get handles of their own."""
        upper = Node(node.start, depth, node.way)
        parent, _ = self._above(node)
        del self.handles[node.handle()]
        parent.children[node.way.unit(node.start)] = upper
        upper.children[node.way.unit(depth)] = node
        node.start = depth
        self.handles[node.handle()] = node
        self.handles[upper.handle()] = upper
        return upper

    def _above(self, node: Node) -> tuple[Node, int]:
        """The parent: the deepest node whose handle is a prefix of the way to ``node`` above it."""
        above, low, high = self.root, 0, node.start
        while low < high:
            at = two_fattest(low, high)
            found = self.handles.get(node.way.prefix[at])
            if found is None or found.depth > node.start:
                high = at - 1
            else:
                above, low = found, found.depth
        return above, low

    def expand(self) -> Iterator[tuple]:
        """All nodes of all depths: what is summed up below each (children first), and how it stands to other shards.

        (node, parent, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved, length, ends, order, edge);
        ``order`` numbers the edge nodes with each before those below it. An edge node's children, leaves and sums
        are those of its inner children only, its n_convs and conv_id those of this shard.
        """
        for bound in {self.low, self.high}:
            way = Way(bound)
            node = self.root
            while True:
                node.edge.add(bound)
                if node.depth >= way.depth:
                    break
                node = node.children[way.unit(node.depth)]
        done: dict[int, tuple[int, int, int, int]] = {}
        stack, order = [(self.root, None)], 0
        finished: list[tuple[Node, Node | None]] = []
        while stack:
            node, parent = stack.pop()
            finished.append((node, parent))
            stack.extend((child, node) for child in node.children.values())
        size = {}
        for node, _ in reversed(finished):  # members below, and the smallest of them
            n, least = node.ends, node.least
            for child in node.children.values():
                m, other = size[id(child)]
                n, least = n + m, other if least is None else min(least, other)
            size[id(node)] = n, least
        order = sum(node.depth - node.start for node, _ in finished if node.edge) + 1
        for node, parent in reversed(finished):
            n, least = size[id(node)]
            inner = [done[id(c)] for c in node.children.values() if not c.edge]
            children, leaves, saved = len(inner), sum(x[0] for x in inner), sum(x[1] for x in inner)
            way, edge, ends = node.way, bool(node.edge), node.ends
            for depth in range(node.depth, node.start if parent else -1, -1):
                length = way.length(depth)
                if not edge:
                    leaves += not children
                    saved += (n - 1) * length
                order -= edge
                above = parent if depth == node.start + 1 else node
                up = way.prefix[depth - 1] if depth else None
                # an inner node's parent is final too, or an edge node whose smallest member is not known yet
                above_conv = size[id(above)][1] if depth and not above.edge and not edge else None
                yield (way.prefix[depth], up, depth, least, above_conv, n, children, leaves, saved, length, ends, order if edge else None, edge)
                children, ends = (0 if edge else 1), 0
                if edge:
                    leaves = saved = 0
            done[id(node)] = leaves, saved


_FIELDS = [
    ("node", "binary"), ("parent", "binary"), ("depth", "long"), ("conv_id", "long"), ("parent_conv_id", "long"), ("n_convs", "long"),
    ("n_children", "long"), ("n_leaves", "long"), ("saved", "long"), ("length", "long"), ("ends", "long"), ("place", "long"),
    ("edge", "boolean"), ("shard", "int"),
]
_ARROW = {"binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32()}


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    waiting = []
    for row in rows:
        waiting.append(row)
        if len(waiting) == BATCH_ROWS:
            yield _batch(waiting, schema)
            waiting = []
    if waiting:
        yield _batch(waiting, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def shard_nodes(distinct: DataFrame, shards: int) -> DataFrame:
    """The nodes of every shard's trie over distinct conversations (units, n, least); see ``ZFastTrie.expand``."""
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in _FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId() if context else 0
        trie = ZFastTrie()
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("units", "n", "least")), strict=True):
                trie.insert(*row)
        if trie.root:
            yield from _batches(((*row, shard) for row in trie.expand()), schema)

    return distinct.repartitionByRange(shards, "units").mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in _FIELDS))


def _edge_sums(table: pa.Table) -> pa.Table:
    """Sums over the edge nodes of one shard: what each adds itself and all below it (at most two conversations' depths)."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("place", "depth", "node", "own_leaves", "own_saved")), strict=True))
    below: dict[int, tuple[int, int]] = {}
    found = []
    for _, depth, node, leaves, saved in reversed(rows):
        more = below.pop(depth + 1, (0, 0))
        leaves, saved = leaves + more[0], saved + more[1]
        found.append((node, leaves, saved))
        beside = below.get(depth, (0, 0))
        below[depth] = beside[0] + leaves, beside[1] + saved
    schema = pa.schema([("node", pa.binary()), ("n_leaves", pa.int64()), ("saved", pa.int64())])
    return pa.Table.from_batches([_batch(found, schema)])


def _merged_edges(edges: DataFrame) -> DataFrame:
    """The edge nodes of all shards, each once, with final values but for the parent's smallest member."""
    nodes = edges.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inner"), F.first("length").alias("length"),
        F.sum("ends").alias("ends"), F.min("shard").alias("owner"),
    )
    nodes = materialize(nodes, "edges")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("outer"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.col("inner") + F.coalesce("outer", F.lit(0)))
    nodes = materialize(nodes.drop("inner", "outer"), "edges")
    told = nodes.select("node", "owner", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("length")).alias("weight"))
    mine = F.when(F.col("shard") == F.col("owner"), 1).otherwise(0)
    parts = edges.join(told, "node").select(
        "shard", "place", "depth", "node",
        (F.col("n_leaves") + mine * F.col("leaf")).alias("own_leaves"), (F.col("saved") + mine * F.col("weight")).alias("own_saved"),
    )
    sums = parts.groupBy("shard").applyInArrow(_edge_sums, "node binary, n_leaves long, saved long")
    sums = sums.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    return nodes.join(sums, "node")


def _end_digests(ends: DataFrame, tasks: int) -> DataFrame:
    """(node, ends_sha256) for (node, conv_id): SHA-256 of the node's ids, ascending, with commas.

    Sorted by node and id over the cluster, ids become texts of bounded length there; the digest of a node is taken over
    its texts one after the other, so that a node where a third of all conversations end is never held at once.
    """
    most = PACKED_BYTES
    packed = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.binary())])
    digests = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            node, first, ids, size = None, 0, [], 0
            for batch in batches:
                for own, id in zip(*(batch.column(c).to_pylist() for c in ("node", "conv_id")), strict=True):
                    if own != node or size >= most:
                        if ids:
                            yield node, first, b",".join(ids)
                        node, first, ids, size = own, id, [], 0
                    ids.append(b"%d" % id)
                    size += len(ids[-1]) + 1
            if ids:
                yield node, first, b",".join(ids)

        waiting, size = [], 0
        for row in rows():
            waiting.append(row)
            size += len(row[2])
            if size >= most or len(waiting) == BATCH_ROWS:
                yield _batch(waiting, packed)
                waiting, size = [], 0
        if waiting:
            yield _batch(waiting, packed)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            node, state = None, None
            for batch in batches:
                for own, ids in zip(*(batch.column(c).to_pylist() for c in ("node", "ids")), strict=True):
                    if own != node:
                        if state:
                            yield node, state.hexdigest()
                        node, state = own, hashlib.sha256(ids)
                    else:
                        state.update(b"," + ids)
            if state:
                yield node, state.hexdigest()

        yield from _batches(rows(), digests)

    ranged = ends.repartitionByRange(tasks, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    texts = ranged.mapInArrow(pack, "node binary, first long, ids binary")
    return texts.repartition(tasks, "node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def rebuilt(turns: DataFrame, shared: bool) -> DataFrame:
    """(conv_id, units): the turns of every conversation in a row, 16 bytes of hash and 4 of length each."""
    role, text = (F.coalesce(q(c).cast("string"), F.lit("")) for c in ("role", "text"))
    unit = F.concat(
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")), F.lpad(F.hex(F.length(text)), 8, "0")
    )
    own = turns.select(q("conv_id").cast("long").alias("conv_id"), q("turn").cast("long").alias("turn"), unit.alias("unit"))
    own = own.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "unit"))).getField("unit").alias("own"))
    if not shared:
        return own.select("conv_id", F.unhex(F.array_join("own", "")).alias("units"))
    own = materialize(own, "turns")
    first = own.filter(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("head"), F.slice("own", 1, SHARED - 1).alias("first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    joined = own.withColumn("head", F.col("conv_id") - F.col("conv_id") % BLOCK).join(first, "head", "left")
    row = F.concat(
        F.slice(F.coalesce("first", F.array().cast("array<string>")), F.lit(1), h), F.slice("own", h + 1, F.size("own"))
    )
    return joined.select("conv_id", F.unhex(F.array_join(row, "")).alias("units"))


def prefix_nodes(turns: DataFrame, shared: bool = False) -> DataFrame:
    """The nodes of the prefix tree over ``turns`` (conv_id, turn, role, text): each distinct row of first turns is one.

    Columns: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id, null for the root), n_convs,
    n_children, n_leaves, saved_tokens (summed over its subtree: (n_convs - 1) times the code points of the last text)
    and ends_sha256 (of the comma-joined ids of conversations that end there).

    Turns are ordered by ``turn``, null first, ties by the hash of role and text; null roles and texts are empty;
    repeated rows are repeated turns. Rows without a conv_id take no part; without conversations there is no node.
    With ``shared`` every conversation begins with up to five turns of its block of 100 ids (see ``rebuilt``).
    One conversation must fit into a task, 24 bytes a turn; other columns are not looked at. Turns are known by 128 bits.
    """
    spark = turns.sparkSession
    path = new_path(spark, "nodes")
    with scratch(spark):
        convs = materialize(rebuilt(turns, shared), "rebuilt")
        volume = convs.agg(F.sum(F.length("units") / _UNIT + 1)).first()[0] or 0
        shards = max(int(-(-volume // SHARD_TURNS)), 1)
        distinct = convs.groupBy("units").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
        nodes = materialize(shard_nodes(distinct, shards), "shards")
        edges = materialize(_merged_edges(nodes.filter("edge")), "edges")
        columns = ["node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
        few = edges.count() <= BROADCAST_NODES
        above = edges.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
        above = F.broadcast(above) if few else above
        every = nodes.filter("not edge").select(columns).unionByName(edges.withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns))
        every = every.join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
        ends = _end_digests(convs.select(F.unhex(F.md5("units")).alias("node"), "conv_id"), shards)
        named = every.filter("ends > 0").join(ends, "node").unionByName(
            every.filter("ends = 0").withColumn("ends_sha256", F.lit(_NOTHING)).select(*every.columns, "ends_sha256")
        )
        named.select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"
        ).write.parquet(path)
    return spark.read.parquet(path)


def oracle() -> str:
    return f"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
      SELECT conv_id, list(struct_pack(role := role, text := text)
        ORDER BY turn NULLS FIRST, md5(strlen(role)::VARCHAR || ':' || role || text)) AS own
      FROM t GROUP BY 1),
    rebuilt AS MATERIALIZED (
      SELECT o.conv_id, list_concat(CASE WHEN b.own IS NULL THEN [] ELSE b.own[:o.h] END, o.own[o.h + 1:]) AS row
      FROM (SELECT *, ({sql.crc32("conv_id::VARCHAR")} % {SHARED})::INT AS h FROM own) o
      LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % {BLOCK}),
    members AS (SELECT conv_id, row[:d] AS way, d AS depth, len(row) = d AS last FROM rebuilt, unnest(range(0, len(row) + 1)) AS u(d)),
    nodes AS MATERIALIZED (
      SELECT way, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
      FROM members GROUP BY 1, 2),
    known AS MATERIALIZED (
      SELECT n.way, n.depth, n.conv_id, n.n_convs, n.ends_sha256, p.conv_id AS parent_conv_id, coalesce(c.n, 0) AS n_children,
        CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.way[n.depth].text) END AS saved
      FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.way = n.way[:n.depth - 1] AND p.depth = n.depth - 1
      LEFT JOIN (SELECT way[:depth - 1] AS way, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1) c ON c.way = n.way),
    sums AS (
      SELECT way[:d] AS way, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
      FROM known, unnest(range(0, depth + 1)) AS u(d) GROUP BY 1)
    SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, k.ends_sha256
    FROM known k JOIN sums s USING (way)"""
