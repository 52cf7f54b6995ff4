"""Near duplicates by Jaccard similarity of word shingles: exact, by vertical partitioning, without pairs of copies.

The global order of shingles is that of their hashes. It is cut into fragments, as many as a pair of linked sets of some
size can have differing shingles, and a quarter more: then several fragments are the same in both. As many of a set's
fragments as may agree beside one are left out, those that most sets have: the rarest agreeing fragment of a linked
pair is among the others on both sides. So sets are candidates if a fragment agrees that both keep, and a passage that
many texts share brings together only texts that hold little else. For candidates the common shingles are counted in
each coarse fragment separately and summed per pair.

Equal sets are one class from the start. Classes that share a kept fragment form a bucket, however many they are; a
bucket is compared with two of its members at a time, and members already connected are not compared again; only buckets
that are still apart go on. What is apart after a few rounds is compared in full, in blocks, so that no link is lost; sizes
and bit sketches, which bound the difference of two sets from below, leave most of these pairs out inside the join.
Neither links nor buckets reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmill.functions.columns import q
from flowmill.llm.batches import pieces
from flowmill.llm.words import SPACED, mix, windows, word_spans
from flowmill.session import materialize, new_path, scratch

SHINGLE = 4
#: Linked if 100 * common >= 85 * union.
THRESHOLD = (85, 100)
#: Rounds of comparing with two members per bucket before what is still apart is compared in full.
STAR_ROUNDS = 2
#: Coarse fragments in which common shingles are counted; 64-bit words of a set's sketch.
COUNTED_FRAGMENTS, SKETCH_WORDS = 4, 16
#: Ids (8 bytes each) that may be broadcast to pick documents; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Text bytes whose fragments one task groups, and keys that a task holds before it hands them on.
PART_BYTES, CHUNK_KEYS = 32 << 20, 1_000_000
#: A class is heavy if more than one row in so many belongs to it, so there are fewer heavy ones than this.
HEAVY = 1_000
_KEY_BITS = 40
#: Members of a bucket that one task compares with as many others in the last round.
BLOCK_MEMBERS = 1_000
_NO_ID = (1 << 63) - 1


class Sizes:
    """Classes of set sizes: linked sets are in the same or in neighbouring classes."""

    def __init__(self, threshold: tuple[int, int], most: int):
        p, d = threshold
        borders = [1]
        while borders[-1] <= most:
            borders.append(max(-(-borders[-1] * d // p), borders[-1] + 1))
        borders.append(max(-(-borders[-1] * d // p), borders[-1] + 1))
        borders.append(max(-(-borders[-1] * d // p), borders[-1] + 1))
        self.borders = np.array(borders)
        largest = self.borders[1:] - 1
        # common >= p * (a + b) / (d + p), so a + b - 2 * common <= (d - p) * (a + b) / (d + p)
        self.differ = 2 * largest * (d - p) // (d + p)
        self.fragments = np.where(self.differ > 0, self.differ + 4 + self.differ // 4, 0)

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.borders, n, side="right") - 1


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of all texts in a row, and each text's offset."""
    _, _, _, hashes, offsets = word_spans(texts, SPACED)
    found, ends = windows(hashes, offsets, size)
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        found[a:b].sort()
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    new[ends[:-1][np.diff(ends) > 0]] = True
    return found[new], np.append(0, np.cumsum(new))[ends]


def set_ids(shingles: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set; 0 for empty ones."""
    found = []
    for salt in (0x1234567, 0x7654321):
        sums = np.append(np.uint64(0), np.cumsum(mix(shingles + np.uint64(salt)), dtype=np.uint64))
        found.append(mix(sums[offsets[1:]] - sums[offsets[:-1]]).astype(np.int64))
    return found[0], found[1]


def fragment_keys(shingles: np.ndarray, offsets: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, ...]:
    """Hashes of the fragments of all sets, for their own size class and the next, and the set of each.

    The lowest bit of a key is that of its size class. A set with too few filled fragments for the guarantee gives every
    shingle as a key of its own besides. The third result tells for each set the lowest bit of its own size class, the
    fourth and fifth how many of its keys for its own class and for the next it can do without.
    """
    n = np.diff(offsets)
    spare = [np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)]
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    owner = np.repeat(np.arange(len(n)), n)
    mixed = mix(shingles ^ np.uint64(0x5BF0363546E1A5C3))
    for step in (0, 1):
        kind = sizes.of(np.maximum(n, 1)) + step
        number = np.where(n > 0, sizes.fragments[kind], 0)
        some = number[owner] > 0
        own, parts = owner[some], number[owner[some]].astype(np.uint64)
        if not len(own):
            continue
        place = (shingles[some] >> np.uint64(32)) * parts >> np.uint64(32)
        first = np.ones(len(own), bool)
        first[1:] = (own[1:] != own[:-1]) | (place[1:] != place[:-1])
        starts = np.flatnonzero(first)
        salt = mix(place[starts] + (kind[own[starts]].astype(np.uint64) << np.uint64(40)))
        keys.append(mix(np.add.reduceat(mixed[some], starts) + salt))
        owners.append(own[starts])
        filled = np.bincount(own[starts], minlength=len(n))
        sparse = (number > 0) & (filled <= sizes.differ[kind])
        # at most so many fragments as shingles differ are not the same in a linked set
        spare[step] = np.where(number > 0, np.maximum(filled - sizes.differ[kind] - 1, 0), 0)
        bit = kind.astype(np.uint64) & np.uint64(1)
        keys[-1] = (keys[-1] & ~np.uint64(1)) | bit[owners[-1]]
        if sparse.any():
            which = sparse[owner]
            own = owner[which]
            single = mix(mixed[which] + mix((kind[own] + (1 << 20)).astype(np.uint64)))
            keys.append((single & ~np.uint64(1)) | bit[own])
            owners.append(own)
    return np.concatenate(keys), np.concatenate(owners), sizes.of(np.maximum(n, 1)) & 1, *spare


def _packed(keys: np.ndarray, owners: np.ndarray, parts: int) -> Iterator[tuple]:
    """A task's keys by part, each once with one owner, and its own buckets of keys with several owners."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    key = (part << _KEY_BITS) | (keys & np.uint64((1 << _KEY_BITS) - 1)).astype(np.int64)
    order = np.lexsort((owners, key))
    key, owner = key[order], owners[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    again = np.zeros(len(key), bool)
    again[1:] = ~first[1:] & (owner[1:] != owner[:-1])
    several = np.zeros(len(key), bool)
    several[np.flatnonzero(first)] = np.logical_or.reduceat(again, np.flatnonzero(first)) if len(key) else False
    several |= again
    yield None, None, None, None, key[several].tobytes(), owner[several].tobytes()
    key, owner = key[first], owner[first]
    part = key >> _KEY_BITS
    order = np.lexsort((key, owner, part))
    key, owner, part = key[order], owner[order], part[order]
    borders = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else []
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        low = key[a:b].astype("<i8").view(np.uint8).reshape(-1, 8)[:, : _KEY_BITS // 8]
        starts = np.flatnonzero(np.append(True, owner[a + 1 : b] != owner[a : b - 1]))
        counts = np.diff(np.append(starts, b - a)).astype(np.uint32)
        yield int(part[a]), low.tobytes(), owner[a:b][starts].tobytes(), counts.tobytes(), None, None


_KEYED = "part int, keys binary, owners binary, counts binary, bucket_keys binary, bucket_owners binary"
_SETS = "id long, n int, hi long, lo long, bit int, spare0 int, spare1 int"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.int32()] * 3, pa.int32(), *[pa.binary()] * 5]


def _sets(texts: DataFrame, parts: int, size: int, threshold: tuple[int, int]) -> DataFrame:
    """A row per text with its set's size and ids, and rows with packed fragment keys of the classes."""
    names = [x.split(" ")[0] for x in f"{_SETS}, {_KEYED}".split(", ")]

    def rows(columns: list, n: int) -> pa.RecordBatch:
        arrays = [pa.nulls(n, k) if c is None else pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(threshold, 1 << 12)
        seen: set[tuple[int, int]] = set()
        keys, owners, waiting = [], [], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                shingles, offsets = shingle_sets(piece.column("text"), size)
                n = np.diff(offsets)
                hi, lo = set_ids(shingles, offsets)
                if n.max(initial=0) >= sizes.borders[-3]:
                    sizes = Sizes(threshold, 2 * int(n.max()))
                fresh = np.zeros(len(n), bool)
                for i, pair in enumerate(zip(hi.tolist(), lo.tolist(), strict=True)):
                    if n[i] and pair not in seen:
                        seen.add(pair)
                        fresh[i] = True
                mine = np.repeat(fresh, n)
                found, who, *told = fragment_keys(shingles[mine], np.append(0, np.cumsum(n[fresh])), sizes)
                facts = []
                for values in told:  # of the first text with a set only
                    every = np.ma.masked_all(len(n), np.int32)
                    every[fresh] = values
                    facts.append(pa.array(every.data, pa.int32(), mask=np.ma.getmaskarray(every)))
                yield rows([piece.column("id"), n.astype(np.int32), hi, lo, *facts, *[None] * 6], len(n))
                keys.append(found)
                owners.append(lo[fresh][who])
                waiting += len(found)
                if waiting >= CHUNK_KEYS:
                    for row in _packed(np.concatenate(keys), np.concatenate(owners), parts):
                        yield rows([None] * 7 + [[x] for x in row], 1)
                    keys, owners, waiting = [], [], 0
                    seen.clear()
        if waiting:
            for row in _packed(np.concatenate(keys), np.concatenate(owners), parts):
                yield rows([None] * 7 + [[x] for x in row], 1)

    return texts.mapInArrow(run, f"{_SETS}, {_KEYED}")


def _shared(table: pa.Table) -> pa.Table:
    """Keys of one part that several classes have, with their classes."""
    part = table.column("part")[0].as_py()
    keys, owners = [], []
    for low, own, counts in zip(*(table.column(c).to_pylist() for c in ("keys", "owners", "counts")), strict=True):
        wide = np.zeros((len(low) // (_KEY_BITS // 8), 8), np.uint8)
        wide[:, : _KEY_BITS // 8] = np.frombuffer(low, np.uint8).reshape(len(wide), -1)
        keys.append(wide.view("<i8").ravel())
        owners.append(np.repeat(np.frombuffer(own, np.int64), np.frombuffer(counts, np.uint32)))
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[fresh], owner[fresh]
    more = np.zeros(len(key) + 1, bool)
    more[1:-1] = key[1:] == key[:-1]
    several = more[1:] | more[:-1]
    return pa.table({"key": (np.int64(part) << _KEY_BITS) | key[several], "cls": owner[several]})


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, owners in zip(*(batch.column(c).to_pylist() for c in ("bucket_keys", "bucket_owners")), strict=True):
            columns = [pa.array(np.frombuffer(x, np.int64)) for x in (keys, owners)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "cls"])


def _buckets(sets: DataFrame) -> DataFrame:
    """(key, cls): the classes that share a fragment, one key for all fragments shared by the same classes."""
    across = sets.filter(F.col("part").isNotNull()).select("part", "keys", "owners", "counts")
    within = sets.filter(F.col("bucket_keys").isNotNull()).select("bucket_keys", "bucket_owners")
    found = across.groupBy("part").applyInArrow(_shared, "key long, cls long")
    found = materialize(found.union(within.mapInArrow(_unpacked, "key long, cls long")).distinct(), "buckets")
    found = materialize(_without_spare(found, sets), "kept")
    members = found.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("cls").alias("low"),
        F.max("cls").alias("high"),
        F.bit_xor(F.xxhash64("cls")).alias("x"),
        F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y"),
    )
    kept = members.filter("n > 1").groupBy("n", "low", "high", "x", "y").agg(F.min("key").alias("key"))
    return found.join(kept.select("key"), "key", "left_semi")


def _without_spare(found: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, cls) without the keys that a class can do without: of its shared ones those that most classes have.

    The rarest key that a linked pair shares stays on both sides: besides it, at most as many keys of a set are not
    shared as shingles differ, and all that are left out stand behind so many and one in the common order.
    """
    several = F.min("bit") == F.max("bit")  # classes are known by 64 bits here: of two with the same, nothing is left out
    told = sets.filter("bit is not null").groupBy(F.col("lo").alias("cls")).agg(
        F.min("bit").alias("bit"), *(F.when(several, F.min(c)).otherwise(0).alias(c) for c in ("spare0", "spare1"))
    )
    held = found.groupBy("key").agg(F.count(F.lit(1)).alias("held"))
    rows = found.join(held, "key").join(told, "cls")
    step = F.col("key").bitwiseAND(F.lit(1)).bitwiseXOR(F.col("bit").cast("long"))
    rows = rows.withColumn("step", step).withColumn("spare", F.when(step == 0, F.col("spare0")).otherwise(F.col("spare1")))
    common_last = Window.partitionBy("cls", "step").orderBy(F.desc("held"), F.desc("key"))  # the keys of one set
    return rows.withColumn("place", F.row_number().over(common_last)).filter("place > spare").select("key", "cls")


def _fragments(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cls, n, s0 ..., f0 ...) of the wanted classes, each from the first document that has it.

    f0 ... are the set's shingles by coarse fragment, s0 ... its sketch: one bit per group of shingles, telling whether
    their number is odd. Two sets differ in at least as many shingles as their sketches differ in bits.
    """
    few = wanted.count() <= BROADCAST_IDS
    picked = wanted.select("id").distinct()
    docs = texts.join(F.broadcast(picked) if few else picked, "id", "left_semi")
    names = ["hi", "lo", "n", *_SKETCH, *_PARTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                shingles, offsets = shingle_sets(piece.column("text"), size)
                hi, lo = set_ids(shingles, offsets)
                columns = [pa.array(x) for x in (hi, lo, np.diff(offsets).astype(np.int32), *sketches(shingles, offsets))]
                for k in range(COUNTED_FRAGMENTS):
                    inside = (shingles >> np.uint64(32)) * np.uint64(COUNTED_FRAGMENTS) >> np.uint64(32) == k
                    ends = np.append(0, np.cumsum(inside))[offsets].astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(shingles[inside].view(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names)

    kinds = ["hi long", "lo long", "n int", *(f"{c} long" for c in _SKETCH), *(f"{c} array<long>" for c in _PARTS)]
    found = docs.mapInArrow(run, ", ".join(kinds))
    classes = wanted.select("hi", "lo")
    found = found.join(F.broadcast(classes) if few else classes, ["hi", "lo"], "left_semi")
    found = materialize(found.withColumnRenamed("lo", "cls"), "fragments")
    if found.groupBy("cls", "hi").count().filter("count > 1").isEmpty():
        return found.drop("hi")
    return materialize(found.dropDuplicates(["hi", "cls"]), "fragments").drop("hi")  # ids that several texts have


_SKETCH = [f"s{k}" for k in range(SKETCH_WORDS)]
_PARTS = [f"f{k}" for k in range(COUNTED_FRAGMENTS)]


def sketches(shingles: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For every set, bits that tell for each group of shingles whether their number is odd; 64 bits per array."""
    mixed = mix(shingles ^ np.uint64(0x2545F4914F6CDD1D))
    word, bit = mixed >> np.uint64(32), np.uint64(1) << (mixed & np.uint64(63))
    found = []
    for k in range(SKETCH_WORDS):
        own = np.where(word % np.uint64(SKETCH_WORDS) == k, bit, np.uint64(0))
        sums = np.bitwise_xor.accumulate(np.append(np.uint64(0), own))
        found.append((sums[offsets[1:]] ^ sums[offsets[:-1]]).view(np.int64))
    return found


def _maybe(left: str, right: str, threshold: tuple[int, int]) -> Column:
    """False for pairs that their sizes or sketches show to be too different."""
    p, d = threshold
    a, b = F.col(f"{left}n"), F.col(f"{right}n")
    apart = sum((F.bit_count(F.col(left + c).bitwiseXOR(F.col(right + c))) for c in _SKETCH), F.lit(0))
    return (a * d >= b * p) & (b * d >= a * p) & (apart * (d + p) <= (a + b) * (d - p))


def _side(fragments: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    return fragments.select(F.col("cls").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in columns))


def _linked(pairs: DataFrame, fragments: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that reach the threshold: common shingles counted by fragment and summed."""
    p, d = threshold
    # sizes and sketches first: shingles are moved for the pairs that are left
    told = ["n", *_SKETCH]
    maybe = pairs.join(_side(fragments, "a", told), "a").join(_side(fragments, "b", told), "b")
    maybe = maybe.filter(_maybe("a_", "b_", threshold)).select("a", "b", (F.col("a_n") + F.col("b_n")).alias("n"))
    maybe = materialize(maybe, "candidates")
    wanted = maybe.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    few = wanted.count() <= BROADCAST_IDS
    fragments = fragments.join(F.broadcast(wanted) if few else wanted, "cls", "left_semi")
    both = maybe.join(_side(fragments, "a", _PARTS), "a").join(_side(fragments, "b", _PARTS), "b")
    common = sum((F.size(F.array_intersect(f"a_{c}", f"b_{c}")) for c in _PARTS), F.lit(0))
    counted = both.select("a", "b", "n", common.alias("common"))
    return counted.filter(d * F.col("common") >= p * (F.col("n") - F.col("common"))).select("a", "b")


def _mark(labels: DataFrame) -> int:
    """A number that changes with the labels."""
    return labels.agg(F.bit_xor(F.xxhash64("cls", "label"))).first()[0]


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(cls, label) with the least label that links (a, b) connect; ``labels`` may already join some.

    Classes take the least label beside them; from the fourth step on also the label of their label, so that long chains
    shorten by half each time.
    """
    ways = links.select("a", "b").union(links.select("b", "a")).toDF("cls", "other")
    # classes that already share a label hand it on through the class the label names
    ways = materialize(ways.union(labels.filter("cls <> label").select("cls", "label")).union(
        labels.filter("cls <> label").select("label", "cls")
    ), "ways")
    step, before = 0, _mark(labels)
    while True:
        beside = ways.join(labels.withColumnRenamed("cls", "other"), "other").select("cls", "label")
        if step >= 3:
            jump = labels.select("cls", F.col("label").alias("other")).join(labels.withColumnRenamed("cls", "other"), "other")
            beside = beside.union(jump.select("cls", "label"))
        labels = materialize(labels.union(beside).groupBy("cls").agg(F.min("label").alias("label")), "labels")
        step, after = step + 1, _mark(labels)
        if after == before:
            return labels
        before = after


def _turn(step: int) -> Column:
    """An order of the classes, another one for every step."""
    return (F.xxhash64("cls", F.lit(step)) if step else F.col("cls")).alias("turn")


def link_components(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    size: int = SHINGLE,
    threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """Per row: ``id``, ``n_shingles`` (of its set) and ``component_id``, the smallest id reachable by links.

    Texts with fewer than ``size`` words have one shingle, all their words; null and empty texts have none and are
    linked with nothing. Equal sets are linked. Repeated rows stay, each with the same component. A null id is left out
    of a component's smallest id (null if it has no other). Words are known by 64-bit hashes, sets by 128 bits, of which
    64 name a class among candidates.
    """
    spark = docs.sparkSession
    path = new_path(spark, "components")
    with scratch(spark):  # what is written on the way goes with the end of the work
        _link_components(docs, text, id, size, threshold).write.parquet(path)
    return spark.read.parquet(path)


def _link_components(docs: DataFrame, text: str, id: str, size: int, threshold: tuple[int, int]) -> DataFrame:
    texts = docs.select(F.coalesce(q(id).cast("long"), F.lit(_NO_ID)).alias("id"), q(text).cast("string").alias("text"))
    volume = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(-(-volume // PART_BYTES), 1)
    spark, paths = docs.sparkSession, [new_path(docs.sparkSession, name) for name in ("rows", "buckets")]
    with scratch(spark):  # the keys are the largest table, and done with here
        sets = materialize(_sets(texts, parts, size, threshold), "sets")
        sets.filter(F.col("n").isNotNull()).select("id", "n", "hi", "lo").write.parquet(paths[0])
        _buckets(sets).write.parquet(paths[1])
    rows, buckets = (spark.read.parquet(path) for path in paths)
    real_id = F.when(F.col("id") != _NO_ID, F.col("id"))
    classes = rows.filter("n > 0").groupBy("hi", "lo").agg(F.min("id").alias("id"), F.min(real_id).alias("least"), F.count(F.lit(1)).alias("copies"))
    mine = buckets.select(F.col("cls").alias("lo")).distinct()
    wanted = materialize(classes.join(mine, "lo", "left_semi"), "classes")
    fragments = _fragments(texts, wanted, size)
    labels = wanted.select(F.col("lo").alias("cls"), F.col("lo").alias("label")).distinct()
    for step in range(STAR_ROUNDS + 1):
        members = buckets.join(labels, "cls")
        apart = members.groupBy("key").agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            *(F.min(F.struct(_turn(2 * step + k), "cls", "label")).alias(f"c{k}") for k in (0, 1)),
        )
        apart = materialize(apart.filter("low <> high"), "apart")
        if apart.isEmpty():
            break
        members = materialize(members.join(apart.select("key"), "key", "left_semi"), "members")
        buckets = members.select("key", "cls")
        if step < STAR_ROUNDS:
            centres = apart.select("key", F.explode(F.array_distinct(F.array("c0", "c1"))).alias("c"))
            others = centres.select("key", F.col("c.cls").alias("other"), F.col("c.label").alias("other_label"))
            pairs = members.join(others, "key").filter("label <> other_label")
        else:
            # members outside a bucket's first component against all others
            told = _side(fragments, "cls", ["n", *_SKETCH])
            blocks = members.groupBy("key").agg((F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS) - 1).cast("int").alias("most"))
            rest = members.join(apart.select("key", "low"), "key").join(blocks, "key").join(told, "cls")
            small = rest.filter("label <> low")
            # a large bucket is dealt out to several tasks, each with one block of its members and one of the others
            own, every = F.pmod(F.xxhash64("cls"), F.col("most") + 1).cast("int"), F.explode(F.sequence(F.lit(0), "most"))
            rest, small = rest.withColumn("i", own).withColumn("j", every), small.withColumn("j", own).withColumn("i", every)
            small = small.select("key", "i", "j", *(F.col(c).alias(f"o_{c}") for c in small.columns if c not in ("key", "i", "j")))
            pairs = rest.join(small, ["key", "i", "j"]).filter(
                (F.col("label") != F.col("o_label"))
                & ((F.col("label") == F.col("low")) | (F.col("cls") < F.col("o_cls")))
                & _maybe("cls_", "o_cls_", threshold)
            )
            pairs = pairs.withColumnRenamed("o_cls", "other")
        pairs = pairs.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct()
        links = materialize(_linked(pairs, fragments, threshold), "links")
        if not links.isEmpty():
            labels = components(labels, links)
    named = wanted.join(labels, wanted["lo"] == labels["cls"])
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    joined = named.join(least, "label").select("hi", "lo", "component_id")
    known = classes.join(joined, ["hi", "lo"], "left")
    known = known.select("hi", "lo", "copies", F.coalesce("component_id", "least").alias("component_id"))
    own = real_id.alias(id), F.col("n").cast("long").alias("n_shingles")
    # the few classes of a large share of the rows reach them by a broadcast, so that no task gets all their copies
    total = rows.count()
    heavy = F.broadcast(materialize(known.filter(F.col("copies") * HEAVY > total), "heavy"))
    filled = rows.filter("n > 0")
    light = filled.join(heavy, ["hi", "lo"], "left_anti").join(known.filter(F.col("copies") * HEAVY <= total), ["hi", "lo"])
    some = filled.join(heavy, ["hi", "lo"]).select(*own, "component_id").unionByName(light.select(*own, "component_id"))
    none = rows.filter("n = 0").select(*own, real_id.alias("component_id"))
    return some.unionByName(none)


def one_per_component(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    size: int = SHINGLE,
    threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with its smallest id.

    Rows without an id stand behind all others; equal texts among them count as one. Rows of one id and text count as
    one. Other rows of one id are not told apart: they stay or go together. Rows without a shingle are linked with nothing
    and stay. Columns are those of ``docs``.
    """
    behind = F.lit(1 << 62) + F.pmod(F.xxhash64(F.coalesce(q(text).cast("string"), F.lit(""))), F.lit(1 << 61))
    named = F.coalesce(q(id).cast("long"), behind)
    small = docs.select(named.alias("id"), q(text).cast("string").alias("text"))
    found = link_components(small, "text", "id", size, threshold).groupBy("id")
    told = materialize(found.agg(F.max(F.col("id") == F.col("component_id")).alias("stays"), F.count(F.lit(1)).alias("n")), "ids")
    gone = told.filter("not stays").select(F.col("id").alias("_named"))
    few = gone.count() <= BROADCAST_IDS
    kept = docs.withColumn("_named", named).join(F.broadcast(gone) if few else gone, "_named", "left_anti")
    if not told.filter("stays and n > 1").isEmpty():
        kept = kept.dropDuplicates(["_named", text])
    return kept.select(*(q(c) for c in docs.columns))


def oracle() -> str:
    """The same in DuckDB: shared shingles counted for all pairs of different sets, links closed by recursion."""
    p, d = THRESHOLD
    return f"""
    WITH RECURSIVE words AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents),
    sets AS MATERIALIZED (
      SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
        range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')))) END AS s
      FROM words),
    classes AS MATERIALIZED (SELECT min(r) AS c, s, len(s) AS n, min(doc_id) AS least FROM sets WHERE len(s) > 0 GROUP BY s),
    shingles AS MATERIALIZED (SELECT c, n, unnest(s) AS x FROM classes),
    links AS MATERIALIZED (
      SELECT a.c AS a, b.c AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.c <> b.c AND a.n * {d} >= b.n * {p} AND b.n * {d} >= a.n * {p}
      GROUP BY a.c, b.c, a.n, b.n HAVING count(*) * {d} >= (a.n + b.n - count(*)) * {p}),
    reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    named AS (SELECT k.s, min(o.least) AS component_id FROM reach r JOIN classes k ON k.c = r.a JOIN classes o ON o.c = r.b GROUP BY k.s)
    SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, CASE WHEN len(sets.s) = 0 THEN doc_id ELSE component_id END AS component_id
    FROM sets LEFT JOIN named ON named.s = sets.s"""
