"""Passages of benchmark items in documents: a prefix-filtered set join of word windows.

An item is cut into windows of a fixed number of words. A window is a set of short shingles with places; a document
holds the window if it holds all its shingles in these places, so any one shingle is a necessary prefix. Shingles
are ordered by rarity in the documents, and the rarest of each window is its prefix. Documents are joined with windows on
prefixes only; the place of the shingle bounds where the window can lie, the document's length whether it fits, and the
words themselves decide.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import q
from flowmill.llm.batches import Shared, pieces
from flowmill.llm.words import ALPHANUMERIC, windows, word_spans
from flowmill.session import materialize

WINDOW, SHINGLE = 10, 3
#: Text of items that one pass over the documents looks for. More items take more passes, not more memory.
PASS_BYTES = 16 << 20
_BITS = 20


class _Members:
    """Which of many hashes are in a small sorted set: a bit table first, then binary search."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.bits = np.zeros(1 << _BITS, bool)
        self.bits[(values >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the members among the hashes, and their places in the set."""
        maybe = np.flatnonzero(self.bits[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(maybe):
            return maybe, maybe
        at = np.minimum(np.searchsorted(self.values, hashes[maybe]), len(self.values) - 1)
        real = self.values[at] == hashes[maybe]
        return maybe[real], at[real]


@dataclass
class Windows:
    """The distinct windows of some items: their words' hashes (0 behind a short item's last), and their items."""

    words: np.ndarray
    sizes: np.ndarray
    items: list[tuple[str, ...]]

    @staticmethod
    def of(rows: Sequence[tuple[str, str]], window: int) -> Windows:
        found: dict[bytes, set[str]] = {}
        _, _, _, hashes, offsets = word_spans(pa.array([t for _, t in rows], pa.string()), ALPHANUMERIC)
        for (item, _), a, b in zip(rows, offsets[:-1], offsets[1:], strict=True):
            for i in range(a, max(b - window + 1, min(a + 1, b))):
                own = np.zeros(window, np.uint64)
                own[: min(window, b - i)] = hashes[i : min(i + window, b)]
                found.setdefault(own.tobytes(), set()).add(item)
        words = np.frombuffer(b"".join(found), np.uint64).reshape(-1, window)
        return Windows(words, (words != 0).sum(axis=1), [tuple(sorted(x)) for x in found.values()])

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The shingles of all windows in a row and each window's offset; of fewer words, all words are one shingle."""
        flat = self.words[self.words != 0]
        return windows(flat, np.append(0, np.cumsum(self.sizes)), size)


@dataclass
class Index:
    """Windows by the hash of their rarest shingle."""

    windows: Windows
    shingle: int
    prefixes: _Members
    first: np.ndarray  # offset of each prefix's windows in ``which``
    which: np.ndarray
    place: np.ndarray  # words before the prefix, by window

    @staticmethod
    def of(found: Windows, shingle: int, seen: dict[int, int]) -> Index:
        hashes, offsets = found.shingles(shingle)
        counts = np.array([seen.get(h, 0) for h in hashes.tolist()], np.int64)
        rarest = np.array([a + int(np.argmin(counts[a:b])) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64)
        prefix, place = hashes[rarest], rarest - offsets[:-1]
        which = np.argsort(prefix, kind="stable")
        values, first = np.unique(prefix[which], return_index=True)
        return Index(found, shingle, _Members(values), np.append(first, len(which)), which, place)

    def occurrences(self, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and window of every occurrence in texts whose words' hashes lie in a row."""
        starts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        # prefixes of windows shorter than a shingle are their whole text, which may lie anywhere in a document
        for size in sorted({self.shingle, *np.minimum(self.windows.sizes, self.shingle).tolist()}):
            grams = _grams(hashes, size)
            at, member = self.prefixes.find(grams)
            number = self.first[member + 1] - self.first[member]
            at = np.repeat(at, number)
            window = self.which[np.repeat(self.first[member], number) + _count_up(number)]
            own = np.minimum(self.windows.sizes[window], self.shingle) == size
            at, window = at[own], window[own]
            start, length = at - self.place[window], self.windows.sizes[window]
            text = np.searchsorted(offsets, at, side="right") - 1
            fits = (start >= offsets[text]) & (start + length <= offsets[text + 1])
            start, window, length = start[fits], window[fits], length[fits]
            same = np.ones(len(start), bool)
            for k in range(self.windows.words.shape[1]):
                inside = same & (k < length)
                same[inside] = hashes[start[inside] + k] == self.windows.words[window[inside], k]
            starts.append(start[same])
            found.append(window[same])
        return np.concatenate(starts), np.concatenate(found)


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each word on, across texts too; none at the end."""
    return windows(hashes, np.array([0, len(hashes)]), size)[0] if len(hashes) >= size else np.zeros(0, np.uint64)


def _count_up(numbers: np.ndarray) -> np.ndarray:
    return np.arange(int(numbers.sum())) - np.repeat(np.cumsum(numbers) - numbers, numbers)


def _shingle_counts(docs: DataFrame, found: Windows, shingle: int) -> dict[int, int]:
    """How often the windows' shingles occur in the documents; as many numbers as the windows have shingles."""
    wanted = np.unique(found.shingles(shingle)[0])
    shared = Shared(docs.sparkSession, wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = _Members(shared.get())
        totals = np.zeros(len(members.values), np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                _, _, _, hashes, _ = word_spans(piece.column("text"), ALPHANUMERIC)
                totals += np.bincount(members.find(_grams(hashes, shingle))[1], minlength=len(totals))
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], ["at", "n"])

    counted = docs.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    values = wanted.tolist()
    return {values[r["at"]]: r["n"] for r in counted.collect()}


def _item_passes(items: DataFrame, item_id: str, text: str) -> list[DataFrame]:
    rows = items.select(
        F.coalesce(q(item_id).cast("string"), F.lit("")).alias("item"), q(text).cast("string").alias("text")
    ).filter(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(-(-total // PASS_BYTES), 1)
    if passes == 1:
        return [rows]
    return [rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == i) for i in range(passes)]


def _index(texts: DataFrame, items: DataFrame, window: int, shingle: int) -> Index:
    """The windows of one pass's items by their shingle that is rarest in the texts."""
    own = Windows.of([(r["item"], r["text"]) for r in items.sort("item", "text").collect()], window)
    return Index.of(own, shingle, _shingle_counts(texts, own, shingle) if len(own.words) else {})


def find(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """Per row of ``docs``: ``n_words``, ``hits`` (stretches of words inside occurring windows, from and to, merged) and
    ``items`` (ids, as strings, of the items with an occurring window, sorted).

    Null and empty texts have no words and hit nothing; so do items without words. An item of fewer words than
    ``window`` is one window. Items of one id count once, a null id is an empty string. Texts of any length are searched
    whole. Repeated rows stay; kept columns named like a result give way. Items beyond ``PASS_BYTES`` are looked for in
    several passes, each written to the shared folder.
    """
    kept = [c for c in dict.fromkeys(keep) if c not in ("n_words", "hits", "items")]
    names = [f"k{i}" for i in range(len(kept))]
    current = docs.select(*(q(c).alias(n) for c, n in zip(kept, names, strict=True)), q(text).cast("string").alias("text"))
    current = current.withColumns({"hits": F.array().cast(_SPANS), "items": F.array().cast("array<string>")})
    passes = _item_passes(items, item_id, item_text)
    for i, rows in enumerate(passes):
        index = _index(docs.select(q(text).cast("string").alias("text")), rows, window, shingle)
        current = _search(current, index, names)
        if i + 1 < len(passes):
            current = materialize(current, "hits")
    return current.select(*(F.col(n).alias(c) for n, c in zip(names, kept, strict=True)), "n_words", "hits", "items")


_SPANS = "array<struct<from:int,to:int>>"


def _search(docs: DataFrame, index: Index, keep: Sequence[str]) -> DataFrame:
    """One pass: what the index finds is merged with the ``hits`` and ``items`` that the rows have."""
    shared = Shared(docs.sparkSession, index)
    spans = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
    schema = docs.select(*keep, F.lit(0).cast("long").alias("n_words"), "hits", "items", "text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for batch in batches:
            for piece in pieces(batch, "text"):
                _, _, _, hashes, offsets = word_spans(piece.column("text"), ALPHANUMERIC)
                starts, found = own.occurrences(hashes, offsets)
                texts = np.searchsorted(offsets, starts, side="right") - 1
                hits, items = piece.column("hits").to_pylist(), piece.column("items").to_pylist()
                for i in np.unique(texts).tolist():
                    mine = texts == i
                    pairs = [(h["from"], h["to"]) for h in hits[i]]
                    begin = starts[mine] - offsets[i]
                    pairs += zip(begin.tolist(), (begin + own.windows.sizes[found[mine]]).tolist(), strict=True)
                    hits[i] = [{"from": a, "to": b} for a, b in _merged(pairs)]
                    names = {x for w in np.unique(found[mine]).tolist() for x in own.windows.items[w]}
                    items[i] = sorted(names.union(items[i]))
                columns = [*(piece.column(c) for c in keep), pa.array(np.diff(offsets)), pa.array(hits, spans)]
                columns += [pa.array(items, pa.list_(pa.string())), piece.column("text")]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)


def _merged(pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if found and a <= found[-1][1]:
            found[-1] = (found[-1][0], max(b, found[-1][1]))
        else:
            found.append((a, b))
    return found


def clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, with their columns.

    Rows are dropped where their text is searched, so each text goes to a task's worker once and comes back once.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    current = docs.select(*(q(c).alias(n) for c, n in zip(docs.columns, names, strict=True)))
    own = names[docs.columns.index(text)]
    searched = q(text).cast("string").alias("text")
    passes = _item_passes(items, "item_id", "text")
    for i, rows in enumerate(passes):
        current = _without(current, _index(docs.select(searched), rows, WINDOW, SHINGLE), own)
        if i + 1 < len(passes):
            current = materialize(current, "clean")
    return current.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)))


def _without(docs: DataFrame, index: Index, text: str) -> DataFrame:
    """The rows whose text holds no window of the index."""
    shared = Shared(docs.sparkSession, index)
    columns, kind = docs.columns, docs.schema[text].dataType
    searched = text
    if kind.simpleString() != "string":
        searched = "text"
        docs = docs.withColumn(searched, F.col(text).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for batch in batches:
            for piece in pieces(batch, searched):
                _, _, _, hashes, offsets = word_spans(piece.column(searched), ALPHANUMERIC)
                starts, _ = own.occurrences(hashes, offsets)
                free = np.ones(piece.num_rows, bool)
                free[np.searchsorted(offsets, starts, side="right") - 1] = False
                yield piece.select(columns).filter(pa.array(free))

    return docs.mapInArrow(run, docs.select(*columns).schema)


def oracle() -> str:
    """The digest of hits of ``op8_benchmark_hits`` in DuckDB, windows as texts."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
    WITH items AS (SELECT item_id::VARCHAR AS item, {words} AS w FROM benchmark),
    windows AS MATERIALIZED (
      SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS window
      FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
    docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
    sizes AS (SELECT DISTINCT size FROM windows),
    places AS (
      SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS window
      FROM docs JOIN sizes ON len(w) >= size, unnest(range(1, len(w) - size + 2)) AS t(i)),
    found AS MATERIALIZED (SELECT r, p.size, i, item FROM places p JOIN windows k ON p.window = k.window AND p.size = k.size),
    hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM found, unnest(range(i, i + size)) AS t(k) GROUP BY r),
    listed AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hits USING (r) LEFT JOIN listed USING (r)"""
