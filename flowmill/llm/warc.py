"""WARC archives written and read as a table of record chunks, so that no task holds a whole archive or record.

A chunk row names its record and its number in it, holds at most ``CHUNK_BYTES`` of the payload and carries the digest and
length of the payload up to its end; the last chunk's are those of the whole. Writing turns a chunk into a WARC
record of its own: the first into a ``response``, the others into ``continuation`` records (segments) behind it. Reading
is the reverse: a task streams an archive, whatever the borders of its batches, and hands on a chunk when it is full.

Equal payloads are stored once. Only digests are compared across records; payloads are moved at most once, to meet the
decision on their record, and not at all while the decisions fit a broadcast.
"""

from __future__ import annotations

import hashlib
from base64 import b32encode
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from urllib.parse import unquote_plus

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmill.functions.columns import q
from flowmill.llm import sql
from flowmill.session import materialize, new_path, scratch

#: Payload bytes of a chunk.
CHUNK_BYTES = 1 << 20
#: Payload bytes that a task gathers before it hands its rows on, and rows.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 5_000
#: Bytes that the header of a record or of its response may have.
HEADER_BYTES = 1 << 20
#: Records (about 100 bytes each) whose decisions may be broadcast; more are joined by a shuffle.
BROADCAST_RECORDS = 1_000_000
#: A payload is heavy if more than one record in so many has it, so there are fewer heavy ones than this.
HEAVY = 1000
#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:record:"


def base32_sha1(state) -> str:
    return b32encode(state.digest()).decode()


class _Rows:
    """Rows gathered for one Arrow batch."""

    def __init__(self, schema: pa.Schema):
        self._schema, self._rows, self._bytes = schema, [], 0

    def add(self, row: tuple, n_bytes: int = 0) -> bool:
        """True if it is time to take what is gathered."""
        self._rows.append(row)
        self._bytes += n_bytes
        return self._bytes >= BATCH_BYTES or len(self._rows) >= BATCH_ROWS

    def take(self) -> Iterator[pa.RecordBatch]:
        if self._rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self._rows, strict=True), self._schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=self._schema)
        self._rows, self._bytes = [], 0


def payload_chunks(records: DataFrame, with_data: bool = True) -> DataFrame:
    """``records`` (id string, uri, payload binary) as chunk rows; without data only the last of each record.

    ``number`` tells the records of a task apart. ``digest`` and ``n`` cover the payload up to the chunk's end,
    ``payload_digest`` and ``payload_n`` all of it. A null payload is empty; an empty one has one empty chunk.
    """
    size = CHUNK_BYTES
    fields = [("id", pa.string()), ("uri", pa.string()), ("number", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_())]
    fields += [("n", pa.int64()), ("digest", pa.string()), ("payload_n", pa.int64()), ("payload_digest", pa.string())]
    fields += [("data", pa.binary())]
    ddl = "id string, uri string, number long, chunk int, last boolean, n long, digest string, payload_n long, payload_digest string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, number = _Rows(pa.schema(fields)), 0
        for batch in batches:
            for id, uri, payload in zip(*(batch.column(c) for c in ("id", "uri", "payload")), strict=True):
                number += 1
                data = memoryview(payload.as_buffer() if payload.is_valid else b"")
                whole = base32_sha1(hashlib.sha1(data))
                named = id.as_py(), uri.as_py(), number
                state = hashlib.sha1()
                starts = range(0, max(len(data), 1), size)
                for chunk, at in enumerate(starts, 1):
                    piece, last = data[at : at + size], at == starts[-1]
                    state.update(piece)
                    row = (*named, chunk, last, at + len(piece), base32_sha1(state), len(data), whole)
                    if with_data and rows.add((*row, bytes(piece)), len(piece)):
                        yield from rows.take()
                    elif last and not with_data and rows.add((*row, None)):
                        yield from rows.take()
        yield from rows.take()

    return records.mapInArrow(run, f"{ddl}, data binary")


def _repeats(digests: DataFrame, least: int) -> DataFrame:
    """(id, digest, keeper): records with the payload of another one with a larger id.

    Groups of equal payloads are counted, ids and digests only. The few that a large share of the records belongs to
    are broadcast, so that none of them lands in one task.
    """
    groups = digests.filter(F.col("payload_n") >= least).groupBy("payload_digest")
    groups = groups.agg(F.max("order").alias("keeper"), F.count(F.lit(1)).alias("c")).filter("c > 1 and keeper is not null")
    groups, total = materialize(groups, "groups"), digests.count()
    heavy = F.broadcast(groups.filter(F.col("c") * HEAVY > total).drop("c"))
    light = groups.filter(F.col("c") * HEAVY <= total).drop("c")
    found = digests.join(heavy, "payload_digest").unionByName(
        digests.join(heavy, "payload_digest", "left_anti").join(light, "payload_digest")
    )
    found = found.filter(~F.col("order").eqNullSafe(F.col("keeper")))
    return found.select(F.col("id").alias("r_id"), F.col("payload_digest").alias("r_digest"), F.col("keeper")).distinct()


def _name(id: Column) -> Column:
    return F.concat(F.lit(f"<{NAME}"), F.url_encode(F.coalesce(id.cast("string"), F.lit(""))), F.lit(">"))


def _header(*lines: tuple[str, Column]) -> Column:
    """Header lines, each but those with a null value, and the empty line behind them."""
    return F.concat(
        F.concat_ws("\r\n", F.lit("WARC/1.1"), *(F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in lines)),
        F.lit("\r\n\r\n"),
    ).cast("binary")


def _segments(chunks: DataFrame, date: str) -> DataFrame:
    """Chunk rows as the bytes of one WARC record each, but for their last line break."""
    first, revisit = F.col("chunk") == 1, F.col("keeper").isNotNull()
    several = ~(first & F.col("last"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_n").cast("string"), F.lit("\r\n\r\n")
    ).cast("binary")
    block = F.when(revisit, F.lit(b"")).when(first, F.concat(http, F.col("data"))).otherwise(F.col("data"))
    uri = F.regexp_replace(F.coalesce("uri", F.lit("about:blank")), r"[\x00-\x20\x7F]", "%20")
    part = F.concat(F.substring(_name(F.col("id")), F.lit(1), F.length(_name(F.col("id"))) - 1), F.lit(":"), F.col("chunk"), F.lit(">"))
    here = lambda condition, value: F.when(condition, value)
    header = _header(
        ("WARC-Type", F.when(~first, "continuation").when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", F.when(first, _name(F.col("id"))).otherwise(part)),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", here(first, F.concat(F.lit("sha1:"), F.col("payload_digest")))),
        ("X-Payload-Length", here(first, F.col("payload_n"))),
        ("WARC-Profile", here(first & revisit, F.lit(REVISIT_PROFILE))),
        ("WARC-Refers-To", here(first & revisit, _name(F.col("keeper")))),
        ("WARC-Segment-Origin-ID", here(~first, _name(F.col("id")))),
        ("WARC-Segment-Number", here(several & ~revisit, F.col("chunk"))),
        ("WARC-Segment-Total-Length", here(~first & F.col("last"), F.col("payload_n") + F.length(http))),
        ("Content-Type", here(first & ~revisit, F.lit("application/http;msgtype=response"))),
        ("Content-Length", F.length(block)),
    )
    return chunks.select(F.concat(header, block, F.lit(b"\r\n\r")).cast("string").alias("value"))


def write_archives(
    records: DataFrame, path: str, id: str = "page_id", uri: str = "url", payload: str = "html", least: int = 0
) -> None:
    """Writes gzip archives with a record per row to the new folder ``path``, in bounded pieces.

    Of rows with equal payloads of at least ``least`` bytes the one with the largest id becomes a ``response`` and the
    others ``revisit`` records that refer to it; all other rows become responses. Null payloads are empty. Rows equal
    in id and payload are one record written as often as they come, all of the same kind. A null id is smaller than all
    others; rows without one are responses if no equal payload has an id. A null uri is written as ``about:blank``,
    white space and control characters in one as ``%20``. Other columns are not looked at.
    """
    source = records.select(
        q(id).cast("string").alias("id"), q(uri).cast("string").alias("uri"), q(payload).cast("binary").alias("payload")
    )
    last = payload_chunks(source, with_data=False).select("id", "payload_n", "payload_digest")
    digests = materialize(last.withColumn("order", F.col("id").cast(records.schema[id].dataType)), "digests")
    repeats = materialize(_repeats(digests, least), "repeats")
    few = repeats.count() <= BROADCAST_RECORDS
    same = F.col("id").eqNullSafe(F.col("r_id")) & (F.col("payload_digest") == F.col("r_digest"))
    decided = payload_chunks(source).join(F.broadcast(repeats) if few else repeats, same, "left")
    decided = decided.filter("keeper is null or chunk = 1")
    if not few:  # all chunks of a record come from one task and go to one
        decided = decided.sortWithinPartitions("id", "payload_digest", "number", "chunk")
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    _segments(decided, date).write.option("lineSep", "\n").option("compression", "gzip").text(path)


class _Archive:
    """The state between two batches of one task that reads archives: where in which record it is."""

    def __init__(self, with_data: bool):
        self._with_data, self._rest, self._left, self._http = with_data, b"", None, None
        self._record: dict | None = None

    def feed(self, stream: bytes) -> Iterator[tuple]:
        """Chunk rows that are complete with these bytes."""
        stream = self._rest + stream if self._rest else stream
        self._rest, at = b"", 0
        while at < len(stream):
            if self._left is None:
                while stream[at : at + 1] in (b"\r", b"\n"):
                    at += 1
                end = stream.find(b"\r\n\r\n", at)
                if end < 0:
                    self._rest = stream[at:]
                    if len(self._rest) > HEADER_BYTES:
                        raise ValueError("no WARC header where one should be")
                    return
                self._start(stream[at:end].decode("utf-8", "replace"))
                at = end + 4
            took = min(self._left, len(stream) - at)
            yield from self._block(memoryview(stream)[at : at + took])
            at, self._left = at + took, self._left - took
            if not self._left:
                self._left = None
                if not self._record["open"]:
                    yield self._row(True)
                    self._record = None

    def end(self) -> None:
        if self._left is not None or self._rest.strip(b"\r\n") or self._record:
            raise ValueError("the archive ends within a record")

    def _start(self, header: str) -> None:
        version, *lines = header.split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC header where one should be: {version[:80]!r}")
        told = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        kind, self._left = told.get("warc-type", ""), int(told["content-length"])
        if kind == "continuation":
            r = self._record
            if not r or told.get("warc-segment-origin-id") != r["name"] or int(told["warc-segment-number"]) != r["segment"] + 1:
                raise ValueError("a segment is not right behind the one before it")
            r["segment"] += 1
            r["open"] = "warc-segment-total-length" not in told
            return
        if self._record:
            raise ValueError(f"record {self._record['name']} ends without its last segment")
        self._http = b"" if kind == "response" and told.get("content-type", "").startswith("application/http") else None
        self._record = {
            "name": told.get("warc-record-id"), "uri": told.get("warc-target-uri"), "type": kind,
            "refers": told.get("warc-refers-to"), "stated": told.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "length": told.get("x-payload-length"), "open": told.get("warc-segment-number") == "1", "segment": 1, "chunk": 1,
            "n": 0, "state": hashlib.sha1(), "data": bytearray(),
        }

    def _block(self, piece: memoryview) -> Iterator[tuple]:
        r = self._record
        if self._http is not None:
            head = self._http + bytes(piece[:HEADER_BYTES])
            end = head.find(b"\r\n\r\n")
            if end < 0:
                if len(head) > HEADER_BYTES:
                    raise ValueError(f"no end of the response's header in record {r['name']}")
                self._http = head
                return
            piece, self._http = piece[end + 4 - len(self._http) :], None
        while len(piece):
            if len(r["data"]) == CHUNK_BYTES:
                yield self._row(False)
                r["chunk"] += 1
                r["data"] = bytearray()
            part = piece[: CHUNK_BYTES - len(r["data"])] if self._with_data else piece
            r["state"].update(part)
            r["n"] += len(part)
            if self._with_data:
                r["data"] += part
            piece = piece[len(part) :]

    def _row(self, last: bool) -> tuple:
        r = self._record
        n, digest = r["n"], base32_sha1(r["state"])
        intact = r["stated"] in (None, digest) if last else None
        if r["type"] == "revisit":
            n, digest, intact = int(r["length"]) if r["length"] else None, r["stated"], None
        data = bytes(r["data"]) if self._with_data else None
        return _id(r["name"]), r["uri"], r["type"], _id(r["refers"]), r["chunk"], last, n, digest, intact, data


def _id(name: str | None) -> str | None:
    """The id in a record's name; other archives' names as they are."""
    name = (name or "").removeprefix("<").removesuffix(">")
    return (unquote_plus(name[len(NAME) :]) if name.startswith(NAME) else name) or None


def _joined(lines: pa.Array) -> bytes:
    """The bytes of lines, each with its line break again."""
    ends = np.frombuffer(lines.buffers()[1], np.int32 if lines.type == pa.binary() else np.int64)
    ends = ends[lines.offset : lines.offset + len(lines) + 1]
    raw = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return np.insert(raw, ends[1:] - ends[0], 10).tobytes()


def read_chunks(spark: SparkSession, path: str, with_data: bool = True) -> DataFrame:
    """Chunk rows (id, uri, record_type, refers_to, chunk, last, n, digest, intact, data) of the gzip archives in ``path``.

    Archives must be gzip files (``*.gz``), which Spark gives to one task each as a stream of lines; a line (of a payload,
    too) has to fit the task, those that ``write_archives`` writes have at most a chunk. Records of any type are read;
    the payload of a ``response`` begins behind its HTTP header, and segments count as one record. ``intact`` tells for a
    record's last chunk whether its digest is the one its header states. A ``revisit`` has the digest and length that
    its header states. Without data only the last chunk of each record comes.
    """
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(path)
    names = ["id", "uri", "record_type", "refers_to", "chunk", "last", "n", "digest", "intact", "data"]
    kinds = [*[pa.string()] * 4, pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, rows = _Archive(with_data), _Rows(schema)
        for batch in batches:
            for row in archive.feed(_joined(batch.column("value"))) if batch.num_rows else ():
                if rows.add(row, len(row[-1] or b"")):
                    yield from rows.take()
        archive.end()
        yield from rows.take()

    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(
        run,
        "id string, uri string, record_type string, refers_to string, chunk int, last boolean, n long, digest string, intact boolean, data binary",
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(id, uri, record_type, refers_to, payload_bytes, payload_digest, intact) of every record; ids are strings."""
    found = read_chunks(spark, path, with_data=False).filter("last")
    return found.select(
        "id", "uri", "record_type", "refers_to", F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "intact"
    )


def round_trip(
    records: DataFrame,
    id: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    least: int = 0,
    then: Callable[[str], None] = lambda path: None,
) -> DataFrame:
    """Writes archives, reads them back and returns their records, with ids in their own type; the archives go.

    ``then`` is called with the folder of the archives before that. A payload that does not have its digest any more is
    an error.
    """
    spark, kind = records.sparkSession, records.schema[id].dataType
    path = new_path(spark, "records")
    with scratch(spark):
        archives = new_path(spark, "archives")
        write_archives(records, archives, id, uri, payload, least)
        then(archives)
        found = read_records(spark, archives)
        damaged = F.raise_error(F.concat(F.lit("damaged payload of record "), F.coalesce("id", F.lit("without id"))))
        whole = found.filter(F.when(~F.col("intact"), damaged.cast("boolean")).otherwise(True))
        whole.select(
            F.col("id").cast(kind).alias(id), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
        ).write.parquet(path)
    return spark.read.parquet(path)


def oracle() -> str:
    return f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper FROM pages)
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {sql.base32("sha1(html)")} AS payload_digest,
      CASE WHEN page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
    FROM p"""
