"""WARC archives with an index that comes first.

Each record becomes a gzip member of its own where its page is read, so that
only compressed records move, once, to the task that writes their archive. The
task returns what it wrote as index rows (archive, offset, length, URL, digest),
under a file name of its own: a retried task leaves at most a file that no index
names. Readers sort the index rows they want by archive and offset, join
neighbouring records into one range, and read only these ranges.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.llm.text import slices
from tallymark.operators.keys import same_keys
from tallymark.sources.scratch import scratch_path, stash

# The blank line that ends a record, and the profile of a revisit record.
RECORD_END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

RECORD_ID = "urn:page:"
#: Payloads from this size on are stored once.
DEDUPLICATE_BYTES = 1000
#: Records this close are read in one range, ranges end at this size.
MAX_GAP = 64 << 10
MAX_RANGE = 8 << 20


@dataclass(frozen=True)
class Archives:
    """Where the archives lie, and their index: page_id, url, archive, offset, length, payload_bytes, payload_digest,
    record_type, refers_to."""

    path: str
    index: DataFrame


def _facts(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return pages.select(*_fact_columns(F.coalesce(col(html_col).cast("string"), F.lit("")), id_col, url_col))


def _fact_columns(payload: Column, id_col: str, url_col: str) -> list[Column]:
    return [
        col(id_col).cast("bigint").alias("page_id"),
        col(url_col).cast("string").alias("url"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.unhex(F.sha1(payload)).alias("digest"),
    ]


def _keepers(facts: DataFrame) -> DataFrame:
    """Digest and largest id of payloads that occur more than once. Counts are folded before they move."""
    large = facts.filter(col("payload_bytes") >= DEDUPLICATE_BYTES)
    grouped = large.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
    return stash(
        grouped.filter((col("n") > 1) & col("keeper").isNotNull()).select(
            col("digest").alias("kept_digest"), "keeper"
        ),
        "warc-keepers",
    )


def _revisits(facts: DataFrame, keepers: DataFrame) -> DataFrame:
    """Id and digest of the rows that revisit another, and the id of that one. Narrow rows only."""
    met = facts.select("page_id", "digest").join(keepers, col("digest") == col("kept_digest"))
    return met.filter(~col("page_id").eqNullSafe(col("keeper"))).select(
        col("page_id").alias("_of"), col("digest").alias("_digest"), col("keeper").alias("refers_to")
    ).distinct()


def _record(page_id: int | None, url: str, digest: str, date: str, payload: bytes | None, size: int, refers: int | None) -> bytes:
    """A whole record: a response with its payload, or a revisit where ``payload`` is None."""
    kind = "response" if payload is not None else "revisit"
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{RECORD_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}", "WARC-Target-URI: " + re.sub(r"[\x00-\x20]", "%20", url), f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if payload is None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{RECORD_ID}{refers}>", f"WARC-Payload-Length: {size}"]
    body = _HTTP + (payload or b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + RECORD_END + body + RECORD_END


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


_MEMBERS = "page_id bigint, url string, payload_bytes bigint, digest binary, member binary"


def _members(pages: DataFrame, id_col: str, url_col: str, html_col: str, date: str) -> DataFrame:
    """Every page as the compressed response it would be."""
    rows = pages.select(
        col(id_col).cast("bigint").alias("page_id"), col(url_col).cast("string").alias("url"),
        F.coalesce(col(html_col).cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            ids, urls, payloads = (c.to_pylist() for c in batch.columns)
            digests = [hashlib.sha1(p) for p in payloads]
            members = [
                _member(_record(i, u or "", d.hexdigest(), date, p, len(p), None))
                for i, u, d, p in zip(ids, urls, digests, payloads)
            ]
            yield pa.record_batch([
                batch.column(0), batch.column(1), pa.array([len(p) for p in payloads], pa.int64()),
                pa.array([d.digest() for d in digests], pa.binary()), pa.array(members, pa.binary()),
            ], names=["page_id", "url", "payload_bytes", "digest", "member"])

    return rows.mapInArrow(pack, _MEMBERS)


_INDEX = (
    "page_id bigint, url string, archive string, offset bigint, length bigint, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint"
)


def write_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    archive_bytes: int = 256 << 20,
    date: str = "2024-01-01T00:00:00Z",
) -> Archives:
    """Write one record per row, each a gzip member, and return the archives with their index.

    Of rows with equal payloads of at least 1000 bytes the one with the largest
    id is a response and the others revisit it; rows of equal id and payload are
    all responses. A NULL payload is an empty one, a NULL URL an empty one, and
    a NULL id writes an empty record name. Archives lie in the shared folder, in
    files of up to ``archive_bytes``; an empty table gives no archive and an
    empty index.
    """
    spark = pages.sparkSession
    # digests are computed again for each use: a copy of them would cost more
    facts = _facts(pages, id_col, url_col, html_col)
    revisits = _revisits(facts, _keepers(facts))
    path = scratch_path(spark, "warc")
    members = _members(pages, id_col, url_col, html_col, date)
    # one shuffle of compressed records, by id and digest: equal payloads do not meet in one task
    same = same_keys(members, revisits, [("page_id", "_of"), ("digest", "_digest")])
    placed = members.join(revisits.hint("merge"), same, "left").select(*members.columns, "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, out, offset = None, None, 0
        for batch in batches:
            rows = []
            for page_id, url, size, digest, member, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if refers is not None:
                    member = _member(_record(page_id, url or "", digest.hex(), date, None, size, refers))
                if out is None or offset + len(member) > archive_bytes and offset:
                    if out is not None:
                        out.close()
                    archive, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = _create(f"{path}/{archive}")
                out.write(member)
                kind = "response" if refers is None else "revisit"
                rows.append((page_id, url, archive, offset, len(member), size, digest.hex(), kind, refers))
                offset += len(member)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = [c.split(" ")[0] for c in _INDEX.split(", ")]
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        if out is not None:
            out.close()

    return Archives(path, stash(placed.mapInArrow(write, _INDEX), "warc-index"))


RECORD_SCHEMA = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
    "payload binary"
)


def read_records(archives: Archives, selected: DataFrame | None = None, payload: bool = True) -> DataFrame:
    """The records that ``selected`` rows of the index name (all rows by default), read back from the archives.

    Responses carry their payload, whose digest is computed anew and must equal
    the header's; revisits have a NULL payload. ``payload=False`` checks the
    payloads but leaves them out of the result.
    """
    spark = archives.index.sparkSession
    chosen = (archives.index if selected is None else selected).select("archive", "offset", "length")
    total = chosen.agg(F.sum("length")).first()[0]
    if not total:
        return spark.createDataFrame([], RECORD_SCHEMA)
    # ranges of sorted index rows are of like size, whatever the sizes of the archives; a task reads a few ranges
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // (4 * MAX_RANGE)))
    near = chosen.repartitionByRange(int(tasks), "archive", "offset").sortWithinPartitions("archive", "offset")
    folder = archives.path

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for archive, start, data, spans in _ranges(batches, folder):
            packed = memoryview(data)
            found = [
                _parse(zlib.decompress(packed[offset - start : offset - start + length], 31), archive, offset)
                for offset, length in spans
            ]
            if not payload:
                found = [(*r[:-1], None) for r in found]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = [c.split(" ")[0] for c in RECORD_SCHEMA.split(", ")]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    return near.mapInArrow(read, RECORD_SCHEMA)


def _ranges(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple[str, int, bytes, list[tuple[int, int]]]]:
    """Join sorted records into byte ranges and read them, one open file at a time."""
    path, opened, spans = None, None, []

    def flush():
        start, end = spans[0][0], max(o + n for o, n in spans)
        return path, start, opened.read_at(end - start, start), list(spans)

    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(3))
        for name, offset, length in zip(*columns):
            if spans:
                start, end = spans[0][0], spans[-1][0] + spans[-1][1]
                if name != path or offset - end > MAX_GAP or offset + length - start > MAX_RANGE:
                    yield flush()
                    spans.clear()
            if name != path:
                if opened is not None:
                    opened.close()
                path, opened = name, _open(f"{folder}/{name}")
            if (offset, length) not in spans[-1:]:
                spans.append((offset, length))
    if spans:
        yield flush()
    if opened is not None:
        opened.close()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    uri = "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path
    return fs.FileSystem.from_uri(uri)


def _open(path: str):
    store, inner = _store(path)
    return store.open_input_file(inner)


def _create(path: str):
    store, inner = _store(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    # members are compressed one by one, not the file as its name suggests
    return store.open_output_stream(inner, compression=None)


def _parse(raw: bytes, path: str, offset: int) -> tuple:
    head, _, block = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = block[: int(fields["Content-Length"])]
    if not lines[0].startswith("WARC/") or not raw.endswith(RECORD_END):
        raise ValueError(f"no record at {path}:{offset}")
    body = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    name = fields["WARC-Record-ID"][1 + len(RECORD_ID) : -1]
    refers = fields.get("WARC-Refers-To")
    size = len(body) if kind == "response" else int(fields["WARC-Payload-Length"])
    if kind == "response":
        if hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"damaged payload at {path}:{offset}")
    return (
        int(name) if name else None, fields["WARC-Target-URI"], kind,
        int(refers[1 + len(RECORD_ID) : -1]) if refers else None,
        size, digest, body if kind == "response" else None,
    )
