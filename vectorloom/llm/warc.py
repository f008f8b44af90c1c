"""WARC archives: one gzip member per record, revisit records for repeated payloads, sequential reading.

Archives go to a folder that all executors share, given as a URI that ``pyarrow.fs`` can open.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.operators.lookup import lookup_join
from vectorloom.session import materialize, scratch_path

# Payloads below this many bytes are stored in full each time.
REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
_READ_BYTES = 1 << 18
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = b"\r\n"

MANIFEST = "archive string, records long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)


class BadArchive(ValueError):
    """The archive does not hold what its framing or its digests say."""


def with_record_types(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with payload size, digest, record type and the response referred to.

    Of pages with equal payloads of at least 100 bytes the smallest page_id is the response and the
    others revisit it. Only digests that occur twice or more are joined back, hot ones without a shuffle.
    """
    sized = pages.select(
        "page_id",
        "url",
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    )
    repeated = (
        sized.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("payload_digest")
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first_page"))
        .filter("n > 1")
        .select("payload_digest", "first_page")
    )
    is_revisit = F.col("page_id") > F.col("first_page")
    # one page repeated, or all empty ones, may be most of the table: their rows stay where they are
    return (
        lookup_join(sized, materialize(repeated, "warc-repeated"), "payload_digest")
        .withColumn("record_type", F.when(is_revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(is_revisit, F.col("first_page")))
        .drop("first_page")
    )


def _record_id(page: int | None) -> bytes:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page}')}>".encode()


def _record(row: dict, stamp: str) -> bytes:
    revisit = row["record_type"] == "revisit"
    block = b"" if revisit else row["payload"]
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + row["record_type"].encode(),
        b"WARC-Record-ID: " + _record_id(row["page_id"]),
        b"WARC-Date: " + stamp.encode(),
        b"X-Page-Number: " + str(row["page_id"]).encode(),
        b"X-Payload-Length: " + str(row["payload_bytes"]).encode(),
        b"WARC-Payload-Digest: sha256:" + row["payload_digest"].encode(),
        b"WARC-Block-Digest: sha256:" + hashlib.sha256(block).hexdigest().encode(),
    ]
    if row["url"] is not None:
        # header values are one line; other characters travel percent-encoded
        url = row["url"].replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        head.append(b"WARC-Target-URI: " + url.encode())
    if revisit:
        head.append(b"WARC-Profile: " + _REVISIT_PROFILE.encode())
        head.append(b"WARC-Refers-To: " + _record_id(row["refers_to"]))
        head.append(b"X-Refers-To-Page: " + str(row["refers_to"]).encode())
    head.append(b"Content-Length: " + str(len(block)).encode())
    return _CRLF.join(head) + 2 * _CRLF + block + 2 * _CRLF


def _member(data: bytes, level: int) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def write_archives(pages: DataFrame, folder: str, level: int = 6, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page as a record and return the manifest: archive path and number of records.

    Each task fills archives of about ``archive_bytes`` under names of its own attempt, so a task that
    runs twice leaves two sets of files; the manifest, written once all tasks are done, names one of them.
    """
    stamp = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = pafs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        context = TaskContext.get()
        prefix = f"{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        done, out, size, count = [], None, 0, 0

        def close() -> None:
            nonlocal out
            out.close()
            done.append((f"{folder}/{name}", count))
            out = None

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}
                if out is None:
                    name, size, count = f"{prefix}-{len(done):04d}.warc.gz", 0, 0
                    out = target.open_output_stream(f"{root}/{name}", compression=None)
                data = _member(_record(row, stamp), level)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())],
            names=["archive", "records"],
        )

    wanted = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return materialize(with_record_types(pages).select(*wanted).mapInArrow(write, MANIFEST), "warc-manifest")


def _members(stream) -> Iterator[bytes]:
    """Each gzip member of the stream, inflated step by step."""
    rest = b""
    while True:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            data = rest or stream.read(_READ_BYTES)
            if not data:
                if parts or inflate.unconsumed_tail:
                    raise BadArchive("the last gzip member is cut off")
                return
            try:
                parts.append(inflate.decompress(data))
            except zlib.error as broken:
                raise BadArchive(f"not a gzip member: {broken}") from broken
            rest = b""
        rest = inflate.unused_data
        yield b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; framing and block digest are checked."""
    head, blank, rest = data.partition(2 * _CRLF)
    lines = head.split(_CRLF)
    if not blank or not lines[0].startswith(b"WARC/"):
        raise BadArchive("no record header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise BadArchive(f"header line without a colon: {line[:80]!r}")
        fields[name.decode().lower()] = value.strip().decode()
    length = fields.get("content-length", "")
    if not length.isdigit():
        raise BadArchive("no content length")
    block, end = rest[: int(length)], rest[int(length) :]
    if len(block) != int(length) or end != 2 * _CRLF:
        raise BadArchive("the block does not fill its content length")
    if fields.get("warc-block-digest") != "sha256:" + hashlib.sha256(block).hexdigest():
        raise BadArchive("block digest differs")
    return fields, block


def _row(fields: dict[str, str], block: bytes) -> tuple:
    def number(name: str) -> int | None:
        value = fields.get(name, "None")
        return None if value == "None" else int(value)

    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    size = number("x-payload-length")
    if kind == "response" and (len(block) != size or hashlib.sha256(block).hexdigest() != digest):
        raise BadArchive("payload digest differs")
    url = fields.get("warc-target-uri")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    payload = block if kind == "response" else None
    return number("x-page-number"), url, size, digest, kind, number("x-refers-to-page"), payload


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the archives named in ``manifest``, read in sequence, a few records in memory.

    A revisit has no payload of its own; digest and size are those of the payload it stands for. A cut-off
    member, wrong framing, a wrong digest or a wrong number of records raises ``BadArchive``.
    """
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for listed in batches:
            for archive, expected in zip(listed.column(0).to_pylist(), listed.column(1).to_pylist()):
                source, path = pafs.FileSystem.from_uri(archive)
                rows, size, found = [], 0, 0
                with source.open_input_stream(path, compression=None) as stream:
                    for data in _members(stream):
                        rows.append(_row(*parse_record(data)))
                        size, found = size + len(data), found + 1
                        if size > (4 << 20):
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)
                if found != expected:
                    raise BadArchive(f"{archive}: {found} records, {expected} were written")

    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, RECORDS)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back.

    A null html is an empty payload; null urls have no target header; equal page_ids give a record each,
    all responses unless a smaller page_id has the same payload. Extra columns are left out. An empty
    table writes no archive and gives no rows.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_archives(write_archives(pages, folder))
