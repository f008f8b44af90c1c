import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from vectorloom.llm import warc as w
from vectorloom.session import scratch_path

PAGES = "page_id long, url string, html string"


@pytest.fixture
def pages(spark):
    big, other = "<p>" + "é" * 80, "<p>" + "n" * 200
    rows = [
        (3, "u3", big), (1, "u1", big), (2, None, big), (4, "u4", None), (5, "u5", ""), (6, "u6", "short"),
        (7, "u7", "short"), (8, "a\r\nb %41 c", other), (9, "u9", other), (9, "u9", other), (10, "u10", "x" * 99),
        (11, "u11", "x" * 99), (12, "u12", "y" * 100), (13, "u13", "y" * 100), (14, "u14", "z" * 3_000_000),
        (-5, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
    ]
    return spark.createDataFrame(rows, PAGES)


def archives(pages):
    folder = "file://" + scratch_path(pages.sparkSession, "warc-test").removeprefix("file:").replace("//", "/")
    return w.write_archives(pages, folder)


def test_round_trip(pages):
    rows = w.archive_pages(pages).collect()
    html = {(r.page_id, r.url): r.html or "" for r in pages.collect()}
    assert len(rows) == pages.count()
    for r in rows:
        payload = html[r.page_id, r.url].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == payload


def test_record_types(pages):
    got = {(r.page_id, r.record_type, r.refers_to) for r in w.archive_pages(pages).collect()}
    revisits = {(p, to) for p, kind, to in got if kind == "revisit"}
    # equal page_ids are no revisits of each other; below 100 bytes there are none
    assert revisits == {(2, 1), (3, 1), (9, 8), (13, 12)}


def test_one_member_per_record(pages):
    manifest = archives(pages).collect()
    assert sum(m.records for m in manifest) == pages.count()
    for m in manifest:
        with open(m.archive.removeprefix("file://"), "rb") as file:
            members = list(w._members(file))
        with gzip.open(m.archive.removeprefix("file://")) as file:
            assert file.read() == b"".join(members)
        assert len(members) == m.records
        for member in members:
            fields, block = w.parse_record(member)
            assert int(fields["content-length"]) == len(block)


def test_small_archives(pages):
    folder = "file://" + scratch_path(pages.sparkSession, "warc-small").removeprefix("file:").replace("//", "/")
    manifest = w.write_archives(pages.coalesce(1), folder, archive_bytes=1)
    assert manifest.count() == pages.count()
    assert w.read_archives(manifest).count() == pages.count()


@pytest.mark.parametrize("damage", ["cut", "flip", "count"])
def test_damage_is_found(pages, damage):
    manifest = archives(pages.filter("page_id = 12")).collect()
    path = manifest[0].archive.removeprefix("file://")
    with open(path, "rb") as file:
        data = bytearray(file.read())
    if damage == "cut":
        data = data[:-12]
    elif damage == "flip":
        plain = gzip.decompress(bytes(data)).replace(b"yyy", b"yyz", 1)
        data = gzip.compress(plain)
    else:
        data = data + data
    with open(path, "wb") as file:
        file.write(data)
    again = pages.sparkSession.createDataFrame(manifest, w.MANIFEST)
    with pytest.raises(Exception, match="cut off|digest differs|records"):
        w.read_archives(again).collect()


@pytest.mark.parametrize(
    "record",
    [b"", b"HTTP/1.1 200\r\n\r\n", b"WARC/1.1\r\nno colon\r\n\r\n", b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"],
)
def test_bad_framing(record):
    with pytest.raises(w.BadArchive):
        w.parse_record(record)


def test_empty_table(pages):
    assert w.archive_pages(pages.filter("page_id > 99")).collect() == []


def test_extra_columns(pages):
    assert w.archive_pages(pages.withColumn("payload", F.lit(1)).withColumn("archive", F.lit(2))).count() == 16
