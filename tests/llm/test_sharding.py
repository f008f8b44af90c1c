import zlib

import pytest

from vectorloom.llm import sharding as s
from vectorloom.llm.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def shards(docs, n=16):
    sized = docs.select("doc_id", s.byte_size(docs.text).alias("size"))
    return s.assign_shards(sized, ["doc_id"], "size", n).collect()


def by_hand(rows, n):
    total, before, out, slots = sum(size for _, size in rows), 0, [], {}
    for key, size in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        shard = min(n - 1, (2 * before + size) * n // max(2 * total, 1))
        out.append((key, size, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        before += size
    return out


@pytest.mark.parametrize("n", [1, 3, 16])
def test_equals_running_sum(spark, n):
    rows = [(i * 7 % 501, (i * i) % 97 + 1) for i in range(501)]
    docs = spark.createDataFrame(rows, "doc_id long, size long")
    got = [(r.doc_id, r["size"], r["shard"], r.slot) for r in s.assign_shards(docs, ["doc_id"], "size", n).collect()]
    assert sorted(got) == sorted(by_hand(rows, n))


def test_sizes_near_equal(spark):
    rows = [(i, 1 + (i * 37) % 1000) for i in range(5000)]
    got = s.assign_shards(spark.createDataFrame(rows, "doc_id long, size long"), ["doc_id"], "size").collect()
    sums = [0] * 16
    for r in got:
        sums[r["shard"]] += r["size"]
    assert max(sums) - min(sums) <= 2 * 1000


def test_awkward_rows(awkward):
    rows = [(r.doc_id, len((r.text or "").encode()) + 1) for r in awkward.collect()]
    got = [(r.doc_id, r["size"], r["shard"], r.slot) for r in shards(awkward)]
    key = lambda r: (r[0] is not None, *[x or 0 for x in r])
    assert sorted(got, key=key) == sorted(by_hand(rows, 16), key=key)


def test_clashing_columns_are_refused(awkward):
    with pytest.raises(ValueError):
        s.assign_shards(awkward.withColumn("slot", awkward["size"]), ["doc_id"], "size")


def test_write_and_read(spark, tmp_path):
    docs = spark.createDataFrame([(i, 5, f"t{i}") for i in range(40)], "doc_id long, size long, text string")
    s.write_shards(s.assign_shards(docs, ["doc_id"], "size"), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 40 and sorted({r["shard"] for r in back.collect()}) == list(range(16))


def test_empty_table(make_docs):
    assert shards(make_docs((1, "x")).filter("doc_id < 0")) == []


def test_query_checksums(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in QUERIES["op5_sharding"](spark, SF_DIR).collect():
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())


def test_a_third_of_all_rows_under_one_key(spark):
    """Rows of one key and size are split over ranges, and different partitionings give the same shards."""
    data = [(None if i % 3 == 0 else i, 10, i) for i in range(900)]
    docs = spark.createDataFrame(data, "doc_id long, size long, text_crc32 long")
    runs = [{tuple(r) for r in s.assign_shards(d, ["doc_id"], "size").collect()} for d in (docs, docs.repartition(5, "text_crc32"))]
    assert runs[0] == runs[1] and len(runs[0]) == 900
    shards = [r[3] for r in runs[0]]
    assert {shards.count(n) for n in range(16)} <= {56, 57}
    assert len({r[3] for r in runs[0] if r[0] is None}) >= 5
