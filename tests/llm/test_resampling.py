import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import SENTENCE
from pyspark.sql import functions as F

from vectorloom.llm import resampling
from vectorloom.llm.resampling import feature_buckets, kth_row, resample, spans_crc32

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, max_words=1):
    words = WORD.findall((text or "").translate(LOWERED))
    return words, [" ".join(words[i : i + n]) for n in range(1, max_words + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=10, min_words=20, buckets=10_000, max_words=1):
    """{place in the table: (doc_id, n_features, weight, score, rank)}; rows that tie in score and id are told apart by the caller."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for into, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for f in features(x, max_words)[1]:
                into[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        words, found = features(text, max_words)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, weight + noise, len(words)))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [r[:4] for r in able[: percent * len(able) // 100]]
    return rows, drawn


def check(got, docs, target, **options):
    rows, drawn = brute(docs, target, **options)
    assert sorted(map(str, (tuple(r)[:4] for r in got))) == sorted(str(r[:4]) for r in rows)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [tuple(r)[:4] for r in ranked] == drawn


def texts(n, seed=0):
    random = np.random.default_rng(seed)
    return [(i, " ".join(f"w{w}" for w in random.zipf(1.5, random.integers(5, 60)) % 400)) for i in range(n)]


@pytest.mark.parametrize("max_words", [1, 3])
def test_equals_brute_force(spark, make_docs, max_words):
    docs, target = texts(700), [x for _, x in texts(30, seed=1)]
    got = resample(make_docs(*docs), make_docs(*enumerate(target)), max_words=max_words, buckets=5_000).collect()
    check(got, docs, target, max_words=max_words, buckets=5_000)


def test_awkward_rows(spark, awkward, make_docs):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    target = [SENTENCE, None, "", "é日本 ONE"]
    got = resample(awkward, make_docs(*enumerate(target), extra=True), percent=60).collect()
    check(got, docs, target, percent=60)


def test_a_third_of_all_rows_under_one_key(spark, make_docs):
    docs = [(None if i % 3 == 0 else i, x) for i, x in texts(600)] + [(None, SENTENCE)] * 200
    target = [SENTENCE]
    got = resample(make_docs(*docs), make_docs((0, SENTENCE)), percent=35).collect()
    check(got, docs, target, percent=35)


def test_empty_tables(spark, make_docs):
    empty, some = make_docs((1, "x")).limit(0), make_docs(*texts(50))
    assert resample(empty, some).collect() == []
    check(resample(some, empty, percent=50).collect(), texts(50), [], percent=50)


@pytest.mark.parametrize("k", [1, 2, 999, 1000, 1999, 2000])
def test_quickselect_finds_every_place(spark, monkeypatch, k):
    monkeypatch.setattr(resampling, "PIVOTS", 3)
    rows = spark.range(2000).select(
        F.pmod("id", F.lit(7)).alias("score"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("doc_id"),
        F.xxhash64("id").alias("text_hash"), F.col("id").alias("row"),
    )
    order = sorted(rows.collect(), key=lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"] or 0, r["text_hash"]))
    assert kth_row(rows, 2000, k) == order[k - 1].asDict()


def test_crc32_of_spans():
    random = np.random.default_rng(2)
    data = random.integers(0, 256, 5_000, dtype=np.uint8)
    starts = random.integers(0, 4_000, 300)
    ends = starts + np.concatenate([random.integers(0, 90, 298), [0, 1000]])
    got = spans_crc32(data, starts, ends)
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in zip(starts, ends)]
    assert spans_crc32(data, starts[:0], ends[:0]).tolist() == []


def test_words_end_with_their_row():
    column = pa.array(["ab", "cd", None, "", "Z9-é!", "-"])
    ((_, n_words, _, hashed),) = feature_buckets(column, 1 << 31, 1)
    assert n_words.tolist() == [1, 1, 0, 0, 2, 0]
    assert hashed.tolist() == [zlib.crc32(w.encode()) % (1 << 31) for w in ("ab", "cd", "z9", "é")]
