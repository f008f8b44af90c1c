"""Importance resampling towards a target: array-scored weights, then a distributed quickselect.

Hashed features of the target texts and of all documents are counted into an array of gains, one per bucket. A
document's weight is the sum of gains over its features, its score the weight plus Gumbel noise that depends on
its key alone, so taking the highest scores draws without replacement in proportion to the weights.

The k highest of all scores are found without sorting them: a few random rows serve as pivots, one pass counts
exactly how many rows come before, at and after each, and only the rows between the two pivots around place k go
on. A composite key (score, key, then the row itself) has no ties, so the k-th row is found exactly. Only rows up to
it are sorted and ranked.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.textops import LOWER, give_back, text_passes
from vectorloom.operators.numbering import number_rows
from vectorloom.session import materialize

BUCKETS, MAX_WORDS = 10_000, 1
SEED, MIN_WORDS, PERCENT = 2024, 20, 10
# Pivots of a round of the quickselect.
PIVOTS = 32
# Words up to this many bytes are hashed side by side, longer ones one by one.
_SIDE_BY_SIDE = 48

# Words are runs of digits, ASCII letters and everything beyond ASCII.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x80:] = True
for _first, _last in ("09", "AZ", "az"):
    _IN_WORD[ord(_first) : ord(_last) + 1] = True


def _crc_table() -> np.ndarray:
    """CRC-32 of one byte after a zero register, by the reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC_TABLE = _crc_table()


def spans_crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every span: byte by byte over all spans at once, as zlib has it."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    out = np.empty(len(starts), np.uint32)
    long = int(np.searchsorted(-lengths[order], -_SIDE_BY_SIDE, "left"))
    for i in order[:long].tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]])
    order = order[long:]
    at, left = starts[order], lengths[order]
    register = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for step in range(int(left[0]) if len(left) else 0):
        # the longest come first
        n = int(np.searchsorted(-left, -step, "left"))
        low = (register[:n] ^ data[at[:n] + step]) & np.uint32(0xFF)
        register[:n] = _CRC_TABLE[low] ^ (register[:n] >> np.uint32(8))
    out[order] = register ^ np.uint32(0xFFFFFFFF)
    return out


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the index of each row's first word (one entry more than rows)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[data]
    begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    begins[cuts] = ends[cuts] = True
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends), np.searchsorted(starts, offsets, "left")


def feature_buckets(column: pa.Array, buckets: int, max_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, words of each row, features of each row, bucket of each feature) for runs of rows.

    Features are all runs of 1 to ``max_words`` words joined by one space. The features of a row stand together,
    shorter runs first.
    """
    for first, data, offsets in text_passes(column):
        data = LOWER[data]
        starts, ends, row_words = _words(data, offsets)
        n_words = np.diff(row_words)
        if max_words == 1:
            yield first, n_words, n_words, spans_crc32(data, starts, ends) % np.uint32(buckets)
            continue
        # joined text: every word followed by one space, so that a run of words is a span
        keep = np.zeros(len(data) + 1, bool)
        keep[:-1] = _IN_WORD[data]
        lengths = ends - starts
        joined = np.full(int(lengths.sum()) + len(starts), 0x20, np.uint8)
        word_starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        into = np.repeat(word_starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        joined[into] = data[keep[:-1]]
        word_ends = word_starts + lengths
        row_of = np.repeat(np.arange(len(n_words)), n_words)
        spans = []
        for n in range(1, max_words + 1):
            begin = np.arange(max(len(starts) - n + 1, 0))
            begin = begin[row_of[begin] == row_of[begin + n - 1]]
            spans.append((row_of[begin], word_starts[begin], word_ends[begin + n - 1]))
        rows, a, b = (np.concatenate(x) for x in zip(*spans))
        order = np.argsort(rows, kind="stable")
        hashed = spans_crc32(joined, a[order], b[order]) % np.uint32(buckets)
        yield first, n_words, np.bincount(rows, minlength=len(n_words)), hashed


def bucket_counts(texts: DataFrame, text: str, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> np.ndarray:
    """Features in every bucket over all texts: an array per task, added up by bucket; ``buckets`` numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, hashed in feature_buckets(batch.column(0), buckets, max_words):
                totals += np.bincount(hashed, minlength=buckets)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], names=["bucket", "n"])
        give_back()

    per_task = texts.select(text).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over that in the corpus), in doubles, by bucket."""
    in_corpus, in_target = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    ratios = ((t + 1) * in_corpus / ((s + 1) * in_target) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weigh(docs: DataFrame, key: str, text: str, gain: np.ndarray, max_words: int = MAX_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, text_hash): the sum of gains over a document's features."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = ([np.zeros(0, np.int64)] for _ in range(3))
            for _, n_words, n_features, hashed in feature_buckets(batch.column(1), len(gain), max_words):
                sums = np.concatenate([[0], np.cumsum(gain[hashed])])
                ends = np.cumsum(n_features)
                words.append(n_words)
                features.append(n_features)
                weights.append(sums[ends] - sums[ends - n_features])
            numbers = [pa.array(np.concatenate(x), pa.int64()) for x in (words, features, weights)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *numbers, batch.column(2)], names=["doc_id", "n_words", "n_features", "weight", "text_hash"]
            )
        give_back()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, text_hash long")


def gumbel(key: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 8 hex digits of sha256(seed:key); a null key is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0)


# Order of the draw: highest score, smallest key, then the row itself.
_ORDER = ("score", "doc_id", "text_hash", "row")


def _draw_order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("text_hash"), F.asc("row")]


def _before(pivot: dict) -> Column:
    """Rows that are drawn before ``pivot``."""
    out, same = F.lit(False), F.lit(True)
    for name in _ORDER:
        value, column = pivot[name], F.col(name)
        if name == "score":
            earlier = column > F.lit(value)
        elif value is None:
            earlier = column.isNotNull()
        else:
            earlier = F.coalesce(column < F.lit(value), F.lit(False))
        out = out | (same & earlier)
        same = same & column.eqNullSafe(F.lit(value))
    return out


def _some(rows: DataFrame, n: int, seed: int) -> list[dict]:
    """At most ``PIVOTS`` random rows of ``n``, about twice as many sampled by hash."""
    hashed = F.xxhash64(*_ORDER, F.lit(seed))
    if n > 2 * PIVOTS:
        rows = rows.filter(F.shiftrightunsigned(hashed, 1) < int(2 * PIVOTS / n * (1 << 63)))
    return [r.asDict() for r in rows.select(*_ORDER).orderBy(hashed, "row").limit(PIVOTS).collect()]


def kth_row(rows: DataFrame, n: int, k: int) -> dict:
    """The row at place ``k`` (from 1) of ``n`` in the order of the draw, by quickselect.

    Every round takes a few random rows that are left as pivots and counts in one pass, per partition and then
    summed, the rows before each. The counts split the rest in three: what surely comes before the k-th row, what
    may be it, and what comes after. Only the middle is written for the next round.
    """
    # rows that come before those that are left
    passed, seed = 0, 0
    while True:
        seed += 1
        pivots = _some(rows, n, seed)
        if not pivots:
            continue
        counts = rows.agg(*[F.count_if(_before(p)).alias(str(i)) for i, p in enumerate(pivots)]).first()
        # no two rows are equal, so a pivot's place is known exactly
        places = sorted((passed + counts[str(i)] + 1, i) for i in range(len(pivots)))
        end, middle = passed + n + 1, F.lit(True)
        for place, i in places:
            if place == k:
                return pivots[i]
            if place < k:
                passed = place
                middle = ~_before(pivots[i]) & (F.col("row") != pivots[i]["row"])
        above = [(place, i) for place, i in places if place > k]
        if above:
            end = above[0][0]
            middle = middle & _before(pivots[above[0][1]])
        n = end - passed - 1
        rows = materialize(rows.filter(middle), "resample-middle")


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    max_words: int = MAX_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null where it is not drawn.

    Of the N documents with at least ``min_words`` words the floor(percent * N / 100) highest scores are drawn, ties to
    the smaller key, null keys last; rows that share a key have the same noise and are settled by a hash of their
    text, then by their place in the table. A null, empty or wordless text has no features and weight 0. An
    empty target is smoothed like any other. Whole texts count, of any length. Extra columns are left out; an
    empty table gives no rows.
    """
    gain = gains(bucket_counts(docs, text, buckets, max_words), bucket_counts(target, target_text, buckets, max_words))
    weighed = weigh(docs, key, text, gain, max_words).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    rows = materialize(weighed.withColumn("row", F.monotonically_increasing_id()), "resample-scores")
    eligible = rows.filter(F.col("n_words") >= min_words)
    n = eligible.count()
    k = percent * n // 100
    out = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    last = kth_row(eligible, n, k)
    drawn = (F.col("n_words") >= min_words) & (_before(last) | (F.col("row") == last["row"]))
    ranked = number_rows(rows.filter(drawn), _draw_order(), "place").rows
    rest = rows.filter(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*out, (F.col("place") + 1).alias("rank")).unionByName(rest)
