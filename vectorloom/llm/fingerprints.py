"""Order MinHash fingerprints: alike when texts are close in edit distance, not only in content.

A text is its k-mers of bytes, each numbered by occurrence. One hash deals the numbered k-mers to bins; in each bin
the smallest ones are selected, put back into text order, and hashed as a tuple. A component therefore
agrees when the same k-mers were selected and stand in the same order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.blocks import BLOCKS, split_by, unpack
from vectorloom.llm.textops import SpanHashes, mix, text_passes

KMER = 12
BINS = 64
# Order matters within a tuple; a tuple has two k-mers, or one where a bin holds no more.
TUPLE = 2
GROUP_BYTES = 16 << 20
MIN_GROUPS = 32

_POSITION_BITS = 20
_POSITION = np.uint64((1 << _POSITION_BITS) - 1)
_BIN_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_OCCURRENCE = np.uint64(0x9FB21C651E98DF25)
_FIRST, _SECOND = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
_FIRST_KEY = np.iinfo(np.int64).min


def _sorted_with_places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper 44 bits of the values in order, ties by place, and their places."""
    upper = values & ~_POSITION
    if len(values) <= int(_POSITION):
        both = np.sort(upper | np.arange(len(values), dtype=np.uint64))
        return both & ~_POSITION, (both & _POSITION).astype(np.int64)
    order = np.argsort(upper, kind="stable")
    return upper[order], order


def _components(kmers: np.ndarray) -> np.ndarray:
    value, place = _sorted_with_places(kmers)
    begins = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    occurrence = np.arange(len(value)) - np.repeat(begins, np.diff(np.append(begins, len(value))))
    numbered = np.empty_like(value)
    numbered[place] = mix(value ^ (occurrence.astype(np.uint64) + np.uint64(1)) * _OCCURRENCE)
    value, place = _sorted_with_places(numbered)
    edges = np.searchsorted(value, np.arange(BINS, dtype=np.uint64) << _BIN_SHIFT)
    count = np.diff(np.append(edges, len(value)))
    one = place[np.minimum(edges, len(place) - 1)]
    two = place[np.minimum(edges + 1, len(place) - 1)]
    two = np.where(count >= TUPLE, two, one)
    before, after = np.minimum(one, two), np.maximum(one, two)
    tuples = mix(kmers[before] * _FIRST + np.where(count >= TUPLE, kmers[after] * _SECOND, np.uint64(0)))
    return np.where(count > 0, tuples % np.uint64(0xFFFF) + np.uint64(1), np.uint64(0)).astype(">u2")


def order_minhash(texts: pa.Array) -> np.ndarray:
    """Components of every text, 16 bits each; 0 stands for an empty bin. Texts below k bytes are one k-mer."""
    out = np.zeros((len(texts), BINS), ">u2")
    for first, data, offsets in text_passes(texts):
        hashes = SpanHashes(data)
        at = np.arange(max(0, len(data) - KMER + 1))
        kmers = hashes.of(at, at + KMER)
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            if b - a >= KMER:
                out[first + i] = _components(kmers[a : b - KMER + 1])
            elif b > a:
                out[first + i] = _components(hashes.of(np.array([a]), np.array([b])))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal components among bins that are not empty in both; 1 for two empty texts."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    equal = ((a == b) & (a != 0)).sum(axis=1)
    return np.where(used > 0, equal / np.maximum(used, 1), 1.0)


def as_hex(components: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in components]


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint): 64 components of four hex digits. A null text is empty: all zeros."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array(as_hex(order_minhash(batch.column(1))), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], names=[key, "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(compute, f"`{key}` {kind}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last third (by code points, rounded down) replaced by the start of another text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_DOC = pa.schema([("key", pa.int64()), ("start", pa.binary()), ("text", pa.string()), ("guest", pa.bool_())])
_PLACE = np.dtype([("down", "<i8"), ("start", "S16")])
_STUDY = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double"
)


def edit_study(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """How a fingerprint reacts to an edit: every text against its edited form and against the next text.

    Next is by descending key; the last is followed by the first. Keys are cut into ranges; texts travel
    to their range once, and the head of a range also to the range before it, so that every text meets
    the one that follows.

    A null text is empty, a null key comes last and stays null. Rows that share a key are ordered by text, and
    ranges split them where their first 16 bytes differ.
    A single row follows itself. Extra columns are left out. Empty input gives no rows.
    """
    docs = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.select(F.coalesce("key", F.lit(int(_FIRST_KEY))).alias("key"), F.substring(F.col("text").cast("binary"), 1, 16).alias("start"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(MIN_GROUPS, total // GROUP_BYTES)
    place = F.struct((-1 - F.col("key")).alias("down"), "start")
    ranged = docs.select(place.alias("place")).repartitionByRange(n, "place").groupBy(F.spark_partition_id()).agg(F.min("place").alias("head"))
    # one place per range, in order; the key counts down
    heads = np.unique(np.array([(r["head"]["down"], bytes(r["head"]["start"])) for r in ranged.collect()], _PLACE))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.empty(batch.num_rows, _PLACE)
            places["down"], places["start"] = -1 - batch.column(0).to_numpy(), batch.column(1).to_pylist()
            # the last head that is not behind the row
            own = np.searchsorted(heads, places, "right") - 1
            guests = np.flatnonzero(heads[own] == places)
            before = (own[guests] - 1) % len(heads)
            rows = pa.Table.from_arrays([*batch.columns, pa.array(np.zeros(batch.num_rows, bool))], schema=_DOC)
            again = rows.take(pa.array(guests)).set_column(3, "guest", pa.array(np.ones(len(guests), bool)))
            both = pa.concat_tables([rows, again]).combine_chunks()
            if both.num_rows:
                yield from split_by(np.concatenate([own, before]), both).to_batches()

    def study(_: tuple, blocks: pa.Table) -> pa.Table:
        table = unpack(blocks.column("data").to_pylist(), _DOC)
        # the guest range follows: all of its rows come after the range's own
        table = table.sort_by([("guest", "ascending"), ("key", "descending"), ("text", "ascending")])
        own = table.num_rows - sum(table.column("guest").to_pylist())
        table = table.slice(0, own + 1)
        texts = table.column("text").to_pylist()
        changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
        prints = order_minhash(table.column("text").combine_chunks())
        changed_prints = order_minhash(pa.array(changed, pa.large_string()))
        keys = [None if k == _FIRST_KEY else k for k in table.column("key").to_pylist()[:own]]
        return pa.table(
            {
                key: pa.array(keys, pa.int64()),
                "n_chars": pa.array([len(t) for t in texts[:own]], pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                "fingerprint": as_hex(prints[:own]),
                "edited_fingerprint": as_hex(changed_prints),
                "near_edited": likeness(prints[:own], changed_prints),
                "near_next": likeness(prints[:own], prints[1:]),
            }
        )

    # a group or two to a task where there are few
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(2 * n, 4_000))
    dealt = docs.mapInArrow(deal, BLOCKS).repartition(tasks, "bucket")
    return dealt.groupBy("bucket").applyInArrow(study, f"`{key}` long, {_STUDY}")
