"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes when a string of ``length`` bytes that covers it also starts earlier, in a document with a
smaller key or further to the front of its own. Positions whose longest previous factor reaches ``length``
start such strings.

A suffix array over a whole corpus does not fit one task, so the windows of ``length`` bytes are dealt out
first. Every window has an anchor, its 32-byte gram with the smallest hash; equal windows have equal
anchors at equal places. Neighbouring windows that share an anchor form a stretch. Stretches equal as a
whole need no more work: all but the first are repeats. Stretches whose anchor occurs nowhere else are
new. Only the stretches of anchors that occur in different surroundings, those around the ends of repeats, meet
in a task, which sorts the windows, finds previous and next smaller text positions in suffix order, and
takes the longer of the two common prefixes.

An anchor met in very many different surroundings is spread over several tasks. What is first in such a
task is then compared by window hash across tasks. A bounded sample of documents tells which anchors
those are; it decides where they are compared, never whether.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorloom.llm.blocks import BLOCKS, bucket_of, split_by, unpack
from vectorloom.llm.textops import SpanHashes, byte_slices, give_back, lean, mix, text_passes
from vectorloom.operators.lookup import lookup_join
from vectorloom.operators.numbering import number_rows
from vectorloom.session import materialize

LENGTH = 100
GRAM = 32
# Bytes of text per document bucket, and stretches per task that sorts windows.
BUCKET_BYTES = 4 << 20
MIN_BUCKETS = 64
TASK_STRETCHES = 4_096
# Documents sampled, and different surroundings in them from which an anchor is spread.
SAMPLE_DOCS = 20_000
SPREAD_FROM = 20

_LAST = np.iinfo(np.int64).max
_STRETCH = pa.schema(
    [("k", pa.uint32()), ("f", pa.uint64()), ("key", pa.int64()), ("tie", pa.int64()), ("p", pa.uint32()),
     ("n", pa.uint8()), ("spread", pa.bool_())]
)
_COVER = pa.schema([("key", pa.int64()), ("tie", pa.int64()), ("start", pa.uint32()), ("end", pa.uint32())])
_CANDIDATE = pa.schema(
    [("key", pa.int64()), ("tie", pa.int64()), ("p", pa.uint32()), ("n", pa.uint8()), ("block", pa.uint64()),
     ("spread", pa.bool_())]
)
_CONTEXT = pa.schema([*_CANDIDATE, ("bytes", pa.binary())])
_WINDOW = pa.schema([("hash", pa.uint64()), ("key", pa.int64()), ("tie", pa.int64()), ("p", pa.uint32())])
_DOC = pa.schema([("key", pa.int64()), ("tie", pa.int64()), ("text", pa.large_binary())])


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    return {c: table.column(c).to_numpy() for c in table.schema.names if not pa.types.is_binary(table.schema.field(c).type)}


def _table(schema: pa.Schema, *columns) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _doc_table(batch: pa.RecordBatch) -> pa.Table:
    """Key, tie, bytes and further columns of a batch of (key, tie, text, …), in order of key and tie."""
    key = batch.column(0).cast(pa.int64()).fill_null(int(_LAST))
    text = batch.column(2).cast(pa.large_binary()).fill_null(b"")
    table = pa.Table.from_arrays([key, batch.column(1), text], schema=_DOC)
    for i, column in enumerate((batch.column(0), *batch.columns[3:])):
        table = table.append_column(f"carried {i}", column)
    return table.take(pc.sort_indices(table, [("key", "ascending"), ("tie", "ascending")]))


def _doc_bucket(key: np.ndarray, tie: np.ndarray, buckets: int) -> np.ndarray:
    return bucket_of(mix(key.view(np.uint64) ^ mix(tie.view(np.uint64))), buckets)


def _bucket_of_rows(table: pa.Table, buckets: int) -> np.ndarray:
    return _doc_bucket(table.column("key").to_numpy(), table.column("tie").to_numpy(), buckets)


_ID, _COPIES, _TIE = "__row_id", "__copies", "__tie"


def with_ties(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, bool]:
    """(key, tie, text, …) and whether rows share a key.

    Key and tie together tell different rows apart: 0 where a row has its key to itself, else a number in order of
    key and md5 of the text, larger for null keys. Where rows share a key there are two columns more, an identity and the
    number of equal rows, and the table is written.
    """
    rest = [c for c in docs.columns if c not in (key, text)]
    shared = materialize(docs.groupBy(key).count().filter("count > 1").select(key), "dedup-shared-keys")
    alone = F.when(F.col(key).isNull(), F.lit(1)).otherwise(F.lit(0)).cast("long").alias(_TIE)
    if shared.isEmpty():
        return docs.select(key, alone, text, *rest), False
    content = F.coalesce(F.col(text), F.lit(""))
    # a null key is left out of the identity, a key of its own
    row_id = F.concat_ws("/", F.col(key).cast("string"), F.md5(content), F.octet_length(content).cast("string"))
    thin = docs.select(key, row_id.alias(_ID))
    named = lookup_join(thin.filter(F.col(key).isNotNull()), shared.filter(F.col(key).isNotNull()), key, how="left_semi")
    different = named.unionByName(thin.filter(F.col(key).isNull())).groupBy(key, _ID).agg(F.count("*").alias(_COPIES))
    ties = number_rows(different, [F.col(key).asc_nulls_last(), F.col(_ID)], "__nth").rows.select(_ID, "__nth", _COPIES)
    rows = lookup_join(docs.withColumn(_ID, row_id), ties, _ID)
    tie = F.coalesce(F.col("__nth") + 1, alone).alias(_TIE)
    rows = rows.select(key, tie, text, *rest, _ID, F.coalesce(_COPIES, F.lit(1)).alias(_COPIES))
    return materialize(rows, "dedup-rows"), True


def stretches(docs: pa.Table, length: int) -> dict[str, np.ndarray]:
    """Stretches of all texts, in order: row, first window p, windows n, anchor k and whole f as hashes."""
    out: dict[str, list] = {c: [] for c in ("row", "p", "n", "k", "f")}
    width = length - GRAM + 1
    for first, data, offsets in text_passes(docs.column("text").combine_chunks()):
        if len(data) < length:
            continue
        hashes = SpanHashes(data)
        at = np.arange(len(data) - GRAM + 1)
        gram = hashes.of(at, at + GRAM)
        low, place, span = gram, at, 1
        while span * 2 <= width:
            low, place = _lower(low[:-span], place[:-span], low[span:], place[span:])
            span *= 2
        if rest := width - span:
            low, place = _lower(low[: len(low) - rest], place[: len(place) - rest], low[rest:], place[rest:])
        # windows that run over the end of their text
        inside = np.ones(len(place), bool)
        for end in offsets[1:-1]:
            inside[max(0, end - length + 1) : end] = False
        window = np.flatnonzero(inside)
        if not len(window):
            continue
        anchor = place[window]
        begins = np.flatnonzero(
            np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)])
        )
        p, n = window[begins], np.diff(np.append(begins, len(window)))
        anchor = anchor[begins]
        row = np.searchsorted(offsets, p, "right") - 1
        whole = hashes.of(p, p + n + length - 1) ^ mix((anchor - p).astype(np.uint64) * np.uint64(256) + n.astype(np.uint64))
        for name, values in (("row", row + first), ("p", p - offsets[row]), ("n", n), ("k", gram[anchor]), ("f", whole)):
            out[name].append(values)
    kinds = {"row": np.int64, "p": np.int64, "n": np.int64, "k": np.uint64, "f": np.uint64}
    return {c: np.concatenate([np.zeros(0, kinds[c]), *v]) for c, v in out.items()}


def _lower(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # on ties the first place counts
    second = b < a
    return np.where(second, b, a), np.where(second, bt, at)


def _both(k: np.ndarray, f: np.ndarray) -> np.ndarray:
    return mix(k * np.uint64(0x9E3779B97F4A7C15) + f)


def spread_anchors(docs: DataFrame, n_docs: int, length: int) -> dict[int, int]:
    """Anchors that a bounded sample shows in many surroundings, with the number of tasks each gets."""
    share = min(1.0, SAMPLE_DOCS / max(n_docs, 1))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in byte_slices(whole, 2)):
            found = stretches(_doc_table(batch), length)
            _, first = np.unique(_both(found["k"], found["f"]), return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["k"][first].view(np.int64)), pa.array(found["f"][first].view(np.int64))], names=["k", "f"]
            )

    some = docs.filter(F.pmod(F.xxhash64(docs.columns[0], _TIE, F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    seen = some.mapInArrow(sampled, "k long, f long").distinct().groupBy("k").count().filter(F.col("count") >= SPREAD_FROM)
    return {
        r["k"] & (1 << 64) - 1: -(-int(r["count"] / share) // TASK_STRETCHES) * 2
        for r in seen.collect()  # at most one per SPREAD_FROM stretches of the sample
    }


def stretch_blocks(docs: DataFrame, length: int, buckets: int, doc_buckets: int, spread: dict[int, int]) -> DataFrame:
    """(kind, bucket, data): the first of equal stretches of some texts by anchor, the covers of the others by document."""
    spread_keys = np.array(sorted(spread), np.uint64)
    spread_ways = np.array([spread[int(k)] for k in spread_keys], np.uint64)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in byte_slices(whole, 2)):
            table = _doc_table(batch)
            found = stretches(table, length)
            if not len(found["k"]):
                continue
            docs_of = _columns(table.select(["key", "tie"]))
            key, tie = docs_of["key"][found["row"]], docs_of["tie"][found["row"]]
            k, f, p, n = found["k"], found["f"], found["p"], found["n"]
            _, first = np.unique(_both(k, f), return_index=True)
            is_first = np.zeros(len(key), bool)
            is_first[first] = True

            place = mix(k)
            is_spread = np.zeros(len(k), bool)
            if len(spread_keys):
                at = np.minimum(np.searchsorted(spread_keys, k), len(spread_keys) - 1)
                is_spread = spread_keys[at] == k
                place = np.where(is_spread, mix(place + mix(f) % spread_ways[at]), place)
            kept = np.flatnonzero(is_first)
            low = (place[kept] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            rows = _table(_STRETCH, low, f[kept], key[kept], tie[kept], p[kept], n[kept], is_spread[kept])
            yield _of_kind(0, split_by(bucket_of(place[kept], buckets), rows))
            again = np.flatnonzero(~is_first)
            if len(again):
                covers = _table(_COVER, key[again], tie[again], p[again], p[again] + n[again] + length - 1)
                yield _of_kind(1, split_by(_doc_bucket(key[again], tie[again], doc_buckets), covers))
        give_back()

    return docs.mapInArrow(blocks, f"kind int, {BLOCKS}")


def _of_kind(kind: int, blocks: pa.Table) -> pa.RecordBatch:
    kinds = pa.array(np.full(blocks.num_rows, kind), pa.int32())
    return blocks.add_column(0, "kind", kinds).combine_chunks().to_batches()[0]


def _joined(tables: list[pa.Table]) -> pa.Table:
    schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("data", pa.binary())])
    return pa.concat_tables([schema.empty_table(), *tables])


def compare_stretches(blocks: DataFrame, length: int, doc_buckets: int) -> DataFrame:
    """(kind, bucket, data) by document: covers of repeated stretches (1), and stretches to look into (2)."""

    @lean
    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        c = _columns(unpack(rows.column("data").to_pylist(), _STRETCH))
        order = np.lexsort((c["p"], c["tie"], c["key"], c["f"], c["k"]))
        c = {name: values[order] for name, values in c.items()}
        new_k = np.concatenate([[True], c["k"][1:] != c["k"][:-1]])
        new_f = new_k | np.concatenate([[True], c["f"][1:] != c["f"][:-1]])
        group = np.cumsum(new_k) - 1
        surroundings = np.bincount(group, weights=new_f)[group]
        look = new_f & ((surroundings > 1) | c["spread"])
        end = c["p"].astype(np.int64) + c["n"] + (length - 1)
        again = ~new_f
        covers = _table(_COVER, c["key"][again], c["tie"][again], c["p"][again], end[again])
        block = np.uint64(key[0].as_py()) << np.uint64(32) | c["k"].astype(np.uint64)
        candidates = _table(_CANDIDATE, *[c[x][look] for x in ("key", "tie", "p", "n")], block[look], c["spread"][look])
        return _joined(
            [
                pa.Table.from_batches([_of_kind(kind, split_by(_bucket_of_rows(t, doc_buckets), t))])
                for kind, t in ((1, covers), (2, candidates))
                if t.num_rows
            ]
        )

    return blocks.filter("kind = 0").groupBy("bucket").applyInArrow(compare, f"kind int, {BLOCKS}")


def document_blocks(docs: DataFrame, doc_buckets: int) -> DataFrame:
    """(bucket, data): the texts themselves by document bucket."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in byte_slices(whole, 2)):
            table = _doc_table(batch)
            if table.num_rows:
                yield from split_by(_bucket_of_rows(table, doc_buckets), table).to_batches()
        give_back()

    return docs.mapInArrow(blocks, BLOCKS)


def _row_of(docs: pa.Table, key: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Row of the document for each (key, tie); ``docs`` is in that order."""
    have = np.empty(docs.num_rows, [("key", "i8"), ("tie", "i8")])
    have["key"], have["tie"] = docs.column("key").to_numpy(), docs.column("tie").to_numpy()
    want = np.empty(len(key), have.dtype)
    want["key"], want["tie"] = key, tie
    return np.searchsorted(have, want)


def _sorted_docs(rows: pa.Table) -> pa.Table:
    values = rows.column("data").to_pylist()
    schema = pa.ipc.open_stream(values[0]).schema if values else _DOC
    docs = unpack(values, schema)
    return docs.take(pc.sort_indices(docs, [("key", "ascending"), ("tie", "ascending")]))


def contexts(texts: DataFrame, found: DataFrame, length: int, tasks: int) -> DataFrame:
    """(bucket, data): the bytes of the stretches to look into, by anchor."""

    @lean
    def cut(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = _CONTEXT.empty_table()
        if right.num_rows and left.num_rows:
            docs, wanted = _sorted_docs(left), unpack(right.column("data").to_pylist(), _CANDIDATE)
            c = _columns(wanted)
            text = docs.column("text").combine_chunks()
            values = [
                text[row].as_buffer()[p : p + n + length - 1].to_pybytes()
                for row, p, n in zip(_row_of(docs, c["key"], c["tie"]).tolist(), c["p"].tolist(), c["n"].tolist())
            ]
            out = wanted.append_column("bytes", pa.array(values, pa.binary()))
        return split_by(bucket_of(mix(out.column("block").to_numpy()), tasks), out)

    wanted = found.filter("kind = 2").select("bucket", "data")
    return texts.groupBy("bucket").cogroup(wanted.groupBy("bucket")).applyInArrow(cut, BLOCKS)


def previous_factors(windows: np.ndarray, enough: int) -> np.ndarray:
    """Longest previous factor of every window, rows in text order; shorter ones than ``enough`` may read 0.

    The windows are sorted as suffixes. For each, the nearest rows before and after it in that order that
    stand earlier in the text give its longest earlier match: the least common prefix on the way there.
    """
    n, width = windows.shape
    order = np.argsort(np.ascontiguousarray(windows).view(f"V{width}").ravel().view(f"S{width}"), kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    prefix = np.concatenate([[0], np.where(same.all(axis=1), width, same.argmin(axis=1))])
    best = np.maximum(
        _toward_smaller(order, prefix, enough),
        _toward_smaller(order[::-1], np.concatenate([[0], prefix[:0:-1]]), enough)[::-1],
    )
    out = np.empty(n, np.int64)
    out[order] = best
    return out


def _toward_smaller(text: np.ndarray, prefix: np.ndarray, enough: int) -> np.ndarray:
    """Common prefix with the nearest row before that has a smaller text position, by pointer jumping."""
    to, low = np.arange(len(text)) - 1, prefix.copy()
    active = np.flatnonzero(low >= enough)
    while len(active):
        active = active[text[to[active]] > text[active]]
        jump = to[active]
        low[active] = np.minimum(low[active], low[jump])
        to[active] = to[jump]
        active = active[low[active] >= enough]
    return np.where(low >= enough, low, 0)


def _runs(c: dict[str, np.ndarray], stretch: np.ndarray, window: np.ndarray, length: int) -> pa.Table:
    """Covers for windows (by stretch and place in it) that are repeats; neighbours form one cover."""
    begins = np.flatnonzero(
        np.concatenate([[True], (stretch[1:] != stretch[:-1]) | (window[1:] != window[:-1] + 1)])[: len(window)]
    )
    ends = np.append(begins[1:], len(window)) - 1 if len(begins) else begins
    of = stretch[begins]
    p = c["p"][of].astype(np.int64)
    return _table(_COVER, c["key"][of], c["tie"][of], p + window[begins], p + window[ends] + length)


def repeats_in_contexts(blocks: DataFrame, length: int, doc_buckets: int, tasks: int) -> DataFrame:
    """(kind, bucket, data): covers by document (1), and windows to compare across tasks, by hash (3)."""

    @lean
    def search(key: tuple, rows: pa.Table) -> pa.Table:
        table = unpack(rows.column("data").to_pylist(), _CONTEXT)
        table = table.sort_by([("block", "ascending"), ("key", "ascending"), ("tie", "ascending"), ("p", "ascending")])
        c = _columns(table)
        content = table.column("bytes").combine_chunks()
        offsets = np.frombuffer(content.buffers()[1], np.int32)[content.offset : content.offset + len(content) + 1]
        data = np.frombuffer(content.buffers()[2], np.uint8)
        size = np.bincount(np.unique(c["block"], return_inverse=True)[1])
        size = np.repeat(size, size)
        out, start = [], 0
        while start < table.num_rows:
            # whole blocks up to the limit, or a part of one that exceeds it
            stop = min(start + TASK_STRETCHES, table.num_rows)
            if stop < table.num_rows and c["block"][stop] == c["block"][stop - 1]:
                begin = int(np.searchsorted(c["block"], c["block"][stop]))
                stop = begin if begin > start else stop
            order = start + np.lexsort((c["p"][start:stop], c["tie"][start:stop], c["key"][start:stop]))
            n = c["n"][order].astype(np.int64)
            stretch = np.repeat(order, n)
            window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            views = np.lib.stride_tricks.sliding_window_view(data, length)[offsets[stretch] + window]
            repeat = previous_factors(views, length) >= length
            out.append((1, _runs(c, stretch[repeat], window[repeat], length)))
            # first here, but the anchor is met in other tasks or parts too
            open_ = ~repeat & (c["spread"] | (size > TASK_STRETCHES))[stretch]
            if open_.any():
                at = offsets[stretch[open_]] + window[open_]
                of = stretch[open_]
                hashes = np.concatenate([_window_hashes(views[open_][i : i + 65536]) for i in range(0, len(at), 65536)])
                out.append((3, _table(_WINDOW, hashes, c["key"][of], c["tie"][of], c["p"][of] + window[open_])))
            start = stop
        tables = []
        for kind, t in out:
            if t.num_rows:
                c_ = _columns(t)
                bucket = _bucket_of_rows(t, doc_buckets) if kind == 1 else bucket_of(c_["hash"], tasks)
                tables.append(pa.Table.from_batches([_of_kind(kind, split_by(bucket, t))]))
        return _joined(tables)

    return blocks.groupBy("bucket").applyInArrow(search, f"kind int, {BLOCKS}")


def _window_hashes(views: np.ndarray) -> np.ndarray:
    data = np.ascontiguousarray(views).ravel()
    starts = np.arange(len(views)) * views.shape[1]
    return SpanHashes(data).of(starts, starts + views.shape[1])


def repeats_across_tasks(blocks: DataFrame, length: int, doc_buckets: int) -> DataFrame:
    """(kind, bucket, data): covers of windows that are first in their own task but not in all."""

    def search(key: tuple, rows: pa.Table) -> pa.Table:
        c = _columns(unpack(rows.column("data").to_pylist(), _WINDOW))
        order = np.lexsort((c["p"], c["tie"], c["key"], c["hash"]))
        again = order[1:][c["hash"][order[1:]] == c["hash"][order[:-1]]]
        if not len(again):
            return _joined([])
        p = c["p"][again].astype(np.int64)
        covers = _table(_COVER, c["key"][again], c["tie"][again], p, p + length)
        bucket = _bucket_of_rows(covers, doc_buckets)
        return _joined([pa.Table.from_batches([_of_kind(1, split_by(bucket, covers))])])

    return blocks.filter("kind = 3").groupBy("bucket").applyInArrow(search, f"kind int, {BLOCKS}")


def remove_covered(texts: DataFrame, covers: DataFrame, shape: T.StructType) -> DataFrame:
    """Every text without its covered bytes, in the given shape: key, n_bytes, n_removed, n_spans, kept, carried columns."""
    as_text = shape["kept"].dataType == T.StringType()
    names = shape.names

    @lean
    def apply(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        docs = _sorted_docs(left)
        c = _columns(unpack(right.column("data").to_pylist(), _COVER))
        row = _row_of(docs, c["key"], c["tie"])
        order = np.argsort(row, kind="stable")
        row, starts, ends = row[order], c["start"][order].astype(np.int64), c["end"][order].astype(np.int64)
        edge = np.searchsorted(row, np.arange(docs.num_rows + 1))
        text = docs.column("text").combine_chunks()
        counts, kept = [], []
        for i in range(docs.num_rows):
            data = np.frombuffer(text[i].as_buffer(), np.uint8)
            a, b = edge[i], edge[i + 1]
            removed = spans = 0
            if a < b:
                depth = np.zeros(len(data) + 1, np.int32)
                np.add.at(depth, starts[a:b], 1)
                np.add.at(depth, ends[a:b], -1)
                gone = np.cumsum(depth[:-1]) > 0
                removed = int(gone.sum())
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rest = data[~gone].tobytes()
            else:
                rest = data.tobytes()
            counts.append((len(data), removed, spans))
            kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
        numbers = [pa.array([n[j] for n in counts], pa.int64()) for j in range(3)]
        kept_column = pa.array(kept, pa.string() if as_text else pa.binary())
        original_key, *carried = docs.columns[len(_DOC) :]
        return pa.table([original_key, *numbers, kept_column, *carried], names=names)

    return texts.groupBy("bucket").cogroup(covers.groupBy("bucket")).applyInArrow(apply, shape)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, carry: tuple[str, ...] = (),
    as_text: bool = False,
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) of every document; ``kept`` are the remaining bytes.

    ``carry`` names further columns that come along. ``as_text`` gives ``kept`` as text, without the
    characters that a cut left incomplete.

    Strings are judged on the input, and overlaps with an earlier start in the same document count. A null
    or empty text has no bytes. Texts below ``length`` bytes stay as they are. Null keys come after all
    others. Rows that agree in key and text are judged as one document; rows that share a key only are
    ordered by the md5 of their text. Other columns are left out. Empty input gives no rows. Positions are 32 bits: a
    text has less than 4 GB.
    """
    rows, shared = with_ties(docs.select(key, text, *carry), key, text)
    if not shared:
        return _without_repeats(rows, key, text, length, carry, as_text)
    # equal rows go through it once
    several = F.col(_COPIES) > 1
    once = rows.filter(~several).unionByName(rows.filter(several).dropDuplicates([_ID]))
    found = materialize(_without_repeats(once, key, text, length, (*carry, _ID, _COPIES), as_text), "dedup-once")
    out = [key, *_COUNTS, "kept", *carry]
    of_copies = found.filter(several).select(_ID, *_COUNTS, "kept")
    copies = lookup_join(rows.filter(several).select(key, *carry, _ID), of_copies, _ID, how="inner")
    return found.filter(~several).select(out).unionByName(copies.select(out))


_COUNTS = ("n_bytes", "n_removed", "n_spans")


def _without_repeats(rows: DataFrame, key: str, text: str, length: int, carry: tuple[str, ...], as_text: bool) -> DataFrame:
    """``remove_repeats`` of (key, tie, text, …) where key and tie are unique."""
    whole, docs = rows.select(key, _TIE, text, *carry), rows.select(key, _TIE, text)
    row = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    n_docs, n_bytes = row["n"], row["b"] or 0
    doc_buckets = max(MIN_BUCKETS, n_bytes // BUCKET_BYTES)
    # about 32 windows a stretch
    buckets = max(MIN_BUCKETS, n_bytes // 32 // (1 << 18))
    tasks = max(4 * MIN_BUCKETS, n_bytes // 32 // 12 // TASK_STRETCHES)
    spread = spread_anchors(docs, n_docs, length)

    dealt = materialize(stretch_blocks(docs, length, buckets, doc_buckets, spread), "dedup-stretches")
    found = materialize(compare_stretches(dealt, length, doc_buckets), "dedup-compared")
    looked = contexts(document_blocks(docs, doc_buckets), found, length, tasks)
    searched = materialize(repeats_in_contexts(looked, length, doc_buckets, tasks), "dedup-searched")
    across = repeats_across_tasks(searched, length, doc_buckets)
    covers = dealt.union(found).union(searched).filter("kind = 1").union(across).select("bucket", "data")
    counts = [whole.schema[key], *[T.StructField(c, T.LongType()) for c in _COUNTS]]
    kept = T.StructField("kept", T.StringType() if as_text else T.BinaryType())
    shape = T.StructType([*counts, kept, *[whole.schema[c] for c in carry]])
    return remove_covered(document_blocks(whole, doc_buckets), covers, shape)
