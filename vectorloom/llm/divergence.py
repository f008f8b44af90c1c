"""How the sources of a language differ in the words they use, by Gustavson row accumulation.

Groups (language, source) are the rows of a sparse matrix, kept terms its columns, counts its cells. A cell's p is its
smoothed share in thousand millionths; a term that a group lacks has the group's baseline p. The sum of
|p - q| over all kept terms is wanted for every two groups of a language.

A row is multiplied with a term-major index of its peers: for each of its terms the postings of that term are
scattered into a dense accumulator, one entry per peer, so no (group, peer, term) rows are made. The accumulator
starts from what the sum would be if the groups shared no term: all baselines, corrected for the row's own terms
against the peer's baseline and the peer's terms against the row's. Every shared term then corrects the rest:
|p - q| - |p - baseline of q| - |baseline of p - q| + |difference of baselines|.

Groups are cut into blocks and terms into slices, so a task holds two blocks and one slice, whatever the number of
sources and terms; the sums of slices are added up by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.llm.blocks import pack, unpack
from vectorloom.llm.textops import LOWER, byte_slices, give_back, lean, text_passes
from vectorloom.operators.numbering import number_rows
from vectorloom.session import materialize

MIN_DOCS, SMOOTHING, UNIT, TOP_TERMS = 30, 5, 1_000_000_000, 50
# Groups and cells of a block, cells of a group in a slice of terms.
GROUPS, CELLS = 256, 1 << 21

# Text whose terms are counted at once: the larger, the fewer cells move.
PASS_BYTES = 4 << 20

# Terms are runs of ASCII letters and everything beyond ASCII.
_IN_TERM = np.zeros(256, bool)
_IN_TERM[0x80:] = True
for _first, _last in ("AZ", "az"):
    _IN_TERM[ord(_first) : ord(_last) + 1] = True
_CELL = "lang string, source string, term string, n long, docs long"


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of a run of rows, and the number of terms of each row."""
    inside = _IN_TERM[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    # rows meet without anything between them
    cuts = offsets[:-1][np.diff(offsets) > 0]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    kept = np.concatenate([[0], np.cumsum(inside)])
    ends = np.append(kept[starts], kept[-1]).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data[inside].tobytes()))
    return terms, np.diff(np.searchsorted(starts, offsets, "left"))


def term_cells(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term; term is null for the documents of a group."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in byte_slices(whole, 2)):
            groups = pa.Table.from_batches([batch]).select(["lang", "source"])
            present = groups.group_by(["lang", "source"], use_threads=False).aggregate([([], "count_all")])
            of_row = _codes(groups, present)
            yield _cells(present, np.arange(len(present)), pa.nulls(len(present), pa.string()), present["count_all"], present["count_all"])
            for first, data, offsets in text_passes(batch.column(2), PASS_BYTES):
                terms, n_terms = _terms(LOWER[data], offsets)
                if not len(terms):
                    continue
                coded = terms.dictionary_encode()
                term, n_distinct = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
                row = np.repeat(np.arange(len(n_terms)), n_terms)
                in_doc, times = np.unique(row * n_distinct + term, return_counts=True)
                cell, at = np.unique(of_row[first + in_doc // n_distinct] * n_distinct + in_doc % n_distinct, return_inverse=True)
                n = np.zeros(len(cell), np.int64)
                np.add.at(n, at, times)
                found = coded.dictionary.take(pa.array(cell % n_distinct)).cast(pa.string())
                yield _cells(present, cell // n_distinct, found, pa.array(n), pa.array(np.bincount(at, minlength=len(cell))))
        give_back()

    named = [F.coalesce(c, F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    cells = docs.select(*named).mapInArrow(count, _CELL)
    return cells.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _codes(rows: pa.Table, present: pa.Table) -> np.ndarray:
    """Row of ``present`` for each of ``rows``."""
    place = {pair: i for i, pair in enumerate(zip(present["lang"].to_pylist(), present["source"].to_pylist()))}
    return np.array([place[pair] for pair in zip(rows["lang"].to_pylist(), rows["source"].to_pylist())], np.int64)


def _cells(present: pa.Table, group: np.ndarray, term: pa.Array, n: pa.Array, docs: pa.Array) -> pa.RecordBatch:
    at = pa.array(group)
    columns = [present["lang"].combine_chunks().take(at), present["source"].combine_chunks().take(at), term, n, docs]
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(1000000000 (count + 5) / (total + 5 terms)), exactly."""
    over = (count + F.lit(SMOOTHING)).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (total + F.lit(SMOOTHING) * terms).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", over.cast("decimal(29,0)"), below)


def _blocks(groups: DataFrame) -> DataFrame:
    """(lang, source, cells, base, block, place): groups of a language in blocks of a bounded number of groups and cells."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n, total, last = TaskContext.get().partitionId() << 32, 0, 0, None
        for batch in batches:
            blocks, places = [], []
            for lang, cells in zip(batch.column("lang").to_pylist(), batch.column("cells").to_pylist()):
                if n and (lang != last or n == GROUPS or total + cells > CELLS):
                    block, n, total = block + 1, 0, 0
                blocks.append(block)
                places.append(n)
                n, total, last = n + 1, total + cells, lang
            more = [pa.array(blocks, pa.int64()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "block", "place"])

    ordered = groups.repartitionByRange("lang", "source").sortWithinPartitions("lang", "source")
    return ordered.mapInArrow(number, "lang string, source string, cells long, base long, block long, place long")


_GROUPS = pa.schema([("source", pa.string()), ("base", pa.int64())])
_POSTINGS = pa.schema([("place", pa.int64()), ("term", pa.int64()), ("p", pa.int64())])


def packed_blocks(cells: DataFrame, groups: DataFrame, slices: int) -> DataFrame:
    """(lang, block, slice, groups, cells): the groups of a block and their cells of a slice of terms."""
    headers = groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).selectExpr(
        "lang", "block", "slice", "source", "base", "place", "CAST(NULL AS LONG) term", "CAST(NULL AS LONG) p"
    )
    placed = cells.join(groups.select("lang", "source", "block", "place"), ["lang", "source"]).select(
        "lang", "block", F.pmod("term_id", F.lit(slices)).cast("int").alias("slice"), F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("long").alias("base"), "place", F.col("term_id").alias("term"), "p",
    )

    def one(key: tuple, table: pa.Table) -> pa.Table:
        header = table.filter(pc.is_null(table["term"])).sort_by("place")
        held = table.filter(pc.is_valid(table["term"]))
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()], pa.string()),
                "block": pa.array([key[1].as_py()], pa.int64()),
                "slice": pa.array([key[2].as_py()], pa.int32()),
                "groups": pa.array([pack(header.select(_GROUPS.names).cast(_GROUPS))], pa.binary()),
                "cells": pa.array([pack(held.select(_POSTINGS.names).cast(_POSTINGS))], pa.binary()),
            }
        )

    return headers.union(placed).groupBy("lang", "block", "slice").applyInArrow(lean(one), "lang string, block long, slice int, groups binary, cells binary")


class Block:
    """Groups of a block with the cells of a slice: rows by group, and a term-major index."""

    def __init__(self, groups: bytes, cells: bytes) -> None:
        held = unpack([groups], _GROUPS)
        self.sources = held["source"].combine_chunks()
        self.base = held["base"].to_numpy()
        place, term, p = (unpack([cells], _POSTINGS)[c].to_numpy() for c in _POSTINGS.names)
        # the index: postings by term
        order = np.argsort(term, kind="stable")
        self.terms, first = np.unique(term[order], return_index=True)
        self.ends = np.append(first, len(term))
        self.peer, self.posted = place[order], p[order]
        # the rows: cells by group
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(1, len(self.base)))
        self.row_terms, self.row_p = np.split(term[order], cuts), np.split(p[order], cuts)

    def against(self, baselines: np.ndarray) -> np.ndarray:
        """For every group and baseline b: sum of |p - b| - |base - b| over the group's own terms."""
        out = np.zeros((len(self.base), len(baselines)), np.int64)
        for g, p in enumerate(self.row_p):
            p = np.sort(p)
            sums = np.concatenate([[0], np.cumsum(p)])
            below = np.searchsorted(p, baselines)
            above = (sums[-1] - sums[below]) - baselines * (len(p) - below)
            out[g] = above + baselines * below - sums[below] - len(p) * np.abs(self.base[g] - baselines)
        return out


def accumulate(one: Block, other: Block, baselines: bool, terms: int) -> np.ndarray:
    """Sums of |p - q| of every group of ``one`` with every group of ``other`` over the terms of a slice.

    ``baselines`` adds those of all ``terms``, which is for one of the slices to do.
    """
    out = one.against(other.base) + other.against(one.base).T
    if baselines:
        out += terms * np.abs(one.base[:, None] - other.base[None])
    for g in range(len(one.base)):
        dense = out[g]
        at = np.searchsorted(other.terms, one.row_terms[g])
        at = np.minimum(at, max(len(other.terms) - 1, 0))
        shared = np.flatnonzero(other.terms[at] == one.row_terms[g]) if len(other.terms) else at[:0]
        begin, end = other.ends[at[shared]], other.ends[at[shared] + 1]
        lengths = end - begin
        posting = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        p, q, peer = np.repeat(one.row_p[g][shared], lengths), other.posted[posting], other.peer[posting]
        base, bases = one.base[g], other.base[peer]
        np.add.at(dense, peer, np.abs(p - q) - np.abs(p - bases) - np.abs(base - q) + np.abs(base - bases))
    return out


_PAIR = "lang string, source string, item string, value long"


def pair_sums(blocks: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two groups of a language, both ways round."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one = Block(row["groups"], row["cells"])
                same = row["a"] == row["b"]
                other = one if same else Block(row["other_groups"], row["other_cells"])
                sums = accumulate(one, other, row["slice"] == 0, row["terms"])
                i, j = np.indices(sums.shape).reshape(2, -1)
                i, j = (i[i != j], j[i != j]) if same else (i, j)
                for mine, theirs, a, b in [(one, other, i, j)] + ([] if same else [(other, one, j, i)]):
                    lang = pa.array([row["lang"]] * len(a), pa.string())
                    names = [mine.sources.take(pa.array(a)), theirs.sources.take(pa.array(b))]
                    yield pa.RecordBatch.from_arrays([lang, *names, pa.array(sums[i, j])], names=["lang", "source", "item", "value"])
        give_back()

    # pairs of numbers first, so that the blocks of a language with many sources are dealt to tasks by block
    ids = blocks.select("lang", "slice", "block")
    pairs = ids.withColumnRenamed("block", "a").join(ids.withColumnRenamed("block", "b"), ["lang", "slice"]).filter("a <= b")
    right = blocks.select(
        "slice", F.col("block").alias("b"), F.col("groups").alias("other_groups"), F.col("cells").alias("other_cells")
    )
    left = blocks.select("slice", F.col("block").alias("a"), "terms", "groups", "cells")
    pairs = pairs.join(right, ["b", "slice"]).join(left, ["a", "slice"])
    found = pairs.select("lang", "slice", "terms", "a", "b", "groups", "cells", "other_groups", "other_cells").mapInArrow(multiply, _PAIR)
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group (lang, source).

    Part ``pair``: every other source of the language, value the sum of |p - q| over the kept terms of the
    language, all ranks. Part ``term``: terms the group has and uses more than its language does, value p - q, ranks
    up to ``top_terms``. Ranks count from 1 by value, descending, and item in UTF-8 order. A term is kept where at
    least ``min_docs`` documents of the language have it. All sums and divisions are exact.

    Null texts, languages and sources count as empty strings, and an empty name is a name like any other. A group
    whose documents have no term, or none that is kept, is compared by its baseline; a language that keeps no term
    gives pairs of value 0. A language with a single source has no pairs. Repeated rows count each; extra columns
    are left out; an empty table gives no rows. Whole texts count, of any length.
    """
    counted = materialize(term_cells(docs, text, lang, source), "divergence-cells")
    found = counted.filter("term IS NOT NULL")
    kept = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= min_docs)
    kept = number_rows(kept.select("lang", "term", "lang_n"), ["lang", "term"], "term_id").rows
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    cells = materialize(found.join(kept, ["lang", "term"]).select("lang", "source", "term", "term_id", "n", "lang_n"), "divergence-kept")

    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("cells"))
    groups = counted.filter("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.na.fill(0, ["total", "cells", "terms", "lang_total"])
    # without terms there is no share to take
    base = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.greatest("terms", F.lit(1)))).otherwise(0)
    groups = materialize(groups.withColumn("base", base.cast("long")), "divergence-groups")
    shares = groups.select("lang", "source", "total", "terms", "lang_total")
    cells = cells.join(shares, ["lang", "source"]).select(
        "lang", "source", "term", "term_id",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    cells = materialize(cells, "divergence-shares")

    numbered = materialize(_blocks(groups.select("lang", "source", "cells", "base")), "divergence-blocks")
    widest = groups.agg(F.max("cells")).first()[0] or 0
    slices = max(1, -(-widest // CELLS))
    packed = packed_blocks(cells, numbered, slices).join(groups.groupBy("lang").agg(F.max("terms").alias("terms")), "lang")
    pairs = pair_sums(materialize(packed, "divergence-packed")).withColumn("part", F.lit("pair"))
    terms = cells.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"), F.lit("term").alias("part")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = [df.withColumn("rank", F.row_number().over(order)) for df in (pairs, terms)]
    both = ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top_terms))
    return both.select("lang", "source", "part", "item", "value", "rank")
