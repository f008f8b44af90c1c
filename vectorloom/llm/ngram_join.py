"""Exact Jaccard join of documents on word n-grams by universe partition.

The hash range of all shingles is cut into m equal segments, so every set falls into m subsets. Two sets
that differ in at most H shingles agree in enough segments: give segment i a tolerance of 0 or 1 (or leave
it out) and let 0 count one unit and 1 two; if the units exceed H, some chosen segment differs by no more
than its tolerance. Tolerance 0 looks for the equal subset; tolerance 1 also for subsets with one shingle
less or more, found by one-deletion neighbourhoods on either side.

Sets are indexed under the scheme of their own size band. A set looks for partners of its own size or
smaller: under its own scheme, and under that of the band below when its size allows. It needs H + 1
units for its own largest H and takes the cheapest: segments with many shingles are rarely shared by
chance, ones with none or one are shared by many. All candidates are checked on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.blocks import pack, unpack
from vectorloom.llm.components import connected_components
from vectorloom.llm.textops import LOWER, SLICE_BYTES, SpanHashes, as_texts, byte_slices, give_back, mix, text_passes, word_spans
from vectorloom.operators.lookup import lookup_join
from vectorloom.session import materialize

# Signature rows that one bucket should hold.
BUCKET_ROWS = 1_000_000
MIN_BUCKETS = 64

_ORDER_CODES = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ELEMENT = np.uint64(0xD6E8FEB86659FD93)
# Bits of a sketch per shingle; centres tried in a group, and sets that a centre is chosen by.
_SKETCH_BITS, _CENTRES, _COMPARED = 2, 16, 32
# Sets and shingles of a block of linked sets; columns of a matrix that counts common shingles.
LINK_SETS, LINK_SHINGLES, _COLUMNS = 512, 1 << 19, 4_096
# Members and shingles of a block of a group. Documents sampled, and different sets in them from which a signature is hot.
GROUP_SETS, GROUP_SHINGLES = 1_024, 1 << 22
SAMPLE_DOCS, HOT_FROM = 8_192, 32
_INDEX, _INDEX_DELETION, _PROBE, _PROBE_DELETION = 1, 2, 4, 8


@dataclass(frozen=True)
class Rule:
    """Sets of word ``n``-grams are linked when percent * union <= 100 * intersection."""

    n: int = 4
    percent: int = 85

    def most_different(self, a: int, b: int) -> int:
        """Largest symmetric difference of linked sets of these sizes."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def largest_partner(self, a: int) -> int:
        return a * 100 // self.percent


@dataclass(frozen=True)
class Scheme:
    """Segments for one band of sizes."""

    low: int
    high: int
    borders: np.ndarray
    seeds: np.ndarray
    # the first segments also have one-deletion neighbourhoods
    deletions: int


class Schemes:
    """The size bands, each about two steps of the threshold wide."""

    def __init__(self, rule: Rule) -> None:
        self.rule = rule
        self.lows = [1]
        while self.lows[-1] < 1 << 40:
            low = self.lows[-1]
            self.lows.append(max(low + 1, low * 10_000 // rule.percent**2))
        self.made: dict[int, Scheme] = {}

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.lows, size, "right")) - 1

    def get(self, band: int) -> Scheme:
        if band not in self.made:
            low, high = self.lows[band], self.lows[band + 1] - 1
            units = self.rule.most_different(high, self.rule.largest_partner(high)) + 1
            # a tenth more segments than units, so that poor ones can be left out
            segments = units + units // 10 + 2
            borders = np.array([i * (1 << 64) // segments for i in range(segments)], np.uint64)
            seeds = mix(np.arange(segments, dtype=np.uint64) + np.uint64(band * 1_000_003 + 7))
            self.made[band] = Scheme(low, high, borders, seeds, max(1, segments // 32))
        return self.made[band]

    def signatures(self, shingles: np.ndarray, band: int, index: bool, units: int) -> tuple[np.ndarray, np.ndarray]:
        """Signatures and roles of a sorted set; ``units`` 0 means no search."""
        scheme = self.get(band)
        segments = len(scheme.borders)
        edges = np.append(np.searchsorted(shingles, scheme.borders), len(shingles))
        count = np.diff(edges)
        element = mix(shingles ^ _ELEMENT)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(element)])
        subset = sums[edges[1:]] - sums[edges[:-1]]

        role = np.full(segments, _INDEX if index else 0, np.uint8)
        deletion_role = np.full(scheme.deletions, _INDEX_DELETION if index else 0, np.uint8)
        if units:
            # cost of tolerance 0, and of raising it to 1: the rows it adds and a subset that is one poorer
            plain = _segment_cost(count)
            some = count[: scheme.deletions]
            raised = np.where(some >= 3, some + 1 + _segment_cost(some - 1), np.inf)
            chosen = np.argsort(np.concatenate([plain, raised]), kind="stable")[:units]
            role[chosen[chosen < segments]] |= _PROBE
            deletion_role[chosen[chosen >= segments] - segments] |= _PROBE_DELETION

        used = role > 0
        out, roles = [subset[used] + scheme.seeds[used]], [role[used]]
        for i in np.flatnonzero(deletion_role):
            out.append(subset[i] - element[edges[i] : edges[i + 1]] + scheme.seeds[i])
            roles.append(np.full(count[i], deletion_role[i], np.uint8))
        return mix(np.concatenate(out)), np.concatenate(roles)

    def all_signatures(self, shingles: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Signatures under the schemes that concern a set; empty for sets that only equal sets match."""
        rule, size = self.rule, len(shingles)
        if not size:
            return []
        out, band = [], self.band(size)
        indexed = rule.largest_partner(size) > size
        most = rule.most_different(size, size)
        if indexed or most:
            out.append(self.signatures(shingles, band, indexed, most + 1 if most else 0))
        if band and rule.largest_partner(high := self.get(band - 1).high) >= size:
            most = rule.most_different(high, size)
            if most:
                out.append(self.signatures(shingles, band - 1, False, most + 1))
        return out


def _segment_cost(count: np.ndarray) -> np.ndarray:
    # by the number of shingles: none is shared by everyone, one by all texts with that phrase
    cost = np.where(count == 0, 1e6, np.where(count == 1, 100.0, np.where(count == 2, 10.0, 1.0)))
    return cost - 0.001 * np.minimum(count, 50)


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text, lower-cased in A-Z."""
    for first, data, offsets in text_passes(column):
        data = LOWER[data]
        starts, ends, row_words = word_spans(data, offsets)
        words = SpanHashes(data).of(starts, ends)
        grams = np.zeros(0, np.uint64)
        if len(words) >= n:
            grams = mix(sum(words[i : len(words) - n + 1 + i] * _ORDER_CODES[i] for i in range(n)))
        for i in range(len(offsets) - 1):
            a, b = row_words[i], row_words[i + 1]
            if b - a >= n:
                yield first + i, np.unique(grams[a : b - n + 1])
            elif b > a:
                short = (words[a:b] * _ORDER_CODES[: b - a]).sum(dtype=np.uint64, keepdims=True)
                yield first + i, mix(short + _ORDER_CODES[n + b - a : n + b - a + 1])
            else:
                yield first + i, np.zeros(0, np.uint64)


def word_sets(texts: list[bytes], n: int) -> Iterator[set]:
    """The same sets with the words themselves."""
    for text in texts:
        words = text.lower().split()
        if len(words) >= n:
            yield set(zip(*[words[i:] for i in range(n)]))
        else:
            yield {tuple(words)} if words else set()


def _node(shingles: np.ndarray) -> int:
    """Equal sets have the same node; 64 bits of a hash over the sorted shingles."""
    place = mix(np.arange(1, len(shingles) + 1, dtype=np.uint64))
    return int(mix((shingles * (place | np.uint64(1))).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def document_sets(docs: DataFrame, key: str, text: str, rule: Rule) -> DataFrame:
    """(key, n_shingles, node, sketch): set size, number of the set and its parity sketch; null for an empty one.

    The sketch has a bit per hash value, set when an odd number of shingles fall on it: two sets differ in
    at least as many shingles as their sketches in bits.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, sketches = [], [], []
            for _, shingles in shingle_sets(batch.column(1), rule.n):
                sizes.append(len(shingles))
                nodes.append(_node(shingles) if len(shingles) else None)
                sketches.append(parity_sketch(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary())],
                names=[key, "n_shingles", "node", "sketch"],
            )
        give_back()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(sets, f"`{key}` {kind}, n_shingles long, node long, sketch binary")


_ENTRY = np.dtype([("node", "<i8"), ("signature", "<u4"), ("role", "u1")])


def hot_signatures(docs: DataFrame, text: str, rule: Rule, n_docs: int) -> np.ndarray:
    """Signatures that a bounded sample of texts shows in many sets, in order; it decides where they meet, never whether."""
    # so many that a signature which is not hot has about as many entries as a bucket at most
    share = min(1.0, max(SAMPLE_DOCS / max(n_docs, 1), HOT_FROM / BUCKET_ROWS))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemes = Schemes(rule)
        for batch in (part for whole in batches for part in byte_slices(whole, 0)):
            seen = {_node(s): s for _, s in shingle_sets(batch.column(0), rule.n) if len(s)}
            values = [np.unique(v) for s in seen.values() for v, _ in schemes.all_signatures(s)]
            value, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *values]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count)], names=["value", "n"])
        give_back()

    some = docs.select(text).filter(F.pmod(F.xxhash64(text, F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    counts = some.distinct().mapInArrow(sampled, "value long, n long").groupBy("value").agg(F.sum("n").alias("n"))
    # a bounded number: signatures of the sample over HOT_FROM
    return np.sort(np.array([r["value"] for r in counts.filter(F.col("n") >= HOT_FROM).collect()], np.int64).view(np.uint64))


def signature_blocks(docs: DataFrame, text: str, rule: Rule, buckets: int, hot: np.ndarray) -> DataFrame:
    """(bucket, entries): signature entries of a batch, packed per bucket. Equal sets count once a batch.

    Entries of hot signatures have the place in ``hot`` as signature and are dealt by node to as many buckets more.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemes = Schemes(rule)
        for batch in (part for whole in batches for part in byte_slices(whole, 0)):
            seen, nodes, sizes, values, roles = set(), [], [], [], []
            for _, shingles in shingle_sets(batch.column(0), rule.n):
                if not len(shingles) or (node := _node(shingles)) in seen:
                    continue
                seen.add(node)
                for signature, role in schemes.all_signatures(shingles):
                    nodes.append(node)
                    sizes.append(len(signature))
                    values.append(signature)
                    roles.append(role)
            if not values:
                continue
            value = np.concatenate(values)
            entries = np.empty(len(value), _ENTRY)
            entries["node"] = np.repeat(np.array(nodes, np.int64), sizes)
            entries["signature"] = (value >> np.uint64(32)).astype(np.uint32)
            entries["role"] = np.concatenate(roles)
            bucket = ((value & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, value), len(hot) - 1)
                is_hot = hot[at] == value
                entries["signature"][is_hot] = at[is_hot]
                dealt = mix(entries["node"][is_hot].view(np.uint64)) % np.uint64(buckets)
                bucket[is_hot] = buckets + dealt.astype(np.int64)
            entries = entries[np.argsort(bucket, kind="stable")]
            present, counts = np.unique(bucket, return_counts=True)
            parts = np.split(entries, np.cumsum(counts)[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(present), pa.array([p.tobytes() for p in parts], pa.binary())], names=["bucket", "entries"]
            )
        give_back()

    return docs.select(text).mapInArrow(blocks, "bucket long, entries binary")


def _matching_groups(entries: np.ndarray) -> Iterator[np.ndarray]:
    """Entries that share a signature, where a search meets an index entry of another set."""
    entries = entries[np.argsort(entries["signature"], kind="stable")]
    starts = np.flatnonzero(np.concatenate([[True], entries["signature"][1:] != entries["signature"][:-1]]))
    ends = np.append(starts[1:], len(entries))
    several = ends - starts > 1
    for a, b in zip(starts[several], ends[several]):
        group = entries[a:b]
        role = np.bitwise_or.reduce(group["role"])
        plain = role & _PROBE and role & (_INDEX | _INDEX_DELETION)
        if (plain or (role & _PROBE_DELETION and role & _INDEX)) and (group["node"] != group["node"][0]).any():
            yield group


def candidate_groups(blocks: DataFrame, buckets: int) -> DataFrame:
    """(group, nodes): sorted distinct sets that share a signature, each list once a bucket.

    Group is null, but for hot signatures it tells which one, and a list has those of its members that a bucket holds.
    """

    def groups(key: tuple, rows: pa.Table) -> pa.Table:
        entries = np.frombuffer(b"".join(rows.column("entries").to_pylist()), _ENTRY)
        if key[0].as_py() >= buckets:
            present = np.unique(entries["signature"])
            lists = [np.unique(entries["node"][entries["signature"] == s]) for s in present]
            hot = present.astype(np.int64)
        else:
            found = {np.unique(group["node"]).tobytes() for group in _matching_groups(entries)}
            lists, hot = [np.frombuffer(nodes, np.int64) for nodes in found], None
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        values = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        of = pa.nulls(len(lists), pa.int64()) if hot is None else pa.array(hot)
        return pa.table({"group": of, "nodes": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))})

    return blocks.groupBy("bucket").applyInArrow(groups, "group long, nodes array<long>")


def candidate_sets(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, size, sketch) of every set in a group; no text moves."""
    wanted = groups.select(F.explode("nodes").alias("node")).distinct()
    # equal sets are one row a task before they move
    different = sets.filter("node IS NOT NULL").select("node", F.col("n_shingles").alias("size"), "sketch").dropDuplicates(["node"])
    return different.join(wanted, "node", "left_semi")


def pair_texts(docs: DataFrame, sets: DataFrame, wanted: DataFrame, key: str, text: str, rule: Rule) -> DataFrame:
    """(node, text) of one document for every node of ``wanted``; ``wanted`` is read twice.

    Documents are found by the smallest key that has the set, and told apart by the set itself; where only rows without
    a key have it, it is looked for among those.
    """
    holders = sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(key).alias(key))
    holders = materialize(holders, "join-holders")
    keys = holders.filter(F.col(key).isNotNull()).select(key).distinct()
    found = docs.join(keys, key, "left_semi").select(text)
    if not holders.filter(F.col(key).isNull()).isEmpty():
        found = found.union(docs.filter(F.col(key).isNull()).select(text))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in byte_slices(whole, 0)):
            seen, rows = {}, []
            for row, shingles in shingle_sets(batch.column(0), rule.n):
                if len(shingles) and (node := _node(shingles)) not in seen:
                    seen[node] = row
                    rows.append(row)
            texts = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), texts], names=["node", "text"])
        give_back()

    return found.mapInArrow(nodes, "node long, text string").join(wanted, "node", "left_semi").dropDuplicates(["node"])


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    bits = 64
    while bits < _SKETCH_BITS * len(shingles):
        bits *= 2
    at = (shingles >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8))


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words of one width, that of the shortest: neighbouring bits of longer ones fall together."""
    width = min(map(len, sketches))
    out = np.empty((len(sketches), width), np.uint8)
    for i, sketch in enumerate(sketches):
        row = np.frombuffer(sketch, np.uint8)
        while len(row) > width:
            bits = np.unpackbits(row)
            row = np.packbits(bits[::2] ^ bits[1::2])
        out[i] = row
    return out.view(np.uint64)


def _apart(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.bitwise_count(sketches ^ one).sum(axis=1, dtype=np.int64)


def group_members(groups: DataFrame) -> DataFrame:
    """(group, node) of the distinct groups with three sets or more, and of the hot signatures."""
    larger = groups.filter("group IS NULL AND size(nodes) > 2").select(F.xxhash64("nodes").alias("group"), "nodes")
    hot = groups.filter("group IS NOT NULL").select("group", "nodes")
    return larger.dropDuplicates(["group"]).union(hot).select("group", F.explode("nodes").alias("node"))


def member_blocks(members: DataFrame, candidates: DataFrame) -> DataFrame:
    """(group, node, size, block): members in blocks, so that a group of any size is spread over tasks."""
    rows = materialize(members.join(candidates.select("node", "size"), "node").select("group", "node", "size"), "join-sized")
    return materialize(_numbered(rows, "group", GROUP_SETS, GROUP_SHINGLES), "join-group-blocks")


def _by_group(table: pa.Table) -> dict[int, np.ndarray]:
    group = table.column("group").to_numpy()
    order = np.argsort(group, kind="stable")
    present, starts = np.unique(group[order], return_index=True)
    return dict(zip(present.tolist(), np.split(order, starts[1:])))


def star_pairs(groups: DataFrame, blocks: DataFrame, candidates: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of groups of two that size and sketch leave possible, and in blocks of larger groups central sets with such.

    A centre is the set closest by sketch to a few others. What is too far from it gets a centre of its own, a
    few times over; ``cross_pairs`` sees to the rest, and to sets of different blocks.
    """

    def stars(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
        node, size = table.column("node").to_numpy(), table.column("size").to_numpy()
        sketches = _folded(table.column("sketch").to_pylist())
        left, us, vs = np.lexsort((node, size)), [], []
        for _ in range(_CENTRES):
            some = left[:: max(1, len(left) // _COMPARED)][:_COMPARED]
            distance = sum(_apart(sketches[left], sketches[i]) for i in some)
            centre = left[int(np.argmin(distance))]
            most = (100 - rule.percent) * (size[left] + size[centre]) // (100 + rule.percent)
            near = _apart(sketches[left], sketches[centre]) <= most
            partners = node[left[near]]
            partners = partners[partners != node[centre]]
            us.append(np.full(len(partners), node[centre]))
            vs.append(partners)
            left = left[~near]
            if len(left) < 2:
                break
        return us, vs

    def in_block(_: tuple, table: pa.Table) -> pa.Table:
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in _by_group(table).values():
            more = stars(table.take(pa.array(at)))
            us += more[0]
            vs += more[1]
        return pa.table({"u": np.concatenate(us), "v": np.concatenate(vs)})

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_u, size_v = (batch.column(c).to_numpy() for c in ("size_u", "size_v"))
            both = zip(*(batch.column(c).to_pylist() for c in ("sketch_u", "sketch_v")))
            apart = np.array([int(_apart(sketches[:1], sketches[1])[0]) for sketches in map(_folded, both)], np.int64)
            near = apart <= (100 - rule.percent) * (size_u + size_v) // (100 + rule.percent)
            yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))

    rows = blocks.join(candidates.select("node", "sketch"), "node")
    found = rows.groupBy("block").applyInArrow(in_block, "u long, v long")
    twos = groups.filter("group IS NULL AND size(nodes) = 2")
    twos = _pairs(twos.select(F.col("nodes")[0].alias("u"), F.col("nodes")[1].alias("v")))
    for name in ("u", "v"):
        side = candidates.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col("sketch").alias(f"sketch_{name}"))
        twos = twos.join(side, name)
    # sizes alone rule out most pairs that meet by chance
    fits = F.least("size_u", "size_v") * 100 >= F.greatest("size_u", "size_v") * rule.percent
    return _pairs(twos.filter(fits).mapInArrow(possible, "u long, v long").union(found))


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()


def _pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


_MEMBER = pa.schema(
    [("group", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("component", pa.int64()), ("sketch", pa.binary())]
)


def cross_pairs(blocks: DataFrame, labels: DataFrame, candidates: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of a group that no chain links yet and that size and sketch leave possible.

    A task compares one block, or two blocks of a group whose sizes allow a link.
    """
    labelled = blocks.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = materialize(labelled, "join-members")
    unsettled = labelled.groupBy("group").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    unsettled = unsettled.filter("a != b").select("group")
    rows = materialize(labelled.join(unsettled, "group", "left_semi"), "join-unsettled")

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        data = pack(table.select(_MEMBER.names).cast(_MEMBER).combine_chunks())
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "data": pa.array([data], pa.binary())})

    held = rows.join(candidates.select("node", "sketch"), "node").groupBy("block").applyInArrow(packed, "block long, data binary")
    held = materialize(held, "join-unsettled-sets")
    alone = held.select(F.lit(None).cast("long").alias("group"), F.col("data").alias("left"), F.lit(None).cast("binary").alias("right"))
    pairs = (
        materialize(block_pairs(rows, "group", rule), "join-unsettled-pairs")
        .join(held.select(F.col("block").alias("a"), F.col("data").alias("left")), "a")
        .join(held.select(F.col("block").alias("b"), F.col("data").alias("right")), "b")
        .select("group", "left", "right")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, left, right in zip(*(batch.column(c) for c in ("group", "left", "right"))):
                one = unpack([left.as_py()], _MEMBER)
                other = one if right.as_py() is None else unpack([right.as_py()], _MEMBER)
                ones, others = _by_group(one), _by_group(other)
                for g in [*ones] if group.as_py() is None else [group.as_py()]:
                    us, vs = _possible(one.take(pa.array(ones[g])), other.take(pa.array(others[g])), rule)
                    yield pa.RecordBatch.from_arrays([pa.array(us), pa.array(vs)], names=["u", "v"])
        give_back()

    return _pairs(alone.union(pairs).mapInArrow(compare, "u long, v long").filter("u != v"))


def _possible(one: pa.Table, other: pa.Table, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets of different components that size and sketch leave possible."""
    other = other.sort_by([("size", "ascending"), ("node", "ascending")])
    (u, u_component, u_size), (v, v_component, v_size) = (
        [t.column(c).to_numpy() for c in ("node", "component", "size")] for t in (one, other)
    )
    sketches = _folded([*one.column("sketch").to_pylist(), *other.column("sketch").to_pylist()])
    mine, theirs = sketches[: len(u)], sketches[len(u) :]
    starts = np.searchsorted(v_size, -(-u_size * rule.percent // 100))
    stops = np.searchsorted(v_size, u_size * 100 // rule.percent, "right")
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(len(u)):
        j = np.arange(starts[i], stops[i])
        j = j[v_component[j] != u_component[i]]
        if len(j):
            most = (100 - rule.percent) * (u_size[i] + v_size[j]) // (100 + rule.percent)
            j = j[_apart(theirs[j], mine[i]) <= most]
            us.append(np.full(len(j), u[i]))
            vs.append(v[j])
    return np.concatenate(us), np.concatenate(vs)


def verified(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose word sets meet the threshold, compared word by word."""
    one = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    other = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for batch in (part for whole in batches for part in byte_slices(whole, 3, SLICE_BYTES // 2)):
            keep = []
            ones = batch.column(0).to_pylist()
            for u, text_u, text_v in zip(ones, as_texts(batch.column(2)), as_texts(batch.column(3))):
                if u != last:
                    last, (last_set,) = u, word_sets([text_u], rule.n)
                (other_set,) = word_sets([text_v], rule.n)
                common = len(last_set & other_set)
                keep.append(100 * common >= rule.percent * (len(last_set) + len(other_set) - common))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    both = pairs.join(other, "v").join(one, "u").select("u", "v", "text_u", "text_v")
    return both.mapInArrow(check, "u long, v long")


_LINKED = pa.schema(
    [("node", pa.int64()), ("component", pa.int64()), ("copies", pa.int64()), ("shingles", pa.large_list(pa.uint64()))]
)


def _numbered(rows: DataFrame, by: str, sets: int, shingles: int) -> DataFrame:
    """``rows`` with a ``block`` each: runs in order of ``by``, size and node, numbered upwards in that order.

    A block has at most so many sets and shingles, or one larger set; a value of ``by`` may span many blocks and
    a block hold many values. ``rows`` are read twice.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n, total = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            numbers = []
            for size in batch.column("size").to_pylist():
                if n and (n == sets or total + size > shingles):
                    block, n, total = block + 1, 0, 0
                n, total = n + 1, total + size
                numbers.append(block)
            yield batch.append_column("block", pa.array(numbers, pa.int64()))

    ordered = rows.repartitionByRange(by, "size", "node").sortWithinPartitions(by, "size", "node")
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return ordered.mapInArrow(number, f"{shape}, block long")


def block_pairs(numbered: DataFrame, by: str, rule: Rule) -> DataFrame:
    """(by, a, b): pairs of different blocks that hold sets of one value of ``by`` with sizes that may be linked."""
    spans = numbered.groupBy(by, "block").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    several = spans.groupBy(by).count().filter("count > 1").select(by)
    spans = materialize(spans.join(several, by, "left_semi"), "join-spans")
    one = spans.select(by, F.col("block").alias("a"), (F.col("high") * 100).alias("most"))
    other = spans.select(by, F.col("block").alias("b"), (F.col("low") * rule.percent).alias("least"))
    return one.join(other, by).filter("a < b AND least <= most").select(by, "a", "b")


def common_shingles(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sets of hashes, by products of matrices of bounded width."""
    values, column = np.unique(np.concatenate([*one, *other]), return_inverse=True)
    row = np.repeat(np.arange(len(one) + len(other)), [len(x) for x in [*one, *other]])
    first = row < len(one)
    both = (np.bincount(column[first], minlength=len(values)) > 0) & (np.bincount(column[~first], minlength=len(values)) > 0)
    used = both[column]
    column, row = (np.cumsum(both) - 1)[column[used]], row[used]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((len(one), len(other)), np.int64)
    for start in range(0, int(both.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [start, start + _COLUMNS])
        marks = np.zeros((len(one) + len(other), min(_COLUMNS, int(both.sum()) - start)), np.float32)
        marks[row[a:b], column[a:b] - start] = 1
        out += (marks[: len(one)] @ marks[len(one) :].T).astype(np.int64)
    return out


def _linked(one: list[np.ndarray], other: list[np.ndarray], rule: Rule) -> np.ndarray:
    common = common_shingles(one, other)
    sizes = np.array([len(x) for x in one])[:, None] + np.array([len(x) for x in other])[None]
    return 100 * common >= rule.percent * (sizes - common)


def link_counts(labels: DataFrame, sets: DataFrame, candidates: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """(node, links): documents with another set that a set is linked to, for every set of ``labels``.

    Links do not leave a component, so its sets, in order of size, are cut into blocks, and every two blocks
    whose sizes allow a link are compared in a task of their own, each pair of sets once. What a task gives
    back are counts per set, so no row per link is made; the pairs compared grow with the square of the
    largest components. The two sets of a component of two are linked to each other.
    """
    copies = sets.filter("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"))
    rows = labels.select("node", "component").join(candidates.select("node", "size"), "node").join(copies, "node")
    members = labels.groupBy("component").agg(F.count("*").alias("members"))
    rows = materialize(rows.join(members, "component"), "join-linked")
    twos = rows.filter("members = 2")
    totals = twos.groupBy("component").agg(F.sum("copies").alias("total"))
    of_twos = twos.join(totals, "component").select("node", (F.col("total") - F.col("copies")).alias("links"))
    numbered = _numbered(rows.filter("members > 2").drop("members"), "component", LINK_SETS, LINK_SHINGLES)
    numbered = materialize(numbered, "join-linked-blocks")

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        found = [s for _, s in shingle_sets(table.column("text").combine_chunks(), rule.n)]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in found])])
        shingles = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(np.concatenate(found)))
        block = pa.Table.from_arrays([*(table.column(c) for c in ("node", "component", "copies")), shingles], schema=_LINKED)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "data": pa.array([pack(block)], pa.binary())})

    with_text = numbered.select("node", "component", "copies", "block").join(texts.select("node", "text"), "node")
    blocks = materialize(with_text.groupBy("block").applyInArrow(packed, "block long, data binary"), "join-linked-sets")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for component, one, other in zip(*(batch.column(c) for c in ("component", "left", "right"))):
                nodes, links = _count_links(component.as_py(), one.as_py(), other.as_py(), rule)
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(links, pa.int64())], names=["node", "links"])
        give_back()

    alone = blocks.select(F.lit(None).cast("long").alias("component"), F.col("data").alias("left"), F.lit(None).cast("binary").alias("right"))
    pairs = (
        materialize(block_pairs(numbered, "component", rule), "join-linked-pairs")
        .join(blocks.select(F.col("block").alias("a"), F.col("data").alias("left")), "a")
        .join(blocks.select(F.col("block").alias("b"), F.col("data").alias("right")), "b")
        .select("component", "left", "right")
    )
    counted = alone.union(pairs).mapInArrow(count, "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("links")).union(of_twos)


def _count_links(component: int | None, left: bytes, right: bytes | None, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and links of two blocks in a component; without a second block, of one in all its components."""

    def parts(data: bytes) -> dict[int, tuple]:
        table = unpack([data], _LINKED)
        of, node, copies = (table.column(c).to_numpy() for c in ("component", "node", "copies"))
        lists = table.column("shingles").combine_chunks()
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        wanted = np.unique(of).tolist() if component is None else [component]
        return {
            c: (node[at], copies[at], [values[offsets[i] : offsets[i + 1]] for i in at])
            for c, at in ((c, np.flatnonzero(of == c)) for c in wanted)
        }

    nodes, links = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    ones = parts(left)
    others = ones if right is None else parts(right)
    for c, (node, copies, shingles) in ones.items():
        linked = _linked(shingles, others[c][2], rule)
        if right is None:
            np.fill_diagonal(linked, False)
        else:
            nodes.append(others[c][0])
            links.append(linked.T @ copies)
        nodes.append(node)
        links.append(linked @ others[c][1])
    return np.concatenate(nodes), np.concatenate(links)


def ngram_jaccard_join(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule(), count_links: bool = True
) -> DataFrame:
    """(key, n_shingles, component_id, n_links): set size, the smallest key reachable over links, and their number.

    Links are counted by document: every other row whose set is linked counts, rows with an equal set too.
    ``count_links=False`` leaves the column out and the counting undone.

    Equal sets are one node. Sets that share a signature form a group; they are compared with central sets
    of the group, and only where that leaves a group in several components are the remaining pairs across
    components compared too. A test on size and sketch that no linked pair can fail comes before. So groups
    of near copies take about a comparison per member, and no link between components is missed.

    A null or wordless text has an empty set and is its own component, as has a null key (component null).
    Texts with fewer than n words have one shingle, all of them. Repeated keys are rows of their own; they
    share a component only if linked. A document with an empty set has no links. Extra columns are left out.
    Empty input gives no rows.
    """
    docs = docs.select(key, text)
    sets = materialize(document_sets(docs, key, text, rule), "join-sets")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    # a set has about a third as many signatures as shingles
    buckets = max(MIN_BUCKETS, total // (3 * BUCKET_ROWS))
    hot = hot_signatures(docs, text, rule, sets.count())
    signatures = signature_blocks(docs, text, rule, buckets, hot)
    groups = materialize(candidate_groups(signatures, buckets), "join-groups")
    candidates = materialize(candidate_sets(sets, groups), "join-candidates")

    members = materialize(group_members(groups), "join-groups-apart")
    blocks = member_blocks(members, candidates)
    pairs = materialize(star_pairs(groups, blocks, candidates, rule), "join-pairs")
    texts = materialize(pair_texts(docs, sets, _nodes(pairs), key, text, rule), "join-texts")
    links = materialize(verified(pairs, texts, rule), "join-links")
    labels = materialize(connected_components(links), "join-labels")
    pairs = materialize(cross_pairs(blocks, labels, candidates, rule), "join-more-pairs")
    if not pairs.isEmpty():
        missing = materialize(_nodes(pairs).join(texts, "node", "left_anti"), "join-more-nodes")
        texts = texts.union(materialize(pair_texts(docs, sets, missing, key, text, rule), "join-more-texts"))
        more = materialize(verified(pairs, texts, rule), "join-more-links")
        if not more.isEmpty():
            labels = materialize(connected_components(links.union(more)), "join-labels")

    of_sets = sets.filter("node IS NOT NULL").groupBy("node").agg(F.min(key).alias("first"), F.count("*").alias("copies"))
    labelled = materialize(of_sets, "join-nodes").join(labels, "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    roots = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    of_node = labelled.join(roots, "component").select("node", "component_id", (F.col("copies") - 1).alias("equal"))
    of_node = materialize(of_node, "join-components")
    # a set may be that of many documents, and very many have none: hot nodes are joined where they are
    thin = sets.select(key, "n_shingles", "node")
    component = F.when(F.col("node").isNull(), F.col(key)).otherwise(F.col("component_id")).alias("component_id")
    if not count_links:
        return lookup_join(thin, of_node, "node").select(key, "n_shingles", component)
    counts = materialize(link_counts(labels, sets, candidates, texts, rule), "join-counts")
    of_node = of_node.join(counts, "node", "left").withColumn("links", F.col("equal") + F.coalesce("links", F.lit(0)))
    n_links = F.coalesce("links", F.lit(0)).cast("long").alias("n_links")
    return lookup_join(thin, materialize(of_node, "join-linked-nodes"), "node").select(key, "n_shingles", component, n_links)
