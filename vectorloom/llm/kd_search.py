"""Exact top-k search by inner product: a KD-tree per shard, best-first traversal, a kth score that travels.

Rows are dealt to shards at random, so shards are alike in size whatever the ids and however many copies a
vector has. A shard becomes a tree: the widest dimension is split at its median until a leaf is small, and
every node has the tight box of its vectors. The best score a box allows is the sum over dimensions of the
better of its two corners; nodes are visited best bound first, until the bound falls below the kth score.

Every query first searches the shard it lives in. The kth score found there goes with it to all other shards,
where a traversal starts with it and gives back only what is no worse.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.llm.textops import give_back, lean
from vectorloom.session import materialize

SCALE = 1024
# Components of a shard: this many times the root of all components, so that shards grow in number and in size, up to a bound.
SHARD_FACTOR, SHARD_VALUES = 128, 1 << 24
# Components of a block of queries; vectors in a leaf; queries whose bounds are held at once.
BLOCK_VALUES, LEAF, _AT_ONCE = 1 << 18, 128, 256
_EXACT = 1 << 53
_HIT = "query_row long, query_id long, vec_row long, vec_id long, score long"
_HITS = pa.schema([(c, pa.int64()) for c in ("query_row", "query_id", "vec_row", "vec_id", "score")])


@dataclass(frozen=True)
class Tree:
    """Vectors in the order of the leaves; node i has the children 2i + 1 and 2i + 2."""

    vectors: np.ndarray
    rows: np.ndarray
    ids: np.ndarray
    # rows without an id, and rows that are queries
    unnamed: np.ndarray
    asks: np.ndarray
    low: np.ndarray
    high: np.ndarray
    # first vector of every leaf, and the end
    starts: np.ndarray

    @property
    def first_leaf(self) -> int:
        return len(self.starts) - 2


def _packed(**arrays: np.ndarray) -> bytes:
    sink = io.BytesIO()
    np.savez(sink, **arrays)
    return sink.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return {name: found[name] for name in found.files}


def _smallest(values: np.ndarray) -> np.ndarray:
    """Integer values in the narrowest type that holds them; doubles where none does."""
    most = float(np.abs(values).max(initial=0))
    kind = next((k for k in (np.int8, np.int16, np.int32) if most <= np.iinfo(k).max), np.float64)
    return values.astype(kind)


def scaled(column: pa.Array, dim: int) -> np.ndarray:
    """floor(1024 x) of every component, as doubles that hold integers."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).reshape(len(values), dim)


def build_tree(vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, asks: np.ndarray) -> Tree:
    """Median splits of the widest dimension; all leaves have the same depth and are alike in size."""
    n = len(vectors)
    order, cuts = np.arange(n), [0, n]
    while cuts[1] - cuts[0] > LEAF:
        finer = [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part, middle = order[a:b], (b - a) // 2
            if vectors.shape[1]:
                own = vectors[part]
                widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                order[a:b] = part[np.argpartition(own[:, widest], middle)]
            finer += [a + middle, b]
        cuts = finer
    vectors = vectors[order]
    lows = [np.minimum.reduceat(vectors, cuts[:-1], axis=0)]
    highs = [np.maximum.reduceat(vectors, cuts[:-1], axis=0)]
    while len(lows[0]) > 1:
        lows.insert(0, np.minimum(lows[0][::2], lows[0][1::2]))
        highs.insert(0, np.maximum(highs[0][::2], highs[0][1::2]))
    return Tree(
        vectors, rows[order], ids[order], unnamed[order], asks[order], np.concatenate(lows), np.concatenate(highs), np.array(cuts)
    )


def _whole(values: np.ndarray) -> np.ndarray:
    """Python integers, for products that doubles do not hold."""
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


class Searcher:
    """Best-first traversal of one tree."""

    def __init__(self, tree: Tree, k: int) -> None:
        self.tree, self.k = tree, k
        self.vectors, self.low, self.high = (x.astype(np.float64) for x in (tree.vectors, tree.low, tree.high))
        self.most = float(np.abs(self.vectors).max(initial=0))

    def _side(self, queries: np.ndarray) -> tuple[np.ndarray, ...]:
        products = self.most * float(np.abs(queries).max(initial=0)) * max(queries.shape[1], 1)
        if products < _EXACT:
            return queries, self.vectors, self.low, self.high
        return tuple(map(_whole, (queries, self.vectors, self.low, self.high)))

    def search(self, queries: np.ndarray, query_rows: np.ndarray, kth: list[int | None]) -> Iterator[tuple[int, np.ndarray, list[int]]]:
        """(query, places in the tree, scores) of the best k that are no worse than ``kth``."""
        queries, vectors, low, high = self._side(queries.astype(np.float64))
        for start in range(0, len(queries), _AT_ONCE):
            some = queries[start : start + _AT_ONCE]
            bounds = np.maximum(some, 0) @ high.T + np.minimum(some, 0) @ low.T
            for i in range(len(some)):
                at = start + i
                places, scores = self._one(some[i], bounds[i].tolist(), vectors, int(query_rows[at]), kth[at])
                yield at, places, [int(s) for s in scores]

    def _one(self, query: np.ndarray, bounds: list, vectors: np.ndarray, own: int, kth: int | None) -> tuple[np.ndarray, np.ndarray]:
        tree, first_leaf = self.tree, self.tree.first_leaf
        places, scores = np.zeros(0, np.int64), np.zeros(0, vectors.dtype)
        open_nodes = [(-bounds[0], 0)]
        while open_nodes:
            bound, node = heapq.heappop(open_nodes)
            # what equals the kth score may still come first by its id
            if kth is not None and -bound < kth:
                break
            if node < first_leaf:
                for child in (2 * node + 1, 2 * node + 2):
                    if kth is None or bounds[child] >= kth:
                        heapq.heappush(open_nodes, (-bounds[child], child))
                continue
            a, b = tree.starts[node - first_leaf], tree.starts[node - first_leaf + 1]
            found = vectors[a:b] @ query
            good = np.arange(b - a) if kth is None else np.flatnonzero(found >= kth)
            good = good[tree.rows[a + good] != own]
            if not len(good):
                continue
            places, scores = np.append(places, a + good), np.append(scores, found[good])
            if len(places) >= self.k:
                best = np.lexsort((tree.rows[places], tree.ids[places], tree.unnamed[places], -scores))[: self.k]
                places, scores = places[best], scores[best]
                kth = scores[-1]
        return places, scores


def index_shards(vectors: DataFrame, shards: int) -> DataFrame:
    """(shard, dim, tree): one tree for the vectors of a shard that have the same number of components."""

    def build(key: tuple, table: pa.Table) -> pa.Table:
        shard, dim = (k.as_py() for k in key)
        ids = table.column("vec_id")
        tree = build_tree(
            scaled(table.column("vector"), dim),
            table.column("vec_row").to_numpy(),
            ids.fill_null(0).to_numpy(),
            ids.is_null().to_numpy(),
            table.column("asks").to_numpy(),
        )
        fields = {name: getattr(tree, name) for name in Tree.__dataclass_fields__}
        fields |= {name: _smallest(fields[name]) for name in ("vectors", "low", "high")}
        data = pa.array([_packed(**fields)], pa.binary())
        return pa.table({"shard": pa.array([shard], pa.int64()), "dim": pa.array([dim], pa.int32()), "tree": data})

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_row"), F.lit(shards)).cast("long"))
    return dealt.groupBy("shard", "dim").applyInArrow(lean(build), "shard long, dim int, tree binary")


def _hits(tree: Tree, found: Iterator, query_rows: np.ndarray, query_ids: np.ndarray, unnamed: np.ndarray) -> pa.RecordBatch:
    rows, ids, vec_rows, vec_ids, absent, asked, scores = [], [], [], [], [], [], []
    for at, places, values in found:
        n = len(places)
        rows.append(np.full(n, query_rows[at]))
        ids.append(np.full(n, query_ids[at]))
        asked.append(np.full(n, unnamed[at]))
        vec_rows.append(tree.rows[places])
        vec_ids.append(tree.ids[places])
        absent.append(tree.unnamed[places])
        scores += values
    empty = np.zeros(0, np.int64)
    columns = [np.concatenate([empty, *x]).astype(np.int64) for x in (rows, ids, vec_rows, vec_ids)]
    asked, absent = (np.concatenate([empty, *x]).astype(bool) for x in (asked, absent))
    masks = [None, asked, None, absent]
    # a score that 64 bits do not hold fails here
    arrays = [pa.array(c, pa.int64(), mask=m) for c, m in zip(columns, masks)] + [pa.array(scores, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, schema=_HITS)


def home_hits(trees: DataFrame, k: int) -> DataFrame:
    """The best k of every query within its own shard."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("tree"):
                tree = Tree(**_unpacked(data.as_py()))
                asks = np.flatnonzero(tree.asks)
                for start in range(0, len(asks), 4096):
                    some = asks[start : start + 4096]
                    found = Searcher(tree, k).search(tree.vectors[some], tree.rows[some], [None] * len(some))
                    yield _hits(tree, found, tree.rows[some], tree.ids[some], tree.unnamed[some])
        give_back()

    return trees.select("tree").mapInArrow(search, _HIT)


def query_blocks(vectors: DataFrame, home: DataFrame, k: int, shards: int, values: int) -> DataFrame:
    """(block, dim, queries): queries with the kth score of their own shard, a bounded number in a block."""
    kth = home.groupBy("query_row").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    asked = vectors.filter("asks").withColumnRenamed("vec_row", "query_row")
    asked = asked.join(kth, "query_row", "left").withColumn("home", F.pmod(F.xxhash64("query_row"), F.lit(shards)).cast("long"))
    blocks = max(1, -(-values // BLOCK_VALUES))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        block, dim = (k.as_py() for k in key)
        found, ids = table.column("kth"), table.column("vec_id")
        data = _packed(
            vectors=_smallest(scaled(table.column("vector"), dim)),
            rows=table.column("query_row").to_numpy(),
            ids=ids.fill_null(0).to_numpy(),
            unnamed=ids.is_null().to_numpy(),
            home=table.column("home").to_numpy(),
            kth=found.fill_null(0).to_numpy(),
            open=found.is_null().to_numpy(),
        )
        return pa.table({"dim": pa.array([dim], pa.int32()), "queries": pa.array([data], pa.binary())})

    dealt = asked.withColumn("block", F.pmod(F.xxhash64("query_row", F.lit(1)), F.lit(blocks)))
    return dealt.groupBy("block", "dim").applyInArrow(lean(pack), "dim int, queries binary")


def other_hits(trees: DataFrame, blocks: DataFrame, k: int, shards: int) -> DataFrame:
    """What all other shards have that is no worse than the kth score a query brings."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, searcher = None, None
        for batch in batches:
            for shard, dim, tree, queries in zip(*(batch.column(c) for c in ("shard", "dim", "tree", "queries"))):
                if (key := (shard.as_py(), dim.as_py())) != last:
                    last, searcher = key, Searcher(Tree(**_unpacked(tree.as_py())), k)
                asked = _unpacked(queries.as_py())
                away = np.flatnonzero(asked["home"] != key[0])
                asked = {name: x[away] for name, x in asked.items()}
                kth = [None if missing else value for value, missing in zip(asked["kth"].tolist(), asked["open"])]
                found = searcher.search(asked["vectors"], asked["rows"], kth)
                yield _hits(searcher.tree, found, asked["rows"], asked["ids"], asked["unnamed"])
        give_back()

    numbers = F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))
    everywhere = blocks.select(F.explode(numbers).alias("shard"), "dim", "queries")
    pairs = trees.join(everywhere, ["shard", "dim"]).select("shard", "dim", "tree", "queries")
    return pairs.mapInArrow(search, _HIT)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query with all other rows.

    Components count as floor(1024 x); scores are exact integers, ties go to the smaller key. ``is_query`` is a
    condition on the columns of ``vectors``. A vector that is null, or has a null or non-finite component, takes no
    part. Vectors are compared with those of as many components; those without any score 0. A null key comes
    last among ties. Rows that share a key are rows of their own: each is a query of its own, left out of its own
    answers only, and ties between them are settled by their place in the table. Fewer than k other rows give as
    many answers, none no row. Extra columns are left out; an empty table gives no rows. A score that does not
    fit 64 bits is an error.

    Every pair of a shard and a block of queries meets in one task, which holds just these two. Scores of shards
    other than the query's own come back only if they are no worse than its kth score there.
    """
    spark = vectors.sparkSession
    chosen = vectors.select(
        F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    proper = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    chosen = chosen.filter(F.col("vector").isNotNull() & proper).withColumn("dim", F.size("vector"))
    chosen = materialize(chosen.withColumn("vec_row", F.monotonically_increasing_id()), "search-vectors")
    total = chosen.agg(
        F.sum("dim").alias("all"), F.sum(F.when(F.col("asks"), F.col("dim"))).alias("asked"), F.count("*").alias("rows")
    ).first()
    values = max(total["all"] or 0, total["rows"])
    shards = max(1, -(-values // min(SHARD_VALUES, SHARD_FACTOR * isqrt(values) + 1)))

    trees = materialize(index_shards(chosen, shards), "search-trees")
    home = materialize(home_hits(trees, k), "search-home")
    blocks = materialize(query_blocks(chosen, home, k, shards, total["asked"] or 0), "search-queries")
    hits = home.union(other_hits(trees, blocks, k, shards)) if shards > 1 else home
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
