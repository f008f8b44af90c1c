import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectorloom.llm import kd_search
from vectorloom.llm.kd_search import Searcher, build_tree, top_k

SHAPE = "vec_id long, embedding array<double>, label int"


def brute(rows, k=10):
    """Every pair in plain Python; rows are (vec_id, vector)."""
    proper = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in proper]
    out = []
    for n, (q, a) in enumerate(whole):
        if q is None or q % 100:
            continue
        found = [(-sum(x * y for x, y in zip(a, b)), i is None, i or 0, m, i) for m, (i, b) in enumerate(whole) if m != n and len(a) == len(b)]
        out += [(q, r + 1, f[4], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def run(spark, rows, k=10, schema=SHAPE):
    df = spark.createDataFrame([(*r, 1) for r in rows], schema)
    return sorted(map(tuple, top_k(df, F.expr("vec_id % 100 = 0"), k).collect()), key=str)


@pytest.fixture
def many_shards(monkeypatch):
    monkeypatch.setattr(kd_search, "SHARD_FACTOR", 8)
    monkeypatch.setattr(kd_search, "BLOCK_VALUES", 40)


def test_equals_brute_force(spark, many_shards):
    random = np.random.default_rng(3)
    rows = [(i, (random.normal(size=6) * 0.2).tolist()) for i in range(900)]
    assert run(spark, rows) == brute(rows)


def test_ties_and_hot_copies(spark, many_shards):
    # a third of all rows has one vector, and few distinct values make many ties
    random = np.random.default_rng(4)
    rows = [(i, [0.5, 0.25, 0.0] if i % 3 == 0 else random.choice([-0.5, 0.0, 0.5], 3).tolist()) for i in range(600)]
    assert run(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, -1.0]), (100, [0.5, 0.5]), (200, None), (300, [float("nan"), 1.0]), (400, [float("inf"), 1.0]),
        (500, [None, 1.0]), (600, []), (700, []), (1, []), (800, [1.0, 2.0, 3.0]), (None, [2.0, 2.0]), (None, [2.0, 2.0]),
        (-100, [0.0005, -0.0005]), (100, [0.5, 0.5]), (100, [3.0, 0.5]), (7, [-0.0001, 0.0]),
    ]
    assert run(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    rows = [(i, [1e6 + i, -1e6 + 3 * i, 0.001 * i]) for i in range(0, 300, 50)]
    assert run(spark, rows) == brute(rows)


def test_score_beyond_64_bits_fails(spark):
    with pytest.raises(Exception, match="too large|OverflowError|overflow"):
        run(spark, [(0, [1e30]), (1, [1e30])])


def test_empty_table_and_clashing_names(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    df = df.selectExpr("*", "1 AS shard", "2 AS rank", "3 AS vec_row", "4 AS vector", "5 AS asks")
    assert [tuple(r) for r in top_k(df, F.expr("vec_id % 100 = 0")).collect()] == [(0, 1, 1, 1024 * 2048)]


def test_fewer_rows_than_k(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-1.0])]
    assert run(spark, rows) == [(0, 1, 1, 2097152), (0, 2, 2, -1048576)]


def test_boxes_are_tight_and_prune():
    random = np.random.default_rng(5)
    vectors = np.floor(random.normal(size=(2_000, 3)) * 1000)
    n = len(vectors)
    tree = build_tree(vectors, np.arange(n), np.arange(n), np.zeros(n, bool), np.zeros(n, bool))
    leaves = len(tree.starts) - 1
    for leaf in range(leaves):
        own = tree.vectors[tree.starts[leaf] : tree.starts[leaf + 1]]
        assert (tree.low[tree.first_leaf + leaf] == own.min(axis=0)).all()
        assert (tree.high[tree.first_leaf + leaf] == own.max(axis=0)).all()
        assert len(own) <= kd_search.LEAF
    assert (tree.low[0] == vectors.min(axis=0)).all() and (tree.high[0] == vectors.max(axis=0)).all()

    seen = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                seen.append(key)
            return super().__getitem__(key)

    searcher = Searcher(tree, 5)
    searcher.vectors = searcher.vectors.view(Counting)
    query = vectors[:1]
    ((_, places, scores),) = searcher.search(query, np.array([-1]), [None])
    best = np.sort(vectors @ query[0])[::-1][:5]
    assert scores == best.astype(int).tolist() and len(places) == 5
    assert len(seen) < leaves / 2
    # a kth score from elsewhere leaves less to visit, and only what is no worse comes back
    first = len(seen)
    ((_, _, scores),) = searcher.search(query, np.array([-1]), [int(best[0])])
    assert scores == [int(best[0])] and len(seen) - first <= first
