"""Alias tables hold the probabilities they were made from."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vectorloom.operators import alias as al


def distributions():
    rng = random.Random(5)
    out = {}
    for key in range(60):
        weights = [rng.choice([0, 1e-6, 1, 1, 3, rng.random(), 50 * rng.random()]) for _ in range(rng.randint(1, 30))]
        if sum(weights):
            out[key] = {3 * i: w / sum(weights) for i, w in enumerate(weights)}
    out[100] = {i: 0.25 for i in range(4)}
    out[101] = {7: 1.0}
    out[102] = {0: 0.5, 1: 0.25, 2: 0.25}
    return out


def frame(spark, given):
    return spark.createDataFrame([(k, c, float(p)) for k, ps in given.items() for c, p in ps.items()], "key long, class int, p double")


@pytest.fixture(scope="module")
def tables(spark):
    return {r["key"]: r for r in al.alias_tables(frame(spark, distributions()), "key", "class", "p").collect()}


def test_masses_are_those_given(spark):
    given = distributions()
    masses = al.table_masses(al.alias_tables(frame(spark, given), "key", "class", "p"), "key", "class").collect()
    got = {(r["key"], r["class"]): r["p"] for r in masses}
    want = {(k, c): p for k, ps in given.items() for c, p in ps.items() if p > 1e-11}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-10 for k in want)


def test_every_slot_is_full_and_has_one_alias(tables):
    for t in tables.values():
        assert len(t["classes"]) == len(t["cuts"]) == len(t["aliases"]) == t["slots"]
        assert all(0 < cut <= t["total"] for cut in t["cuts"])
        assert all(cut == t["total"] or alias != own for own, cut, alias in zip(t["classes"], t["cuts"], t["aliases"]))


def test_draws_follow_the_distribution(spark):
    given = {1: {0: 0.7, 4: 0.2, 5: 0.1}, 2: {9: 1.0}}
    draws = spark.range(60_000).select((F.col("id") % 3).alias("key"), ((F.col("id") * 7919 % 60_000) / 60_000.0).alias("u"))
    tables = al.alias_tables(frame(spark, given), "key", "class", "p")
    got = Counter((r["key"], r["sampled"]) for r in al.draw_classes(draws, "key", "u", tables).collect())
    assert got[0, None] == 20_000 and got[2, 9] == 20_000
    assert all(abs(got[1, c] / 20_000 - p) < 0.01 for c, p in given[1].items())


def test_each_distribution_is_read_once(spark, no_broadcast):
    """A million draws: the plan of the draws has the tables as they are, a row per distribution."""
    draws = spark.range(1_000_000).select((F.col("id") % 2).alias("key"), (F.col("id") / 1e6).alias("u"))
    tables = al.alias_tables(frame(spark, {0: {0: 0.5, 1: 0.5}, 1: {3: 1.0}}), "key", "class", "p")
    assert tables.count() == 2
    drawn = al.draw_classes(draws, "key", "u", tables)
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan
    assert drawn.filter("sampled IS NULL").count() == 0 and drawn.count() == 1_000_000


def test_nothing_to_draw_from(spark):
    empty = al.alias_tables(frame(spark, {5: {0: 0.0}}), "key", "class", "p")
    assert empty.collect() == []
