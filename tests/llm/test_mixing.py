import math

import pytest

from vectorloom.llm import mixing as m


def filled(sizes, weights, copies=3):
    """Targets by giving out the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped = {s: 0.0 for s in sizes}, set()
    rest = float(sum(sizes.values()))
    while rest > 1e-9 and len(capped) < len(sizes):
        share = sum(weight[s] for s in sizes if s not in capped)
        for s in sizes:
            if s not in capped:
                target[s] += rest * weight[s] / share
        rest = 0.0
        for s in sizes:
            if target[s] > copies * sizes[s]:
                rest += target[s] - copies * sizes[s]
                target[s] = copies * sizes[s]
                capped.add(s)
    return target


@pytest.fixture
def rows(spark):
    plan = {"a": (900, 3), "b": (5, 40), "c": (50, 11), None: (7, 9), "Z": (300, 2), "ä": (4, 0)}
    data, key = [], 0
    for source, (n, size) in plan.items():
        for i in range(n):
            data.append((key, source, size + i % 4 if size else 0))
            key += 1
    return spark.createDataFrame(data, "doc_id long, source string, size long")


def test_targets_and_taken(rows):
    data = m.pareto_mix(rows, "doc_id", "source", "size").collect()
    sizes = {}
    for r in data:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = filled(sizes, (5, 2, 1))
    taken, largest = {}, {}
    for r in data:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6)
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r["size"])
    assert len(data) == rows.count()
    for source, total in taken.items():
        assert abs(total - want[source]) <= largest[source]


def test_a_huge_document_does_not_end_the_drawing(spark):
    """Sources with one document larger than what is wanted, wherever the order has it."""
    data = [(i, s, 100 + i % 57) for s, at in (("a", 0), ("b", 1000), ("c", 2000)) for i in range(at, at + 1000)]
    data += [(5000 + i, s, 50_000) for i, s in enumerate("abc")]
    docs = spark.createDataFrame(data, "doc_id long, source string, size long")
    for seed in range(2):
        got = m.pareto_mix(docs, "doc_id", "source", "size", weights=(1, 1.2, 4), seed=seed)
        for r in got.groupBy("source").agg({"taken": "sum", "target": "max"}).collect():
            assert abs(r["sum(taken)"] - r["max(target)"]) <= 156, (seed, r)


def test_copies_are_whole_part_or_one_more(rows):
    for r in m.pareto_mix(rows, "doc_id", "source", "size").collect():
        whole = math.floor(r.target / r.source_size) if r.source_size else 0
        assert r.copies in (whole, whole + 1)


def test_reruns_and_partitioning_agree(rows):
    one = {tuple(r) for r in m.pareto_mix(rows, "doc_id", "source", "size").collect()}
    other = {tuple(r) for r in m.pareto_mix(rows.repartition(7, "size"), "doc_id", "source", "size").collect()}
    assert one == other


def test_many_windows_per_source(rows, monkeypatch):
    one = {tuple(r) for r in m.pareto_mix(rows, "doc_id", "source", "size").collect()}
    monkeypatch.setattr(m, "ROWS_PER_WINDOW", 10)
    assert one == {tuple(r) for r in m.pareto_mix(rows, "doc_id", "source", "size").collect()}


def test_chances_follow_the_fraction(spark):
    """Over many seeds a row of a source at half its size is taken about half the time."""
    docs = spark.createDataFrame([(i, s, 10) for i in range(40) for s in "ab"], "doc_id long, source string, size long")
    docs = docs.selectExpr("doc_id * 2 + int(source = 'b') AS doc_id", "source", "size")
    hits = {}
    for seed in range(6):
        for r in m.pareto_mix(docs, "doc_id", "source", "size", weights=(1, 3), seed=seed).collect():
            hits.setdefault(r.source, []).append(r.copies)
    assert abs(sum(hits["a"]) / len(hits["a"]) - 0.5) < 0.05 and abs(sum(hits["b"]) / len(hits["b"]) - 1.5) < 0.05


def test_awkward_rows(awkward):
    docs = awkward.drop("size").select("*", m.word_count(awkward.text).alias("size"))
    data = m.pareto_mix(docs, "doc_id", "source", "size").collect()
    assert len(data) == 13 and {r.taken for r in data if r["size"] == 0} == {0}
    assert {"key", "bucket", "node"} <= set(data[0].asDict())
    with pytest.raises(ValueError):
        m.pareto_mix(docs.withColumn("taken", docs["size"]), "doc_id", "source", "size")


def test_empty_table_and_no_words(make_docs):
    rows = make_docs((1, ""), (2, None))
    sized = rows.select("doc_id", "source", m.word_count(rows.text).alias("size"))
    assert [r.taken for r in m.pareto_mix(sized, "doc_id", "source", "size").collect()] == [0, 0]
    assert m.pareto_mix(sized.filter("doc_id < 0"), "doc_id", "source", "size").collect() == []


def test_no_python_in_the_plan(rows):
    plan = m.pareto_mix(rows, "doc_id", "source", "size")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def chances(sizes, wanted, power=m.POWER):
    """min(1, rate * size ^ power) for the rate that makes the expected words those wanted."""
    low, high = 0.0, 1e6
    for _ in range(200):
        rate = (low + high) / 2
        low, high = (rate, high) if sum(min(1.0, rate * s**power) * s for s in sizes) < wanted else (low, rate)
    return {s: min(1.0, low * s**power) for s in set(sizes)}


def test_inclusion_follows_unequal_chances(spark):
    """A hundred sources of one make-up at half their size, and a hundred at one and a half."""
    sizes = [20, 45, 80, 150, 400] * 12 + [700]
    data = [(i * 1000 + k, f"{i:03}", s) for i in range(200) for k, s in enumerate(sizes)]
    docs = spark.createDataFrame(data, "doc_id long, source string, size long")
    want, hits = chances(sizes, sum(sizes) / 2), {}
    assert want[20] < 0.3 * want[400] < 0.3
    for r in m.pareto_mix(docs, "doc_id", "source", "size", weights=(1, 3)).collect():
        assert math.isclose(r.target, sum(sizes) * (0.5 if int(r.source) % 2 == 0 else 1.5))
        hits.setdefault((int(r.source) % 2, r["size"]), []).append(r.copies)
    for (odd, s), copies in hits.items():
        assert abs(sum(copies) / len(copies) - odd - want[s]) < 0.06, (odd, s, want[s])


def test_sample_size_is_fixed_before_words_are_met(spark):
    """Rows of one size need no correction: every source has exactly the rounded sum of its chances."""
    data = [(i, f"{i % 40:02}", 10) for i in range(40 * 25)]
    docs = spark.createDataFrame(data, "doc_id long, source string, size long")
    taken = {}
    for r in m.pareto_mix(docs, "doc_id", "source", "size", weights=(2, 6)).collect():
        taken[r.source] = taken.get(r.source, 0) + r.copies
    assert {taken[s] for s in taken if int(s) % 2 == 0} <= {12, 13} and {taken[s] for s in taken if int(s) % 2} <= {37, 38}


def test_a_third_of_all_rows_under_one_key(spark):
    """Rows without a key are drawn at random like any others, and so are equal rows."""
    data = [(None, "a", 1 + i % 900) for i in range(1500)] + [(None, "b", 10)] * 400 + [(i, "b", 10) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, source string, size long")
    got = m.pareto_mix(docs, "doc_id", "source", "size", weights=(1, 80)).collect()
    large = [r.copies for r in got if r.source == "a" and r["size"] > 600]
    small = [r.copies for r in got if r.source == "a" and r["size"] <= 300]
    assert 0 < sum(small) < len(small) and 0 < sum(large) and sum(large) / len(large) > sum(small) / len(small)
    equal = [r.copies for r in got if r.source == "b" and r.doc_id is None]
    others = [r.copies for r in got if r.source == "b" and r.doc_id is not None]
    assert abs(sum(equal) / len(equal) - sum(others) / len(others)) < 0.15
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 900


def test_a_hot_source_is_spread(spark, monkeypatch):
    """Two thirds of all rows in one source: its rows are ranked in many parts."""
    data = [(i, "hot" if i % 3 else f"s{i % 7}", 1 + i % 50) for i in range(6000)]
    docs = spark.createDataFrame(data, "doc_id long, source string, size long").repartition(6)
    parts, materialize = [], m.materialize

    def spy(df, label):
        table = materialize(df, label)
        if label == "mix-parts":
            parts.extend(r["count"] for r in table.groupBy("__part").count().collect())
        return table

    monkeypatch.setattr(m, "materialize", spy)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert len(m.pareto_mix(docs, "doc_id", "source", "size").collect()) == 6000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(parts) < 6000 / 4
