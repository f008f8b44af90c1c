import random
from glob import glob
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from vectorloom.operators.lookup import broadcast_limit, lookup_join, measure
from vectorloom.operators.numbering import last_part, number_rows, order_value
from vectorloom.session import materialize, scratch, scratch_path, shared_dir


@pytest.mark.parametrize("n, partitions", [(0, 1), (1, 3), (5000, 1), (5000, 16)])
def test_dense_numbers_in_order(spark, n, partitions):
    df = spark.range(n).select(((F.col("id") * 7919) % 10007).alias("k")).repartition(partitions)
    numbered = number_rows(df, ["k"])
    assert numbered.total == n
    rows = sorted((r["k"], r["pos"]) for r in numbered.rows.collect())
    assert [p for _, p in rows] == list(range(n))


def test_numbers_across_several_sorted_partitions(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        numbered = number_rows(spark.range(3000).withColumn("k", -F.col("id")), ["k"])
    finally:
        spark.conf.set(key, "true")
    assert numbered.rows.filter("pos <> 2999 - id").count() == 0
    assert len(numbered.rows.inputFiles()) > 1


def test_hot_group_does_not_break_numbering(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("g"), "id")
    rows = number_rows(df, ["g", "id"]).rows.orderBy("pos").collect()
    assert [(r["g"], r["id"]) for r in rows] == sorted((0 if i < 2000 else i, i) for i in range(3000))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_lookup_join_matches_plain_join(spark, how, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    k = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
    facts = spark.range(4000).select("id", k.cast("bigint").alias("k"))
    lookup = spark.range(0, 400, 2).union(spark.range(7, 8)).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got, plain = lookup_join(facts, lookup, "k", how), facts.join(lookup, "k", how)
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_hot_rows_are_not_shuffled(spark, no_broadcast):
    """Rows of the hot key meet their lookup row in a broadcast join; the others are shuffled."""
    facts = spark.range(1000).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("k"), "id")
    plan = lookup_join(facts, spark.range(1000).select(F.col("id").alias("k")), "k")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def test_measure_counts_text(spark):
    small, large = (spark.range(10).select(F.repeat(F.lit("x"), n).alias("s")) for n in (1, 1000))
    assert measure(small).rows == measure(large).rows == 10
    assert measure(large).bytes - measure(small).bytes == 9990


def test_broadcast_limit_units(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        for text, expected in (("-1", -1), ("100", 100), ("2k", 2048), ("10MB", 10 << 20), ("1g", 1 << 30)):
            spark.conf.set(key, text)
            assert broadcast_limit(spark) == expected
    finally:
        spark.conf.set(key, before)


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake_session(master, **conf):
    conf = {k.replace("_", "."): v for k, v in conf.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=FakeContext(master))


def test_shared_dir_follows_the_session():
    named = fake_session("spark://x", spark_checkpoint_dir="hdfs:///shared")
    assert shared_dir(named) == "hdfs:///shared"
    assert scratch_path(named, "t").startswith("hdfs:///shared/vectorloom/t-")
    assert scratch_path(named, "t") != scratch_path(named, "t")


def test_unset_shared_dir():
    local = fake_session("local[2]")
    assert shared_dir(local) == shared_dir(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake_session("spark://x"))


def test_scratch_is_empty_after_use(spark, tmp_path):
    before = set(glob(f"{shared_dir(spark).removeprefix('file:')}/vectorloom/*"))
    with scratch(spark):
        numbered = number_rows(spark.range(100), ["id"])
        kept = materialize(numbered.rows, "kept")
        assert kept.count() == 100 and set(glob(f"{shared_dir(spark).removeprefix('file:')}/vectorloom/*")) > before
    assert set(glob(f"{shared_dir(spark).removeprefix('file:')}/vectorloom/*")) == before


@pytest.mark.parametrize("kinds", ["a long, b int", "a int, b int, c int", "a long, b long", "a string, b int", "a int, b long"])
def test_order_value_sorts_like_its_columns(spark, kinds):
    names = [k.split()[0] for k in kinds.split(", ")]
    tops = {"long": (1 << 63) - 1, "int": (1 << 31) - 1}
    rng = random.Random(kinds)
    values = {
        "long": [-tops["long"] - 1, tops["long"], 0, -1, 5], "int": [-tops["int"] - 1, tops["int"], 0, -1, 7], "string": ["a", "", "b"],
    }
    rows = sorted({tuple(rng.choice(values[k.split()[1]]) for k in kinds.split(", ")) for _ in range(60)})
    df = spark.createDataFrame(rows, kinds)
    got = df.select(*names, order_value(df, names).alias("o")).orderBy("o").collect()
    assert [tuple(r)[:-1] for r in got] == rows
    back = df.select(names[-1], last_part(df, names, order_value(df, names)).alias("l")).filter(f"l <> {names[-1]}")
    assert back.count() == 0
