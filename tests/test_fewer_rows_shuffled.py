"""Joins that move fewer rows: a Bloom filter before the shuffle, and tables that lie in buckets."""

import pytest
from pyspark.sql import functions as F

from vectorloom.operators import bloom
from vectorloom.operators.dictionary import with_known_style
from vectorloom.sources.bucketed import join_bucketed, save_for_joins

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def small_broadcasts(spark):
    """The filter of 4,000 keys may be broadcast, the keys may not."""
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "40000")
    yield
    spark.conf.set(THRESHOLD, before)


def tables(spark):
    styles = spark.range(4_000).select((F.col("id") * 10).alias("item_id"), (F.col("id") % 7).alias("style_index"))
    reviews = spark.range(60_000).select(F.when(F.col("id") % 11 > 0, F.col("id")).alias("item"), F.lit("text").alias("text"))
    return reviews, styles


def test_rows_without_a_partner_are_dropped_early(spark, small_broadcasts):
    reviews, styles = tables(spark)
    known = styles.withColumnRenamed("item_id", "item")
    passing = bloom.keep_possible(reviews, known.select("item"), "item")
    wanted = reviews.join(known, "item", "left_semi").count()
    # rows that reach the exchange of the join, of 60,000
    assert wanted <= passing.count() <= wanted + 300
    assert reviews.join(known, "item", "left_semi").exceptAll(passing).count() == 0
    assert passing.columns == reviews.columns


def test_same_result_as_without_it(spark, small_broadcasts):
    reviews, styles = tables(spark)
    got = with_known_style(reviews, "item", "text", styles)
    want = reviews.join(styles.withColumnRenamed("item_id", "item"), "item")
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == want.count()
    assert "__word_0" in got._jdf.queryExecution().toString()


def test_nothing_is_done_where_it_does_not_help(spark, no_broadcast):
    reviews, styles = tables(spark)
    assert bloom.keep_possible(reviews, styles.select(F.col("item_id").alias("item")), "item") is reviews


def test_no_key_escapes_the_filter(spark):
    keys = spark.range(0, 3_000, 3).select("id")
    blocks = bloom.bloom_filter(keys, "id", 50)
    assert blocks.count() == 50
    block, bits = bloom._place("id", 50)
    probed = keys.withColumn("__block", block).join(blocks, "__block")
    assert probed.filter(" AND ".join("true" for _ in bits)).count() == 1_000
    for i, bit in enumerate(bits):
        assert probed.filter(F.col(f"__word_{i}").bitwiseAND(bit) == 0).count() == 0
    assert bloom.bloom_filter(keys.limit(0), "id", 50).count() == 0


def test_bucketed_tables_are_joined_where_they_lie(spark, no_broadcast):
    reviews = spark.range(500).select((F.col("id") % 90).alias("item"), F.col("id").alias("review"))
    styles = spark.range(0, 90, 2).select(F.col("id").alias("item"), (F.col("id") % 5).alias("style_index"), F.lit("Gose").alias("style"))
    left, right = (save_for_joins(df, "item", label, 8) for df, label in ((reviews, "bucketed_reviews"), (styles, "bucketed_styles")))
    joined = join_bucketed(left, right, "item")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    got = {(r["item"], r["review"]): (r["style_index"], r["style"]) for r in joined.collect()}
    assert got == {(i % 90, i): ((i % 90 % 5, "Gose") if i % 90 % 2 == 0 else (-1, None)) for i in range(500)}
