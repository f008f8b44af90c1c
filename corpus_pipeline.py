"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again for the next.

Every stage takes rows with the columns of ``documents`` and works on all of them; all but the last give
such rows back. A stage's result has to be written before the next stage begins, which deletes the tables behind it. Rows without a doc_id, and rows that share one, are rows like any other. Joins of decisions to documents are merge joins at every
size, so that what a stage moves stays in proportion to its input.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.llm.mixing import pareto_mix, word_count
from vectorloom.llm.ngram_join import Rule, ngram_jaccard_join
from vectorloom.llm.packing import pack_documents
from vectorloom.llm.quality_classifier import keep_good, train_classifier
from vectorloom.llm.suffix_dedup import remove_repeats
from vectorloom.llm.textops import small_batches
from vectorloom.operators.lookup import lookup_join
from vectorloom.session import delete_path, materialize, noted_scratch, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Near copies: word 5-grams, Jaccard similarity of at least 0.8.
NEAR_COPIES = Rule(n=5, percent=80)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Tables that the stage before wrote on its way to its result.
_LEFT: list[str] = []


def stage(function: Stage) -> Stage:
    """A stage that begins by deleting what the one before wrote on its way: its result has been written and read again."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _LEFT:
            delete_path(spark, path)
        _LEFT.clear()
        with noted_scratch() as paths:
            try:
                return function(spark, docs, sf_dir)
            finally:
                _LEFT.extend(paths)

    return run_stage


@stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on these documents, calls good."""
    small_batches(spark)
    docs = docs.select(COLUMNS)
    _, scorer = train_classifier(docs)
    return keep_good(docs, scorer)


@stage
def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked rows the first by doc_id (null last) and a hash of the row.

    Rows are judged by their text alone: each gets a number, and the join works on the numbers. No text is sorted.
    """
    small_batches(spark)
    rows = docs.select(COLUMNS).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows.withColumn("row_hash", F.xxhash64(*COLUMNS)), "pipeline-rows")
    joined = ngram_jaccard_join(rows, key="row", rule=NEAR_COPIES, count_links=False)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_hash", "row")
    placed = joined.select("row", "component_id").join(rows.select("row", place.alias("place")), "row")
    placed = materialize(placed, "pipeline-places")
    groups = placed.groupBy("component_id").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    kept = groups.select(F.col("first.row").alias("row"))
    members = lookup_join(placed.select("row", "component_id"), groups.select("component_id"), "component_id", how="left_semi")
    copies = materialize(members.join(kept, "row", "left_anti").select("row"), "pipeline-copies-of-rows")
    return rows.join(copies.hint("merge"), "row", "left_anti").select(COLUMNS)


@stage
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 100 bytes that start earlier; an emptied document stays, empty."""
    small_batches(spark)
    rows = docs.select(COLUMNS).withColumn("absent", F.col("text").isNull())
    kept = remove_repeats(rows, carry=("lang", "source", "n_chars", "absent"), as_text=True)
    changed = F.col("n_removed") > 0
    return kept.select(
        "doc_id",
        F.when(~F.col("absent"), F.col("kept")).alias("text"),
        "lang",
        "source",
        F.when(changed, F.char_length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their weights: every document as often as the mix takes it."""
    # rows that share a doc_id are rows of their own, and so are equal rows
    rows = materialize(docs.select(COLUMNS).withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")
    sizes = rows.select("row", F.xxhash64(*COLUMNS).alias("row_key"), "source", word_count(F.col("text")).alias("size"))
    mixed = pareto_mix(sizes, "row", "source", "size", drawn_from=("row_key", "source", "size"))
    copies = materialize(mixed.filter("copies > 0").select("row", "copies"), "pipeline-copies")
    repeated = rows.join(copies.hint("merge"), "row")
    return repeated.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(COLUMNS)


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; ids as a checksum, as the texts are in the stage before."""
    small_batches(spark)
    return pack_documents(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_join", ngram_join),
    ("suffix_dedup", suffix_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# The stages hash, train and tokenize: SQL has no equivalent. tests/llm compares them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = materialize(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
