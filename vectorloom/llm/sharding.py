"""Contiguous shards of equal byte size from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.session import materialize

SHARDS = 16


def byte_size(text: Column) -> Column:
    """UTF-8 bytes plus one separator; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def assign_shards(docs: DataFrame, order_by: list[str], size: str, n_shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``: contiguous in ``order_by``, byte sizes near equal.

    Rows are range-partitioned by ``order_by`` and written; only row count and byte total of each
    partition are gathered, and their running sums turn sums inside a partition into global ones. With
    the total cut at n equal targets, a row goes to the shard that holds its middle byte, so a shard
    is off its target by at most one row. ``slot`` numbers a shard's rows from 0 without gaps.

    Rows equal in ``order_by`` are ordered by size, then by a hash of all columns, so reruns agree; equal rows are
    interchangeable and may lie in several partitions. Null keys come first. A null size counts as 0. Empty input gives no rows; with fewer rows than shards some shards
    stay empty. Columns of ``docs`` named shard or slot are an error; others pass through.
    """
    clash = {"shard", "slot"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} would be overwritten")
    order = [*order_by, size, "__hash", "__id"]
    docs = docs.withColumn(size, F.coalesce(F.col(size), F.lit(0)).cast("long"))
    names = docs.columns
    docs = docs.withColumn("__hash", F.xxhash64(*names)).withColumn("__id", F.monotonically_increasing_id())
    docs = materialize(docs, "shard-sizes")
    placed = materialize(docs.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "shard-ranges")

    totals = placed.groupBy("__part").agg(F.count("*").alias("__n"), F.sum(size).alias("__bytes"))
    running = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    starts = totals.select(
        "__part",
        (F.sum("__n").over(running) - F.col("__n")).alias("__row_start"),
        (F.sum("__bytes").over(running) - F.col("__bytes")).alias("__byte_start"),
        F.sum("__bytes").over(Window.partitionBy()).alias("__total"),
    )
    within = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    middle = 2 * F.col("__before") + F.col(size)
    shard = F.least(F.lit(n_shards - 1), F.expr(f"__middle * {n_shards} div greatest(2 * __total, 1)"))
    numbered = (
        placed.withColumn("__row", F.row_number().over(within) - 1)
        .withColumn("__before", F.sum(size).over(within) - F.col(size))
        .join(F.broadcast(starts), "__part")
        .withColumn("__row", F.col("__row") + F.col("__row_start"))
        .withColumn("__before", F.col("__before") + F.col("__byte_start"))
        .withColumn("__middle", middle)
        .withColumn("shard", shard.cast("int"))
    )
    numbered = materialize(numbered, "shard-rows")
    first = numbered.groupBy("shard").agg(F.min("__row").alias("__first"))
    return (
        numbered.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("__row") - F.col("__first"))
        .select(*names, "shard", "slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard."""
    sharded.write.partitionBy("shard").parquet(path)
