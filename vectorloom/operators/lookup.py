"""Joins of a large table to a lookup table with a unique key."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorloom.session import materialize

# Hot keys are told apart up to this many; a key that is not among them has a smaller share than 1/MAX_HOT_KEYS.
MAX_HOT_KEYS = 2_000
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def broadcast_limit(spark: SparkSession) -> int:
    """Spark's own broadcast threshold in bytes; negative means never."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", text).groups()
    return int(number) * _UNITS[unit]


def row_bytes(schema: T.StructType):
    """Expression for the approximate size of one row in memory."""
    width = F.lit(16 * len(schema.fields)).cast("bigint")
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return width


def measure(df: DataFrame) -> Size:
    """Row count and approximate bytes of ``df``, by one aggregate job."""
    row = df.agg(F.count("*").alias("n"), F.sum(row_bytes(df.schema)).alias("b")).first()
    return Size(row["n"], row["b"] or 0)


def fits_broadcast(spark: SparkSession, size: Size) -> bool:
    return size.bytes <= broadcast_limit(spark)


def hot_share(spark: SparkSession) -> float:
    """The share of the rows from which a key is hot: a quarter of an even shuffle partition.

    With very many partitions the number of hot keys is what limits it (``MAX_HOT_KEYS``).
    """
    return max(1 / MAX_HOT_KEYS, 0.25 / int(spark.conf.get("spark.sql.shuffle.partitions")))


def frequent_keys(facts: DataFrame, key: str) -> list:
    """At most 1/share keys, among them every key above the hot share of the rows."""
    return facts.select(key).stat.freqItems([key], hot_share(facts.sparkSession)).first()[0]


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    size: Size | None = None,
    costly: bool = False,
    may_broadcast: bool = True,
) -> DataFrame:
    """Join ``facts`` to ``lookup``, whose ``key`` values are unique.

    ``how`` is left, inner, left_semi or left_anti. A lookup whose measured size is
    within Spark's broadcast threshold is broadcast, if ``may_broadcast``. A larger one is shuffled, except
    for the hot keys of ``facts``, whether the lookup has them or not: at most 1/share of them can exist
    (``hot_share``), so their lookup rows are always small, and the many fact rows that carry them are joined where
    they are. That route reads ``facts`` once for each part, and once more to find the hot keys;
    ``costly`` facts are written first. A stream is joined by a plain shuffle: its hot keys are not known.
    """
    spark = facts.sparkSession
    if may_broadcast and fits_broadcast(spark, size or measure(lookup)):
        return facts.join(F.broadcast(lookup), key, how)
    if facts.isStreaming:
        return facts.join(lookup, key, how)

    if costly:
        facts = materialize(facts, "facts")
    hot_keys = [k for k in frequent_keys(facts, key) if k is not None]
    on_hot = F.col(key).isNull() | F.col(key).isin(hot_keys)
    hot = facts.filter(on_hot).join(F.broadcast(lookup.filter(F.col(key).isin(hot_keys))), key, how)
    cold = facts.filter(~on_hot).join(lookup, key, how)
    return hot.unionByName(cold)
