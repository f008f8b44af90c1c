"""A blocked Bloom filter as a table: rows that cannot have a partner are dropped before they are shuffled.

A key's hash picks a block and one bit in each of its four words, so a probe reads a single block. Blocks are made by a
bitwise aggregate over the keys and are a fraction of the keys' own size: they can be broadcast where the keys cannot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.operators.lookup import broadcast_limit, fits_broadcast, measure
from vectorloom.session import materialize

# Words of a block, and keys that a block should hold: 16 bits a key, of which it sets four.
WORDS, KEYS_PER_BLOCK = 4, 16
# What a row of the filter takes where it is broadcast.
_ROW_BYTES = 8 * (WORDS + 1) + 56
_NAMES = [f"__word_{i}" for i in range(WORDS)]


def _place(key: str, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key, and its bit in each word."""
    block = F.pmod(F.xxhash64(F.col(key)), F.lit(blocks))
    bits = F.xxhash64(F.col(key), F.lit(7))
    return block, [F.call_function("shiftleft", F.lit(1).cast("long"), _six_bits(bits, i)) for i in range(WORDS)]


def _six_bits(bits: Column, i: int) -> Column:
    return F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(__block, __word_0 … __word_3): the filter over the keys; NULL is none."""
    block, bits = _place(key, blocks)
    placed = keys.filter(F.col(key).isNotNull()).select(block.alias("__block"), *[b.alias(n) for b, n in zip(bits, _NAMES)])
    return placed.groupBy("__block").agg(*[F.bit_or(n).alias(n) for n in _NAMES])


def keep_possible(facts: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``facts`` without most rows whose ``key`` is not among the unique ``keys``; every row with a partner stays.

    Nothing is done where the keys themselves are small enough to be broadcast, or where even the filter is not. Of rows
    without a partner about one in 400 stays.
    """
    spark = facts.sparkSession
    size = measure(keys)
    blocks = max(1, -(-size.rows // KEYS_PER_BLOCK))
    if fits_broadcast(spark, size) or blocks * _ROW_BYTES > broadcast_limit(spark):
        return facts
    filled = F.broadcast(materialize(bloom_filter(keys, key, blocks), "bloom"))
    block, bits = _place(key, blocks)
    probed = facts.withColumn("__block", block).join(filled, "__block")
    for name, bit in zip(_NAMES, bits):
        probed = probed.filter(F.col(name).bitwiseAND(bit) != 0)
    return probed.drop("__block", *_NAMES)
