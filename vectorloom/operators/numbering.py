"""Dense 0-based row numbers without pulling all rows into one task."""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorloom.session import materialize

# monotonically_increasing_id() keeps the partition number above this bit
_PARTITION_SHIFT = 33
_TAG = "__row_tag"
# Number of values of an integer type.
_RANGES = {T.ByteType: 1 << 8, T.ShortType: 1 << 16, T.IntegerType: 1 << 32, T.LongType: 1 << 64}
_MAX_DECIMAL = 10**38


def _ranges(df: DataFrame, columns: list[str], count: int | None) -> list[tuple[int, int]] | None:
    """Range and shift of each column after the first, if all fit side by side into a decimal."""
    kinds = [_RANGES.get(type(df.schema[c].dataType)) for c in columns]
    if None in kinds:
        return None
    ranges = [(n, n // 2) for n in kinds[1:]]
    if count is not None:
        ranges[-1] = (max(count, 1), 0)
    # the leading column keeps its sign
    return ranges if kinds[0] // 2 * math.prod(n for n, _ in ranges) < _MAX_DECIMAL else None


def order_value(df: DataFrame, columns: list[str], count: int | None = None) -> Column:
    """One value that sorts like the columns, for ``min`` and ``max``.

    A single column is itself. Integers whose ranges fit side by side into a decimal make one, which has a fixed
    width and lets aggregates hash; anything else makes a struct. ``count`` says that the last column
    is below it and not negative. Nothing is cut off or overflows.
    """
    if len(columns) == 1:
        return F.col(columns[0])
    ranges = _ranges(df, columns, count)
    if ranges is None:
        return F.when(F.greatest(*[F.col(c).isNull() for c in columns]), None).otherwise(F.struct(*columns))
    value = F.col(columns[0]).cast("decimal(38,0)")
    for c, (size, shift) in zip(columns[1:], ranges):
        value = (value * F.lit(Decimal(size))).cast("decimal(38,0)")
        value = (value + (F.col(c).cast("decimal(21,0)") + F.lit(Decimal(shift)))).cast("decimal(38,0)")
    return value


def last_part(df: DataFrame, columns: list[str], value: Column, count: int | None = None) -> Column:
    """The last of the columns, taken back out of an ``order_value``."""
    if len(columns) == 1:
        return value
    ranges = _ranges(df, columns, count)
    if ranges is None:
        return value[columns[-1]]
    size, shift = ranges[-1]
    return (F.pmod(value, F.lit(Decimal(size))) - F.lit(Decimal(shift))).cast(df.schema[columns[-1]].dataType)


@dataclass(frozen=True)
class Numbered:
    rows: DataFrame
    total: int


def number_rows(df: DataFrame, order_by: list[str | Column], column: str = "pos") -> Numbered:
    """Number rows 0, 1, 2, … in the order of ``order_by``, which should be unique.

    One range-partitioned sort tags every row with (partition, row in partition); the
    tagged rows are written, and only the row count of each partition comes back to
    the driver to turn the tags into global positions. A window without partitioning
    would send every row to a single task instead.
    """
    tagged = df.orderBy(*order_by).withColumn(_TAG, F.monotonically_increasing_id())
    table = materialize(tagged, "numbered")
    part = F.shiftright(_TAG, _PARTITION_SHIFT).cast("int")
    counts = {r["part"]: r["n"] for r in table.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}

    offsets, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    starts = F.split(F.lit(",".join(map(str, offsets)) or "0"), ",").cast("array<bigint>")
    local = F.col(_TAG).bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    return Numbered(table.withColumn(column, F.get(starts, part) + local).drop(_TAG), total)
