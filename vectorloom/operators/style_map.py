"""A stored map from item to its last style, updated in place.

Items are dealt to buckets by a hash of their id, a folder each. An update reads and rewrites the buckets its items
fall into and no other; the position stored with an item decides what is last, so updates may come in any order
and more than once.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorloom.operators.dictionary import last_styles, style_key
from vectorloom.operators.lookup import lookup_join
from vectorloom.session import materialize

# Written next to the buckets: their number and the columns of a position.
_ABOUT = "about"


@dataclass(frozen=True)
class StyleMap:
    """Where a map is stored; ``create`` makes a new one, ``open_map`` finds one."""

    path: str
    buckets: int
    position: tuple[str, ...]
    schema: T.StructType

    @property
    def items(self) -> str:
        return f"{self.path}/items"

    def rows(self, spark: SparkSession) -> DataFrame:
        """item_id, style, the position columns and the bucket of every item."""
        return spark.read.schema(self.schema).parquet(self.items)


def create(spark: SparkSession, path: str, items: DataFrame, item_id: str, position: list[str], buckets: int = 64) -> StyleMap:
    """An empty map for items like these; ``path`` must be new. A bucket should hold some hundred thousand items."""
    if clash := {"item_id", "style", "bucket", "place"} & set(position):
        raise ValueError(f"position columns {sorted(clash)} are names of the map")
    kinds = {c: items.schema[c].dataType for c in (item_id, *position)}
    schema = T.StructType([T.StructField("item_id", kinds[item_id]), T.StructField("style", T.StringType())])
    for c in position:
        schema = schema.add(c, kinds[c])
    schema = schema.add("bucket", T.IntegerType())
    spark.createDataFrame([], schema).write.partitionBy("bucket").parquet(f"{path}/items")
    about = [(buckets, list(position), schema.json())]
    spark.createDataFrame(about, "buckets int, position array<string>, schema string").coalesce(1).write.parquet(f"{path}/{_ABOUT}")
    return StyleMap(path, buckets, tuple(position), schema)


def open_map(spark: SparkSession, path: str) -> StyleMap:
    about = spark.read.parquet(f"{path}/{_ABOUT}").first()
    schema = T.StructType.fromJson(json.loads(about["schema"]))
    return StyleMap(path, about["buckets"], tuple(about["position"]), schema)


def upsert(target: StyleMap, items: DataFrame, item_id: str, style: str) -> list[int]:
    """Bring the last styles of ``items`` into the map; returns the buckets that were rewritten.

    Rows without a style, or with a NULL in their position, change nothing. Later positions win over what is
    stored, on a tie the last style in the alphabet, so the order of updates does not matter.
    """
    spark, position = items.sparkSession, list(target.position)
    kept = items.filter(F.col(style).isNotNull()).select(
        F.col(item_id).cast(target.schema["item_id"].dataType).alias("item_id"),
        F.col(style).alias("style"),
        *[F.col(c).cast(target.schema[c].dataType).alias(c) for c in position],
    )
    new = last_styles(kept, "item_id", "style", position, carry=tuple(position)).drop("place")
    new = materialize(new.withColumn("bucket", _bucket(target)), "map-new")
    # at most the number of buckets
    touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())
    if not touched:
        return []
    stored = target.rows(spark).filter(F.col("bucket").isin(touched))
    both = stored.unionByName(new)
    merged = last_styles(both, "item_id", "style", position, carry=(*position, "bucket")).drop("place")
    merged = materialize(merged, "map-merged")
    # a bucket is one file, written in one piece
    merged.select(target.schema.names).repartition("bucket").write.partitionBy("bucket").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(target.items)
    return touched


def _bucket(target: StyleMap):
    return F.pmod(F.xxhash64("item_id"), F.lit(target.buckets)).cast("int")


def item_styles(target: StyleMap, dictionary: DataFrame) -> DataFrame:
    """item_id, style_index and style of the stored items whose style the dictionary knows."""
    rows = target.rows(dictionary.sparkSession).withColumn("style_key", style_key(F.col("style")))
    known = lookup_join(rows, dictionary.select("style_key", "style_index"), "style_key", how="inner")
    return known.select("item_id", "style_index", "style")
