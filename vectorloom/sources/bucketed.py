"""Tables that lie in buckets of a key, sorted by it: joins on the key need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.operators.dictionary import UNKNOWN
from vectorloom.session import scratch_path

BUCKETS = 64


def save_bucketed(df: DataFrame, key: str, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Write ``df`` as the table ``name``: each bucket is one file, sorted by the key, so that a scan gives it in order."""
    dealt = df.repartition(buckets, key)
    dealt.write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name, format="parquet")


def save_for_joins(df: DataFrame, key: str, label: str, buckets: int = BUCKETS) -> DataFrame:
    """``df`` as a bucketed table in the shared folder, under a name of its own."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    save_bucketed(df, key, name, scratch_path(spark, label), buckets)
    return spark.table(name)


def join_bucketed(reviews: DataFrame, item_styles: DataFrame, key: str) -> DataFrame:
    """Bucketed reviews with the columns of their item, bucketed by the same key and number; no row is shuffled.

    An unknown item has style index -1 and no style.
    """
    joined = reviews.join(item_styles.hint("merge"), key, "left")
    if "style_index" in item_styles.columns:
        joined = joined.withColumn("style_index", F.coalesce("style_index", F.lit(UNKNOWN)))
    return joined
