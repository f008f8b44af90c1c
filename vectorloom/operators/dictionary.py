"""Style dictionaries and the joins that use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.functions.numeric import trimmed
from vectorloom.functions.text import nonempty_text
from vectorloom.operators.bloom import keep_possible
from vectorloom.operators.lookup import lookup_join
from vectorloom.operators.numbering import number_rows, order_value
from vectorloom.session import materialize

# The style buckets, tested in this order.
STYLE_BUCKETS = ("porter", "ale", "lager", "stout", "ipa")
UNKNOWN = -1


def style_key(style: Column) -> Column:
    return F.lower(trimmed(style))


def grouped_style(style: Column, buckets: tuple[str, ...] = STYLE_BUCKETS) -> Column:
    """The first bucket whose name occurs in the style, NULL when none does."""
    key = style_key(style)
    return F.coalesce(*[F.when(F.contains(key, F.lit(b)), F.lit(b)) for b in buckets])


def _style_entries(items: DataFrame, style: str, position: list[str]) -> DataFrame:
    """One row per key. Counts are fixed-width, and positions too unless they need a struct (``order_value``)."""
    spellings = (
        items.filter(F.col(style).isNotNull())
        .groupBy(style_key(F.col(style)).alias("style_key"), F.col(style).alias("style"))
        .agg(F.count("*").alias("n"), F.min(order_value(items, position)).alias("first_at"))
    )
    return spellings.groupBy("style_key").agg(
        F.sum("n").alias("n"),
        F.min("first_at").alias("first_at"),
        F.min_by("style", "first_at").alias("style"),
    )


def style_dictionary(items: DataFrame, style: str, position: list[str]) -> DataFrame:
    """Key, display spelling, count and index by first appearance in the order of the ``position`` columns."""
    entries = _style_entries(items, style, position)
    numbered = number_rows(entries, ["first_at", "style_key"], "style_index").rows
    return numbered.select("style_key", "style", "n", "style_index")


def grouped_style_dictionary(
    items: DataFrame, style: str, position: list[str], buckets: tuple[str, ...] = STYLE_BUCKETS
) -> DataFrame:
    """Dictionary over the buckets; styles without a bucket are not indexed."""
    bucketed = items.select(grouped_style(F.col(style), buckets).alias("__bucket"), *position)
    return style_dictionary(bucketed.filter(F.col("__bucket").isNotNull()), "__bucket", position)


def filtered_count(items: DataFrame, style: str, buckets: tuple[str, ...] = STYLE_BUCKETS) -> DataFrame:
    """Number of items that match no bucket."""
    return items.agg(F.count_if(grouped_style(F.col(style), buckets).isNull()).alias("n_filtered"))


def style_statistics(dictionary: DataFrame) -> DataFrame:
    """Index and item count per style, with the number of styles."""
    total = dictionary.agg(F.count("*").alias("total_styles")).first()["total_styles"]
    return dictionary.select("style_key", "style_index", "n", F.lit(total).cast("bigint").alias("total_styles"))


def item_to_style(
    items: DataFrame,
    item_id: str,
    style: str,
    position: list[str],
    dictionary: DataFrame,
    key: Column | None = None,
) -> DataFrame:
    """Item id to style index and raw style; the last of several equal ids wins, on a tie the last style.

    ``key`` is the dictionary key of a style, e.g. ``grouped_style``; rows whose key is NULL are left out, and
    items whose last row has an unknown one.
    """
    styled = items.withColumn("__key", style_key(F.col(style)) if key is None else key).filter(F.col("__key").isNotNull())
    last = last_styles(styled, item_id, style, position, carry=("__key",)).withColumnRenamed("__key", "style_key")
    indexed = lookup_join(last, dictionary.select("style_key", "style_index"), "style_key", how="inner", costly=True)
    return indexed.select("item_id", "style_index", "style")


def last_styles(items: DataFrame, item_id: str, style: str, position: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """(item_id, style, place, …): the style of each item's last row, on a tie the last style; ``place`` is its position.

    The aggregate over all rows sees ids and positions and no text; then the winning position brings its style back.
    Rows with a NULL in their position have no place in the order and are left out.
    """
    placed = items.select(
        F.col(item_id).alias("item_id"), F.col(style).alias("style"), order_value(items, position).alias("place"), *carry
    )
    last = placed.groupBy("item_id").agg(F.max("place").alias("place")).filter(F.col("place").isNotNull())
    last = last.select(F.col("item_id").alias("__id"), F.col("place").alias("__place"))
    same = F.col("item_id").eqNullSafe(F.col("__id")) & (F.col("place") == F.col("__place"))
    # equal positions of an item are few: the window sees one of them per task
    latest = Window.partitionBy("item_id").orderBy(F.desc("style"))
    won = placed.join(last, same).drop("__id", "__place").withColumn("__rank", F.row_number().over(latest))
    return won.filter(F.col("__rank") == 1).drop("__rank")


def lookup_style_index(styles: DataFrame, style: str, dictionary: DataFrame) -> DataFrame:
    """Add ``style_index`` by normalized name, −1 when unknown."""
    keyed = styles.withColumn("style_key", style_key(F.col(style)))
    found = lookup_join(keyed, dictionary.select("style_key", "style_index"), "style_key")
    return found.withColumn("style_index", F.coalesce("style_index", F.lit(UNKNOWN))).drop("style_key")


def _styles_by(item_styles: DataFrame, key: str, *columns: str) -> DataFrame:
    """The item map under the review's key name, written so it is measured and joined cheaply."""
    return materialize(item_styles.select(F.col("item_id").alias(key), *columns), "item_styles")


def join_style_index(reviews: DataFrame, key: str, item_styles: DataFrame) -> DataFrame:
    """Reviews with the style index of their item, −1 when the item is unknown."""
    joined = lookup_join(reviews, _styles_by(item_styles, key, "style_index"), key)
    return joined.withColumn("style_index", F.coalesce("style_index", F.lit(UNKNOWN)))


def join_style_text(reviews: DataFrame, key: str, item_styles: DataFrame) -> DataFrame:
    """Reviews with the raw style of their item, NULL when the item is unknown."""
    return lookup_join(reviews, _styles_by(item_styles, key, "style"), key)


def with_known_style(reviews: DataFrame, key: str, text: str, item_styles: DataFrame) -> DataFrame:
    """Non-empty reviews whose item has a style, with its index.

    Where the map is too large to be broadcast, reviews without a style are mostly dropped before they are shuffled.
    """
    kept = reviews.filter(nonempty_text(F.col(text)))
    styles = _styles_by(item_styles, key, "style_index")
    return lookup_join(keep_possible(kept, styles.select(key), key), styles, key, how="inner")


def with_unknown_style(reviews: DataFrame, key: str, item_styles: DataFrame) -> DataFrame:
    """Reviews whose item has no style."""
    return lookup_join(reviews, _styles_by(item_styles, key), key, how="left_anti")
