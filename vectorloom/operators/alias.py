"""Alias tables: draws from many distributions with constant work each.

A table has a slot per class. A slot of an unlikely class is filled up by one other class, its alias; a draw takes a
slot at random and then one of the two. Which class fills which slot follows from running sums alone: unlikely classes
lay what they lack on a line one after the other, likely ones what they have too much, and a slot's alias is the class
whose part begins to cover it. So all tables are made at once by windows over (distribution, class).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.operators.lookup import lookup_join
from vectorloom.session import materialize

# Shares are counted in units of 2^-40, so sums are exact.
UNITS = 1 << 40


def alias_tables(distributions: DataFrame, key: str, index: str, p: str) -> DataFrame:
    """(key, slots, total, classes, cuts, aliases): one row per distribution.

    Slot i gives class ``classes[i]`` for positions below ``cuts[i]`` of ``total``, else ``aliases[i]``. Classes without a
    share are left out, so is a distribution without any. A distribution's classes share a window.
    """
    units = F.round(F.col(p) * F.lit(UNITS)).cast("long")
    shares = distributions.select(F.col(key).alias("__key"), F.col(index).alias("__class"), units.alias("__units")).filter("__units > 0")
    whole = Window.partitionBy("__key")
    by_class = whole.orderBy("__class")
    # what a slot holds, and what a class has, in units of total / number of classes
    shares = shares.withColumn("__total", F.sum("__units").over(whole)).withColumn("__n", F.count("*").over(whole).cast("long"))
    shares = shares.withColumn("__lacks", F.col("__total") - F.col("__units") * F.col("__n"))
    small = F.col("__lacks") > 0
    up_to = by_class.rowsBetween(Window.unboundedPreceding, 0)
    shares = shares.withColumn("__need", F.sum(F.when(small, F.col("__lacks")).otherwise(0)).over(up_to))
    shares = shares.withColumn("__spare", F.sum(F.when(~small, -F.col("__lacks")).otherwise(0)).over(up_to))

    # a small class begins where the needs before it end; a large one covers the line up to its spare
    at = F.when(small, F.col("__need") - F.col("__lacks")).otherwise(F.col("__spare"))
    line = shares.withColumn("__small", small).withColumn("__at", at)
    # of equal places small ones come last: a part that ends there does not cover what begins there
    after = whole.orderBy("__at", "__small", "__class").rowsBetween(1, Window.unboundedFollowing)
    large = F.when(~F.col("__small"), F.struct("__at", "__class"))
    covered = line.withColumn("__next", F.min(large).over(after))
    # a large class gives away what its last small one needs beyond its spare, and takes that from the next large one
    ends = F.when(F.col("__small"), F.col("__need")).otherwise(F.col("__spare"))
    behind = whole.orderBy("__end", F.col("__small").cast("int")).rowsBetween(0, Window.unboundedFollowing)
    need = covered.withColumn("__end", ends).withColumn("__reached", F.min(F.when(F.col("__small"), F.col("__need"))).over(behind))
    given = F.coalesce(F.col("__reached") - F.col("__spare"), F.lit(0))
    own = F.when(F.col("__small"), F.col("__units") * F.col("__n")).otherwise(F.col("__total") - given)
    alias = F.coalesce(F.col("__next.__class"), F.col("__class"))
    slots = need.select("__key", "__class", "__total", "__n", own.alias("__cut"), alias.alias("__alias"))
    # a row per distribution holds its classes
    packed = slots.groupBy("__key").agg(
        F.max("__n").alias("slots"), F.max("__total").alias("total"),
        F.array_sort(F.collect_list(F.struct("__class", "__cut", "__alias"))).alias("__slots"),
    )
    return packed.select(
        F.col("__key").alias(key), "slots", "total",
        F.col("__slots.__class").alias("classes"), F.col("__slots.__cut").alias("cuts"), F.col("__slots.__alias").alias("aliases"),
    )


def drawn_class(u: Column) -> Column:
    """The class of a draw ``u`` from 0 up to 1, from the columns of its table."""
    slot = F.least(F.floor(u * F.col("slots")).cast("int"), F.col("slots").cast("int") - 1)
    within = (u * F.col("slots") - slot) * F.col("total")
    return F.when(within < F.get("cuts", slot), F.get("classes", slot)).otherwise(F.get("aliases", slot))


def draw_classes(draws: DataFrame, key: str, u: str, tables: DataFrame) -> DataFrame:
    """``draws`` with ``sampled``, the class drawn from the distribution of the key; NULL where there is none.

    Each distribution is one row of ``tables``, joined once however many draws it has; a hot one is joined where its draws are.
    """
    written = materialize(tables, "alias-tables")
    joined = lookup_join(draws, written, key)
    return joined.withColumn("sampled", drawn_class(F.col(u))).select(*draws.columns, "sampled")


def table_masses(tables: DataFrame, key: str, index: str) -> DataFrame:
    """(key, index, p): the probability of every class as the tables have it."""
    slots = tables.select(key, "slots", "total", F.explode(F.arrays_zip("classes", "cuts", "aliases")).alias("s"))
    parts = slots.select(
        key, "slots", "total", F.inline(F.array(
            F.struct(F.col("s.classes").alias(index), F.col("s.cuts").alias("__part")),
            F.struct(F.col("s.aliases").alias(index), (F.col("total") - F.col("s.cuts")).alias("__part")),
        )),
    )
    whole = F.max(F.col("total").cast("double") * F.col("slots"))
    return parts.groupBy(key, index).agg((F.sum("__part") / whole).alias("p")).filter("p > 0")
