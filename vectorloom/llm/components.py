"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.session import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its smallest node.

    Each round links all larger neighbours of a node to the smallest one it knows, then does the same
    among its smaller neighbours, and writes the result; the number of edges never grows and the rounds
    needed are logarithmic in the length of a chain. Loops and repeated edges do no harm. No edges, no rows.
    """
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = materialize(ordered.filter("u > v").distinct(), "edges")
    state = _state(current)
    while state[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large-star")

        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = materialize(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        before, state = state, _state(current)
        if state == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
