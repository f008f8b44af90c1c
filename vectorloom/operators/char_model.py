"""A character model from counts: the next character by style and character before, backed off where that is rare.

The share of a character after another one in a style is smoothed towards that in all styles, and this towards
the character's share in all text. Every table is counts of pairs, at most vocabulary squared per style; text is read
once and never leaves the aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.functions.vocab import DEFAULT, Vocabulary
from vectorloom.operators.metrics import masked_mean_loss
from vectorloom.operators.sequences import next_char_pairs

# Pairs seen that weigh as much as the estimate one step further back.
BACK_OFF = 5.0


def pair_counts(docs: DataFrame, text: str, by: tuple[str, ...], vocab: Vocabulary = DEFAULT) -> DataFrame:
    """(by…, in_idx, out_idx, n): how often a step sees the one index and predicts the other. NULL texts have no steps."""
    known = docs.filter(F.col(text).isNotNull()).select(*by, text)
    pairs = next_char_pairs(known, text, vocab)
    # a step is one integer until it is counted
    width = vocab.stop + 1
    steps = F.zip_with("inputs", "targets", lambda i, o: i * F.lit(width) + o)
    counts = pairs.select(*by, F.explode(steps).alias("step")).groupBy(*by, "step").agg(F.count("*").alias("n"))
    return counts.select(*by, F.expr(f"int(step div {width})").alias("in_idx"), (F.col("step") % width).cast("int").alias("out_idx"), "n")


@dataclass(frozen=True)
class CharModel:
    """Counts by style, and what they add up to; ``pairs`` has a row per pair of indices that was seen."""

    style: str
    by_style: DataFrame
    by_style_in: DataFrame
    pairs: DataFrame
    by_in: DataFrame
    characters: DataFrame


def fit_char_model(counts: DataFrame, style: str, vocab: Vocabulary = DEFAULT, back_off: float = BACK_OFF) -> CharModel:
    """The model of pair counts (style, in_idx, out_idx, n).

    ``characters`` has the smoothed share of every index, seen or not, and ``pairs`` that after another index.
    """
    spark = counts.sparkSession
    by_style = counts.select(F.col(style).alias("style"), "in_idx", "out_idx", "n")
    by_style_in = by_style.groupBy("style", "in_idx").agg(F.sum("n").alias("style_in_n"))
    all_pairs = by_style.groupBy("in_idx", "out_idx").agg(F.sum("n").alias("pair_n"))
    by_in = all_pairs.groupBy("in_idx").agg(F.sum("pair_n").alias("in_n"))
    # one row per index of the vocabulary, stop included
    size = vocab.stop + 1
    index = spark.range(size).select(F.col("id").cast("int").alias("out_idx"))
    total = F.broadcast(all_pairs.agg(F.coalesce(F.sum("pair_n"), F.lit(0)).alias("total")))
    seen = index.join(all_pairs.groupBy("out_idx").agg(F.sum("pair_n").alias("out_n")), "out_idx", "left").join(total)
    share = (F.coalesce("out_n", F.lit(0)) + 1.0) / (F.col("total") + size)
    characters = seen.select("out_idx", share.alias("p_character"))
    smoothed = (F.col("pair_n") + back_off * F.col("p_character")) / (F.col("in_n") + back_off)
    pairs = all_pairs.join(by_in, "in_idx").join(characters, "out_idx").select("in_idx", "out_idx", smoothed.alias("p_pair"))
    return CharModel(style, by_style, by_style_in, pairs, by_in, characters)


def step_probabilities(steps: DataFrame, model: CharModel, back_off: float = BACK_OFF) -> DataFrame:
    """``steps`` (style, in_idx, out_idx, …) with ``p``, the probability of each under the model.

    A style, an index or a pair that the model has not seen takes the estimate one step further back. The tables of
    all styles together have at most vocabulary squared rows and are broadcast.
    """
    named = steps.withColumnRenamed(model.style, "style")
    keys = ["style", "in_idx", "out_idx"]
    of_style = model.by_style.withColumnRenamed("n", "style_pair_n")
    # styles may be many: these two meet by a shuffle on the style if need be; a NULL style is a style
    for table, on in ((of_style, keys), (model.by_style_in, keys[:2])):
        other = table.select(*[F.col(c).alias(f"__{c}") for c in on], *[c for c in table.columns if c not in on])
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]
        named = named.join(other, same, "left").drop(*[f"__{c}" for c in on])
    known = (
        named.join(F.broadcast(model.pairs), ["in_idx", "out_idx"], "left")
        .join(F.broadcast(model.by_in), "in_idx", "left")
        .join(F.broadcast(model.characters), "out_idx")
    )
    # an unseen pair has no count, but its first index may have one
    unseen = back_off * F.col("p_character") / (F.coalesce("in_n", F.lit(0)) + back_off)
    behind: Column = F.coalesce("p_pair", unseen)
    seen, total = F.coalesce("style_pair_n", F.lit(0)), F.coalesce("style_in_n", F.lit(0))
    p = (seen + back_off * behind) / (total + back_off)
    added = ["style_pair_n", "style_in_n", "p_pair", "in_n", "p_character"]
    return known.withColumn("p", p).drop(*added).withColumnRenamed("style", model.style)


def held_out_loss(held_out: DataFrame, model: CharModel, back_off: float = BACK_OFF) -> DataFrame:
    """(style, loss): mean cost of a step, in nats, over pair counts (style, in_idx, out_idx, n) that were held out."""
    scored = step_probabilities(held_out, model, back_off)
    return masked_mean_loss(scored, F.col("n") * -F.log("p"), F.col("n"), by=(model.style,))
