"""Style buckets from thousands of keywords: one pass by a pattern of them all, or an inverted index of rare keyword
grams, instead of a chain of tests.

Keywords that are small enough to be broadcast become one pattern, a tree of their first characters, that finds the keywords
of a text where it is read. For more keywords there is the index: a text contains a keyword only if it contains each of the
keyword's grams, so a keyword is filed under its rarest one. The grams of a text that have keywords filed under them give its
candidates, which are then tested on the text. Either way the first keyword in order that a text contains is the bucket.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.operators.dictionary import style_dictionary, style_key
from vectorloom.operators.lookup import Size, fits_broadcast, lookup_join, measure
from vectorloom.session import materialize

# Characters of a gram; shorter keywords are filed under themselves. Rows that tell which grams are rare.
GRAM = 4
SAMPLE_ROWS = 500
# Most bytes of keywords in one pattern, some 100,000 words. Characters of a keyword that branch in it, and those that it
# looks at, each against a class, before it branches.
PATTERN_BYTES = 4 << 20
PATTERN_DEPTH = 4
PATTERN_GUARDS = 8


def _grams(text: Column, width: int) -> Column:
    """Distinct grams of a text; none if it is shorter. At every character one looks ahead for a gram."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{width}}}))."), F.lit(1)))


def keyword_table(keywords: DataFrame, keyword: str, order: str) -> DataFrame:
    """(nth, keyword): distinct keywords with their order; the first of equal ones counts, NULL is none."""
    kept = keywords.filter(F.col(keyword).isNotNull()).groupBy(F.col(keyword).alias("keyword"))
    return kept.agg(F.min(order).cast("long").alias("nth"))


def gram_index(keywords: DataFrame, texts: DataFrame, text: str, widths: Sequence[int]) -> DataFrame:
    """(gram, width, nth): every keyword under its gram that fewest texts of a bounded sample have.

    The sample decides which gram a keyword is filed under, never whether its texts are found.
    """
    own = F.when(F.length("keyword") < GRAM, F.array("keyword")).otherwise(_grams(F.col("keyword"), GRAM))
    filed = keywords.withColumn("gram", F.explode(own)).select("nth", "gram", F.length("gram").alias("width"))
    filed = materialize(filed, "keyword-grams")
    n = texts.count()
    some = texts.sample(min(1.0, SAMPLE_ROWS / max(n, 1)), seed=1) if n > SAMPLE_ROWS else texts
    seen = lookup_join(_exploded(some, [], text, widths), filed.select("gram").distinct(), "gram", how="left_semi", costly=True)
    counts = lookup_join(filed, materialize(seen.groupBy("gram").agg(F.count("*").alias("n")), "gram-counts"), "gram")
    rarest = counts.groupBy("nth").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "gram", "width")).alias("rarest"))
    return rarest.select("nth", "rarest.gram", "rarest.width")


def _exploded(texts: DataFrame, keys: Sequence[str], text: str, widths: Sequence[int]) -> DataFrame:
    """(keys…, gram): the distinct grams of every text; the text itself goes no further."""
    every = F.flatten(F.array(*[_grams(F.col(text), w) for w in widths]))
    return texts.filter(F.col(text).isNotNull()).select(*keys, F.explode(every).alias("gram"))


def _alternatives(words: list[str], depth: int) -> str:
    """Pattern of the longest of sorted distinct ``words`` that comes next: longer ones are tried first."""
    if depth == 0 or len(words) < 3:
        return "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))
    parts = []
    for first, group in groupby(filter(None, words), key=lambda w: w[0]):
        tails = [w[1:] for w in group]
        parts.append(re.escape(first) + (re.escape(tails[0]) if len(tails) == 1 else f"(?:{_alternatives(tails, depth - 1)})"))
    return "|".join(parts if words[0] else [*parts, ""])


def keyword_pattern(order: dict[str, int]) -> str:
    """Pattern that captures, wherever keywords begin, the first of them in order, given as keyword to place.

    A keyword that begins with an earlier one is never the first in a text. Among those left that begin at one place, each
    is the start of the next longer one, and a longer one comes earlier; so the longest is the first.
    """
    widths = {len(k) for k in order}
    first = [k for k, at in order.items() if not any(w < len(k) and order.get(k[:w], at) < at for w in widths)]
    # most places are told by a few characters: what the keywords have at the first, at the second, …
    told = zip(*(k[:PATTERN_GUARDS] for k in first))
    guards = "".join("[" + "".join(map(re.escape, sorted(set(chars)))) + "]" for chars in told)
    return f"(?={guards})(?=({_alternatives(sorted(first), PATTERN_DEPTH)}))"


def _found_by_pattern(texts: DataFrame, keys: list[str], text: str, keywords: DataFrame, size: Size) -> DataFrame:
    """(keys…, nth) of the first keyword of each text, found where the text is read."""
    pattern = keyword_pattern({r["keyword"]: r["nth"] for r in keywords.collect()})
    # rows with a NULL in their keys have no bucket
    kept = texts.dropna(subset=[*keys, text])
    met = kept.select(*keys, F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1)))).alias("keyword"))
    return lookup_join(met, keywords, "keyword", how="inner", size=size).groupBy(*keys).agg(F.min("nth").alias("nth"))


def _found_by_grams(texts: DataFrame, keys: list[str], text: str, keywords: DataFrame, widths: Sequence[int]) -> DataFrame:
    """(keys…, nth) of the first keyword of each text, by an index of grams.

    Grams travel with the keys alone, and a gram that very many texts share is joined where it is. Texts move once, in the
    join that brings their candidates.
    """
    texts = materialize(texts, "keyword-texts")
    index = materialize(gram_index(keywords, texts, text, widths), "gram-index")
    # a gram may have many keywords: filed once, with all of them
    filed = index.groupBy("gram").agg(F.collect_list("nth").alias("all"))
    met = lookup_join(_exploded(texts, keys, text, widths), materialize(filed, "gram-lists"), "gram", how="inner", costly=True)
    candidates = materialize(met.select(*keys, F.explode("all").alias("nth")), "keyword-candidates")
    tested = lookup_join(texts.join(candidates, keys), keywords, "nth", how="inner", costly=True)
    passed = tested.filter(F.contains(F.col(text), F.col("keyword")))
    return passed.groupBy(*keys).agg(F.min("nth").alias("nth"))


def first_keywords(rows: DataFrame, keys: list[str], text: str, keywords: DataFrame) -> DataFrame:
    """(keys…, nth, keyword): the first keyword in order that each text contains, without the texts that contain none.

    ``keys`` tell rows apart; ``keywords`` is a ``keyword_table``. Keywords within Spark's broadcast threshold and
    ``PATTERN_BYTES`` are found by a pattern, more of them by an index of grams.
    """
    texts = rows.select(*keys, text)
    keywords = materialize(keywords.filter(F.col("nth").isNotNull()), "keywords")
    # lengths of keywords, one number each
    lengths = [r["w"] for r in keywords.select(F.least(F.length("keyword"), F.lit(GRAM)).alias("w")).distinct().collect()]
    widths = sorted(w for w in lengths if w)
    found = []
    if widths:
        named = keywords.filter("keyword <> ''")
        size = measure(named)
        if size.bytes <= PATTERN_BYTES and fits_broadcast(rows.sparkSession, size):
            found.append(_found_by_pattern(texts, keys, text, named, size))
        else:
            found.append(_found_by_grams(texts, keys, text, named, widths))
    if 0 in lengths:
        # the empty keyword is in every text
        empty = keywords.filter("keyword = ''").first()["nth"]
        found.append(texts.filter(F.col(text).isNotNull()).select(*keys, F.lit(empty).cast("long").alias("nth")))
    if not found:
        return texts.select(*keys, F.lit(None).cast("long").alias("nth"), F.lit(None).cast("string").alias("keyword")).limit(0)
    first = reduce(DataFrame.unionByName, found).groupBy(*keys).agg(F.min("nth").alias("nth"))
    return lookup_join(materialize(first, "first-keywords"), keywords, "nth", how="inner").select(*keys, "nth", "keyword")


def grouped_styles(items: DataFrame, keys: list[str], style: str, keywords: DataFrame) -> DataFrame:
    """(keys…, bucket): the first keyword that occurs in an item's style, NULL when none does; ``keys`` are unique."""
    keyed = items.select(*keys, style_key(F.col(style)).alias("__style"))
    first = first_keywords(keyed, keys, "__style", keywords).select(*keys, F.col("keyword").alias("bucket"))
    return keyed.select(keys).join(first, keys, "left")


def keyword_dictionary(items: DataFrame, keys: list[str], style: str, keywords: DataFrame) -> DataFrame:
    """Dictionary over the buckets of ``grouped_styles``, indexed by first appearance in the order of the keys."""
    keyed = items.select(*keys, style_key(F.col(style)).alias("__style"))
    return style_dictionary(first_keywords(keyed, keys, "__style", keywords), "keyword", keys)
