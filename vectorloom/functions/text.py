"""Column expressions for character sequences; one row per text, no shuffle."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from vectorloom.functions.vocab import DEFAULT, Vocabulary


def charset_filter(text: Column, vocab: Vocabulary = DEFAULT) -> Column:
    """Drop characters outside the vocabulary."""
    outside = "[^" + "".join(re.escape(c) for c in vocab.characters) + "]"
    return F.regexp_replace(text, outside, "")


def _index_by_code(vocab: Vocabulary) -> Column:
    """Array from code point to vocabulary index, NULL where the character is unknown."""
    codes = {ord(c): i for i, c in enumerate(vocab.characters)}
    cells = [str(codes.get(code, "NULL")) for code in range(max(codes) + 1)]
    return F.expr(f"array({', '.join(cells)})")


def encode(text: Column, vocab: Vocabulary = DEFAULT) -> Column:
    """Vocabulary indices of the known characters, in order."""
    table = _index_by_code(vocab)
    return F.array_compact(F.transform(F.split(text, ""), lambda c: F.get(table, F.ascii(c))))


def decode(indices: Column, vocab: Vocabulary = DEFAULT) -> Column:
    """Text of a sequence of indices; the stop index gives the stop symbol."""
    symbols = F.array(*[F.lit(c) for c in vocab.characters + vocab.stop_symbol])
    return F.array_join(F.transform(indices, lambda i: F.get(symbols, i)), "")


def step_targets(encoded: Column, vocab: Vocabulary = DEFAULT) -> Column:
    """What each step predicts: every character, then one stop."""
    return F.concat(encoded, F.array(F.lit(vocab.stop)))


def step_inputs(encoded: Column, vocab: Vocabulary = DEFAULT) -> Column:
    """What each step sees: the stop index first, then the previous character."""
    return F.concat(F.array(F.lit(vocab.stop)), encoded)


def truncate_sequence(sequence: Column, max_len: int) -> Column:
    return F.slice(sequence, 1, max_len)


def nonempty_text(text: Column) -> Column:
    return F.length(text) >= 1


def short_text_flag(text: Column, min_steps: int = 10) -> Column:
    """True where the text plus its stop has fewer than ``min_steps`` steps."""
    return F.length(text) + 1 < min_steps


def truncate_text(text: Column, max_chars: int = 120) -> Column:
    return F.substring(text, 1, max_chars)


def rescale_rating(rating: Column) -> Column:
    """Ratings 1…5 to −1…+1."""
    return (rating - 1) / 2.0 - 1


def one_hot(index: Column, size: int) -> Column:
    """Indicator array of length ``size``; all zero for an index outside it."""
    if size == 0:
        return F.array().cast("array<double>")
    places = F.sequence(F.lit(0), F.lit(size - 1))
    return F.transform(places, lambda i: F.when(i == index, F.lit(1.0)).otherwise(F.lit(0.0)))
