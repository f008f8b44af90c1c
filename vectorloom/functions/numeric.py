"""Column expressions for the numeric side of vectorization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters trimmed from both ends of a value, and the term that
# keeps a constant column from dividing by zero.
BLANKS = "".join(map(chr, range(33)))
SD_EPSILON = 1e-6


def unquoted(c: Column) -> Column:
    """``c`` as text without any double quote."""
    return F.replace(c.cast("string"), F.lit('"'), F.lit(""))


def trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def label_value(c: Column) -> Column:
    """The category in a raw value: unquoted and trimmed, NULL when empty."""
    text = unquoted(c)
    # most values have nothing to trim, and looking at both ends is cheaper than trimming
    clean_ends = (F.ascii(text) > 32) & (F.ascii(F.right(text, F.lit(1))) > 32)
    return F.when(clean_ends, text).otherwise(F.nullif(trimmed(text), F.lit("")))


def number_value(c: Column) -> Column:
    """The number in a raw text value; NULL when it is not one or is NaN.

    The cast itself ignores blanks around the number.
    """
    return F.nanvl(unquoted(c).try_cast("double"), F.lit(None).cast("double"))


def has_content(c: Column) -> Column:
    """True where a raw text value holds more than quotes and blanks, NULL where it does not."""
    return F.when(c.rlike(r'[^"\x00-\x20]'), F.lit(True))


def copy(x: Column) -> Column:
    return x.cast("double")


def binarize(x: Column, low: Column, high: Column) -> Column:
    """0.0 below the midpoint of the range, 1.0 from the midpoint on."""
    middle = (high - low) / 2 + low
    return F.when(x < middle, F.lit(0.0)).when(x.isNotNull(), F.lit(1.0))


def normalize(x: Column, low: Column, high: Column) -> Column:
    """Position of ``x`` in the range as 0…1, 0.0 for an empty range."""
    scaled = (x - low) / F.nullif(high - low, F.lit(0.0))
    return F.when(x.isNotNull(), F.coalesce(scaled, F.lit(0.0)))


def standardize(x: Column, mean: Column, sd: Column) -> Column:
    return (x - mean) / (sd + F.lit(SD_EPSILON))


def normalize_label(label_id: Column, n_labels: int) -> Column:
    return (label_id + 1) / F.lit(float(n_labels))
