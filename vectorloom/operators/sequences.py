"""Training sequences: next-step records, batches, padding and corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.functions import text as tx
from vectorloom.functions.vocab import DEFAULT, Vocabulary
from vectorloom.operators.numbering import Numbered, number_rows
from vectorloom.session import materialize

# Rating columns in the order of the context vector.
RATINGS = ("appearance", "aroma", "palate", "taste", "overall")
# No vocabulary entry; stands in the padding of an index sequence.
PAD = -1
# Default of ``limit_examples``: up to here a top-k over the bare positions is cheaper than numbering all rows.
TOP_K_ROWS = 100_000


def corpus_stats(docs: DataFrame, text: str) -> DataFrame:
    """Number of texts, of non-empty texts, and the longest text."""
    c = F.col(text)
    return docs.agg(
        F.count("*").alias("n_all"),
        F.count_if(tx.nonempty_text(c)).alias("n_nonempty"),
        F.max(F.length(c)).cast("bigint").alias("max_length"),
    )


def next_char_pairs(docs: DataFrame, text: str, vocab: Vocabulary = DEFAULT, max_len: int = 0) -> DataFrame:
    """Add ``inputs``, ``targets`` (index arrays of equal length) and ``n_steps``."""
    source = F.col(text)
    if max_len:
        # no step past max_len is needed, so no character past it is encoded
        source = F.left(tx.charset_filter(source, vocab), F.lit(max_len))
    encoded = docs.withColumn("__encoded", tx.encode(source, vocab))
    inputs, targets = tx.step_inputs(F.col("__encoded"), vocab), tx.step_targets(F.col("__encoded"), vocab)
    if max_len:
        inputs, targets = tx.truncate_sequence(inputs, max_len), tx.truncate_sequence(targets, max_len)
    return (
        encoded.withColumns({"inputs": inputs, "targets": targets})
        .withColumn("n_steps", F.size("targets"))
        .drop("__encoded")
    )


def context_columns(ratings: dict[str, Column]) -> dict[str, Column]:
    """Rescaled rating columns ``ctx_<name>`` in context order."""
    return {f"ctx_{name}": tx.rescale_rating(ratings[name]) for name in RATINGS}


def context_vector(style_index: Column, n_styles: int, ratings: dict[str, Column]) -> Column:
    """Style one-hot followed by the five rescaled ratings."""
    rescaled = [c.cast("double") for c in context_columns(ratings).values()]
    return F.concat(tx.one_hot(style_index, n_styles), F.array(*rescaled))


def sequence_record(
    reviews: DataFrame, keys: list[str], text: str, ratings: dict[str, Column], vocab: Vocabulary = DEFAULT
) -> DataFrame:
    """One row per step: target, input, and the context of the review.

    The one-hots stay indices (``in_idx``, ``style_index``); a dense row would be as
    wide as vocabulary and styles together.
    """
    context = context_columns(ratings)
    steps = next_char_pairs(reviews.withColumns(context), text, vocab)
    return steps.select(
        *keys,
        "style_index",
        *context,
        F.posexplode(F.arrays_zip(F.col("targets").alias("out_idx"), F.col("inputs").alias("in_idx"))).alias(
            "t", "step"
        ),
    ).select(*keys, "t", "step.out_idx", "step.in_idx", "style_index", *context)


def assign_minibatch(rows: DataFrame, position: list[str], batch_size: int, carry: tuple[str, ...] = ()) -> Numbered:
    """Number rows by the ``position`` columns and cut them into consecutive groups of ``batch_size``.

    Give it only the columns worth sorting; join the result back by ``position``. A sort
    reads its input twice, so write it first where it is dear.
    """
    numbered = number_rows(rows.select(*position, *carry), position)
    batched = numbered.rows.withColumns(
        {
            "batch_id": F.expr(f"pos div {batch_size}"),
            "row_in_batch": F.col("pos") % batch_size,
        }
    )
    return Numbered(batched, numbered.total)


def drop_remainder(batches: Numbered, batch_size: int) -> DataFrame:
    """Only the rows of whole batches."""
    return batches.rows.filter(F.col("batch_id") < batches.total // batch_size)


def pad_and_mask(
    docs: DataFrame,
    position: list[str],
    text: str,
    batch_size: int,
    vocab: Vocabulary = DEFAULT,
    max_len: int = 0,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Index sequences padded to the longest of their batch, with a 0/1 mask and the ``carry`` columns.

    Batches are cut and measured on (position, length) alone. Then the texts move once, in
    the join on the unique position, and are encoded after it: an index array is
    several times as large as its text.
    """
    kept = docs.filter(tx.nonempty_text(F.col(text)))
    steps = F.length(tx.charset_filter(F.col(text), vocab)) + 1
    length = F.least(steps, F.lit(max_len)) if max_len else steps
    lengths = materialize(kept.select(*position, length.alias("__n")), "lengths")
    batches = assign_minibatch(lengths, position, batch_size, ("__n",))
    # a window group is one batch: at most batch_size rows
    measured = batches.rows.withColumn("batch_len", F.max("__n").over(Window.partitionBy("batch_id"))).drop("__n", "pos")
    joined = kept.select(*position, text, *carry).join(measured, position)
    sequences = next_char_pairs(joined, text, vocab, max_len)
    missing = F.col("batch_len") - F.col("n_steps")
    padding = F.array_repeat(F.lit(PAD), missing)
    mask = F.concat(F.array_repeat(F.lit(1), F.col("n_steps")), F.array_repeat(F.lit(0), missing))
    return sequences.select(
        *position,
        *carry,
        "batch_id",
        "row_in_batch",
        "batch_len",
        "n_steps",
        F.concat("inputs", padding).alias("inputs"),
        F.concat("targets", padding).alias("targets"),
        mask.alias("mask"),
    )


def training_batches(
    reviews: DataFrame,
    position: list[str],
    text: str,
    style_index: str,
    ratings: dict[str, Column],
    batch_size: int,
    vocab: Vocabulary = DEFAULT,
    max_len: int = 0,
) -> DataFrame:
    """What a training step takes, a row per example: batch, row, step arrays, mask, style index, five ratings.

    Non-empty reviews only. The context of a review (``style_index``, ``ctx_<rating>``) holds for all of its
    steps and is stored once.
    """
    context = context_columns(ratings)
    kept = reviews.withColumns({"style_index": F.col(style_index), **context})
    return pad_and_mask(kept, position, text, batch_size, vocab, max_len, ("style_index", *context))


def limit_examples(rows: DataFrame, position: str, n: int, top_k_rows: int = TOP_K_ROWS) -> DataFrame:
    """The first ``n`` rows by the unique ``position``; 0 means all. A row without a position is none of the first.

    Finds the last position wanted from the position column alone, then filters, so
    the scan can skip row groups and the wide rows are never sorted. Up to ``top_k_rows`` the last position
    is a top-k, which keeps that many positions in a task; beyond, all positions are numbered. Both give
    the same rows.
    """
    if n <= 0:
        return rows
    positions = rows.select(position).filter(F.col(position).isNotNull())
    if n <= top_k_rows:
        last = positions.orderBy(position).limit(n).agg(F.max(position)).first()[0]
    else:
        numbered = number_rows(positions, [position])
        last = numbered.rows.filter(F.col("pos") < n).agg(F.max(position)).first()[0]
    return rows.filter(F.col(position) <= F.lit(last))
