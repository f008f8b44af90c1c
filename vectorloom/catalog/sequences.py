"""Queries X1–X15: character sequences, context and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.catalog.base import register, table
from vectorloom.catalog.vectors import labels_sql
from vectorloom.functions import text as tx
from vectorloom.functions.vocab import DEFAULT, DEFAULT_CHARACTERS
from vectorloom.operators import sequences as sq
from vectorloom.operators.dictionary import item_to_style, join_style_index, style_dictionary
from vectorloom.operators.lookup import lookup_join
from vectorloom.session import scratch_path

BATCH = 32
TURN_POSITION = ["conv_id", "turn"]
EXAMPLE_LENGTH = 200
EXAMPLES = 128

VOCAB_SQL = (
    "'"
    + DEFAULT_CHARACTERS.replace("'", "''").replace("\n", "' || chr(10) || '").replace("\t", "' || chr(9) || '")
    + "'"
)
CLASS_SQL = (
    r"""'[^a-zA-Z0-9!&()?\-''",.:; \n\t@#$%^*{}\[\]/+_\\|<>=`]'"""
)
KEPT_SQL = f"regexp_replace(text, {CLASS_SQL}, '', 'g')"
STOP = DEFAULT.stop


def indices_sql(source: str, columns: str) -> str:
    """CTE ``e`` with the index list ``ids`` of every text."""
    return f"""vocab AS (SELECT {VOCAB_SQL} AS v),
    kept AS (SELECT {columns}, {KEPT_SQL} AS kept_text FROM {source}),
    e AS (SELECT {columns}, CASE WHEN kept_text = '' THEN []::BIGINT[] ELSE
             list_transform(string_split(kept_text, ''), lambda c: position(c IN v) - 1) END AS ids
          FROM kept CROSS JOIN vocab)"""


def joined(column: str) -> Column:
    """An index array as text, for comparison."""
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@register("x1_charset_filter", f"SELECT doc_id, {KEPT_SQL} AS text FROM documents")
def charset_filter(spark, sf_dir):
    return documents(spark, sf_dir).withColumn("text", tx.charset_filter(F.col("text")))


@register(
    "x3_char_to_index",
    f"WITH {indices_sql('documents', 'doc_id')} SELECT doc_id, array_to_string(ids, ' ') AS ids FROM e",
)
def char_to_index(spark, sf_dir):
    encoded = documents(spark, sf_dir).select("doc_id", tx.encode(F.col("text")).alias("ids"))
    return encoded.select("doc_id", joined("ids"))


@register("x4_index_to_char", f"SELECT doc_id, {KEPT_SQL} AS text, 1::BIGINT AS n_stops FROM documents")
def index_to_char(spark, sf_dir):
    """Encode, add the stop, and decode again; the stop comes back as the stop symbol."""
    targets = tx.step_targets(tx.encode(F.col("text")))
    decoded = documents(spark, sf_dir).select("doc_id", tx.decode(targets).alias("decoded"))
    stop = F.lit(DEFAULT.stop_symbol)
    return decoded.select(
        "doc_id",
        F.replace("decoded", stop, F.lit("")).alias("text"),
        (F.length("decoded") - F.length(F.replace("decoded", stop, F.lit("")))).cast("bigint").alias("n_stops"),
    )


@register(
    "x5_next_char_pairs",
    f"""WITH {indices_sql('documents', 'doc_id')}
    SELECT doc_id, array_to_string(list_concat([{STOP}], ids), ' ') AS inputs,
           array_to_string(list_concat(ids, [{STOP}]), ' ') AS targets, (len(ids) + 1)::INTEGER AS n_steps FROM e""",
)
def next_char_pairs(spark, sf_dir):
    pairs = sq.next_char_pairs(documents(spark, sf_dir), "text")
    return pairs.select("doc_id", joined("inputs"), joined("targets"), "n_steps")


@register(
    "x6_truncate_sequence",
    f"""WITH {indices_sql('documents', 'doc_id')}
    SELECT doc_id, array_to_string(list_concat([{STOP}], ids)[1:{EXAMPLE_LENGTH}], ' ') AS inputs,
           array_to_string(list_concat(ids, [{STOP}])[1:{EXAMPLE_LENGTH}], ' ') AS targets,
           least(len(ids) + 1, {EXAMPLE_LENGTH})::INTEGER AS n_steps FROM e""",
)
def truncate_sequence(spark, sf_dir):
    """The first steps of every sequence, up to the example length."""
    pairs = sq.next_char_pairs(documents(spark, sf_dir), "text", max_len=EXAMPLE_LENGTH)
    return pairs.select("doc_id", joined("inputs"), joined("targets"), "n_steps")


RATINGS_SQL = """ratings AS (
      SELECT doc_id, coalesce(quality * 4 + 1, 0) AS r_quality, coalesce(5 - toxic * 4, 0) AS r_toxic,
             n_chars % 5 + 1 AS r_size, 0 AS r_none
      FROM documents LEFT JOIN labels USING (doc_id))"""


def rated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with ratings from their labels, 0 where a document has none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    rated = lookup_join(docs, table(spark, sf_dir, "labels"), "doc_id")
    return rated.select(
        "doc_id",
        "lang",
        F.coalesce(F.col("quality") * 4 + 1, F.lit(0)).alias("r_quality"),
        F.coalesce(5 - F.col("toxic") * 4, F.lit(0)).alias("r_toxic"),
        (F.col("n_chars") % 5 + 1).alias("r_size"),
        F.lit(0).alias("r_none"),
    )


@register(
    "x7_rescale_rating",
    f"""WITH {RATINGS_SQL} SELECT doc_id, (r_quality - 1) / 2 - 1 AS quality, (r_toxic - 1) / 2 - 1 AS toxic,
           (r_size - 1) / 2 - 1 AS size FROM ratings""",
)
def rescale_rating(spark, sf_dir):
    rated = rated_documents(spark, sf_dir)
    return rated.select("doc_id", *[tx.rescale_rating(F.col(f"r_{n}")).alias(n) for n in ("quality", "toxic", "size")])


LANG_SQL = labels_sql("langs", "documents", "lang", "doc_id")
HOT_SQL = ", ' ', ".join(f"CASE WHEN k = {i} THEN '1.0' ELSE '0.0' END" for i in range(4))


def styled_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Rated documents with the index of their language as style."""
    langs = style_dictionary(table(spark, sf_dir, "documents").select("lang", "doc_id"), "lang", ["doc_id"])
    rated = rated_documents(spark, sf_dir).withColumn("style_key", F.col("lang"))
    joined_rows = lookup_join(rated, langs.select("style_key", "style_index"), "style_key")
    return joined_rows.drop("style_key"), langs.count()


@register(
    "x8_one_hot_style",
    f"""WITH {LANG_SQL} SELECT doc_id, concat({HOT_SQL}) AS hot
    FROM documents LEFT JOIN langs ON langs.label = lang""",
)
def one_hot_style(spark, sf_dir):
    docs, n_styles = styled_documents(spark, sf_dir)
    return docs.select("doc_id", tx.one_hot(F.col("style_index"), n_styles).alias("hot")).select("doc_id", joined("hot"))


@register(
    "x9_context_vector",
    f"""WITH {RATINGS_SQL}, {LANG_SQL}
    SELECT doc_id, concat({HOT_SQL}, ' ', (r_quality - 1) / 2 - 1, ' ', (r_toxic - 1) / 2 - 1, ' ',
                          (r_size - 1) / 2 - 1, ' ', (r_none - 1) / 2 - 1, ' ', (r_quality - 1) / 2 - 1) AS context
    FROM documents JOIN ratings USING (doc_id) LEFT JOIN langs ON langs.label = lang""",
)
def context_vector(spark, sf_dir):
    docs, n_styles = styled_documents(spark, sf_dir)
    order = dict(zip(sq.RATINGS, ("r_quality", "r_toxic", "r_size", "r_none", "r_quality")))
    ratings = {name: F.col(c) for name, c in order.items()}
    context = sq.context_vector(F.col("style_index"), n_styles, ratings)
    return docs.select("doc_id", context.alias("context")).select("doc_id", joined("context"))


@register(
    "x10_sequence_record",
    f"""WITH {indices_sql('conversations', 'conv_id, turn, role')},
    {labels_sql("roles", "conversations", "role", "row(conv_id, turn)")},
    s AS (SELECT e.*, generate_subscripts(list_concat(ids, [{STOP}]), 1) AS i FROM e)
    SELECT conv_id, turn, (i - 1)::INTEGER AS t, list_concat(ids, [{STOP}])[i]::INTEGER AS out_idx,
           list_concat([{STOP}], ids)[i]::INTEGER AS in_idx, coalesce(roles.k, -1) AS style_index,
           (coalesce(quality * 4 + 1, 0) - 1) / 2 - 1 AS ctx_appearance,
           (coalesce(5 - toxic * 4, 0) - 1) / 2 - 1 AS ctx_aroma,
           (turn % 5) / 2 - 1 AS ctx_palate, -1.5::DOUBLE AS ctx_taste, 0.0::DOUBLE AS ctx_overall
    FROM s LEFT JOIN roles ON roles.label = role LEFT JOIN labels ON doc_id = conv_id""",
)
def sequence_record(spark, sf_dir):
    """Turns as reviews: their role is the style, the labels of the conversation's number the ratings."""
    turns = table(spark, sf_dir, "conversations")
    roles = style_dictionary(turns, "role", TURN_POSITION)
    role_styles = item_to_style(turns, "role", "role", TURN_POSITION, roles)
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "conv_id")
    reviews = lookup_join(join_style_index(turns, "role", role_styles), labels, "conv_id")
    ratings = {
        "appearance": F.coalesce(F.col("quality") * 4 + 1, F.lit(0)),
        "aroma": F.coalesce(5 - F.col("toxic") * 4, F.lit(0)),
        "palate": F.col("turn") % 5 + 1,
        "taste": F.lit(0),
        "overall": F.lit(3),
    }
    return sq.sequence_record(reviews, ["conv_id", "turn"], "text", ratings)


POSITIONS_SQL = "p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents WHERE length(text) >= 1)"


def batches(spark: SparkSession, sf_dir: str) -> sq.Numbered:
    kept = documents(spark, sf_dir).filter(tx.nonempty_text(F.col("text")))
    return sq.assign_minibatch(kept, ["doc_id"], BATCH)


@register(
    "x12_assign_minibatch",
    f"WITH {POSITIONS_SQL} SELECT doc_id, pos, pos // {BATCH} AS batch_id, pos % {BATCH} AS row_in_batch FROM p",
)
def assign_minibatch(spark, sf_dir):
    return batches(spark, sf_dir).rows


@register(
    "x13_pad_and_mask",
    f"""WITH {indices_sql('conversations', 'conv_id, turn, text')},
    p AS (SELECT conv_id, turn, ids, len(ids) + 1 AS n_steps,
                 row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos FROM e WHERE length(text) >= 1),
    b AS (SELECT *, pos // {BATCH} AS batch_id, max(n_steps) OVER (PARTITION BY pos // {BATCH}) AS batch_len FROM p)
    SELECT conv_id, turn, batch_id, pos % {BATCH} AS row_in_batch, batch_len::INTEGER AS batch_len, n_steps::INTEGER AS n_steps,
           rtrim(array_to_string(list_concat([{STOP}], ids), ' ') || repeat(' -1', batch_len - n_steps)) AS inputs,
           rtrim(array_to_string(list_concat(ids, [{STOP}]), ' ') || repeat(' -1', batch_len - n_steps)) AS targets,
           ltrim(repeat(' 1', n_steps) || repeat(' 0', batch_len - n_steps)) AS mask
    FROM b""",
)
def pad_and_mask(spark, sf_dir):
    padded = sq.pad_and_mask(table(spark, sf_dir, "conversations"), TURN_POSITION, "text", BATCH)
    return padded.select(
        *TURN_POSITION, "batch_id", "row_in_batch", "batch_len", "n_steps", joined("inputs"), joined("targets"), joined("mask")
    )


@register(
    "x14_drop_remainder",
    f"""WITH {POSITIONS_SQL} SELECT doc_id, pos, pos // {BATCH} AS batch_id, pos % {BATCH} AS row_in_batch
    FROM p WHERE pos < (SELECT count(*) FROM p) // {BATCH} * {BATCH}""",
)
def drop_remainder(spark, sf_dir):
    return sq.drop_remainder(batches(spark, sf_dir), BATCH)


@register("x15_limit_examples", f"SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT {EXAMPLES}")
def limit_examples(spark, sf_dir):
    return sq.limit_examples(documents(spark, sf_dir), "doc_id", EXAMPLES)


CONTEXT_SQL = """(r_quality - 1) / 2 - 1 AS ctx_appearance, (r_toxic - 1) / 2 - 1 AS ctx_aroma,
           (r_size - 1) / 2 - 1 AS ctx_palate, (r_none - 1) / 2 - 1 AS ctx_taste, (r_quality - 1) / 2 - 1 AS ctx_overall"""


@register(
    "x16_training_batches",
    f"""WITH {RATINGS_SQL}, {LANG_SQL}, {indices_sql('documents', 'doc_id, lang, text')},
    cut AS (SELECT doc_id, lang, list_slice(list_concat([{STOP}], ids), 1, {EXAMPLE_LENGTH}) AS inputs,
                   list_slice(list_concat(ids, [{STOP}]), 1, {EXAMPLE_LENGTH}) AS targets,
                   row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM e WHERE length(text) >= 1),
    b AS (SELECT *, len(inputs) AS n_steps, pos // {BATCH} AS batch_id,
                 max(len(inputs)) OVER (PARTITION BY pos // {BATCH}) AS batch_len FROM cut)
    SELECT doc_id, batch_id, pos % {BATCH} AS row_in_batch, batch_len::INTEGER AS batch_len, n_steps::INTEGER AS n_steps,
           array_to_string(inputs, ' ') || repeat(' -1', batch_len - n_steps) AS inputs,
           array_to_string(targets, ' ') || repeat(' -1', batch_len - n_steps) AS targets,
           ltrim(repeat(' 1', n_steps) || repeat(' 0', batch_len - n_steps)) AS mask,
           langs.k AS style_index, {CONTEXT_SQL}
    FROM b JOIN ratings USING (doc_id) LEFT JOIN langs ON langs.label = lang""",
)
def training_batches(spark, sf_dir):
    """Texts with style and ratings to padded batches, written and read back."""
    styled, _ = styled_documents(spark, sf_dir)
    texts = lookup_join(documents(spark, sf_dir), styled, "doc_id", how="inner")
    order = dict(zip(sq.RATINGS, ("r_quality", "r_toxic", "r_size", "r_none", "r_quality")))
    ratings = {name: F.col(c) for name, c in order.items()}
    path = scratch_path(spark, "batches")
    sq.training_batches(texts, ["doc_id"], "text", "style_index", ratings, BATCH, max_len=EXAMPLE_LENGTH).write.parquet(path)
    context = [f"ctx_{name}" for name in sq.RATINGS]
    return spark.read.parquet(path).select(
        "doc_id", "batch_id", "row_in_batch", "batch_len", "n_steps", joined("inputs"), joined("targets"), joined("mask"),
        "style_index", *context,
    )
