"""JSON containers of any size: one file, read by many tasks.

Files are read in pieces that end with a closing brace, so Spark splits them like lines. Where a piece begins,
inside a string or outside, and how deep, is not known to the task that reads it; each piece gives what it
does to that state instead: the number of unescaped quotes, and the brackets it has if it begins outside or
inside a string. These add up over pieces: first within a block of the file, then over the blocks, one row per
block. With the state of every piece known, a record ends where a brace closes it, and pieces are put together
by the number of records that ended before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from vectorloom.session import materialize

# A string, or what is left of one at the end of a piece; a backslash takes the next character along.
_STRING = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\z)'
_NO_BRACKET = r"[^{}\[\]]+"
# What may stand before the first record, before another one, and after the last one.
_HEAD = r'(?s)^\s*+\{\s*+"[^"\\]*+(?:\\.[^"\\]*+)*+"\s*+:\s*+([{\[])\s*+'
_COMMA = r"^\s*+,\s*+"
_TAIL = r"(?s)^\s*+[\]}].*$"
# Behind an empty root may be white space, which gets a brace like every piece.
_EMPTY_ROOT = r"^\s*+\{\s*+\}(?:\s++\})?$"


def _brackets(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, _STRING, ""), _NO_BRACKET, "")


def _change(brackets: Column) -> Column:
    return F.regexp_count(brackets, F.lit(r"[{\[]")) - F.regexp_count(brackets, F.lit(r"[}\]]"))


def _pieces(spark: SparkSession, path: str, split_bytes: int | None) -> DataFrame:
    """(file, block, at, piece, …): pieces with their closing brace and what each does to the state."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        if split_bytes is not None:
            spark.conf.set(key, str(split_bytes))
        read = spark.read.option("lineSep", "}").text(path)
        text = F.concat("value", F.lit("}"))
        return materialize(
            read.select(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_size").alias("size"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("at"),
                text.alias("piece"),
                # with a backslash taking the next character along everywhere, parity does not depend on the state
                F.regexp_count(F.regexp_replace(text, r"(?s)\\.", ""), F.lit('"')).alias("quotes"),
                _brackets(text).alias("outside"),
                _brackets(F.concat(F.lit('"'), text)).alias("inside"),
            ),
            "json-pieces",
        )
    finally:
        spark.conf.set(key, before)


def _up_to(column: str | Column, order: WindowSpec) -> Column:
    """Sum over the rows before, without the row itself."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _in_block() -> WindowSpec:
    return Window.partitionBy("file", "block").orderBy("at")


def _over_blocks() -> WindowSpec:
    return Window.partitionBy("file").orderBy("block")


def _with_state(pieces: DataFrame) -> DataFrame:
    """(file, block, at, piece, brackets, depth): the brackets of a piece outside strings, and the depth it begins at."""
    by_parity = pieces.withColumn("odd", _up_to("quotes", _in_block()) % 2)
    # depth changes if the block begins outside a string, and if it begins inside one
    changes = by_parity.withColumns({"from_outside": _change(F.col("outside")), "from_inside": _change(F.col("inside"))})
    changes = changes.withColumns(
        {
            "change": F.when(F.col("odd") == 0, F.col("from_outside")).otherwise(F.col("from_inside")),
            "other": F.when(F.col("odd") == 0, F.col("from_inside")).otherwise(F.col("from_outside")),
        }
    )
    blocks = changes.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.sum("change").alias("change"), F.sum("other").alias("other")
    )
    blocks = blocks.withColumn("block_odd", _up_to("quotes", _over_blocks()) % 2)
    own = F.when(F.col("block_odd") == 0, F.col("change")).otherwise(F.col("other"))
    blocks = blocks.withColumn("own", own).withColumn("block_depth", _up_to("own", _over_blocks()))
    starts = blocks.select("file", "block", "block_odd", "block_depth")

    state = changes.join(starts, ["file", "block"])
    outside = (F.col("odd") + F.col("block_odd")) % 2 == 0
    state = state.select(
        "file", "size", "block", "at", "piece",
        (F.col("odd") + F.col("quotes") + F.col("block_odd")).alias("quotes_so_far"),
        F.when(outside, F.col("outside")).otherwise(F.col("inside")).alias("brackets"),
        "block_depth",
    )
    return state.withColumn("depth", _up_to(_change(F.col("brackets")), _in_block()) + F.col("block_depth")).drop("block_depth")


def _leaves(brackets: Column, depth: Column) -> Column:
    """Whether the first element of the root ends in these brackets: depth falls from 2 to 1."""
    signs = F.transform(F.split(brackets, ""), lambda c: F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0))
    end = F.aggregate(
        signs,
        F.struct(depth.cast("long").alias("depth"), F.lit(False).alias("left")),
        lambda s, x: F.struct(
            (s["depth"] + x).alias("depth"), (s["left"] | ((s["depth"] == 2) & (x == -1))).alias("left")
        ),
    )
    return end["left"]


def _bad_files(state: DataFrame) -> list[str]:
    """Files that are no container: cut off, with unbalanced brackets or quotes or something after the root."""
    end = F.struct(
        "block", "at", (F.col("depth") + _change(F.col("brackets"))).alias("depth"), "quotes_so_far",
        F.col("piece").rlike(r"^\s+\}$").alias("blank"),
    )
    files = state.groupBy("file").agg(
        F.max(end).alias("last"), F.min("depth").alias("least"), F.sum(F.octet_length("piece")).alias("bytes"), F.max("size").alias("size")
    )
    # the brace of the last piece is not in the file where that ends otherwise; a compressed file does not tell by its size
    added = F.when(F.col("bytes") == F.col("size"), F.lit(False)).when(F.col("bytes") == F.col("size") + 1, F.lit(True))
    added = F.coalesce(added, F.col("last.blank"))
    proper = F.when(added, F.col("last.blank") & (F.col("last.depth") == -1)).otherwise(F.col("last.depth") == 0)
    bad = files.filter(~proper | (F.col("least") < 0) | (F.col("last.quotes_so_far") % 2 != 0)).select("file")
    return [r["file"] for r in bad.limit(5).collect()]


def container_texts(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """(file, at, text): every record under the first element of each file's root, as JSON text of its own.

    ``text`` of a record under an object has its name: a map with one entry. ``at`` counts the records of a file from 0.
    Where text before, between or after records is not what JSON has there, ``text`` is NULL. A file whose brackets
    or quotes do not balance is an error here. Spark does not read empty files: they have no records.
    """
    state = materialize(_with_state(_pieces(spark, path, split_bytes)), "json-state")
    bad = _bad_files(state)
    if bad:
        raise ValueError(f"bad container: {', '.join(bad)}")
    end = F.col("depth") + _change(F.col("brackets"))
    marked = state.withColumn("leaves", _leaves(F.col("brackets"), F.col("depth")).cast("long"))
    # the piece ends a record if its own brace, outside a string, goes from 3 to 2
    closes = (end == 2) & F.col("brackets").endswith("}") & (F.col("quotes_so_far") % 2 == 0) & (F.col("leaves") == 0)
    marked = marked.withColumn("ends", closes.cast("long"))
    marked = marked.withColumns({"left": _up_to("leaves", _in_block()), "number": _up_to("ends", _in_block())})
    blocks = marked.groupBy("file", "block").agg(F.sum("leaves").alias("leaves"), F.sum("ends").alias("ends"))
    blocks = blocks.select(
        "file", "block", _up_to("leaves", _over_blocks()).alias("left_before"), _up_to("ends", _over_blocks()).alias("ended_before")
    )
    numbered = marked.join(blocks, ["file", "block"]).filter(F.col("left") + F.col("left_before") == 0)
    numbered = numbered.withColumn("number", F.col("number") + F.col("ended_before"))

    parts = F.array_sort(F.collect_list(F.struct("block", "at", "piece")))
    whole = numbered.groupBy("file", "number").agg(
        F.array_join(F.transform(parts, lambda p: p["piece"]), "").alias("text"), F.max("ends").alias("is_record")
    )
    whole = materialize(whole, "json-records")
    # the bracket that opens the first element says whether records have names
    heads = whole.filter("number = 0").select("file", (F.regexp_extract("text", _HEAD, 1) == "{").alias("named"))
    whole = whole.join(heads, "file")

    is_first = F.col("number") == 0
    headed = F.when(is_first, F.col("text").rlike(_HEAD)).otherwise(F.col("text").rlike(_COMMA))
    bare = F.when(is_first, F.regexp_replace("text", _HEAD, "")).otherwise(F.regexp_replace("text", _COMMA, ""))
    record = F.when(F.col("named"), F.concat(F.lit("{"), bare, F.lit("}"))).otherwise(bare)
    # what follows the last record has to close the element, unless the root is empty
    after = F.when(is_first, F.regexp_replace("text", _HEAD, "")).otherwise(F.col("text"))
    closed = F.when(is_first, F.col("text").rlike(_HEAD)).otherwise(F.lit(True)) & after.rlike(_TAIL)
    proper_end = closed | (is_first & F.col("text").rlike(_EMPTY_ROOT))
    kept = whole.filter((F.col("is_record") == 1) | ~proper_end)
    text = F.when((F.col("is_record") == 1) & headed, record)
    return kept.select("file", F.col("number").alias("at"), text.alias("text"), "named")
