"""Nested JSON containers: a root whose first element holds the records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.sources.json_split import container_texts

ITEM_FIELDS = "id string, name string, style string, abv string, brewer string"
# Review fields and what a missing one becomes.
REVIEW_DEFAULTS = {
    "text": "",
    "rating_overall": 0.0,
    "rating_aroma": 0.0,
    "rating_taste": 0.0,
    "rating_appearance": 0.0,
    "rating_palate": 0.0,
    "user": "",
    "beer_id": "0",
}
REVIEW_FIELDS = ", ".join(
    f"{name} {'float' if isinstance(default, float) else 'string'}" for name, default in REVIEW_DEFAULTS.items()
)


def read_containers(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """Container documents as text: one per line, or one per file, which is then below 2 GB.

    ``read_records`` reads whole files of any size.
    """
    return spark.read.text(path, wholetext=not per_line)


def _as_text(fields: str) -> str:
    return f"struct<{_struct(fields, True)}>"


def _parsed(containers: DataFrame, fields: str, text: str) -> DataFrame:
    """``containers`` with ``__records``, NULL where there are none, and ``__bad``. Root and records are parsed once each."""
    root = containers.withColumn("__root", F.from_json(text, "map<string,string>"))
    first = root.withColumn("__first", F.trim(F.get(F.map_values("__root"), F.lit(0))))
    as_array = F.from_json("__first", f"array<{_as_text(fields)}>")
    as_object = F.map_values(F.from_json("__first", f"map<string,{_as_text(fields)}>"))
    records = F.when(F.startswith("__first", F.lit("[")), as_array).when(F.startswith("__first", F.lit("{")), as_object)
    found = first.withColumn("__records", records)
    misread = F.exists("__records", lambda r: _misread(r, fields))
    is_bad = F.col("__root").isNull() | (F.col("__first").isNotNull() & (F.col("__records").isNull() | misread))
    return found.withColumn("__bad", F.col(text).isNotNull() & F.coalesce(is_bad, F.lit(True))).drop("__root", "__first")


def _misread(record: Column, fields: str) -> Column:
    """True where a record is none, or has a value that is not of its field's type."""
    wrong = record.isNull()
    for name, kind in (field.split() for field in fields.split(",")):
        if kind != "string":
            wrong = wrong | (record[name].isNotNull() & record[name].try_cast(kind).isNull())
    return wrong


def bad_containers(containers: DataFrame, fields: str, text: str = "value") -> DataFrame:
    """Containers that ``container_records`` would reject: malformed, cut off, or with a value of a wrong type."""
    return _parsed(containers, fields, text).filter("__bad").select(containers.columns)


def container_records(containers: DataFrame, fields: str, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Records under the first element of each root, with their position in it.

    That element may be an object of records or an array of them. A container that cannot be read in
    full is an error; see ``bad_containers``. A NULL text and an empty root have no records.
    """
    parsed = _parsed(containers, fields, text)
    message = F.concat(F.lit("bad container: "), F.left(F.col(text), F.lit(200)))
    records = F.when(F.col("__bad"), F.raise_error(message).cast(f"array<{_as_text(fields)}>")).otherwise(F.col("__records"))
    exploded = parsed.select(*keep, F.posexplode(records).alias("at", "r"))
    return exploded.select(*keep, "at", F.col("r").cast(f"struct<{_struct(fields)}>").alias("r")).select(*keep, "at", "r.*")


def read_records(spark: SparkSession, path: str, fields: str, split_bytes: int | None = None) -> DataFrame:
    """Records of containers that fill a file each, whatever its size, with their position in it.

    Files are read in splits (of ``split_bytes``, else of the session's size) by as many tasks. What ``container_records``
    rejects is an error here too, but for text after the first element of a root, which only has to balance, and a
    first element that is neither object nor array, which always is one.
    """
    texts = container_texts(spark, path, split_bytes)
    one = F.get(F.from_json(F.concat(F.lit("["), "text", F.lit("]")), f"array<{_as_text(fields)}>"), F.lit(0))
    named = F.map_values(F.from_json("text", f"map<string,{_as_text(fields)}>"))
    parsed = texts.withColumn("r", F.when(F.col("named"), F.get(named, F.lit(0))).otherwise(one))
    message = F.concat(F.lit("bad container: "), "file", F.lit(", record "), F.col("at").cast("string"))
    checked = F.when(F.coalesce(_misread(F.col("r"), fields), F.lit(True)), F.raise_error(message).cast(_as_text(fields)))
    record = checked.otherwise(F.col("r")).cast(f"struct<{_struct(fields)}>")
    return parsed.select(F.col("at").cast("int").alias("at"), record.alias("r")).select("at", "r.*")


def _struct(fields: str, as_text: bool = False) -> str:
    pairs = [f.split() for f in fields.split(",")]
    return ", ".join(f"{name}:{'string' if as_text else kind}" for name, kind in pairs)


def _read(spark: SparkSession, path: str, fields: str, per_line: bool, split_bytes: int | None) -> DataFrame:
    if per_line:
        return container_records(read_containers(spark, path, per_line=True), fields)
    return read_records(spark, path, fields, split_bytes)


def read_dictionary_json(spark: SparkSession, path: str, per_line: bool = False, split_bytes: int | None = None) -> DataFrame:
    """Items as text columns id, name, style, abv, brewer; a container per line, or per file of any size."""
    return _read(spark, path, ITEM_FIELDS, per_line, split_bytes)


def read_reviews_json(spark: SparkSession, path: str, per_line: bool = False, split_bytes: int | None = None) -> DataFrame:
    """Reviews with their text, five float ratings, user and item id; defaults filled in."""
    raw = _read(spark, path, REVIEW_FIELDS, per_line, split_bytes)
    filled = {
        name: F.coalesce(name, F.lit(default).cast("float" if isinstance(default, float) else "string"))
        for name, default in REVIEW_DEFAULTS.items()
    }
    return raw.withColumns(filled)
