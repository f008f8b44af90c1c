"""Delimited text lines to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorloom.plans.spec import FeatureSpec


def split_fields(line: Column, spec: FeatureSpec, java_split: bool = False) -> Column:
    """Fields of a line; ``java_split`` drops trailing empty fields."""
    if java_split:
        line = F.regexp_replace(line, f"(?:{spec.delimiter})+$", "")
    return F.split(line, spec.delimiter, -1)


def _records(lines: DataFrame, spec: FeatureSpec, line: str, java_split: bool) -> DataFrame:
    # the first field is blank: nothing but blanks up to a delimiter or the end
    blank = F.col(line).rlike(rf"^[\x00-\x20]*(?:{spec.delimiter}|\z)")
    return lines.filter(~blank).withColumn("__fields", split_fields(F.col(line), spec, java_split))


def read_delimited(
    lines: DataFrame, spec: FeatureSpec, line: str = "value", java_split: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Text columns named by the spec; records whose first field is blank are skipped.

    A record with another number of fields is an error; see ``bad_records``.
    """
    wanted = len(spec.columns)
    size = F.size("__fields")
    message = F.concat(
        F.lit(f"expected {wanted} fields, found "), size.cast("string"), F.lit(": "), F.col(line)
    )
    checked = F.when(size == wanted, F.col("__fields")).otherwise(F.raise_error(message).cast("array<string>"))
    parsed = _records(lines, spec, line, java_split).withColumn("__fields", checked)
    return parsed.select(
        *keep, *[F.nullif(F.col("__fields")[i], F.lit("")).alias(c.name) for i, c in enumerate(spec.columns)]
    )


def bad_records(lines: DataFrame, spec: FeatureSpec, line: str = "value", java_split: bool = False) -> DataFrame:
    """Records ``read_delimited`` would reject, with the number of fields found."""
    records = _records(lines, spec, line, java_split).withColumn("n_fields", F.size("__fields"))
    return records.filter(F.col("n_fields") != len(spec.columns)).drop("__fields")


def map_values_to_columns(
    lines: DataFrame, spec: FeatureSpec, line: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per field: column name and raw value. The number of fields is not checked."""
    names = F.array(*[F.lit(n) for n in spec.names])
    return _records(lines, spec, line, java_split=False).select(
        *keep, F.posexplode("__fields").alias("__at", "raw_value")
    ).filter(F.col("__at") < len(spec.columns)).select(
        *keep, F.get(names, F.col("__at")).alias("column_name"), "raw_value"
    )


def read_typed_csv(lines: DataFrame, schema: T.StructType | str, line: str = "value", **options: str) -> DataFrame:
    """Comma-separated lines to typed columns."""
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    return lines.select(F.from_csv(F.col(line), ddl, {"mode": "FAILFAST", **options}).alias("r")).select("r.*")


def write_delimited(df: DataFrame, path: str, **options: str) -> None:
    """Typed rows as comma-separated lines."""
    df.write.options(**options).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)
