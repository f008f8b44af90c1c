"""Text forms of feature vectors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _policy(missing_label: str, *allowed: str) -> None:
    if missing_label not in allowed:
        raise ValueError(f"missing_label must be one of {', '.join(allowed)}")


def _required(label: Column) -> Column:
    return F.when(label.isNull(), F.raise_error(F.lit("a row has no label")).cast("string")).otherwise(label.cast("string"))


def plain_line(features: Column, label: Column, missing_label: str = "error") -> Column:
    """``f1,…,fn,label``; a NULL feature is an empty field, a NULL label an error or an empty field."""
    _policy(missing_label, "error", "empty")
    cells = F.transform(features, lambda x: F.coalesce(x.cast("string"), F.lit("")))
    last = F.coalesce(label.cast("string"), F.lit("")) if missing_label == "empty" else _required(label)
    return F.array_join(F.array_append(cells, last), ",")


def write_plain_vectors(df: DataFrame, path: str, missing_label: str = "error") -> None:
    """Write ``features`` and ``label`` columns, one line per row (see ``plain_line``)."""
    df.select(plain_line(F.col("features"), F.col("label"), missing_label).alias("value")).write.text(path)


def read_plain_vectors(lines: DataFrame, n: int, line: str = "value") -> DataFrame:
    """Lines of ``n`` features and a label back to ``features`` and ``label``; empty fields are NULL."""
    fields = F.split(F.col(line), ",", -1)
    values = F.transform(_counted(fields, n + 1, n + 1), lambda x: F.nullif(x, F.lit("")).cast("double"))
    return lines.select(values.alias("v")).select(
        F.slice("v", 1, n).alias("features"), F.get("v", F.lit(n)).alias("label")
    )


def svmlight_line(label: Column, entries: Column) -> Column:
    """``label i:v i:v …``; a NULL label is an error, an entry without a value is left out like a zero."""
    present = F.filter(entries, lambda e: e["value"].isNotNull())
    pairs = F.transform(present, lambda e: F.concat_ws(":", e["index"].cast("string"), e["value"].cast("string")))
    return F.concat_ws(" ", _required(label), pairs)


def write_svmlight(df: DataFrame, path: str, missing_label: str = "error") -> None:
    """Write ``label`` and ``entries`` (index, value) columns, one line per row.

    Rows without a label are an error, or left out with ``missing_label="drop"``.
    """
    _policy(missing_label, "error", "drop")
    if missing_label == "drop":
        df = df.filter(F.col("label").isNotNull())
    df.select(svmlight_line(F.col("label"), F.col("entries")).alias("value")).write.text(path)


def read_svmlight(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    """Label and dense ``features`` array; entries left out are 0."""
    raw = spark.read.format("libsvm").option("numFeatures", str(n_features)).load(path)
    return raw.select("label", vector_to_array("features").alias("features"))


def _counted(fields: Column, least: int, most: int | None = None) -> Column:
    """The fields, if there are as many as asked for; an error if not."""
    size = F.size(fields)
    fits = (size >= least) & (size <= most) if most else size >= least
    message = F.concat(F.lit(f"expected {least} fields, found "), size.cast("string"))
    return F.when(fits, fields).otherwise(F.raise_error(message).cast("array<string>"))


def read_labeled_dense(lines: DataFrame, n: int, line: str = "value") -> DataFrame:
    """Label-first comma lines to ``label`` and the next ``n`` fields as ``features``; fewer are an error."""
    fields = _counted(F.split(F.col(line), ",", -1), n + 1)
    return lines.select(
        fields[0].cast("double").alias("label"),
        F.slice(fields, 2, n).cast("array<double>").alias("features"),
    )
