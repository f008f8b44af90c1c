"""Save a profile and load it again, so that applying it needs no scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.operators.lookup import Size, row_bytes
from vectorloom.operators.profile import LABEL_SCHEMA, STATS_SCHEMA, LabelTable, Profile, make_profile
from vectorloom.plans.spec import FeatureSpec, load_spec


def save_profile(profile: Profile, path: str) -> None:
    """The spec as text, and two tables: ``stats``, and ``labels`` with one folder per column."""
    spark = profile.stats.sparkSession
    spark.createDataFrame([(profile.spec.to_text(),)], "spec string").coalesce(1).write.parquet(f"{path}/spec")
    profile.stats.coalesce(1).write.parquet(f"{path}/stats")
    profile.labels.rows.write.partitionBy("column_name").parquet(f"{path}/labels")


def label_table_of(rows: DataFrame) -> LabelTable:
    """A label table over rows that have their ids already."""
    sizes = rows.groupBy("column_name").agg(F.count("*").alias("rows"), F.sum(row_bytes(rows.schema)).alias("bytes"))
    return LabelTable(rows, {r["column_name"]: Size(r["rows"], r["bytes"]) for r in sizes.collect()})


def load_profile(spark: SparkSession, path: str, spec: FeatureSpec | None = None) -> Profile:
    """The saved profile with its own spec; a ``spec`` that differs from it is an error."""
    saved = load_spec(spark.read.parquet(f"{path}/spec").first()["spec"])
    if spec is not None and spec != saved:
        raise ValueError(f"the profile was made for another spec: {saved}")
    stats = spark.read.parquet(f"{path}/stats").orderBy("ordinal").collect()
    labels = spark.read.schema(LABEL_SCHEMA).parquet(f"{path}/labels")
    return make_profile(spark, saved, stats, lambda: label_table_of(labels))


def profile_from_text(spec: FeatureSpec, statistics: DataFrame, labels: DataFrame) -> Profile:
    """A profile from imported statistics (column_name, statistic, value) and labels (column_name, label,
    label_id, n).

    Statistics names are those of the profile, or the long forms minimum, maximum, average and stdDev. A
    NUMERIC column without any is an error; one that has some keeps NULL for the others.
    """
    names = {"minimum": "min", "maximum": "max", "average": "avg", "stddev": "stddev", "count": "n"}
    known = {f.name for f in STATS_SCHEMA if f.name not in ("column_name", "ordinal", "kind", "transform")}
    found: dict[str, dict] = {}
    # one row per column and statistic
    for r in statistics.collect():
        name = names.get(r["statistic"].lower(), r["statistic"].lower())
        if name not in known:
            raise ValueError(f"unknown statistic {r['statistic']!r} of {r['column_name']}")
        found.setdefault(r["column_name"], {})[name] = int(r["value"]) if name in ("n", "n_invalid") else r["value"]
    missing = [c.name for c in spec.numeric if c.name not in found]
    if missing:
        raise ValueError(f"no statistics for {missing}")
    kinds = {f.name: None for f in STATS_SCHEMA}
    rows = [
        kinds | found.get(c.name, {})
        | {"column_name": c.name, "ordinal": i, "kind": c.kind.value, "transform": c.transform.value}
        for i, c in enumerate(spec.columns)
    ]
    stats = statistics.sparkSession.createDataFrame([tuple(r[n] for n in STATS_SCHEMA.names) for r in rows], STATS_SCHEMA)
    wanted = labels.select("column_name", "label", F.col("n").cast("bigint"), F.col("label_id").cast("bigint"))
    return make_profile(statistics.sparkSession, spec, stats.orderBy("ordinal").collect(), lambda: label_table_of(wanted))


def import_stats_text(lines: DataFrame, prefix: str, line: str = "value") -> DataFrame:
    """``<prefix>.<statistic>.<column>=<value>`` lines to (column_name, statistic, value).

    Blank lines are skipped and an empty value is NULL; any other line, or a value that is no number, is an error.
    """
    pattern = "^" + prefix.replace(".", r"\.") + r"\.([A-Za-z]+)\.([^=]+)=(.*)$"
    c = F.trim(F.col(line))
    value = F.nullif(F.trim(F.regexp_extract(c, pattern, 3)), F.lit(""))
    fits = c.rlike(pattern) & (value.isNull() | value.try_cast("double").isNotNull())
    problem = F.raise_error(F.concat(F.lit("not a statistics line: "), c)).cast("string")
    return lines.filter(F.length(c) > 0).select(
        F.when(fits, F.trim(F.regexp_extract(c, pattern, 2))).otherwise(problem).alias("column_name"),
        F.regexp_extract(c, pattern, 1).alias("statistic"),
        value.try_cast("double").alias("value"),
    )


def import_labels_text(lines: DataFrame, line: str = "value") -> DataFrame:
    """``id,label,count`` lines to (label, label_id, n); a label may hold commas.

    Blank lines are skipped; any other line is an error.
    """
    pattern = r"^\s*(\d{1,18})\s*,(.*),\s*(\d{1,18})\s*$"
    c = F.col(line)
    problem = F.raise_error(F.concat(F.lit("not a label line: "), c)).cast("string")
    return lines.filter(F.trim(c) != "").select(
        F.when(c.rlike(pattern), F.trim(F.regexp_extract(c, pattern, 2))).otherwise(problem).alias("label"),
        F.regexp_extract(c, pattern, 1).try_cast("bigint").alias("label_id"),
        F.regexp_extract(c, pattern, 3).try_cast("bigint").alias("n"),
    )
