"""Column statistics, label dictionaries, and their merge."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorloom.functions import numeric as fn
from vectorloom.operators.lookup import Size, row_bytes
from vectorloom.operators.numbering import number_rows, order_value
from vectorloom.plans.spec import ColumnSpec, FeatureSpec, Kind, Transform

STATS_SCHEMA = T.StructType(
    [
        T.StructField("column_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("transform", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("n_invalid", T.LongType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("sum", T.DoubleType()),
        T.StructField("avg", T.DoubleType()),
        T.StructField("m2", T.DoubleType()),
        T.StructField("variance", T.DoubleType()),
        T.StructField("stddev", T.DoubleType()),
    ]
)
LABEL_COLUMNS = ["column_name", "label", "label_id", "n"]
LABEL_SCHEMA = "column_name string, label string, n bigint, label_id bigint"


def typed_column(df: DataFrame, column: ColumnSpec) -> Column:
    """The value a spec column contributes: a double, or trimmed text."""
    raw = F.col(f"`{column.name}`")
    dtype = df.schema[column.name].dataType
    if column.kind is Kind.NOMINAL:
        return fn.label_value(raw)
    if isinstance(dtype, T.StringType):
        return fn.number_value(raw)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(raw.cast("double"), F.lit(None).cast("double"))
    return raw.cast("double")


def present_value(df: DataFrame, column: ColumnSpec) -> Column:
    """Not NULL where a value is present, whether or not it is a number."""
    raw = F.col(f"`{column.name}`")
    if isinstance(df.schema[column.name].dataType, T.StringType):
        return fn.has_content(raw)
    return raw


def _stats_struct(column: ColumnSpec, i: int, wanted: Collection[str]) -> Column:
    """Aggregates over the projected value x{i}; repeated ones are computed once, unwanted ones are NULL."""
    x = f"x{i}"
    values = {
        "column_name": "'" + column.name.replace("\\", "\\\\").replace("'", "\\'") + "'",
        "ordinal": str(i),
        "kind": f"'{column.kind.value}'",
        "transform": f"'{column.transform.value}'",
        "n": f"count({x})",
    }
    if column.kind is Kind.NUMERIC:
        # one central-moment buffer per column; the other moments follow from it
        values |= {
            "n_invalid": f"count(present{i}) - count({x})",
            "min": f"min({x})",
            "max": f"max({x})",
            "sum": f"sum({x})",
            "avg": f"try_divide(sum({x}), count({x}))",
            "m2": f"var_pop({x}) * count({x})",
            "variance": f"var_pop({x})",
            "stddev": f"sqrt(var_pop({x}))",
        }
    always = ("column_name", "ordinal", "kind", "transform")
    values = {name: value for name, value in values.items() if name in wanted or name in always}
    fields = [f"'{f.name}', cast({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()})" for f in STATS_SCHEMA]
    return F.expr(f"named_struct({', '.join(fields)})")


def column_stats(df: DataFrame, spec: FeatureSpec, wanted: Collection[str] = STATS_SCHEMA.names) -> DataFrame:
    """One row of statistics per spec column, by a single aggregate over one scan.

    Every column is covered, SKIP included; variance is the population variance. Only the statistics
    in ``wanted`` are computed.
    """
    typed = df.select(
        *[typed_column(df, c).alias(f"x{i}") for i, c in enumerate(spec.columns)],
        *[present_value(df, c).alias(f"present{i}") for i, c in enumerate(spec.columns) if c.kind is Kind.NUMERIC],
    )
    rows = [_stats_struct(c, i, wanted) for i, c in enumerate(spec.columns)]
    return typed.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def numeric_profile(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Count, minimum, maximum and sum of every NUMERIC column."""
    wanted = ("n", "min", "max", "sum")
    return column_stats(df, spec, wanted).filter(F.col("kind") == Kind.NUMERIC.value).select("column_name", *wanted)


def invalid_entry_count(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Per NUMERIC column: values that parse and values that do not."""
    wanted = ("n", "n_invalid")
    return column_stats(df, spec, wanted).filter(F.col("kind") == Kind.NUMERIC.value).select("column_name", *wanted)


def nominal_values(df: DataFrame, columns: list[ColumnSpec]) -> Column:
    """One row per NOMINAL column: ``column_name`` and ``label``."""
    cells = [cell for c in columns for cell in (F.lit(c.name), typed_column(df, c))]
    return F.stack(F.lit(len(columns)), *cells).alias("column_name", "label")


def label_counts(df: DataFrame, columns: list[ColumnSpec], position: list[str]) -> DataFrame:
    """Distinct values of the NOMINAL columns with their count and first position.

    ``position`` lists the columns that put the rows in order. All columns share one scan; rows are combined
    before the shuffle, so a label held by most of the table arrives as one row per task.
    """
    return (
        df.select(order_value(df, position).alias("at"), nominal_values(df, columns))
        .filter(F.col("label").isNotNull())
        .groupBy("column_name", "label")
        .agg(F.count("*").alias("n"), F.min("at").alias("first_at"))
    )


@dataclass(frozen=True)
class LabelTable:
    """Numbered labels of several columns, with the size of each column's part."""

    rows: DataFrame
    sizes: dict[str, Size]

    def of(self, column: str) -> DataFrame:
        return self.rows.filter(F.col("column_name") == column)


def number_labels(counts: DataFrame) -> LabelTable:
    """Give each column's labels 0-based ids in order of ``first_at`` (ties by label)."""
    numbered = number_rows(counts, ["column_name", "first_at", "label"]).rows
    per_column = numbered.groupBy("column_name").agg(
        F.min("pos").alias("start"),
        F.count("*").alias("rows"),
        F.sum(row_bytes(counts.drop("first_at").schema)).alias("bytes"),
    )
    # one row per spec column
    found = per_column.collect()
    start = reduce(
        lambda chain, r: chain.when(F.col("column_name") == r["column_name"], F.lit(r["start"])),
        found,
        F.when(F.lit(False), F.lit(0)),
    )
    rows = numbered.withColumn("label_id", F.col("pos") - start).drop("pos", "first_at")
    return LabelTable(rows, {r["column_name"]: Size(r["rows"], r["bytes"]) for r in found})


def label_table(df: DataFrame, columns: list[ColumnSpec], position: list[str]) -> LabelTable:
    return number_labels(label_counts(df, columns, position))


def label_dictionary(df: DataFrame, spec: FeatureSpec, position: list[str]) -> DataFrame:
    """Label, 0-based id in first-seen order and count, for every NOMINAL column."""
    return label_table(df, spec.nominal, position).rows.select(*LABEL_COLUMNS)


@dataclass(frozen=True)
class ColumnStats:
    n: int
    low: float | None
    high: float | None
    avg: float | None
    stddev: float | None


@dataclass(frozen=True)
class Profile:
    """Statistics and label dictionaries of one dataset; a value, never updated."""

    spec: FeatureSpec
    stats: DataFrame
    find_labels: Callable[[], LabelTable] = field(repr=False)
    by_column: dict[str, ColumnStats] = field(repr=False)

    @cached_property
    def labels(self) -> LabelTable:
        return self.find_labels()

    def n_labels(self, column: str) -> int:
        size = self.labels.sizes.get(column)
        return size.rows if size else 0


def make_profile(
    spark: SparkSession, spec: FeatureSpec, stats_rows: list, labels: Callable[[], LabelTable]
) -> Profile:
    return Profile(
        spec,
        spark.createDataFrame(stats_rows, STATS_SCHEMA),
        labels,
        {r["column_name"]: ColumnStats(r["n"], r["min"], r["max"], r["avg"], r["stddev"]) for r in stats_rows},
    )


def empty_labels(spark: SparkSession) -> LabelTable:
    return LabelTable(spark.createDataFrame([], LABEL_SCHEMA), {})


def fit_profile(df: DataFrame, spec: FeatureSpec, position: list[str], skipped_labels: bool = False) -> Profile:
    """Profile a table. Only the statistics rows, one per column, reach the driver.

    Labels are counted when they are first asked for; those of SKIP columns only with ``skipped_labels``.
    """
    spark = df.sparkSession
    columns = [c for c in spec.nominal if skipped_labels or c.transform is not Transform.SKIP]

    def labels() -> LabelTable:
        return label_table(df, columns, position) if columns else empty_labels(spark)

    return make_profile(spark, spec, column_stats(df, spec).collect(), labels)


def merge_stats(parts: list[DataFrame]) -> DataFrame:
    """Merge statistics tables of disjoint parts into the statistics of the whole.

    Squared deviations are moved to the common mean before they are added.
    """
    every_column = Window.partitionBy("column_name")
    whole_mean = F.sum("sum").over(every_column) / F.nullif(F.sum("n").over(every_column), F.lit(0))
    moved = reduce(DataFrame.unionByName, parts).withColumn(
        "m2", F.col("m2") + F.col("n") * F.pow(F.col("avg") - whole_mean, 2)
    )
    merged = moved.groupBy("column_name", "ordinal", "kind", "transform").agg(
        F.sum("n").alias("n"),
        F.sum("n_invalid").alias("n_invalid"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.sum("sum").alias("sum"),
        F.sum("m2").alias("m2"),
    )
    count = F.nullif(F.col("n"), F.lit(0))
    return (
        merged.withColumn("avg", F.col("sum") / count)
        .withColumn("variance", F.col("m2") / count)
        .withColumn("stddev", F.sqrt("variance"))
        .select(*STATS_SCHEMA.names)
    )


def merge_labels(parts: list[LabelTable]) -> LabelTable:
    """Merge label tables in the given order: known labels keep their id, new ones follow."""
    ordered = [
        part.rows.select("column_name", "label", "n", F.lit(i).alias("part"), "label_id")
        for i, part in enumerate(parts)
    ]
    largest = max((s.rows for part in parts for s in part.sizes.values()), default=1)
    counts = (
        reduce(DataFrame.unionByName, ordered)
        .groupBy("column_name", "label")
        .agg(F.sum("n").alias("n"), F.min(F.col("part") * F.lit(largest) + F.col("label_id")).alias("first_at"))
    )
    return number_labels(counts)


def merge_profiles(parts: list[Profile]) -> Profile:
    spark = parts[0].stats.sparkSession
    stats = merge_stats([p.stats for p in parts]).collect()
    return make_profile(spark, parts[0].spec, stats, lambda: merge_labels([p.labels for p in parts]))


def balance(labels: DataFrame, stats: DataFrame) -> DataFrame:
    """Per label: id, count, total over the column, share, and values seen.

    ``total_labels`` counts labelled rows; ``values_seen`` is the column's own count.
    """
    totals = labels.groupBy("column_name").agg(F.sum("n").alias("total_labels"))
    # both right sides hold one row per spec column
    return (
        labels.select(*LABEL_COLUMNS)
        .join(F.broadcast(totals), "column_name")
        .join(F.broadcast(stats.select("column_name", F.col("n").alias("values_seen"))), "column_name")
        .withColumn("share", F.col("n") / F.col("total_labels"))
    )


def class_balance(profile: Profile, *, label_column: bool = True) -> DataFrame:
    """Balance of the LABEL columns, or of all other NOMINAL columns."""
    wanted = [c.name for c in profile.spec.nominal if (c.transform is Transform.LABEL) == label_column]
    return balance(profile.labels.rows.filter(F.col("column_name").isin(wanted)), profile.stats)


def category_balance(profile: Profile) -> DataFrame:
    return class_balance(profile, label_column=False)


def statistics_report(profile: Profile) -> DataFrame:
    """Statistics of every column; NOMINAL columns repeat once per label."""
    labels = profile.labels.rows.select("column_name", "label", "label_id", F.col("n").alias("label_n"))
    # stats hold one row per spec column, so the labels stay where they are
    labelled = labels.join(F.broadcast(profile.stats), "column_name")
    others = profile.stats.filter(~F.col("column_name").isin(list(profile.labels.sizes)))
    return labelled.unionByName(others, allowMissingColumns=True).select(
        *STATS_SCHEMA.names, "label", "label_id", "label_n"
    )


def label_count(labels: DataFrame, wanted: list[tuple[str, str]]) -> DataFrame:
    """Count of each (column, label) in ``wanted``, 0 when the dictionary lacks it."""
    asked = labels.sparkSession.createDataFrame(wanted, "column_name string, label string")
    found = labels.join(F.broadcast(asked), ["column_name", "label"], "left_semi").select(
        "column_name", "label", "n"
    )
    return asked.join(found, ["column_name", "label"], "left").select(
        "column_name", "label", F.coalesce("n", F.lit(0)).alias("n")
    )
