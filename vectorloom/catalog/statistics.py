"""Queries A1–A14: statistics, label dictionaries and their merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.catalog.base import as_line, register, rounded, table
from vectorloom.catalog.vectors import LINE_POSITION, LINE_POSITION_SQL, LINE_SPEC, labels_sql, line_profile, lineitem, only
from vectorloom.operators import profile as pr
from vectorloom.operators.dictionary import style_dictionary, style_statistics
from vectorloom.operators.sequences import corpus_stats
from vectorloom.session import scratch_path
from vectorloom.sources.delimited import read_delimited
from vectorloom.streaming.profile import ProfileStore, profile_stream

NUMERIC_COLUMNS = [c.name for c in LINE_SPEC.numeric]
NOMINAL_COLUMNS = [c.name for c in LINE_SPEC.nominal]
SPLIT_DATE = "1998-07-01"

STATS_SQL = "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, CAST(min({c}) AS DOUBLE) AS min,
        CAST(max({c}) AS DOUBLE) AS max, round(CAST(sum({c}) AS DOUBLE), 2) AS sum,
        CASE WHEN avg({c}) < 1 THEN round(avg({c}), 9) ELSE round(avg({c}), 5) END AS avg, CASE WHEN var_pop({c}) < 1 THEN round(var_pop({c}), 8) ELSE round(var_pop({c}), 2) END AS variance, round(stddev_pop({c}), 6) AS stddev
    FROM lineitem"""
    for c in NUMERIC_COLUMNS
) + ")"


def line_labels_sql(column: str, where: str = "TRUE") -> str:
    return f"""SELECT '{column}' AS column_name, {column} AS label, count(*) AS n,
        min({LINE_POSITION_SQL}) AS first_at FROM lineitem WHERE {where} GROUP BY 2"""


LABELS_SQL = """SELECT column_name, label, n,
      row_number() OVER (PARTITION BY column_name ORDER BY first_at, label) - 1 AS label_id
    FROM (""" + " UNION ALL ".join(line_labels_sql(c) for c in NOMINAL_COLUMNS) + ")"
BALANCE_SQL = f"""SELECT column_name, label, label_id, n,
      CAST(sum(n) OVER (PARTITION BY column_name) AS BIGINT) AS total_labels,
      (SELECT count(*) FROM lineitem) AS values_seen,
      round(n / sum(n) OVER (PARTITION BY column_name), 6) AS share
    FROM ({LABELS_SQL}) WHERE column_name"""


def line_stats(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    stats = pr.column_stats(lineitem(spark, sf_dir), LINE_SPEC, wanted).filter("kind = 'NUMERIC'")
    return presentable(stats).select("column_name", *wanted)


def presentable(stats: DataFrame) -> DataFrame:
    out = rounded(stats, 2, "sum")
    # engines add in different orders, so large figures agree to fewer decimals than small ones
    avg = F.when(F.col("avg") < 1, F.round("avg", 9)).otherwise(F.round("avg", 5))
    variance = F.when(F.col("variance") < 1, F.round("variance", 8)).otherwise(F.round("variance", 2))
    return rounded(out, 6, "stddev").withColumns({"avg": avg, "variance": variance})


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The table before a ship date, and from it on."""
    lines, date = lineitem(spark, sf_dir), F.lit(SPLIT_DATE).cast("timestamp_ntz")
    return lines.filter(F.col("l_shipdate") < date), lines.filter(F.col("l_shipdate") >= date)


@register("a1_numeric_profile", f"SELECT column_name, n, min, max, sum FROM ({STATS_SQL})")
def numeric_profile(spark, sf_dir):
    return rounded(pr.numeric_profile(lineitem(spark, sf_dir), LINE_SPEC), 2, "sum")


@register("a2_mean", f"SELECT column_name, avg FROM ({STATS_SQL})")
def mean(spark, sf_dir):
    return line_stats(spark, sf_dir, "avg")


@register("a3_variance_stddev", f"SELECT column_name, variance, stddev FROM ({STATS_SQL})")
def variance_stddev(spark, sf_dir):
    return line_stats(spark, sf_dir, "variance", "stddev")


@register("a4_label_dictionary", LABELS_SQL)
def label_dictionary(spark, sf_dir):
    return pr.label_dictionary(lineitem(spark, sf_dir), LINE_SPEC, LINE_POSITION)


@register("a6_merge_profiles", f"SELECT column_name, n, min, max, sum, avg FROM ({STATS_SQL})")
def merge_profiles(spark, sf_dir):
    parts = [pr.fit_profile(half, LINE_SPEC, LINE_POSITION) for half in halves(spark, sf_dir)]
    merged = pr.merge_profiles(parts).stats.filter("kind = 'NUMERIC'")
    return presentable(merged).select("column_name", "n", "min", "max", "sum", "avg")


@register(
    "a6_merge_labels",
    f"""WITH l AS ({" UNION ALL ".join(
        f"SELECT {part} AS part, * FROM ({line_labels_sql(c, f'l_shipdate {op} DATE ' + repr(SPLIT_DATE))})"
        for c in NOMINAL_COLUMNS for part, op in ((0, "<"), (1, ">="))
    )}),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY part, column_name ORDER BY first_at, label) AS rn FROM l),
    merged AS (
      SELECT column_name, label, CAST(sum(n) AS BIGINT) AS n, min(part * 1000000 + rn) AS place
      FROM numbered GROUP BY 1, 2)
    SELECT column_name, label, n, row_number() OVER (PARTITION BY column_name ORDER BY place) - 1 AS label_id
    FROM merged""",
)
def merge_labels(spark, sf_dir):
    """Labels of the later half are appended to those of the earlier one."""
    tables = [pr.label_table(half, LINE_SPEC.nominal, LINE_POSITION) for half in halves(spark, sf_dir)]
    return pr.merge_labels(tables).rows.select(*pr.LABEL_COLUMNS)


@register(
    "a6_stream_profile",
    f"""SELECT column_name, n, min, max, sum, variance, stddev,
           CAST(NULL AS VARCHAR) AS label, CAST(NULL AS BIGINT) AS label_id, CAST(NULL AS BIGINT) AS label_n
    FROM ({STATS_SQL})
    UNION ALL
    SELECT column_name, (SELECT count(*) FROM lineitem), NULL, NULL, NULL, NULL, NULL, label, label_id, n
    FROM ({LABELS_SQL})""",
)
def stream_profile(spark, sf_dir):
    """Lines arrive in three parts, in order of their keys; a stream profiles each as it comes."""
    folder, state, checkpoint = (scratch_path(spark, name) for name in ("lines", "stream-profile", "stream-state"))
    store = ProfileStore(spark, state, LINE_SPEC, ["order_number", "l_linenumber"], merge_every=2)
    source = table(spark, sf_dir, "lineitem")
    line = F.concat_ws("\t", as_line(*LINE_SPEC.names), F.col("l_linenumber").cast("string"))
    borders = [float("-inf"), *source.approxQuantile("l_orderkey", [0.3, 0.7], 0.05), float("inf")]
    for low, high in zip(borders, borders[1:]):
        part = source.filter((F.col("l_orderkey") > low) & (F.col("l_orderkey") <= high))
        part.select(line.alias("value")).write.mode("append").text(folder)
        lines = spark.readStream.text(folder)
        number = F.split_part("value", F.lit("\t"), F.lit(2)).cast("int").alias("l_linenumber")
        fields = F.split_part("value", F.lit("\t"), F.lit(1)).alias("value")
        rows = read_delimited(lines.select(fields, number), LINE_SPEC, keep=("l_linenumber",))
        # the order key is a number for the position, and text like every other field for the profile
        rows = rows.withColumn("order_number", F.col("l_orderkey").cast("bigint"))
        profile_stream(rows, store, checkpoint, availableNow=True).awaitTermination()
    report = pr.statistics_report(store.profile())
    return presentable(report).drop("ordinal", "kind", "transform", "n_invalid", "m2", "avg")


@register("a7_merge_derived", f"SELECT column_name, variance, stddev FROM ({STATS_SQL})")
def merge_derived(spark, sf_dir):
    """Squared deviations of the halves, moved to the common mean."""
    merged = pr.merge_stats([pr.column_stats(half, LINE_SPEC) for half in halves(spark, sf_dir)])
    return presentable(merged.filter("kind = 'NUMERIC'")).select("column_name", "variance", "stddev")


@register("a8_class_balance", BALANCE_SQL + " = 'l_returnflag'")
def class_balance(spark, sf_dir):
    return rounded(pr.class_balance(line_profile(spark, sf_dir)[1]), 6, "share")


@register("a9_category_balance", BALANCE_SQL + " <> 'l_returnflag'")
def category_balance(spark, sf_dir):
    return rounded(pr.category_balance(line_profile(spark, sf_dir)[1]), 6, "share")


@register(
    "a10_dataset_statistics_report",
    f"""SELECT column_name, n, min, max, sum, avg, variance, stddev,
           CAST(NULL AS VARCHAR) AS label, CAST(NULL AS BIGINT) AS label_id, CAST(NULL AS BIGINT) AS label_n
    FROM ({STATS_SQL})
    UNION ALL
    SELECT column_name, (SELECT count(*) FROM lineitem), NULL, NULL, NULL, NULL, NULL, NULL, label, label_id, n
    FROM ({LABELS_SQL})""",
)
def statistics_report(spark, sf_dir):
    report = pr.statistics_report(line_profile(spark, sf_dir)[1])
    return presentable(report).drop("ordinal", "kind", "transform", "n_invalid", "m2")


@register(
    "a11_label_count",
    f"""SELECT w.column_name, w.label, coalesce(l.n, 0) AS n
    FROM (VALUES ('l_returnflag', 'A'), ('l_returnflag', 'Z'), ('l_linestatus', 'O')) AS w(column_name, label)
    LEFT JOIN ({LABELS_SQL}) l USING (column_name, label)""",
)
def label_count(spark, sf_dir):
    labels = pr.label_dictionary(lineitem(spark, sf_dir), LINE_SPEC, LINE_POSITION)
    return pr.label_count(labels, [("l_returnflag", "A"), ("l_returnflag", "Z"), ("l_linestatus", "O")])


@register(
    "a12_invalid_entry_count",
    """WITH v AS (SELECT CASE WHEN p_size > 40 THEN p_type WHEN p_size > 30 THEN 'NaN'
                         ELSE p_size::VARCHAR END AS a, p_name AS b, p_retailprice::VARCHAR AS c FROM part),
    u AS (SELECT 'mixed' AS column_name, a AS v FROM v UNION ALL SELECT 'words', b FROM v
          UNION ALL SELECT 'numbers', c FROM v)
    SELECT column_name, count(*) FILTER (ok) AS n, count(*) FILTER (NOT ok) AS n_invalid
    FROM (SELECT column_name, coalesce(NOT isnan(TRY_CAST(v AS DOUBLE)), FALSE) AS ok FROM u) GROUP BY 1""",
)
def invalid_entry_count(spark, sf_dir):
    size = F.col("p_size")
    mixed = F.when(size > 40, F.col("p_type")).when(size > 30, F.lit("NaN")).otherwise(size.cast("string"))
    raw = table(spark, sf_dir, "part").select(
        mixed.alias("mixed"), F.col("p_name").alias("words"), F.col("p_retailprice").cast("string").alias("numbers")
    )
    spec = only(("mixed", "NUMERIC", "COPY"), ("words", "NUMERIC", "COPY"), ("numbers", "NUMERIC", "COPY"))
    return pr.invalid_entry_count(raw, spec)


@register(
    "a13_corpus_stats",
    """SELECT count(*) AS n_all, count(*) FILTER (length(text) >= 1) AS n_nonempty,
           CAST(max(length(text)) AS BIGINT) AS max_length FROM documents""",
)
def corpus(spark, sf_dir):
    return corpus_stats(table(spark, sf_dir, "documents"), "text")


@register(
    "a14_style_statistics",
    f"""WITH {labels_sql("d", "part", "lower(trim(p_type))", "p_partkey")}
    SELECT label AS style_key, k AS style_index, n, (SELECT count(*) FROM d) AS total_styles FROM d""",
)
def styles(spark, sf_dir):
    return style_statistics(style_dictionary(table(spark, sf_dir, "part"), "p_type", ["p_partkey"]))
