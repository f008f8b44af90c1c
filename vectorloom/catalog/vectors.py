"""Queries T1–T17: applying and assembling features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.catalog.base import as_line, register, rounded, table
from vectorloom.operators.profile import Profile, fit_profile
from vectorloom.operators.vectorize import (
    apply_profile,
    assemble_plain,
    sparse_entries,
    unseen_label_audit,
    vectorize,
)
from vectorloom.plans.spec import FeatureSpec, make_spec
from vectorloom.sources.delimited import read_delimited

LINE_KEY = ("order_key", "l_linenumber", "l_partkey", "l_suppkey")
LINE_SPEC = make_spec(
    "lineitem",
    ",",
    ("l_orderkey", "NUMERIC", "UNIQUE_ID"),
    ("l_quantity", "NUMERIC", "NORMALIZE"),
    ("l_extendedprice", "NUMERIC", "ZEROMEAN_ZEROUNITVARIANCE"),
    ("l_returnflag", "NOMINAL", "LABEL"),
    ("l_discount", "NUMERIC", "BINARIZE"),
    ("l_tax", "NUMERIC", "SKIP"),
    ("l_linestatus", "NOMINAL", "NORMALIZE"),
)
LINE_POSITION = ["l_orderkey", "l_linenumber"]
LINE_POSITION_SQL = "row(l_orderkey, l_linenumber)"
KEY_SQL = "order_key, l_linenumber, l_partkey, l_suppkey"


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with its order key under a second name, since the spec transforms the first."""
    return table(spark, sf_dir, "lineitem").withColumn("order_key", F.col("l_orderkey"))


def only(*columns: tuple[str, str, str]) -> FeatureSpec:
    return make_spec("table", ",", *columns)


def labels_sql(name: str, source: str, column: str, position: str) -> str:
    """CTE with the 0-based label ids of a column in first-seen order."""
    return f"""{name} AS (
      SELECT label, n, row_number() OVER (ORDER BY first_at, label) - 1 AS k FROM (
        SELECT {column} AS label, count(*) AS n, min({position}) AS first_at FROM {source}
        WHERE {column} IS NOT NULL GROUP BY 1))"""


LINES_SQL = "li AS (SELECT *, l_orderkey AS order_key FROM lineitem)"
LINE_STATS_SQL = """s AS (
      SELECT min(l_quantity) AS q_lo, max(l_quantity) AS q_hi, avg(l_extendedprice) AS p_avg,
             stddev_pop(l_extendedprice) AS p_sd, min(l_discount) AS d_lo, max(l_discount) AS d_hi
      FROM lineitem)"""
FLAG_SQL = labels_sql("flags", "lineitem", "l_returnflag", LINE_POSITION_SQL)
STATUS_SQL = labels_sql("statuses", "lineitem", "l_linestatus", LINE_POSITION_SQL)
LINE_FEATURES_SQL = f"""WITH {LINES_SQL}, {LINE_STATS_SQL}, {FLAG_SQL}, {STATUS_SQL},
    f AS (
      SELECT {KEY_SQL}, CAST(l_orderkey AS DOUBLE) AS f_key,
             round((l_quantity - q_lo) / (q_hi - q_lo), 6) AS f_quantity,
             round((l_extendedprice - p_avg) / (p_sd + 1e-6), 6) AS f_price,
             l_extendedprice > p_avg AS price_above,
             CASE WHEN l_discount < (d_hi - d_lo) / 2 + d_lo THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS f_discount,
             (statuses.k + 1) / (SELECT count(*) FROM statuses)::DOUBLE AS f_status,
             CAST(flags.k AS DOUBLE) AS label
      FROM li CROSS JOIN s
      LEFT JOIN flags ON flags.label = l_returnflag
      LEFT JOIN statuses ON statuses.label = l_linestatus)
"""


def line_profile(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Profile]:
    lines = lineitem(spark, sf_dir)
    return lines, fit_profile(lines, LINE_SPEC, LINE_POSITION)


def lineitem_feature(spark: SparkSession, sf_dir: str, *columns: tuple[str, str, str]) -> DataFrame:
    lines = lineitem(spark, sf_dir)
    return apply_profile(lines, fit_profile(lines, only(*columns), LINE_POSITION), keep=LINE_KEY)


@register("t1_copy_numeric", f"WITH {LINES_SQL} SELECT {KEY_SQL}, l_extendedprice FROM li")
def copy_numeric(spark, sf_dir):
    return lineitem_feature(spark, sf_dir, ("l_extendedprice", "NUMERIC", "COPY"))


@register(
    "t2_copy_nominal",
    f"""WITH {labels_sql("p", "orders", "o_orderpriority", "o_orderkey")}
    SELECT o_orderkey, CAST(k AS DOUBLE) AS o_orderpriority
    FROM orders LEFT JOIN p ON p.label = o_orderpriority""",
)
def copy_nominal(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    spec = only(("o_orderpriority", "NOMINAL", "COPY"))
    return apply_profile(orders, fit_profile(orders, spec, ["o_orderkey"]), keep=("o_orderkey",))


@register(
    "t3_unique_id",
    f"""WITH {labels_sql("names", "customer", "c_name", "c_custkey")}
    SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, CAST(k AS DOUBLE) AS c_name, c_nationkey
    FROM customer LEFT JOIN names ON names.label = c_name""",
)
def unique_id(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    spec = only(("c_custkey", "NUMERIC", "UNIQUE_ID"), ("c_name", "NOMINAL", "UNIQUE_ID"))
    return apply_profile(customers, fit_profile(customers, spec, ["c_custkey"]), keep=("c_nationkey",))


@register(
    "t4_skip",
    f"""WITH {LINES_SQL}
    SELECT {KEY_SQL}, l_discount, (SELECT max(l_tax) FROM lineitem) AS skipped_max FROM li""",
)
def skip(spark, sf_dir):
    """The skipped column is profiled but not emitted."""
    lines = lineitem(spark, sf_dir)
    spec = only(("l_discount", "NUMERIC", "COPY"), ("l_tax", "NUMERIC", "SKIP"))
    profile = fit_profile(lines, spec, LINE_POSITION)
    emitted = apply_profile(lines, profile, keep=LINE_KEY)
    return emitted.withColumn("skipped_max", F.lit(profile.by_column["l_tax"].high))


@register("t5_label_numeric", "SELECT o_orderkey, o_totalprice AS label FROM orders")
def label_numeric(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    spec = only(("o_totalprice", "NUMERIC", "LABEL"))
    out = apply_profile(orders, fit_profile(orders, spec, ["o_orderkey"]), keep=("o_orderkey",))
    return assemble_plain(out, spec, ("o_orderkey",)).drop("features")


@register("t6_label_nominal", LINE_FEATURES_SQL + f"SELECT {KEY_SQL}, label FROM f")
def label_nominal(spark, sf_dir):
    out = lineitem_feature(spark, sf_dir, ("l_returnflag", "NOMINAL", "LABEL"))
    return out.withColumnRenamed("l_returnflag", "label")


@register("t7_binarize", LINE_FEATURES_SQL + f"SELECT {KEY_SQL}, f_discount AS l_discount FROM f")
def binarize(spark, sf_dir):
    return lineitem_feature(spark, sf_dir, ("l_discount", "NUMERIC", "BINARIZE"))


@register("t8_normalize_numeric", LINE_FEATURES_SQL + f"SELECT {KEY_SQL}, f_quantity AS l_quantity FROM f")
def normalize_numeric(spark, sf_dir):
    return rounded(lineitem_feature(spark, sf_dir, ("l_quantity", "NUMERIC", "NORMALIZE")), 6, "l_quantity")


@register("t9_normalize_nominal", LINE_FEATURES_SQL + f"SELECT {KEY_SQL}, f_status AS l_linestatus FROM f")
def normalize_nominal(spark, sf_dir):
    return lineitem_feature(spark, sf_dir, ("l_linestatus", "NOMINAL", "NORMALIZE"))


@register("t10_standardize_numeric", LINE_FEATURES_SQL + f"SELECT {KEY_SQL}, f_price AS l_extendedprice FROM f")
def standardize_numeric(spark, sf_dir):
    out = lineitem_feature(spark, sf_dir, ("l_extendedprice", "NUMERIC", "ZEROMEAN_ZEROUNITVARIANCE"))
    return rounded(out, 6, "l_extendedprice")


@register(
    "t11_standardize_nominal",
    f"""WITH {labels_sql("b", "part", "p_brand", "p_partkey")}
    SELECT p_partkey, round((k + 1) / (SELECT count(*) FROM b)::DOUBLE, 6) AS p_brand
    FROM part LEFT JOIN b ON b.label = p_brand""",
)
def standardize_nominal(spark, sf_dir):
    """A category has no mean, so it falls back to its normalized id."""
    parts = table(spark, sf_dir, "part")
    spec = only(("p_brand", "NOMINAL", "ZEROMEAN_ZEROUNITVARIANCE"))
    out = apply_profile(parts, fit_profile(parts, spec, ["p_partkey"]), keep=("p_partkey",))
    return rounded(out, 6, "p_brand")


@register(
    "t12_strip_quotes",
    f"""WITH {labels_sql("t", "part", "p_type", "p_partkey")}
    SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, CAST(k AS DOUBLE) AS p_type
    FROM part LEFT JOIN t ON t.label = p_type""",
)
def strip_quotes(spark, sf_dir):
    """Quoted text fields, as a quoting writer would leave them."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        *[F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')).alias(c) for c in ("p_size", "p_type")],
    )
    spec = only(("p_size", "NUMERIC", "COPY"), ("p_type", "NOMINAL", "COPY"))
    return apply_profile(parts, fit_profile(parts, spec, ["p_partkey"]), keep=("p_partkey",))


def _plain_columns(df: DataFrame) -> DataFrame:
    names = ("f_key", "f_quantity", "f_price", "f_discount", "f_status")
    keys = [k for k in LINE_KEY if k in df.columns]
    out = df.select(*keys, *[F.col("features")[i].alias(n) for i, n in enumerate(names)], "label")
    return rounded(out, 6, "f_quantity", "f_price")


@register("t14_assemble_plain", LINE_FEATURES_SQL + "SELECT * EXCLUDE (price_above) FROM f")
def plain(spark, sf_dir):
    lines, profile = line_profile(spark, sf_dir)
    return _plain_columns(assemble_plain(apply_profile(lines, profile, keep=LINE_KEY), LINE_SPEC, LINE_KEY))


@register(
    "t15_assemble_sparse",
    LINE_FEATURES_SQL
    + f"""SELECT {KEY_SQL}, label, nullif(f_key, 0) AS s1, nullif(f_quantity, 0) AS s2, f_price AS s3,
           nullif(f_discount, 0) AS s4, f_status AS s5,
           CASE WHEN f_key > 0 THEN f_key END AS c1, CASE WHEN f_quantity > 0 THEN f_quantity END AS c2,
           CASE WHEN price_above THEN f_price END AS c3, CAST(NULL AS DOUBLE) AS c4,
           CASE WHEN f_discount > 0 THEN f_discount END AS c5, f_status AS c6
    FROM f""",
)
def sparse(spark, sf_dir):
    """Contiguous indices (s1…), and the compat form (c1…) that skips the label's index and negatives."""
    lines, profile = line_profile(spark, sf_dir)
    out = apply_profile(lines, profile, keep=LINE_KEY).select(
        *LINE_KEY,
        F.col("l_returnflag").alias("label"),
        F.map_from_entries(sparse_entries(LINE_SPEC)).alias("s"),
        F.map_from_entries(sparse_entries(LINE_SPEC, compat=True)).alias("c"),
    )
    wide = out.select(
        *LINE_KEY,
        "label",
        *[F.col("s")[i].alias(f"s{i}") for i in range(1, 6)],
        *[F.col("c")[i].alias(f"c{i}") for i in range(1, 7)],
    )
    return rounded(wide, 6, "s2", "s3", "c2", "c3")


@register("t16_vectorize", LINE_FEATURES_SQL + "SELECT * EXCLUDE (order_key, price_above) FROM f")
def vectorize_lines(spark, sf_dir):
    """From text lines to features: parse, profile, apply, assemble."""
    lines = lineitem(spark, sf_dir).select(*LINE_KEY[1:], as_line(*LINE_SPEC.names).alias("value"))
    parsed = read_delimited(lines, LINE_SPEC, keep=LINE_KEY[1:]).withColumn("order", F.col("l_orderkey").cast("bigint"))
    return _plain_columns(vectorize(parsed, LINE_SPEC, ["order", "l_linenumber"], LINE_KEY[1:], costly=True))


@register(
    "t17_unseen_label_audit",
    """WITH known AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1996-07-01'),
    v AS (
      SELECT 'o_custkey' AS column_name, o_custkey::VARCHAR AS label,
             o_custkey IN (SELECT o_custkey FROM known) AS seen FROM orders
      UNION ALL
      SELECT 'o_orderpriority', o_orderpriority, o_orderpriority IN (SELECT o_orderpriority FROM known) FROM orders)
    SELECT column_name, count(*) AS n_values, count(*) FILTER (NOT seen) AS n_missed,
           count(DISTINCT CASE WHEN NOT seen THEN label END) AS n_missed_labels
    FROM v GROUP BY 1""",
)
def unseen_labels(spark, sf_dir):
    """Dictionary from the orders before a date, audited against all orders."""
    orders = table(spark, sf_dir, "orders")
    known = orders.filter(F.col("o_orderdate") < F.lit("1996-07-01").cast("timestamp_ntz"))
    spec = only(("o_custkey", "NOMINAL", "COPY"), ("o_orderpriority", "NOMINAL", "COPY"))
    return unseen_label_audit(orders, fit_profile(known, spec, ["o_orderkey"]))
