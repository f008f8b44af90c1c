"""Queries D1–D10: style dictionaries and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from vectorloom.catalog.base import register, table
from vectorloom.catalog.vectors import labels_sql
from vectorloom.operators import dictionary as dc
from vectorloom.operators import keyword_index as ki
from vectorloom.operators import style_map as sm
from vectorloom.operators.lookup import lookup_join
from vectorloom.operators.numbering import number_rows
from vectorloom.session import scratch_path
from vectorloom.sources.bucketed import join_bucketed, save_for_joins

# Keywords of p_name that leave some parts without a bucket.
PART_BUCKETS = ("bolt", "gear", "anvil", "plate")


def bucket_sql(column: str, buckets: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN contains(lower(trim({column})), '{b}') THEN '{b}'" for b in buckets)
    return f"CASE {cases} END"


PART_BUCKET_SQL = bucket_sql("p_name", PART_BUCKETS)
BUCKETED_SQL = f"bucketed AS (SELECT *, {PART_BUCKET_SQL} AS bucket FROM part)"
BUCKET_IDS_SQL = labels_sql("d", "bucketed", "bucket", "p_partkey")
RATED_SQL = """rated AS (SELECT doc_id, ' Q' || quality || ' T' || toxic || ' ' AS style FROM labels)"""
RATED_IDS_SQL = labels_sql("d", "rated", "lower(trim(style))", "doc_id")


def part_dictionary(parts):
    return dc.grouped_style_dictionary(parts, "p_name", ["p_partkey"], PART_BUCKETS)


def part_styles(parts):
    key = dc.grouped_style(F.col("p_name"), PART_BUCKETS)
    return dc.item_to_style(parts, "p_partkey", "p_name", ["p_partkey"], part_dictionary(parts), key)


def rated_styles(spark, sf_dir):
    """Label pairs as the style of a document; only some documents have one."""
    style = F.concat(F.lit(" Q"), "quality", F.lit(" T"), "toxic", F.lit(" "))
    rated = table(spark, sf_dir, "labels").select("doc_id", style.alias("style"))
    return dc.item_to_style(rated, "doc_id", "style", ["doc_id"], dc.style_dictionary(rated, "style", ["doc_id"]))


@register(
    "d1_style_dictionary",
    f"""WITH {labels_sql("d", "part", "lower(trim(p_type))", "p_partkey")}
    SELECT label AS style_key, (SELECT p_type FROM part WHERE lower(trim(p_type)) = label
                                ORDER BY p_partkey LIMIT 1) AS style, n, k AS style_index FROM d""",
)
def style_dictionary(spark, sf_dir):
    return dc.style_dictionary(table(spark, sf_dir, "part"), "p_type", ["p_partkey"])


@register(
    "d2_grouped_style",
    f"SELECT conv_id, turn, {bucket_sql('text', dc.STYLE_BUCKETS)} AS bucket FROM conversations",
)
def grouped_style(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", dc.grouped_style(F.col("text")).alias("bucket"))


@register(
    "d3_grouped_style_dictionary",
    f"""WITH {BUCKETED_SQL}, {BUCKET_IDS_SQL}
    SELECT label AS style_key, label AS style, n, k AS style_index FROM d""",
)
def grouped_style_dictionary(spark, sf_dir):
    return part_dictionary(table(spark, sf_dir, "part"))


KEYWORDS_SQL = """words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{5,}')) AS word FROM benchmark),
    keywords AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS nth FROM words),
    bucketed AS (SELECT doc_id, arg_min(word, nth) AS bucket
                 FROM documents LEFT JOIN keywords ON contains(lower(trim(text)), word) GROUP BY doc_id)"""


def benchmark_words(spark, sf_dir):
    """Every word of the benchmark, in the order of the alphabet."""
    found = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0))).alias("word")
    words = table(spark, sf_dir, "benchmark").select(found).distinct()
    return ki.keyword_table(number_rows(words, ["word"], "nth").rows, "word", "nth")


@register("d2_keyword_index", f"WITH {KEYWORDS_SQL} SELECT doc_id, bucket FROM bucketed")
def keyword_index(spark, sf_dir):
    return ki.grouped_styles(table(spark, sf_dir, "documents"), ["doc_id"], "text", benchmark_words(spark, sf_dir))


@register(
    "d3_keyword_dictionary",
    f"""WITH {KEYWORDS_SQL}, {labels_sql("d", "bucketed", "bucket", "doc_id")}
    SELECT label AS style_key, label AS style, n, k AS style_index FROM d""",
)
def keyword_dictionary(spark, sf_dir):
    return ki.keyword_dictionary(table(spark, sf_dir, "documents"), ["doc_id"], "text", benchmark_words(spark, sf_dir))


@register("d4_filtered_count", f"SELECT count(*) FILTER ({PART_BUCKET_SQL} IS NULL) AS n_filtered FROM part")
def filtered_count(spark, sf_dir):
    return dc.filtered_count(table(spark, sf_dir, "part"), "p_name", PART_BUCKETS)


D5_SQL = f"""WITH u AS (SELECT l_suppkey, l_orderkey, l_linenumber, p_type
                 FROM lineitem JOIN part ON p_partkey = l_partkey),
    {labels_sql("d", "part", "lower(trim(p_type))", "p_partkey")}
    SELECT l_suppkey AS item_id, d.k AS style_index, p_type AS style
    FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey DESC, l_linenumber DESC, p_type DESC) AS rn FROM u)
    JOIN d ON d.label = lower(trim(p_type)) WHERE rn = 1"""


def supplied_types(spark, sf_dir):
    """Supplier and part type of every line."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey"
    )
    types = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return lookup_join(lines, types, "l_partkey", how="inner")


@register("d5_item_to_style", D5_SQL)
def item_to_style(spark, sf_dir):
    """Supplier to the type of its last line: many rows per id, the last one wins."""
    dictionary = dc.style_dictionary(table(spark, sf_dir, "part"), "p_type", ["p_partkey"])
    return dc.item_to_style(supplied_types(spark, sf_dir), "l_suppkey", "p_type", ["l_orderkey", "l_linenumber"], dictionary)


@register("d5_upsert", D5_SQL)
def upsert_styles(spark, sf_dir):
    """The same map, stored and updated with the later lines first, then with the earlier ones."""
    supplied = supplied_types(spark, sf_dir)
    middle = table(spark, sf_dir, "lineitem").agg(F.avg("l_orderkey")).first()[0]
    path = scratch_path(spark, "style-map")
    target = sm.create(spark, path, supplied, "l_suppkey", ["l_orderkey", "l_linenumber"])
    for half in (F.col("l_orderkey") >= middle, F.col("l_orderkey") < middle):
        sm.upsert(target, supplied.filter(half), "l_suppkey", "p_type")
    dictionary = dc.style_dictionary(table(spark, sf_dir, "part"), "p_type", ["p_partkey"])
    return sm.item_styles(sm.open_map(spark, path), dictionary)


@register(
    "d6_lookup_style_index",
    f"""WITH {BUCKETED_SQL}, {BUCKET_IDS_SQL}
    SELECT p_partkey, split_part(p_name, ' ', 2) AS word, coalesce(d.k, -1) AS style_index
    FROM part LEFT JOIN d ON d.label = split_part(p_name, ' ', 2)""",
)
def lookup_style_index(spark, sf_dir):
    """The second word of a part's name, looked up by its upper-case spelling."""
    parts = table(spark, sf_dir, "part")
    word = F.split_part("p_name", F.lit(" "), F.lit(2))
    asked = parts.select("p_partkey", word.alias("word"), F.concat(F.lit(" "), F.upper(word)).alias("asked"))
    return dc.lookup_style_index(asked, "asked", part_dictionary(parts)).drop("asked")


@register(
    "d7_join_style_index",
    f"""WITH {RATED_SQL}, {RATED_IDS_SQL}
    SELECT doc_id, coalesce(d.k, -1) AS style_index
    FROM documents LEFT JOIN rated USING (doc_id) LEFT JOIN d ON d.label = lower(trim(style))""",
)
def join_style_index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return dc.join_style_index(docs, "doc_id", rated_styles(spark, sf_dir))


@register(
    "d8_join_style_text",
    f"WITH {RATED_SQL} SELECT doc_id, lang, style FROM documents LEFT JOIN rated USING (doc_id)",
)
def join_style_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return dc.join_style_text(docs, "doc_id", rated_styles(spark, sf_dir))


def rated_tables(spark, sf_dir):
    """Documents and their styles, in buckets of the document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    styles = rated_styles(spark, sf_dir).withColumnRenamed("item_id", "doc_id")
    return save_for_joins(docs, "doc_id", "rated_documents"), save_for_joins(styles, "doc_id", "document_styles")


@register(
    "d7_bucketed",
    f"""WITH {RATED_SQL}, {RATED_IDS_SQL}
    SELECT doc_id, lang, coalesce(d.k, -1) AS style_index, style
    FROM documents LEFT JOIN rated USING (doc_id) LEFT JOIN d ON d.label = lower(trim(style))""",
)
def join_bucketed_styles(spark, sf_dir):
    return join_bucketed(*rated_tables(spark, sf_dir), "doc_id").select("doc_id", "lang", "style_index", "style")


def line_reviews(spark, sf_dir):
    """Lines as reviews of their part."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_partkey").alias("beer_id"), F.col("l_returnflag").alias("text")
    )


@register(
    "d9_with_known_style",
    f"""WITH {BUCKETED_SQL}, {BUCKET_IDS_SQL}
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey AS beer_id, l_returnflag AS text, d.k AS style_index
    FROM lineitem JOIN bucketed ON p_partkey = l_partkey JOIN d ON d.label = bucket WHERE length(l_returnflag) >= 1""",
)
def with_known_style(spark, sf_dir):
    styles = part_styles(table(spark, sf_dir, "part"))
    return dc.with_known_style(line_reviews(spark, sf_dir), "beer_id", "text", styles)


@register(
    "d10_with_unknown_style",
    f"""WITH {BUCKETED_SQL}
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey AS beer_id, l_returnflag AS text FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM bucketed WHERE bucket IS NOT NULL)""",
)
def with_unknown_style(spark, sf_dir):
    styles = part_styles(table(spark, sf_dir, "part"))
    return dc.with_unknown_style(line_reviews(spark, sf_dir), "beer_id", styles)
