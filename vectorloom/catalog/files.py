"""Queries S1–S11: reading and writing text forms, JSON containers and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.catalog.base import as_line, register, rounded, table
from vectorloom.catalog.statistics import LABELS_SQL, STATS_SQL
from vectorloom.catalog.vectors import LINE_FEATURES_SQL, LINE_KEY, LINE_SPEC, labels_sql, line_profile
from vectorloom.operators.lookup import lookup_join
from vectorloom.operators.profile import fit_profile
from vectorloom.operators.vectorize import apply_profile, assemble_plain, assemble_sparse
from vectorloom.plans.spec import make_spec
from vectorloom.session import scratch_path
from vectorloom.sources import delimited, json_docs, profile_store, vectors

FEATURES = ("f_key", "f_quantity", "f_price", "f_discount", "f_status")
PREFIX = "profile.column"
ORDER_SPEC = make_spec(
    "orders",
    r"\|",
    ("o_orderkey", "NUMERIC", "UNIQUE_ID"),
    ("o_custkey", "NUMERIC", "COPY"),
    ("o_orderstatus", "NOMINAL", "LABEL"),
    ("o_orderpriority", "NOMINAL", "COPY"),
)


def applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, profile = line_profile(spark, sf_dir)
    return apply_profile(lines, profile)


def feature_columns(df: DataFrame, values: list) -> DataFrame:
    out = df.select(*[v.cast("double").alias(n) for n, v in zip(FEATURES, values)], "label")
    return rounded(out, 6, "f_quantity", "f_price")


@register(
    "s1_read_delimited",
    """SELECT l_orderkey, l_quantity, l_extendedprice, l_returnflag, l_discount, l_tax, l_linestatus
    FROM lineitem WHERE l_tax <> 0""",
)
def read_delimited(spark, sf_dir):
    """Lines of untaxed items start with a blank field, so they are skipped."""
    first = F.when(F.col("l_tax") != 0, F.col("l_orderkey").cast("string")).otherwise(F.lit(" "))
    lines = table(spark, sf_dir, "lineitem").withColumn("l_orderkey", first).select(
        as_line(*LINE_SPEC.names).alias("value")
    )
    parsed = delimited.read_delimited(lines, LINE_SPEC)
    numbers = {c.name: F.col(c.name).cast("double") for c in LINE_SPEC.numeric}
    return parsed.withColumns(numbers).withColumn("l_orderkey", F.col("l_orderkey").cast("bigint"))


@register(
    "s2_map_values_to_columns",
    " UNION ALL ".join(
        f"SELECT o_orderkey, '{c}' AS column_name, CAST({c} AS VARCHAR) AS raw_value FROM orders" for c in ORDER_SPEC.names
    ),
)
def map_values_to_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "orders").select("o_orderkey", as_line(*ORDER_SPEC.names, sep="|").alias("value"))
    return delimited.map_values_to_columns(lines, ORDER_SPEC, keep=("o_orderkey",))


@register(
    "s3_read_dictionary_json",
    """SELECT p_partkey::VARCHAR AS id, p_name AS name, p_type AS style, p_size::VARCHAR AS abv, p_brand AS brewer
    FROM part
    UNION ALL SELECT p_partkey::VARCHAR || 'x', upper(p_name), p_type, NULL, p_brand FROM part""",
)
def read_dictionary_json(spark, sf_dir):
    """One container per part with two items, the second without abv."""
    item_id = F.col("p_partkey").cast("string")

    def item(name, key, abv):
        return F.struct(
            key.alias("id"), name.alias("name"), F.col("p_type").alias("style"), abv.alias("abv"), F.col("p_brand").alias("brewer")
        )

    other = F.concat(item_id, F.lit("x"))
    items = F.create_map(
        item_id,
        item(F.col("p_name"), item_id, F.col("p_size").cast("string")),
        other,
        item(F.upper("p_name"), other, F.lit(None).cast("string")),
    )
    path = scratch_path(spark, "items")
    table(spark, sf_dir, "part").select(F.to_json(F.create_map(F.lit("beers"), items)).alias("value")).write.text(path)
    return json_docs.read_dictionary_json(spark, path, per_line=True).drop("at")


ITEMS_PER_FILE = 100


@register(
    "s3_whole_files",
    """SELECT p_partkey::VARCHAR AS id, p_name AS name, p_type AS style, p_size::VARCHAR AS abv, p_brand AS brewer
    FROM part""",
)
def read_whole_files(spark, sf_dir):
    """A container over several lines per file, each with the items of a hundred part keys."""
    key = F.col("p_partkey").cast("string")
    item = F.struct(
        key.alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("style"),
        F.col("p_size").cast("string").alias("abv"), F.col("p_brand").alias("brewer"),
    )
    # a group holds at most ITEMS_PER_FILE items
    grouped = table(spark, sf_dir, "part").groupBy(F.expr(f"p_partkey div {ITEMS_PER_FILE}").alias("block"))
    items = grouped.agg(F.map_from_entries(F.collect_list(F.struct(key, item))).alias("items"))
    container = F.to_json(F.create_map(F.lit("beers"), F.col("items")), {"pretty": "true"})
    path = scratch_path(spark, "item-files")
    items.select("block", container.alias("value")).write.partitionBy("block").text(path)
    return json_docs.read_dictionary_json(spark, path).drop("at", "block")


@register(
    "s3_split_container",
    """SELECT (row_number() OVER (ORDER BY p_partkey) - 1)::INTEGER AS at, p_partkey::VARCHAR AS id,
           '{"' || p_name || '}\\' AS name, p_type AS style, p_size::VARCHAR AS abv, p_brand AS brewer
    FROM part""",
)
def read_split_container(spark, sf_dir):
    """One file with all parts, read in splits of a fortieth of it; names hold braces, quotes and backslashes."""
    key = F.col("p_partkey").cast("string")
    item = F.struct(
        key.alias("id"), F.concat(F.lit('{"'), "p_name", F.lit("}\\")).alias("name"), F.col("p_type").alias("style"),
        F.col("p_size").cast("string").alias("abv"), F.col("p_brand").alias("brewer"),
    )
    parts = table(spark, sf_dir, "part")
    first, last = parts.agg(F.min("p_partkey"), F.max("p_partkey")).first()
    before = F.when(F.col("p_partkey") == first, F.lit('{"beers":{')).otherwise(F.lit(""))
    after = F.when(F.col("p_partkey") == last, F.lit("}}")).otherwise(F.lit(","))
    line = F.concat(before, F.lit('"'), key, F.lit('":'), F.to_json(item), after)
    path = scratch_path(spark, "item-file")
    parts.orderBy("p_partkey").select(line.alias("value")).coalesce(1).write.text(path)
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    return json_docs.read_dictionary_json(spark, path, split_bytes=max(size // 40, 1))


@register(
    "s4_read_reviews_json",
    """SELECT text, coalesce(quality * 2.5, 0)::FLOAT AS rating_overall, 0.0::FLOAT AS rating_aroma,
           0.0::FLOAT AS rating_taste, coalesce(toxic + 1.5, 0)::FLOAT AS rating_appearance,
           0.0::FLOAT AS rating_palate, source AS user, doc_id::VARCHAR AS beer_id
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def read_reviews_json(spark, sf_dir):
    """One container per document; ratings exist only for labelled ones."""
    docs = lookup_join(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")
    review = F.struct(
        "text",
        F.col("source").alias("user"),
        F.col("doc_id").cast("string").alias("beer_id"),
        (F.col("quality") * 2.5).cast("float").alias("rating_overall"),
        (F.col("toxic") + 1.5).cast("float").alias("rating_appearance"),
    )
    path = scratch_path(spark, "reviews")
    docs.select(F.to_json(F.create_map(F.lit("reviews"), F.array(review))).alias("value")).write.text(path)
    return json_docs.read_reviews_json(spark, path, per_line=True).drop("at")


@register(
    "s4_bad_containers",
    """SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE doc_id % 10 IN (3, 7)""",
)
def bad_containers(spark, sf_dir):
    """Of ten containers one is cut off and one has a rating that is no number; the others are read in full."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rating = F.when(F.col("doc_id") % 10 == 7, F.lit("many")).otherwise(F.lit("2.5"))
    whole = F.to_json(F.create_map(F.lit("reviews"), F.array(F.struct("text", rating.alias("rating_overall")))))
    cut = F.when(F.col("doc_id") % 10 == 3, F.left(whole, F.length(whole) - 2)).otherwise(whole)
    return json_docs.bad_containers(docs.select("doc_id", cut.alias("value")), json_docs.REVIEW_FIELDS).select("doc_id")


@register("s5_read_typed_csv", "SELECT event_id, user_id, event_type, value, hour(ts)::INTEGER AS h FROM events")
def read_typed_csv(spark, sf_dir):
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    columns = ("event_id", "ts", "user_id", "event_type", "value")
    lines = table(spark, sf_dir, "events").select(as_line(*columns).alias("value"))
    typed = delimited.read_typed_csv(lines, schema, timestampNTZFormat="yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]")
    return typed.withColumn("h", F.hour("ts")).drop("ts")


@register("s6_write_plain_vectors", LINE_FEATURES_SQL + f"SELECT {', '.join(FEATURES)}, label FROM f")
def write_plain_vectors(spark, sf_dir):
    """Write the lines, and read them back to compare."""
    path = scratch_path(spark, "plain")
    vectors.write_plain_vectors(assemble_plain(applied(spark, sf_dir), LINE_SPEC), path)
    n = len(FEATURES)
    back = vectors.read_plain_vectors(delimited.read_lines(spark, path), n)
    return feature_columns(back, [F.col("features")[i] for i in range(n)])


QUALITY_SPEC = make_spec(
    "documents",
    ",",
    ("doc_id", "NUMERIC", "COPY"),
    ("toxic", "NUMERIC", "COPY"),
    ("lang", "NOMINAL", "COPY"),
    ("quality", "NUMERIC", "LABEL"),
)
QUALITY_SQL = f"""WITH {labels_sql("langs", "documents", "lang", "doc_id")}
    SELECT CAST(doc_id AS DOUBLE) AS f_doc, CAST(toxic AS DOUBLE) AS f_toxic, CAST(langs.k AS DOUBLE) AS f_lang,
           CAST(quality AS DOUBLE) AS label
    FROM documents LEFT JOIN labels USING (doc_id) LEFT JOIN langs ON langs.label = lang"""


def quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, which many of them lack: NULL features and NULL labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    rated = lookup_join(docs, table(spark, sf_dir, "labels"), "doc_id")
    return apply_profile(rated, fit_profile(rated, QUALITY_SPEC, ["doc_id"]))


@register("s6_null_fields", QUALITY_SQL)
def null_fields(spark, sf_dir):
    """NULL features and labels written as empty fields, and read back as NULL."""
    path = scratch_path(spark, "plain")
    vectors.write_plain_vectors(assemble_plain(quality_rows(spark, sf_dir), QUALITY_SPEC), path, missing_label="empty")
    back = vectors.read_plain_vectors(delimited.read_lines(spark, path), 3)
    return back.select(*[F.col("features")[i].alias(n) for i, n in enumerate(("f_doc", "f_toxic", "f_lang"))], "label")


@register(
    "s7_null_label_policy",
    f"""SELECT f_doc, coalesce(f_toxic, 0) AS f_toxic, f_lang, label FROM ({QUALITY_SQL}) WHERE label IS NOT NULL""",
)
def null_label_policy(spark, sf_dir):
    """Rows without a label left out by option; zeros and missing values have no entry."""
    path = scratch_path(spark, "svmlight")
    rows = assemble_sparse(quality_rows(spark, sf_dir), QUALITY_SPEC)
    vectors.write_svmlight(rows, path, missing_label="drop")
    back = vectors.read_svmlight(spark, path, 3)
    return back.select(*[F.col("features")[i].alias(n) for i, n in enumerate(("f_doc", "f_toxic", "f_lang"))], "label")


@register(
    "s7_write_svmlight",
    LINE_FEATURES_SQL
    + """SELECT nullif(f_key, 0) AS f_key, nullif(f_quantity, 0) AS f_quantity, f_price,
           nullif(f_discount, 0) AS f_discount, f_status, label FROM f""",
)
def write_svmlight(spark, sf_dir):
    """Write the lines, and read them back as text; a zero has no entry."""
    path = scratch_path(spark, "svmlight")
    vectors.write_svmlight(assemble_sparse(applied(spark, sf_dir), LINE_SPEC), path)
    split = delimited.read_lines(spark, path).select(
        F.substring_index("value", " ", 1).cast("double").alias("label"),
        F.str_to_map(F.expr("substring(value, instr(value, ' ') + 1)"), F.lit(" "), F.lit(":")).alias("v"),
    )
    return feature_columns(split, [F.col("v")[str(i + 1)] for i in range(len(FEATURES))])


@register("s8_read_svmlight", LINE_FEATURES_SQL + f"SELECT {', '.join(FEATURES)}, label FROM f")
def read_svmlight(spark, sf_dir):
    path = scratch_path(spark, "svmlight")
    vectors.write_svmlight(assemble_sparse(applied(spark, sf_dir), LINE_SPEC), path)
    n = len(FEATURES)
    return feature_columns(vectors.read_svmlight(spark, path, n), [F.col("features")[i] for i in range(n)])


@register(
    "s9_read_labeled_dense",
    "SELECT CAST(l_linenumber AS DOUBLE) AS label, l_quantity AS x1, l_extendedprice AS x2, l_discount AS x3 FROM lineitem",
)
def read_labeled_dense(spark, sf_dir):
    columns = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    lines = table(spark, sf_dir, "lineitem").select(as_line(*columns).alias("value"))
    dense = vectors.read_labeled_dense(lines, 3)
    return dense.select("label", *[F.col("features")[i].alias(f"x{i + 1}") for i in range(3)])


@register(
    "s10_write_delimited",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders""",
)
def write_delimited(spark, sf_dir):
    """Write the lines, and read them back typed."""
    orders = table(spark, sf_dir, "orders")
    path, time = scratch_path(spark, "delimited"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    delimited.write_delimited(orders, path, **time)
    back = delimited.read_typed_csv(delimited.read_lines(spark, path), orders.schema, **time)
    return back.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@register(
    "s11_save_and_load_profile",
    f"""SELECT column_name, 'min' AS item, min AS value FROM ({STATS_SQL})
    UNION ALL SELECT column_name, 'max', max FROM ({STATS_SQL})
    UNION ALL SELECT column_name, 'sum', sum FROM ({STATS_SQL})
    UNION ALL SELECT column_name, 'n', n FROM ({STATS_SQL})
    UNION ALL SELECT column_name, 'label_id ' || label, label_id FROM ({LABELS_SQL})
    UNION ALL SELECT column_name, 'label_n ' || label, n FROM ({LABELS_SQL})""",
)
def save_and_load_profile(spark, sf_dir):
    path = scratch_path(spark, "profile")
    profile_store.save_profile(line_profile(spark, sf_dir)[1], path)
    loaded = profile_store.load_profile(spark, path, LINE_SPEC)
    stats = loaded.stats.filter("kind = 'NUMERIC'").withColumn("n", F.col("n").cast("double"))
    stats = rounded(stats, 2, "sum").unpivot("column_name", ["min", "max", "sum", "n"], "item", "value")
    labels = loaded.labels.rows.select(
        "column_name",
        F.inline(
            F.array(
                *[
                    F.struct(F.concat(F.lit(f"{c} "), "label").alias("item"), F.col(source).cast("double").alias("value"))
                    for c, source in (("label_id", "label_id"), ("label_n", "n"))
                ]
            )
        ),
    )
    return stats.unionByName(labels)


@register(
    "s11_import_stats_text",
    f"""SELECT column_name, 'minimum' AS statistic, min AS value FROM ({STATS_SQL})
    UNION ALL SELECT column_name, 'maximum', max FROM ({STATS_SQL})""",
)
def import_stats_text(spark, sf_dir):
    """Statistics written as key=value lines, and read back."""
    stats = line_profile(spark, sf_dir)[1].stats.filter("kind = 'NUMERIC'")
    long = stats.select("column_name", F.col("min").alias("minimum"), F.col("max").alias("maximum")).unpivot(
        "column_name", ["minimum", "maximum"], "statistic", "value"
    )
    path = scratch_path(spark, "stats-text")
    long.select(F.format_string(PREFIX + ".%s.%s=%s", "statistic", "column_name", F.col("value").cast("string"))).write.text(path)
    return profile_store.import_stats_text(delimited.read_lines(spark, path), PREFIX)


@register(
    "s11_import_labels_text",
    f"SELECT column_name, label, label_id, n FROM ({LABELS_SQL}) WHERE column_name = 'l_returnflag'",
)
def import_labels_text(spark, sf_dir):
    """Labels written as id,label,count lines, and read back."""
    labels = line_profile(spark, sf_dir)[1].labels.of("l_returnflag")
    path = scratch_path(spark, "labels-text")
    labels.select(as_line("label_id", "label", "n").alias("value")).write.text(path)
    back = profile_store.import_labels_text(delimited.read_lines(spark, path))
    return back.select(F.lit("l_returnflag").alias("column_name"), "label", "label_id", "n")


@register(
    "s11_profile_from_text",
    LINE_FEATURES_SQL + "SELECT order_key, l_linenumber, l_partkey, l_suppkey, f_quantity, f_price, f_status, label FROM f",
)
def profile_from_text(spark, sf_dir):
    """Features from a profile made of imported text equal those of the profile itself."""
    lines, profile = line_profile(spark, sf_dir)
    names = ("n", "min", "max", "avg", "stddev")
    figures = profile.stats.filter("kind = 'NUMERIC'").select("column_name", *[F.col(n).cast("double") for n in names])
    long = figures.unpivot("column_name", list(names), "statistic", "value")
    path = scratch_path(spark, "profile-text")
    long.select(F.format_string(PREFIX + ".%s.%s=%s", "statistic", "column_name", F.col("value").cast("string"))).write.text(path)
    statistics = profile_store.import_stats_text(delimited.read_lines(spark, path), PREFIX)
    made = profile_store.profile_from_text(LINE_SPEC, statistics, profile.labels.rows)
    features = assemble_plain(apply_profile(lines, made, keep=LINE_KEY), LINE_SPEC, LINE_KEY)
    out = features.select(
        *LINE_KEY, *[F.col("features")[i].alias(n) for i, n in ((1, "f_quantity"), (2, "f_price"), (4, "f_status"))], "label"
    )
    return rounded(out, 6, "f_quantity", "f_price")
