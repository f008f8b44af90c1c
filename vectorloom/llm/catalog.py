"""Registered queries of this folder: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.llm.divergence import source_divergence
from vectorloom.llm.fingerprints import edit_study
from vectorloom.llm.kd_search import top_k
from vectorloom.llm.mixing import pareto_mix, word_count
from vectorloom.llm.ngram_join import ngram_jaccard_join
from vectorloom.llm.packing import pack_documents
from vectorloom.llm.quality_classifier import classify_quality
from vectorloom.llm.quality_rules import judge_lines, train_field
from vectorloom.llm.resampling import resample
from vectorloom.llm.sharding import assign_shards, byte_size
from vectorloom.llm.suffix_dedup import remove_repeats
from vectorloom.llm.textops import small_batches
from vectorloom.llm.token_counts import attribute_tokens
from vectorloom.llm.warc import archive_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return query(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"))


@register("op3_ngram_join")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


@register(
    "op4_warc",
    """
    WITH sized AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), typed AS (
        SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM sized
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id > first_page THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id > first_page THEN first_page END AS refers_to
    FROM typed
    """,
)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# CRC-32 by its table of 256 entries, one step per byte.
CRC_SQL = """crc AS (
        SELECT [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FOR i IN range(256)] AS t
    )"""


def crc_sql(bytes_: str) -> str:
    """CRC-32 of a list of bytes, where the table ``t`` is at hand."""
    return f"""xor(list_reduce(list_prepend(4294967295, {bytes_}), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])),
            4294967295)"""


@register(
    "op5_sharding",
    f"""
    WITH {CRC_SQL}, sized AS (
        SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
            [('0x' || x)::BIGINT FOR x IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')] AS b
        FROM documents
    ), summed AS (
        SELECT doc_id, size, {crc_sql("b")} AS text_crc32,
            sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total
        FROM sized, crc
    ), dealt AS (
        SELECT *, least(15, (2 * before + size) * 16 // (2 * total))::INTEGER AS shard FROM summed
    )
    SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
        row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM dealt
    """,
)
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        byte_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return assign_shards(docs, ["doc_id"], "size").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@register("op9_mixing")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return pareto_mix(docs, "doc_id", "source", "size").select("doc_id", "size", "source_size", "target", "taken")


@register("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@register("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_study(table(spark, sf_dir, "documents"))


@register("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_field(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    return judge_lines(docs, model)


@register("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribute_tokens(table(spark, sf_dir, "documents")).drop("name")


@register(
    "op13_kd_search",
    """
    WITH whole AS (
        SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
        WHERE embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM whole q JOIN whole c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
        WHERE q.vec_id % 100 = 0
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score
    FROM scored QUALIFY rank <= 10
    """,
)
def op13_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0, k=10)


@register(
    "op11_resampling",
    "WITH " + CRC_SQL + r""", texts AS (
        SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
    ), words AS (
        SELECT side, doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
        FROM texts
    ), spelled AS (
        SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)
    ), bytes AS (
        SELECT word, [16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1
            FOR i IN range(len(h) // 2)] AS b
        FROM spelled
    ), hashed AS (
        SELECT word, """ + crc_sql("b") + r""" % 10000 AS bucket
        FROM bytes, crc
    ), counted AS (
        SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
        FROM words JOIN hashed USING (word) GROUP BY bucket
    ), gains AS (
        SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + 10000)::DOUBLE
            / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + 10000)::DOUBLE))) AS BIGINT) AS gain
        FROM counted
    ), weighed AS (
        SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight
        FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id
    ), scored AS (
        SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[:8])::BIGINT + 0.5::DOUBLE)
                / 4294967296::DOUBLE))) AS BIGINT) AS score
        FROM documents LEFT JOIN weighed USING (doc_id)
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
            count(*) FILTER (n_features >= 20) OVER () AS n
        FROM scored
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n * 10 // 100 THEN place END AS rank
    FROM placed
    """,
)
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register(
    "op12_source_divergence",
    r"""
    WITH docs AS (
        SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
        FROM documents
    ), words AS (
        SELECT doc_id, lang, source, unnest(found) AS term FROM docs
    ), kept AS (
        SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 30
    ), langs AS (
        SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
    ), groups AS (
        SELECT DISTINCT lang, source FROM docs
    ), counts AS (
        SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
    ), totals AS (
        SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source
    ), cells AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
            1 + 1000000000 * (coalesce(c.n, 0)::HUGEINT + 5) // (coalesce(t.total, 0) + 5 * l.v) AS p,
            1 + 1000000000 * (k.lang_n::HUGEINT + 5) // (l.lang_total + 5 * l.v) AS q
        FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
            LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    ), sums AS (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ), pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    ), both_parts AS (
        SELECT * FROM pairs
        UNION ALL
        SELECT lang, source, 'term', term, p - q FROM cells WHERE n > 0 AND p > q
    )
    SELECT lang, source, part, item, value::BIGINT AS value,
        row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM both_parts QUALIFY part = 'pair' OR rank <= 50
    """,
)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))
