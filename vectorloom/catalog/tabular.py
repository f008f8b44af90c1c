"""Queries F1–F12: steps over typed rows and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from vectorloom.catalog.base import register, table
from vectorloom.functions import text as tx
from vectorloom.operators import tabular as tb
from vectorloom.session import materialize

KEPT_TYPES = ["purchase", "signup"]


def raw_events(spark, sf_dir):
    """Events with the time as text, as a file would hold it."""
    text_time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    return table(spark, sf_dir, "events").withColumn("ts_text", text_time).drop("ts")


@register("f1_drop_columns", "SELECT event_id, ts, event_type, value FROM events")
def drop_columns(spark, sf_dir):
    return table(spark, sf_dir, "events").transform(tb.drop_columns("user_id", "props"))


@register("f2_filter_not_in_set", "SELECT event_id, event_type FROM events WHERE event_type IN ('purchase', 'signup')")
def filter_not_in_set(spark, sf_dir):
    kept = table(spark, sf_dir, "events").transform(tb.filter_not_in_set("event_type", KEPT_TYPES))
    return kept.select("event_id", "event_type")


@register("f3_conditional_replace", "SELECT event_id, CASE WHEN value < 50 THEN 0 ELSE value END AS value FROM events")
def conditional_replace(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return events.transform(tb.conditional_replace("value", F.col("value") < 50.0, 0.0))


@register("f4_rename_column", "SELECT event_id, event_type AS category FROM events")
def rename_column(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type").transform(
        tb.rename_column("event_type", "category")
    )


@register(
    "f5_string_to_time",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second, (epoch_us(ts) // 1000) % 1000 AS millis FROM events",
)
def string_to_time(spark, sf_dir):
    parsed = raw_events(spark, sf_dir).transform(tb.string_to_time("ts_text"))
    return parsed.select(
        "event_id",
        F.substring(F.col("ts_text").cast("string"), 1, 19).alias("second"),
        F.date_format("ts_text", "SSS").cast("bigint").alias("millis"),
    )


@register(
    "f6_derive_time_fields",
    """SELECT event_id, year(ts)::INTEGER AS y, month(ts)::INTEGER AS mo, day(ts)::INTEGER AS d,
           hour(ts)::INTEGER AS h, minute(ts)::INTEGER AS mi, second(ts)::INTEGER AS s
    FROM events""",
)
def derive_time_fields(spark, sf_dir):
    fields = dict(y="year", mo="month", d="day", h="hour", mi="minute", s="second")
    steps = [tb.string_to_time("ts_text"), tb.derive_time_fields("ts_text", **fields)]
    return tb.transform_process(raw_events(spark, sf_dir), steps).select("event_id", *fields)


@register(
    "f7_typed_schema_check",
    """SELECT 'event_type' AS column_name, 'in_set' AS rule, count(*) AS n_checked,
           count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase', 'signup')) AS n_violations FROM events
    UNION ALL SELECT 'value', 'not_nan', count(*), count(*) FILTER (isnan(value)) FROM events
    UNION ALL SELECT 'value', 'not_infinite', count(*), count(*) FILTER (isinf(value)) FROM events
    UNION ALL SELECT 'value', 'at_least', count(*), count(*) FILTER (value < 1) FROM events
    UNION ALL SELECT 'value', 'at_most', count(*), count(*) FILTER (value > 90) FROM events""",
)
def typed_schema_check(spark, sf_dir):
    rules = tb.closed_set("event_type", ["view", "click", "purchase", "signup"])
    rules += tb.bounded_double("value", 1.0, 90.0)
    return tb.typed_schema_check(table(spark, sf_dir, "events"), rules)


@register(
    "f8_transform_process",
    """SELECT event_id, event_type AS category, CASE WHEN value < 50 THEN 0 ELSE value END AS value,
           hour(ts)::INTEGER AS hour_of_day
    FROM events WHERE event_type IN ('purchase', 'signup')""",
)
def transform_process(spark, sf_dir):
    steps = [
        tb.drop_columns("user_id", "props"),
        tb.filter_not_in_set("event_type", KEPT_TYPES),
        tb.conditional_replace("value", F.col("value") < 50.0, 0.0),
        tb.string_to_time("ts_text"),
        tb.rename_column("ts_text", "time"),
        tb.rename_column("event_type", "category"),
        tb.derive_time_fields("time", hour_of_day="hour"),
        tb.drop_columns("time"),
    ]
    return tb.transform_process(raw_events(spark, sf_dir), steps)


@register(
    "f8_observed_checks",
    """SELECT 'event_type' AS column_name, 'in_set' AS rule, count(*) AS n_checked,
           count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase')) AS n_violations FROM events
    UNION ALL SELECT 'value', 'not_nan', count(*), count(*) FILTER (isnan(value)) FROM events
    UNION ALL SELECT 'value', 'not_infinite', count(*), count(*) FILTER (isinf(value)) FROM events
    UNION ALL SELECT 'value', 'at_most', count(*), count(*) FILTER (value > 90) FROM events
    UNION ALL SELECT 'code', 'is_number', count(*), count(*) FILTER (event_id % 7 = 0) FROM events
    UNION ALL SELECT 'written', 'rows', count(*), 0 FROM events WHERE event_type IN ('purchase', 'signup')""",
)
def observed_checks(spark, sf_dir):
    """Rules over all events, counted while the kept ones are written."""
    code = F.when(F.col("event_id") % 7 == 0, F.lit("none")).otherwise(F.col("event_id").cast("string"))
    events = table(spark, sf_dir, "events").withColumn("code", code)
    rules = tb.closed_set("event_type", ["view", "click", "purchase"]) + tb.bounded_double("value", high=90.0)
    rules += tb.numeric_text("code")
    watched, observation = tb.observe_checks(events, rules)
    kept = tb.transform_process(watched, [tb.drop_columns("props"), tb.filter_not_in_set("event_type", KEPT_TYPES)])
    written = materialize(kept, "kept-events")
    rows = written.agg(F.lit("written").alias("column_name"), F.lit("rows").alias("rule"), F.count("*").alias("n_checked"))
    return tb.observed_violations(spark, observation, rules).unionByName(rows.withColumn("n_violations", F.lit(0).cast("bigint")))


@register("f10_nonempty_text", "SELECT conv_id, turn, text FROM conversations WHERE length(text) >= 1")
def nonempty_text(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return turns.filter(tx.nonempty_text(F.col("text")))


@register("f11_short_text_flag", "SELECT doc_id, length(text) < 9 AS is_short FROM documents")
def short_text_flag(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.short_text_flag(F.col("text")).alias("is_short"))


@register("f12_truncate_text", "SELECT doc_id, substr(text, 1, 120) AS post FROM documents")
def truncate_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.truncate_text(F.col("text")).alias("post"))
