"""Queries M1–M12: training metrics, evaluation, sampling and the classifier."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.catalog.base import register, rounded, table
from vectorloom.catalog.sequences import STOP, indices_sql
from vectorloom.catalog.vectors import labels_sql
from vectorloom.operators import alias as al
from vectorloom.operators import char_model as cm
from vectorloom.operators import epochs as ep
from vectorloom.operators import metrics as mt
from vectorloom.operators import model as ml
from vectorloom.operators.dictionary import style_dictionary
from vectorloom.operators.lookup import lookup_join
from vectorloom.session import materialize, scratch_path

TEMPERATURE = 1.5
HIDDEN = 16
PARITY_HIDDEN, PARITY_SEED = 4, 123

STATE_SQL = """st AS (
      SELECT user_id, count(value) AS n, arg_min(value, event_id) AS first, arg_max(value, event_id) AS last
      FROM events GROUP BY 1),
    ch AS (SELECT *, CASE WHEN n = 0 THEN 0 WHEN n = 1 THEN first ELSE first - last END AS change FROM st),
    im AS (SELECT *, CASE WHEN n <= 1 THEN change ELSE change / (n - 1) END AS improvement FROM ch),
    pr AS (SELECT *, CASE WHEN n < 5 THEN 0 ELSE last / nullif(improvement, 0) END AS projected FROM im)"""
SERIES_SQL = """se AS (
      SELECT user_id, event_id, value, avg(value) OVER (
               PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS moving_avg
      FROM events)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scores: a user is a run, an event an epoch; props hold its duration in seconds."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select("user_id", "event_id", "value", k.alias("k"))


@register(
    "m1_masked_mean_loss",
    "SELECT round(sum(value) / sum(CAST(json_extract(props, '$.k') AS BIGINT)), 8) AS loss FROM events",
)
def masked_mean_loss(spark, sf_dir):
    return rounded(mt.masked_mean_loss(scores(spark, sf_dir), F.col("value"), F.col("k")), 8, "loss")


@register(
    "m2_moving_average",
    f"WITH {SERIES_SQL} SELECT user_id, event_id, value, round(moving_avg, 6) AS moving_avg FROM se",
)
def moving_average(spark, sf_dir):
    return rounded(mt.moving_average(scores(spark, sf_dir), "user_id", "event_id", "value"), 6, "moving_avg")


CHARACTERS = STOP + 1


@register(
    "m1_character_model",
    f"""WITH {indices_sql("(SELECT doc_id, text, coalesce(lang, '') AS style FROM documents)", "doc_id, style")},
    steps AS (SELECT doc_id % 5 = 0 AS held, style, unnest(list_concat([{STOP}], ids)) AS i,
                     unnest(list_concat(ids, [{STOP}])) AS o FROM e),
    n AS (SELECT held, style, i, o, count(*) AS n FROM steps GROUP BY ALL),
    t AS (SELECT * FROM n WHERE NOT held),
    chars AS (SELECT o, (coalesce(sum(n), 0) + 1) / ((SELECT sum(n) FROM t) + {CHARACTERS}) AS p0
              FROM range({CHARACTERS}) r(o) LEFT JOIN t USING (o) GROUP BY o),
    ins AS (SELECT i, sum(n) AS n FROM t GROUP BY i),
    pairs AS (SELECT i, o, sum(n) AS n FROM t GROUP BY i, o),
    style_ins AS (SELECT style, i, sum(n) AS n FROM t GROUP BY style, i),
    scored AS (
      SELECT h.style, h.n, (coalesce(t.n, 0) + {cm.BACK_OFF} * (coalesce(pairs.n, 0) + {cm.BACK_OFF} * p0)
                 / (coalesce(ins.n, 0) + {cm.BACK_OFF})) / (coalesce(style_ins.n, 0) + {cm.BACK_OFF}) AS p
      FROM n h JOIN chars USING (o) LEFT JOIN ins ON ins.i = h.i LEFT JOIN pairs ON pairs.i = h.i AND pairs.o = h.o
           LEFT JOIN style_ins ON style_ins.style = h.style AND style_ins.i = h.i
           LEFT JOIN t ON t.style = h.style AND t.i = h.i AND t.o = h.o
      WHERE h.held)
    SELECT style, round(sum(n * -ln(p)) / sum(n), 8) AS loss FROM scored GROUP BY style""",
)
def character_model(spark, sf_dir):
    """The character model of four fifths of the documents, by language, scored on the rest."""
    docs = table(spark, sf_dir, "documents").select(
        "text", F.coalesce("lang", F.lit("")).alias("style"), (F.col("doc_id") % 5 == 0).alias("held")
    )
    # counts of pairs, small beside the text
    counts = materialize(cm.pair_counts(docs, "text", ("held", "style")), "pair-counts")
    model = cm.fit_char_model(counts.filter(~F.col("held")).drop("held"), "style")
    return rounded(cm.held_out_loss(counts.filter("held").drop("held"), model), 8, "loss")


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.score_progress(scores(spark, sf_dir), "user_id", "event_id", "value")


@register("m3_score_change", f"WITH {STATE_SQL} SELECT user_id, round(change, 6) AS score_change FROM pr")
def score_change(spark, sf_dir):
    return rounded(progress(spark, sf_dir).select("user_id", "score_change"), 6, "score_change")


@register("m4_avg_improvement_per_epoch", f"WITH {STATE_SQL} SELECT user_id, round(improvement, 8) AS avg_improvement FROM pr")
def avg_improvement(spark, sf_dir):
    return rounded(progress(spark, sf_dir).select("user_id", "avg_improvement"), 8, "avg_improvement")


@register("m5_projected_epochs", f"WITH {STATE_SQL} SELECT user_id, round(projected, 4) AS projected_epochs FROM pr")
def projected_epochs(spark, sf_dir):
    return rounded(progress(spark, sf_dir).select("user_id", "projected_epochs"), 4, "projected_epochs")


@register(
    "m6_training_summary",
    f"""WITH {STATE_SQL}, {SERIES_SQL},
    t AS (SELECT user_id, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) * 1000 // 60000 AS BIGINT) AS minutes,
                 CAST(count(*) * 32 AS BIGINT) AS records FROM events GROUP BY 1),
    a AS (SELECT user_id, arg_max(moving_avg, event_id) AS avg_score FROM se GROUP BY 1)
    SELECT user_id, n AS n_epochs, minutes AS total_minutes, records AS records_seen, first AS first_score,
           last AS last_score, round(avg_score, 6) AS avg_score, minutes // n AS minutes_per_epoch,
           round(change, 6) AS score_change, round(improvement, 8) AS avg_improvement,
           round(projected, 4) AS projected_epochs, round(minutes // n * projected, 3) AS projected_minutes
    FROM pr JOIN t USING (user_id) JOIN a USING (user_id)""",
)
def training_summary(spark, sf_dir):
    runs = scores(spark, sf_dir).withColumns({"millis": F.col("k") * 1000, "records": F.lit(32)})
    out = mt.training_summary(runs, "user_id", "event_id", "value", "millis", "records")
    out = rounded(rounded(out, 6, "avg_score", "score_change"), 8, "avg_improvement")
    return rounded(rounded(out, 4, "projected_epochs"), 3, "projected_minutes")


@register(
    "m7_argmax_prediction",
    "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::BIGINT AS prediction FROM embeddings",
)
def argmax_prediction(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", mt.argmax_prediction(F.col("embedding")).alias("prediction")
    )


@register(
    "m8_classification_evaluation",
    """WITH p AS (SELECT quality AS label, 1 - toxic AS prediction FROM labels),
    c AS (SELECT DISTINCT label AS class FROM p UNION SELECT DISTINCT prediction FROM p),
    k AS (SELECT class, (SELECT count(*) FROM p WHERE label = class AND prediction = class) AS tp,
                 (SELECT count(*) FROM p WHERE label <> class AND prediction = class) AS fp,
                 (SELECT count(*) FROM p WHERE label = class AND prediction <> class) AS fn FROM c)
    SELECT class, tp AS true_positive, fp AS false_positive, fn AS false_negative,
           round(coalesce(tp / nullif(tp + fp, 0), 0), 8) AS precision,
           round(coalesce(tp / nullif(tp + fn, 0), 0), 8) AS recall,
           round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 8) AS f1,
           round((SELECT count(*) FILTER (label = prediction) / count(*) FROM p), 8) AS accuracy
    FROM k""",
)
def classification_evaluation(spark, sf_dir):
    predicted = table(spark, sf_dir, "labels").withColumn("prediction", 1 - F.col("toxic"))
    out = mt.classification_evaluation(predicted, "quality", "prediction")
    return rounded(out, 8, "precision", "recall", "f1", "accuracy")


@register(
    "m8_confusion_matrix",
    "SELECT quality AS label, 1 - toxic AS prediction, count(*) AS n FROM labels GROUP BY ALL",
)
def confusion_matrix(spark, sf_dir):
    predicted = table(spark, sf_dir, "labels").withColumn("prediction", 1 - F.col("toxic"))
    return mt.confusion_matrix(predicted, "quality", "prediction")


@register(
    "m8_overall_evaluation",
    """WITH p AS (SELECT quality AS label, 1 - toxic AS prediction FROM labels),
    c AS (SELECT DISTINCT label AS class FROM p UNION SELECT DISTINCT prediction FROM p),
    k AS (SELECT class, count(*) FILTER (label = class AND prediction = class) AS tp,
                 count(*) FILTER (label <> class AND prediction = class) AS fp,
                 count(*) FILTER (label = class AND prediction <> class) AS fn FROM c CROSS JOIN p GROUP BY 1)
    SELECT count(*) AS n_classes, round(avg(coalesce(tp / nullif(tp + fp, 0), 0)), 8) AS precision,
           round(avg(coalesce(tp / nullif(tp + fn, 0), 0)), 8) AS recall,
           round(avg(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)), 8) AS f1,
           round((SELECT count(*) FILTER (label = prediction) / count(*) FROM p), 8) AS accuracy FROM k""",
)
def overall_evaluation(spark, sf_dir):
    predicted = table(spark, sf_dir, "labels").withColumn("prediction", 1 - F.col("toxic"))
    return rounded(mt.overall_evaluation(predicted, "quality", "prediction"), 8, "precision", "recall", "f1", "accuracy")


DISTRIBUTION_SQL = f"""{labels_sql("kinds", "events", "event_type", "event_id")},
    w AS (SELECT user_id, k AS class_index, sum(value) AS weight
          FROM events JOIN kinds ON kinds.label = event_type GROUP BY 1, 2),
    p AS (SELECT user_id, class_index, weight / sum(weight) OVER (PARTITION BY user_id) AS p FROM w)"""


def distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user the share of each event type in the value, as a distribution over type indices."""
    events = table(spark, sf_dir, "events")
    kinds = style_dictionary(events.select("event_type", "event_id"), "event_type", ["event_id"])
    # pre-aggregated per (user, type), so the join and the window see few rows per user
    weights = events.groupBy("user_id", "event_type").agg(F.sum("value").alias("weight"))
    indexed = lookup_join(weights, kinds.select(F.col("style").alias("event_type"), "style_index"), "event_type", how="inner")
    total = F.sum("weight").over(mt.Window.partitionBy("user_id"))
    return indexed.select("user_id", F.col("style_index").alias("class_index"), (F.col("weight") / total).alias("p"))


@register(
    "m9_temperature_reweight",
    f"""WITH {DISTRIBUTION_SQL}
    SELECT user_id, class_index, round(p, 8) AS p,
           round(exp(p * {TEMPERATURE}) / sum(exp(p * {TEMPERATURE})) OVER (PARTITION BY user_id), 8) AS p_new
    FROM p""",
)
def temperature_reweight(spark, sf_dir):
    return rounded(mt.temperature_reweight(distributions(spark, sf_dir), "user_id", "p", TEMPERATURE), 8, "p", "p_new")


@register(
    "m10_sample_from_distribution",
    f"""WITH {DISTRIBUTION_SQL},
    c AS (SELECT *, sum(p) OVER (PARTITION BY user_id ORDER BY class_index) AS reached FROM p)
    SELECT user_id, min(class_index) FILTER (reached >= (user_id * 7919 % 1000) / 1000) AS sampled
    FROM c GROUP BY 1""",
)
def sample_from_distribution(spark, sf_dir):
    draw = F.col("user_id") * 7919 % 1000 / 1000
    return mt.sample_from_distribution(distributions(spark, sf_dir), "user_id", "class_index", "p", draw)


@register(
    "m10_alias_tables",
    f"""WITH {DISTRIBUTION_SQL} SELECT user_id, class_index, round(p, 8) AS p FROM p WHERE p > 1e-9""",
)
def alias_tables(spark, sf_dir):
    """The probabilities of each user's distribution, put together again from its alias table."""
    tables = al.alias_tables(distributions(spark, sf_dir), "user_id", "class_index", "p")
    return rounded(al.table_masses(tables, "user_id", "class_index").filter("p > 1e-9"), 8, "p")


@register(
    "m10_draws",
    f"""WITH {DISTRIBUTION_SQL},
    one AS (SELECT user_id, count(*) AS n, min(class_index) AS class_index FROM p WHERE p > 1e-9 GROUP BY 1)
    SELECT event_id, user_id, n > 0 AS possible, CASE WHEN n = 1 THEN class_index END AS certain
    FROM events JOIN one USING (user_id)""",
)
def draws(spark, sf_dir):
    """A draw per event from its user's distribution: always one of its classes, and that of a user with one class."""
    given = distributions(spark, sf_dir).filter("p > 1e-9")
    tables = al.alias_tables(given, "user_id", "class_index", "p")
    u = (F.pmod(F.xxhash64("event_id"), F.lit(1 << 30)) / float(1 << 30)).alias("u")
    drawn = al.draw_classes(table(spark, sf_dir, "events").select("event_id", "user_id", u), "user_id", "u", tables)
    # a user has a row per event type at most
    classes = given.groupBy("user_id").agg(F.collect_set("class_index").alias("classes"))
    checked = lookup_join(drawn, classes, "user_id", how="inner")
    certain = F.when(F.size("classes") == 1, F.col("sampled"))
    return checked.select("event_id", "user_id", F.array_contains("classes", F.col("sampled")).alias("possible"), certain.alias("certain"))


def trained(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return ml.train_classifier(table(spark, sf_dir, "embeddings"), "embedding", "label", hidden=HIDDEN)


@register(
    "m11_train_classifier",
    f"""WITH s AS (SELECT max(len(embedding)) AS width, max(label) + 1 AS classes FROM embeddings)
    SELECT 0 AS layer, width AS n_in, {HIDDEN}::BIGINT AS n_out, (width + 1) * {HIDDEN} AS n_params FROM s
    UNION ALL SELECT 1, {HIDDEN}, classes, {HIDDEN + 1} * classes FROM s""",
)
def train_classifier(spark, sf_dir):
    return ml.layer_parameters(trained(spark, sf_dir), spark)


def parities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with two bits of their keys as features and the exclusive or of both as class."""
    bits = [F.col(c) % 2 for c in ("o_orderkey", "o_custkey")]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.array(*[b.cast("double") for b in bits]).alias("bits"),
        (bits[0] != bits[1]).cast("int").alias("label"),
    )


def parity_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return ml.train_classifier(parities(spark, sf_dir), "bits", "label", hidden=PARITY_HIDDEN, seed=PARITY_SEED)


@register(
    "m11_epoch_scores",
    """SELECT o_orderkey, (o_orderkey % 2 <> o_custkey % 2)::INTEGER AS label,
           (o_orderkey % 2 <> o_custkey % 2)::INTEGER AS prediction, 6::BIGINT AS n_epochs, TRUE AS improved
    FROM orders WHERE o_orderkey % 3 = 0""",
)
def epoch_scores(spark, sf_dir):
    """Train on two thirds of the orders in two runs of three epochs; the best model on the rest, with the progress of the run."""
    rows = parities(spark, sf_dir)
    train, held_out = rows.filter("o_orderkey % 3 <> 0"), rows.filter("o_orderkey % 3 = 0")
    path = scratch_path(spark, "epochs")
    for epochs in (3, 6):
        scores = ep.train_epochs(train, held_out, "bits", "label", path, epochs, PARITY_HIDDEN, seed=PARITY_SEED)
    progress = mt.score_progress(scores.withColumn("run", F.lit(0)), "run", "epoch", "score")
    progress = progress.select("n_epochs", (F.col("score_change") > 0).alias("improved"))
    scored = ml.score_with_classifier(ep.best_model(spark, path), held_out, "bits", "label")
    # progress is one row
    return scored.select("o_orderkey", "label", "prediction").join(F.broadcast(progress))


@register("m11_training_accuracy", "SELECT count(*) AS n, 1.0::DOUBLE AS accuracy FROM orders")
def training_accuracy(spark, sf_dir):
    """The trained network tells the exclusive or of two bits for every order."""
    return ml.training_accuracy(parity_model(spark, sf_dir), parities(spark, sf_dir), "bits", "label")


@register(
    "m12_score_with_classifier",
    """SELECT o_orderkey, (o_orderkey % 2 <> o_custkey % 2)::INTEGER AS label,
           (o_orderkey % 2 <> o_custkey % 2)::INTEGER AS prediction FROM orders""",
)
def score_with_classifier(spark, sf_dir):
    """Train, save, load again, and score the whole table."""
    path = scratch_path(spark, "model")
    parity_model(spark, sf_dir).save(path)
    scored = ml.score_with_classifier(PipelineModel.load(path), parities(spark, sf_dir), "bits", "label")
    return scored.select("o_orderkey", "label", "prediction")


@register("m12_score_embeddings")
def score_embeddings(spark, sf_dir):
    """Train on the embeddings, save, load again, and score the whole table."""
    path = scratch_path(spark, "model")
    trained(spark, sf_dir).save(path)
    scored = ml.score_with_classifier(PipelineModel.load(path), table(spark, sf_dir, "embeddings"), "embedding", "label")
    return scored.select("vec_id", "label", "prediction")
