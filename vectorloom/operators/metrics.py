"""Training metrics, evaluation and sampling over score tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.operators.numbering import number_rows
from vectorloom.session import materialize

# Scores in the moving average, and scores needed before a projection.
SCORE_WINDOW = 5
MIN_EPOCHS = 5
# Rows handled by one window group of the moving average.
BLOCK_ROWS = 100_000


def masked_mean_loss(costs: DataFrame, cost: Column, mask: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Sum of costs over sum of masks, of the whole table or of each group ``by`` columns."""
    return costs.groupBy(*by).agg(F.try_divide(F.sum(cost), F.sum(mask)).alias("loss"))


def moving_average(
    scores: DataFrame,
    run: str,
    epoch: str,
    score: str,
    window: int = SCORE_WINDOW,
    carry: tuple[str, ...] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean of the last ``window`` scores of the run at every epoch, as ``moving_avg``.

    A run may hold any share of the table, so windows do not run per run but per block
    of consecutive rows: rows are numbered by (run, epoch) and the last ``window - 1``
    rows of a block are repeated at the head of the next one. A block has at least ``window`` rows.
    """
    block_rows = max(block_rows, window)
    numbered = number_rows(scores.select(run, epoch, score, *carry), [run, epoch], "__pos").rows
    block = F.expr(f"__pos div {block_rows}")
    is_tail = F.col("__pos") % block_rows > block_rows - window
    home = F.struct(block.alias("__block"), F.lit(False).alias("__is_head"))
    repeated = F.struct((block + 1).alias("__block"), F.lit(True).alias("__is_head"))
    blocks = numbered.select("*", F.inline(F.when(is_tail, F.array(home, repeated)).otherwise(F.array(home))))
    last_scores = Window.partitionBy(run, "__block").orderBy("__pos").rowsBetween(-(window - 1), 0)
    return (
        blocks.withColumn("moving_avg", F.avg(score).over(last_scores))
        .filter(~F.col("__is_head"))
        .select(run, epoch, score, *carry, "moving_avg")
    )


def score_state(scores: DataFrame, run: str, epoch: str, score: str) -> DataFrame:
    """Per run: number of scores, the first and the latest. Combines before the shuffle."""
    return scores.groupBy(run).agg(
        F.count(score).alias("n_epochs"),
        F.min_by(score, epoch).alias("first_score"),
        F.max_by(score, epoch).alias("last_score"),
    )


def change_of(n: Column, first: Column, last: Column) -> Column:
    """First score minus latest; 0 without scores, the score itself with one."""
    return F.when(n == 0, F.lit(0.0)).when(n == 1, first).otherwise(first - last)


def improvement_of(n: Column, change: Column) -> Column:
    """Change per epoch step; the change itself for a single score."""
    return F.when(n <= 1, change).otherwise(F.try_divide(change, n - 1))


def projection_of(n: Column, last: Column, improvement: Column) -> Column:
    """Epochs left at this pace, 0 before MIN_EPOCHS; NULL when nothing improves."""
    return F.when(n < MIN_EPOCHS, F.lit(0.0)).otherwise(F.try_divide(last, improvement))


def score_progress(scores: DataFrame, run: str, epoch: str, score: str) -> DataFrame:
    """Per run: change, average improvement and projected epochs."""
    n = F.col("n_epochs")
    return (
        score_state(scores, run, epoch, score)
        .withColumn("score_change", change_of(n, F.col("first_score"), F.col("last_score")))
        .withColumn("avg_improvement", improvement_of(n, F.col("score_change")))
        .withColumn("projected_epochs", projection_of(n, F.col("last_score"), F.col("avg_improvement")))
    )


def training_summary(
    scores: DataFrame, run: str, epoch: str, score: str, millis: str, records: str, window: int = SCORE_WINDOW
) -> DataFrame:
    """Totals per run: time in whole minutes, records seen, and the score figures.

    The average is that of the last ``window`` scores: Spark limits the ranking to them before it shuffles.
    """
    latest = Window.partitionBy(run).orderBy(F.desc(epoch))
    last_scores = (
        scores.select(run, epoch, score)
        .withColumn("__rank", F.row_number().over(latest))
        .filter(F.col("__rank") <= window)
        .groupBy(run)
        .agg(F.avg(score).alias("avg_score"))
    )
    n = F.col("n_epochs")
    return (
        scores.groupBy(run)
        .agg(
            F.count(score).alias("n_epochs"),
            F.floor(F.sum(millis) / 60000).alias("total_minutes"),
            F.sum(records).alias("records_seen"),
            F.min_by(score, epoch).alias("first_score"),
            F.max_by(score, epoch).alias("last_score"),
        )
        .join(last_scores, run)
        .withColumn("minutes_per_epoch", F.floor(F.try_divide(F.col("total_minutes"), n)))
        .withColumn("score_change", change_of(n, F.col("first_score"), F.col("last_score")))
        .withColumn("avg_improvement", improvement_of(n, F.col("score_change")))
        .withColumn("projected_epochs", projection_of(n, F.col("last_score"), F.col("avg_improvement")))
        .withColumn("projected_minutes", F.col("minutes_per_epoch") * F.col("projected_epochs"))
    )


def argmax_prediction(outputs: Column) -> Column:
    """0-based index of the highest output, the first of equals."""
    return F.array_position(outputs, F.array_max(outputs)) - 1


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def classification_evaluation(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class: counts, precision, recall, F1; with the overall accuracy on every row."""
    # one row per pair of classes, used twice below
    matrix = materialize(confusion_matrix(df, label, prediction), "confusion")
    hit = F.col("label") == F.col("prediction")
    # each cell counts for its label, and for its prediction where that differs
    per_class = (
        matrix.select(
            "n",
            hit.alias("hit"),
            F.inline(
                F.array(
                    F.struct(F.col("label").alias("class"), F.lit("label").alias("role")),
                    F.struct(F.col("prediction").alias("class"), F.lit("prediction").alias("role")),
                )
            ),
        )
        .groupBy("class")
        .agg(
            F.sum(F.when((F.col("role") == "label") & F.col("hit"), F.col("n")).otherwise(0)).alias("true_positive"),
            F.sum(F.when((F.col("role") == "prediction") & ~F.col("hit"), F.col("n")).otherwise(0)).alias(
                "false_positive"
            ),
            F.sum(F.when((F.col("role") == "label") & ~F.col("hit"), F.col("n")).otherwise(0)).alias(
                "false_negative"
            ),
        )
    )
    totals = matrix.agg(
        F.sum("n").alias("n"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("correct")
    ).first()
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    return (
        per_class.withColumn("precision", ratio(tp, tp + fp))
        .withColumn("recall", ratio(tp, tp + fn))
        .withColumn("f1", ratio(2 * tp, 2 * tp + fp + fn))
        .withColumn("accuracy", F.lit(totals["correct"] / totals["n"] if totals["n"] else None).cast("double"))
    )


def overall_evaluation(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy, and precision, recall and F1 averaged over the classes with equal weight."""
    per_class = classification_evaluation(df, label, prediction)
    averages = [F.avg(c).alias(c) for c in ("precision", "recall", "f1", "accuracy")]
    return per_class.agg(F.count("*").alias("n_classes"), *averages)


def temperature_reweight(dist: DataFrame, sample: str, p: str, temperature: float, out: str = "p_new") -> DataFrame:
    """exp(p·T) / Σ exp(p·T) within each sample; unchanged for T ≤ 0.

    A window group is one distribution: one row per class.
    """
    if temperature <= 0:
        return dist.withColumn(out, F.col(p))
    weight = F.exp(F.col(p) * temperature)
    return dist.withColumn(out, weight / F.sum(weight).over(Window.partitionBy(sample)))


def sample_from_distribution(dist: DataFrame, sample: str, class_index: str, p: str, draw: Column) -> DataFrame:
    """Per sample: the first class whose cumulative probability reaches ``draw``.

    ``draw`` in [0, 1) is a function of the sample's own columns. A distribution that
    never reaches its draw is an error.
    """
    up_to_here = Window.partitionBy(sample).orderBy(class_index).rowsBetween(Window.unboundedPreceding, 0)
    reached = F.sum(p).over(up_to_here) >= draw
    chosen = (
        dist.withColumn("__reached", reached)
        .groupBy(sample)
        .agg(F.min(F.when(F.col("__reached"), F.col(class_index))).alias("sampled"))
    )
    problem = F.raise_error(F.concat(F.lit("invalid distribution: "), F.col(sample).cast("string")))
    return chosen.select(
        sample, F.when(F.col("sampled").isNull(), problem.cast("int")).otherwise(F.col("sampled")).alias("sampled")
    )
