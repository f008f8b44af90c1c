import random

import pytest
from pyspark.sql import functions as F

from vectorloom.operators import metrics as mt
from vectorloom.operators.model import layer_parameters, score_with_classifier, train_classifier

SERIES = [0.9, 0.8, 0.7, 0.71, 0.6]


def runs(spark, *series):
    rows = [(run, epoch, float(s)) for run, scores in enumerate(series) for epoch, s in enumerate(scores)]
    return spark.createDataFrame(rows, "run int, epoch int, score double")


@pytest.mark.parametrize(
    "n, average, change, improvement, projected",
    [(1, 0.9, 0.9, 0.9, 0.0), (3, 0.8, 0.2, 0.1, 0.0), (5, 0.742, 0.3, 0.075, 8.0)],
)
def test_progress(spark, n, average, change, improvement, projected):
    df = runs(spark, SERIES[:n])
    row = mt.score_progress(df, "run", "epoch", "score").first()
    assert [row["score_change"], row["avg_improvement"], row["projected_epochs"]] == pytest.approx(
        [change, improvement, projected]
    )
    last = mt.moving_average(df, "run", "epoch", "score").orderBy(F.desc("epoch")).first()
    assert last["moving_avg"] == pytest.approx(average)


def test_no_scores(spark):
    df = runs(spark, [])
    assert mt.score_progress(df, "run", "epoch", "score").count() == 0
    assert mt.moving_average(df, "run", "epoch", "score").count() == 0
    nulls = spark.createDataFrame([(0, 0, None)], "run int, epoch int, score double")
    row = mt.score_progress(nulls, "run", "epoch", "score").first()
    assert (row["score_change"], row["avg_improvement"], row["projected_epochs"]) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("block_rows", [3, 7, 100_000])
@pytest.mark.parametrize("window", [1, 5, 50])
def test_moving_average_over_blocks(spark, block_rows, window):
    """A hot run spans many blocks, and short runs share one; both match a plain loop."""
    rng = random.Random(1)
    series = [[rng.random() for _ in range(n)] for n in (200, 1, 3, 40, 2, 6)]
    got = mt.moving_average(runs(spark, *series), "run", "epoch", "score", window, block_rows=block_rows).collect()
    assert len(got) == sum(map(len, series))
    for r in got:
        last = series[r["run"]][max(0, r["epoch"] - window + 1) : r["epoch"] + 1]
        assert r["moving_avg"] == pytest.approx(sum(last) / len(last))


def test_training_summary(spark):
    df = runs(spark, SERIES).withColumns({"ms": F.lit(90_000), "records": F.lit(32)})
    row = mt.training_summary(df, "run", "epoch", "score", "ms", "records").first()
    assert (row["total_minutes"], row["minutes_per_epoch"], row["records_seen"]) == (7, 1, 160)
    assert row["avg_score"] == pytest.approx(0.742)
    assert row["projected_minutes"] == pytest.approx(8.0)


def test_evaluation(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] * 2 + [(1, 1)] * 4 + [(2, 0)]
    df = spark.createDataFrame(pairs, "y int, p int")
    rows = {r["class"]: r for r in mt.classification_evaluation(df, "y", "p").collect()}
    assert (rows[0]["true_positive"], rows[0]["false_positive"], rows[0]["false_negative"]) == (3, 1, 2)
    assert rows[1]["precision"] == pytest.approx(4 / 6) and rows[1]["recall"] == 1.0
    assert (rows[2]["precision"], rows[2]["recall"], rows[2]["f1"]) == (0.0, 0.0, 0.0)
    assert {r["accuracy"] for r in rows.values()} == {0.7}
    assert sum(r["n"] for r in mt.confusion_matrix(df, "y", "p").collect()) == 10


def test_overall_evaluation(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] * 2 + [(1, 1)] * 4 + [(2, 0)]
    row = mt.overall_evaluation(spark.createDataFrame(pairs, "y int, p int"), "y", "p").first()
    assert (row["n_classes"], row["accuracy"]) == (3, pytest.approx(0.7))
    assert row["precision"] == pytest.approx((3 / 4 + 4 / 6 + 0) / 3) and row["recall"] == pytest.approx((3 / 5 + 1) / 3)


def test_summary_needs_no_global_sort(spark):
    df = runs(spark, SERIES).withColumns({"ms": F.lit(1), "records": F.lit(1)})
    plan = mt.training_summary(df, "run", "epoch", "score", "ms", "records")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "rangepartitioning" not in plan


def test_masked_loss(spark):
    df = spark.createDataFrame([(2.0, 1), (3.0, 1), (0.0, 0)], "c double, m int")
    assert mt.masked_mean_loss(df, F.col("c"), F.col("m")).first()["loss"] == 2.5


def test_reweight_and_sample(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 1, 0.6), (0, 2, 0.3), (1, 0, 1.0)], "s int, k int, p double")
    rows = mt.temperature_reweight(df, "s", "p", 2.0).collect()
    assert sum(r["p_new"] for r in rows) == pytest.approx(2.0)
    assert {r["p_new"] for r in mt.temperature_reweight(df, "s", "p", 0.0).collect()} == {0.1, 0.6, 0.3, 1.0}
    for draw, expected in ((0.0, 0), (0.1, 0), (0.11, 1), (0.69, 1), (0.71, 2)):
        got = {r["s"]: r["sampled"] for r in mt.sample_from_distribution(df, "s", "k", "p", F.lit(draw)).collect()}
        assert got == {0: expected, 1: 0}
    with pytest.raises(Exception, match="invalid distribution"):
        mt.sample_from_distribution(df, "s", "k", "p", F.lit(1.5)).collect()


def test_argmax(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],), ([3.0],)], "v array<double>")
    assert [r[0] for r in df.select(mt.argmax_prediction(F.col("v"))).collect()] == [1, 0]


def test_xor_is_learned(spark):
    df = spark.createDataFrame([([a, b], int(a != b)) for a in (0.0, 1.0) for b in (0.0, 1.0)], "x array<double>, y int")
    model = train_classifier(df, "x", "y", hidden=4, max_iter=300)
    assert [tuple(r) for r in layer_parameters(model, spark).collect()] == [(0, 2, 4, 12), (1, 4, 2, 10)]
    assert sum(r["n_params"] for r in layer_parameters(model, spark).collect()) == len(model.stages[-1].weights)
    assert all(r["prediction"] == r["y"] for r in score_with_classifier(model, df, "x", "y").collect())
