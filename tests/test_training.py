"""The character model against counts by hand, and training that is cut and resumed."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vectorloom.functions.vocab import Vocabulary
from vectorloom.operators import char_model as cm
from vectorloom.operators import epochs as ep
from vectorloom.operators import metrics as mt

VOCAB = Vocabulary("abc")
TEXTS = [("x", "abcab"), ("x", "aab?"), ("y", "cc"), (None, "ab"), ("y", ""), ("x", None)]
HELD = [("x", "abc"), ("new", "ba"), (None, "cab"), ("y", "")]


def pairs(texts):
    out = Counter()
    for style, text in texts:
        if text is not None:
            ids = [3, *[VOCAB.characters.index(c) for c in text if c in VOCAB.characters], 3]
            out.update((style, i, o) for i, o in zip(ids, ids[1:]))
    return out


def loss_by_hand(back_off=cm.BACK_OFF):
    seen = pairs(TEXTS)

    def n(**want):
        return sum(k for (s, i, o), k in seen.items() if all({"s": s, "i": i, "o": o}[key] == v for key, v in want.items()))

    cost, mask = Counter(), Counter()
    for (s, i, o), k in pairs(HELD).items():
        p = (n(o=o) + 1) / (n() + 4)
        p = (n(i=i, o=o) + back_off * p) / (n(i=i) + back_off)
        p = (n(s=s, i=i, o=o) + back_off * p) / (n(s=s, i=i) + back_off)
        cost[s] -= k * math.log(p)
        mask[s] += k
    return {s: cost[s] / mask[s] for s in mask}


def counts(spark, texts):
    return cm.pair_counts(spark.createDataFrame(texts, "style string, text string"), "text", ("style",), VOCAB)


def test_pair_counts(spark):
    got = {(r["style"], r["in_idx"], r["out_idx"]): r["n"] for r in counts(spark, TEXTS).collect()}
    assert got == dict(pairs(TEXTS))


def test_held_out_loss(spark):
    model = cm.fit_char_model(counts(spark, TEXTS), "style", VOCAB)
    got = {r["style"]: r["loss"] for r in cm.held_out_loss(counts(spark, HELD), model).collect()}
    assert got == pytest.approx(loss_by_hand())


def test_probabilities_add_up_to_one(spark):
    model = cm.fit_char_model(counts(spark, TEXTS), "style", VOCAB)
    every = spark.range(16).select(F.expr("int(id div 4)").alias("in_idx"), (F.col("id") % 4).cast("int").alias("out_idx"))
    every = every.join(spark.createDataFrame([("x",), ("new",), (None,)], "style string"))
    sums = cm.step_probabilities(every, model).groupBy("style", "in_idx").agg(F.sum("p").alias("p")).collect()
    assert len(sums) == 12 and all(r["p"] == pytest.approx(1) for r in sums)


def test_a_model_of_nothing_is_even(spark):
    model = cm.fit_char_model(counts(spark, TEXTS[:0]), "style", VOCAB)
    got = cm.held_out_loss(counts(spark, HELD[:1]), model).first()
    assert got["loss"] == pytest.approx(math.log(4))


@pytest.fixture(scope="module")
def bits(spark):
    rows = [([float(a), float(b)], a ^ b) for a in (0, 1) for b in (0, 1)] * 10
    return spark.createDataFrame(rows, "bits array<double>, label int")


def test_a_resumed_run_equals_an_uncut_one(spark, bits, tmp_path):
    cut, uncut = str(tmp_path / "cut"), str(tmp_path / "uncut")
    for epochs in (1, 3, 3):
        ep.train_epochs(bits, bits, "bits", "label", cut, epochs, steps=5)
    ep.train_epochs(bits, bits, "bits", "label", uncut, 3, steps=5)
    scores = [[(r["epoch"], r["score"], r["records"]) for r in ep.epoch_scores(spark, p).orderBy("epoch").collect()] for p in (cut, uncut)]
    assert [s[0] for s in scores[0]] == [0, 1, 2] and scores[0][0][2] == 40
    assert [s[1] for s in scores[0]] == pytest.approx([s[1] for s in scores[1]], rel=1e-9)
    one, other = ep.best_model(spark, cut), ep.best_model(spark, uncut)
    assert one.weights.toArray().tolist() == pytest.approx(other.weights.toArray().tolist(), rel=1e-9)


def test_scores_feed_the_metrics(spark, bits, tmp_path):
    scores = ep.train_epochs(bits, bits, "bits", "label", str(tmp_path / "run"), 6).withColumn("run", F.lit("r"))
    values = [r["score"] for r in scores.orderBy("epoch").collect()]
    progress = mt.score_progress(scores, "run", "epoch", "score").first()
    assert progress["score_change"] == values[0] - values[-1] and progress["n_epochs"] == 6
    averages = mt.moving_average(scores, "run", "epoch", "score").orderBy("epoch").collect()
    assert averages[-1]["moving_avg"] == pytest.approx(sum(values[1:]) / 5)
    best = ep.held_out_score(ep.best_model(spark, str(tmp_path / "run")), bits, "bits", "label")
    assert best == pytest.approx(min(values))


def test_held_out_classes_that_training_lacks(spark, bits, tmp_path):
    other = spark.createDataFrame([([0.0, 1.0], 7)], bits.schema)
    scores = ep.train_epochs(bits, other, "bits", "label", str(tmp_path / "run"), 1, steps=2)
    assert scores.first()["score"] == pytest.approx(-math.log(1e-15))


def test_another_shape_is_an_error(spark, bits, tmp_path):
    path = str(tmp_path / "run")
    ep.train_epochs(bits, bits, "bits", "label", path, 1, steps=2)
    with pytest.raises(ValueError, match="layers"):
        ep.train_epochs(bits, bits, "bits", "label", path, 2, hidden=5)
    with pytest.raises(ValueError, match="no finished epoch"):
        ep.best_model(spark, str(tmp_path / "none"))


def test_predictions_follow_from_the_weights(spark):
    """Scores of the embeddings, by a forward pass over the saved weights in plain arithmetic."""
    import numpy as np

    from vectorloom.operators import model as ml

    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    model = ml.train_classifier(rows, "embedding", "label", hidden=16)
    network = model.stages[-1]
    width, hidden, classes = network.getLayers()
    weights = network.weights.toArray()
    first, weights = weights[: width * hidden].reshape(hidden, width, order="F"), weights[width * hidden :]
    first_bias, weights = weights[:hidden], weights[hidden:]
    second, second_bias = weights[: hidden * classes].reshape(classes, hidden, order="F"), weights[hidden * classes :]
    scored = ml.score_with_classifier(model, rows, "embedding", "label").collect()
    for r in scored:
        inner = 1 / (1 + np.exp(-(first @ np.array(r["embedding"], float) + first_bias)))
        outer = np.exp(second @ inner + second_bias)
        assert r["probability"] == pytest.approx((outer / outer.sum()).tolist(), abs=1e-6)
        assert r["prediction"] == int(np.argmax(r["probability"]))
    assert len(scored) == rows.count()
