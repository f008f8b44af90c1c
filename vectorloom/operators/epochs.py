"""Training epoch by epoch: each goes on from the weights of the one before and is scored on held-out rows.

Every epoch writes its model and then its score, so a run that was cut goes on where it ended, with the same weights
as one that was not. The scores are a table like any other score table of ``metrics``.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.operators.metrics import masked_mean_loss
from vectorloom.operators.model import score_with_classifier, with_vectors
from vectorloom.session import materialize

_SCORES = "epoch bigint, score double, millis bigint, records bigint"
# Least probability that a cost is taken of.
_LEAST = 1e-15


def epoch_scores(spark: SparkSession, path: str) -> DataFrame:
    """(epoch, score, millis, records) of the epochs a run has finished, from 0."""
    try:
        return spark.read.schema(_SCORES).parquet(f"{path}/scores/*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCORES)


def held_out_score(model: MultilayerPerceptronClassificationModel, held_out: DataFrame, features: str, label: str) -> float | None:
    """Mean negative logarithm of the probability of the right class; NULL without rows."""
    scored = score_with_classifier(model, held_out, features, label)
    right = F.get("probability", F.col(label).cast("int"))
    cost = -F.log(F.greatest(F.coalesce(right, F.lit(0.0)), F.lit(_LEAST)))
    return masked_mean_loss(scored, cost, F.lit(1)).first()["loss"]


def train_epochs(
    train: DataFrame,
    held_out: DataFrame,
    features: str,
    label: str,
    path: str,
    epochs: int,
    hidden: int = 4,
    steps: int = 20,
    seed: int = 123,
) -> DataFrame:
    """Train up to ``epochs`` epochs of ``steps`` optimizer steps each in the run at ``path``; returns its scores.

    Epochs that ``path`` has already are not trained again. The layers come from the training rows; classes of held-out
    rows that those do not have cost as much as can be. An epoch counts once its score is written, which is the last thing it does.
    """
    spark = train.sparkSession
    rows = materialize(with_vectors(train.select(features, label), features, label), "epoch-rows")
    # one pass for the shape
    shape = rows.agg(F.max(F.size(features)).alias("width"), F.max(label).alias("top"), F.count("*").alias("n")).first()
    layers = [shape["width"], hidden, int(shape["top"]) + 1]
    # one row per epoch
    done = epoch_scores(spark, path).agg(F.max("epoch")).first()[0]
    last = None if done is None else _model(path, done)
    for epoch in range(0 if done is None else done + 1, epochs):
        began = time.monotonic()
        perceptron = MultilayerPerceptronClassifier(
            layers=layers, featuresCol="features_vec", labelCol="label_value", maxIter=steps, seed=seed
        )
        if last is not None:
            if last.getLayers() != layers:
                raise ValueError(f"{path} holds a model of layers {last.getLayers()}, the rows ask for {layers}")
            perceptron.setInitialWeights(last.weights)
        last = perceptron.fit(rows)
        last.write().overwrite().save(f"{path}/models/{epoch}")
        score = held_out_score(last, held_out, features, label)
        millis = int((time.monotonic() - began) * 1000)
        one = spark.createDataFrame([(epoch, score, millis, shape["n"])], _SCORES)
        one.coalesce(1).write.mode("overwrite").parquet(f"{path}/scores/{epoch}")
    return epoch_scores(spark, path)


def _model(path: str, epoch: int) -> MultilayerPerceptronClassificationModel:
    return MultilayerPerceptronClassificationModel.load(f"{path}/models/{epoch}")


def best_model(spark: SparkSession, path: str) -> MultilayerPerceptronClassificationModel:
    """The model of the epoch with the lowest score, the first of equals; epochs without a score count last."""
    best = epoch_scores(spark, path).orderBy(F.asc_nulls_last("score"), "epoch").first()
    if best is None:
        raise ValueError(f"{path} has no finished epoch")
    return _model(path, best["epoch"])
