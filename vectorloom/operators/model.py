"""A two-layer perceptron on feature vectors, through Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_vectors(df: DataFrame, features: str, label: str) -> DataFrame:
    return df.withColumns(
        {
            "features_vec": array_to_vector(F.col(features).cast("array<double>")),
            "label_value": F.col(label).cast("double"),
        }
    )


def train_classifier(
    df: DataFrame,
    features: str,
    label: str,
    hidden: int = 4,
    max_iter: int = 100,
    seed: int = 123,
    solver: str = "l-bfgs",
) -> PipelineModel:
    """Fit on an array column and an integer class column; layer sizes come from the data."""
    shape = df.agg(F.max(F.size(features)).alias("width"), F.max(label).alias("top")).first()
    perceptron = MultilayerPerceptronClassifier(
        layers=[shape["width"], hidden, int(shape["top"]) + 1],
        featuresCol="features_vec",
        labelCol="label_value",
        maxIter=max_iter,
        seed=seed,
        solver=solver,
    )
    return Pipeline(stages=[perceptron]).fit(with_vectors(df.select(features, label), features, label))


def layer_parameters(model: PipelineModel, spark) -> DataFrame:
    """Inputs, outputs and number of parameters (weights and biases) of each layer."""
    sizes = [int(n) for n in model.stages[-1].getLayers()]
    rows = [(i, a, b, (a + 1) * b) for i, (a, b) in enumerate(zip(sizes, sizes[1:]))]
    return spark.createDataFrame(rows, "layer int, n_in bigint, n_out bigint, n_params bigint")


def training_accuracy(model: PipelineModel, df: DataFrame, features: str, label: str) -> DataFrame:
    """Rows scored and the share whose prediction is their label."""
    scored = score_with_classifier(model, df, features, label)
    right = F.avg((F.col("prediction") == F.col(label)).cast("double"))
    return scored.agg(F.count("*").alias("n"), right.alias("accuracy"))


def score_with_classifier(model: PipelineModel, df: DataFrame, features: str, label: str) -> DataFrame:
    """Add ``prediction`` (int) and ``probability`` (array) to the rows."""
    scored = model.transform(with_vectors(df, features, label))
    return scored.withColumns(
        {"prediction": F.col("prediction").cast("int"), "probability": vector_to_array("probability")}
    ).drop("features_vec", "label_value", "rawPrediction")
