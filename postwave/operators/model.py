"""Logistic regression by full-batch gradient descent, and its use.

The model is ``width`` doubles. It lives on the driver between iterations and enters each plan as a constant array;
only per-bucket gradient sums, at most ``width`` rows, come back.
"""

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..functions.vectors import dot, sigmoid
from ..schema import FEATURE_WIDTH, SGD_ITERATIONS, SGD_STEP, SGD_TOLERANCE


@dataclass(frozen=True)
class LogisticModel:
    weights: tuple
    version: int = 0

    @classmethod
    def zeros(cls, width=FEATURE_WIDTH):
        return cls((0.0,) * width)

    def describe(self):
        """The text the MLlib model prints for itself."""
        return (
            "org.apache.spark.mllib.classification.LogisticRegressionModel: intercept = 0.0, "
            f"numFeatures = {len(self.weights)}, numClasses = 2, threshold = 0.5"
        )


def gradient(points, weights, label="sentiment", features="features"):
    """(idx, gradient): sum of (p - y) * x per bucket; each task adds up its own rows before the shuffle."""
    error = sigmoid(dot(F.col(features), weights)) - F.col(label)
    # The error gets its own projection: beside the generator it would be computed once per vector entry.
    errors = points.select(error.alias("error"), features)
    parts = errors.select("error", F.inline(F.arrays_zip(features + ".idx", features + ".value")))
    return parts.groupBy("idx").agg(F.sum(F.col("error") * F.col("value")).alias("gradient"))


def train(points, start=None, iterations=SGD_ITERATIONS, step=SGD_STEP, tolerance=SGD_TOLERANCE,
          label="sentiment", features="features", width=FEATURE_WIDTH):
    """Warm-started descent with step / sqrt(i), until the weights move by less than the tolerance.

    Returns ``start`` itself when there are no rows.
    """
    start = start or LogisticModel.zeros(width)
    points = points.select(label, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = points.count()
        if rows == 0:
            return start
        weights = list(start.weights)
        for i in range(1, iterations + 1):
            before = list(weights)
            rate = step / math.sqrt(i)
            for r in gradient(points, before, label, features).collect():
                weights[r.idx] = before[r.idx] - rate * (r.gradient / rows)
            moved = math.dist(weights, before)
            if i > 1 and moved < tolerance * max(math.hypot(*weights), 1.0):
                break
        return LogisticModel(tuple(weights), start.version + 1)
    finally:
        points.unpersist()


def with_prediction(df, model, features="features", out="prediction"):
    """1.0 where the predicted probability is above one half, else 0.0 (also without features)."""
    p = sigmoid(dot(F.col(features), model.weights))
    return df.withColumn(out, F.when(p > 0.5, F.lit(1.0)).otherwise(F.lit(0.0)))


def scored_posts(df, model, text="text", features="features", keep=()):
    """(tweet, sentiment) with the sentiment as text, '1.0' or '0.0', after the columns ``keep`` names."""
    scored = with_prediction(df, model, features)
    return scored.select(*keep, F.col(text).alias("tweet"), F.col("prediction").cast("string").alias("sentiment"))


def weights_table(spark, model):
    rows = [(i, w, model.version) for i, w in enumerate(model.weights)]
    return spark.createDataFrame(rows, "idx int, weight double, version bigint")
