"""Train the sentiment model on a live stream and evaluate it after every batch."""

from pyspark.sql import functions as F

from ..operators.evaluate import statistics
from ..operators.features import IdfModel, fit_idf, with_tfidf
from ..operators.model import LogisticModel, train, with_prediction
from ..plans.sentiment import DEFAULT, Trained, training_posts
from ..schema import SGD_ITERATIONS, SGD_STEP, SGD_TOLERANCE, TRAINING_TRIGGER
from .tables import carried, read_batches, write_batch

MODEL = "version bigint, weights array<double>"
METRICS = "trainer string, model string, areaUnderRoc double, accuracy double, version bigint"
IDF = "posts bigint, document_frequency array<bigint>, weights array<double>"


def start_training(posts, work, points=None, featurizer=DEFAULT, train_features="tf", iterations=SGD_ITERATIONS,
                   step=SGD_STEP, tolerance=SGD_TOLERANCE, trigger=None):
    """Start training on the tracked English originals of a post stream; returns the query.

    Every batch starts from the weights the batch before left and leaves its own; a batch without rows passes them on.
    With the ``points`` of a corpus (``training_points``), every new model is evaluated there and the row kept in
    ``metrics``; the IDF fitted on them is stored beside the weights (``latest_trained``). The points are read once per
    model, so pass a materialized table. ``train_features`` is 'tf' or, to train on what is scored later, 'tfidf', which needs the points too.
    """
    if train_features not in ("tf", "tfidf"):
        raise ValueError("train_features is 'tf' or 'tfidf'")
    idf = tested = None
    if points is not None:
        idf = fit_idf(points, width=featurizer.width)
        tested = with_tfidf(points, idf)
        write_idf(points.sparkSession, work, idf)

    def on_batch(labelled, batch_id):
        spark = labelled.sparkSession
        before = carried(spark, f"{work}/weights", batch_id)
        start = LogisticModel(tuple(before.weights), before.version) if before else LogisticModel.zeros(featurizer.width)
        rows = featurizer.tf(labelled) if train_features == "tf" else featurizer.tfidf(labelled, idf)
        fitted = train(rows, start, iterations, step, tolerance, width=featurizer.width)
        left = spark.createDataFrame([(fitted.version, list(fitted.weights))], MODEL)
        write_batch(left, f"{work}/weights", batch_id)
        if tested is not None and fitted.version > start.version:
            row = statistics(with_prediction(tested, fitted), fitted)
            write_batch(row.withColumn("version", F.lit(fitted.version).cast("bigint")), f"{work}/metrics", batch_id)

    return (
        training_posts(posts)
        .select("text", "sentiment")
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(**(trigger or {"processingTime": TRAINING_TRIGGER}))
        .start()
    )


def latest_model(spark, work):
    """The newest model, or None before the first batch."""
    row = read_batches(spark, f"{work}/weights", MODEL).orderBy(F.desc("batch")).first()
    return LogisticModel(tuple(row.weights), row.version) if row else None


def latest_trained(spark, work):
    """The newest model with the IDF of its corpus, ready to classify in any session; None before the first batch.

    The stream must have been started with the points of a corpus.
    """
    newest = latest_model(spark, work)
    if newest is None:
        return None
    row = spark.read.schema(IDF).parquet(f"{work}/idf").first()
    return Trained(newest, IdfModel(row.posts, tuple(row.document_frequency), tuple(row.weights)), None)


def write_idf(spark, work, idf):
    row = [(idf.posts, list(idf.document_frequency), list(idf.weights))]
    spark.createDataFrame(row, IDF).write.mode("overwrite").parquet(f"{work}/idf")


def read_metrics(spark, work):
    """The statistics of each new model; no rows before the first one."""
    return read_batches(spark, f"{work}/metrics", METRICS)
