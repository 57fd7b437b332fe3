"""Accuracy, area under the ROC curve, and the one-row statistics of a model."""

from pyspark.sql import Window
from pyspark.sql import functions as F

NAN = float("nan")


def accuracy(prediction="prediction", label="label"):
    """Share of exact matches; NaN for no rows."""
    return F.coalesce(F.avg((F.col(prediction) == F.col(label)).cast("double")), F.lit(NAN))


def hard_auc(prediction="prediction", label="label"):
    """Area under the ROC curve of 0/1 predictions: (TPR + TNR) / 2, in one aggregate.

    A class that never occurs leaves its rate at the curve's end point: all-positive data give 1, all-negative 0.
    """
    y, p = F.col(label) > 0.5, F.col(prediction) > 0.5
    tpr = F.avg(F.when(y, p.cast("double")))
    tnr = F.avg(F.when(~y, (~p).cast("double")))
    one_class = F.when(tnr.isNull() & tpr.isNull(), F.lit(NAN)).when(tnr.isNull(), 1.0).when(tpr.isNull(), 0.0)
    return F.coalesce(one_class, (tpr + tnr) / 2)


def area_under_roc(scores, prediction="prediction", label="label", ranges=None):
    """One row, ``auc``, for any scores, with ties counted half.

    Equal scores become one row first. Distinct scores are then cut into ranges of about equal size; positives are
    compared with the negatives of lower ranges through the range totals and within a range by a running sum, so no task
    sorts the whole table. ``ranges`` is the session's number of shuffle partitions by default, so it grows with them.
    """
    ranges = max(2, ranges or int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    y = F.col(label) > 0.5
    by_score = scores.groupBy(F.col(prediction).alias("score")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")
    )
    cuts = by_score.agg(
        F.percentile_approx("score", [i / ranges for i in range(1, ranges)], max(10_000, 100 * ranges)).alias("cuts")
    )
    placed = by_score.withColumn("cuts", cuts.scalar()).select(
        "score", "pos", "neg", F.size(F.filter("cuts", lambda c: c < F.col("score"))).alias("part")
    )
    inside = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pairs = F.col("pos") * (F.sum("neg").over(inside) - F.col("neg") / 2)
    totals = (
        placed.select("part", "pos", "neg", pairs.alias("pairs"))
        .groupBy("part")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("pairs").alias("pairs"))
    )
    below = F.sum("neg").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    won = F.col("pairs") + F.col("pos").cast("double") * (below - F.col("neg"))
    pos, neg = F.sum("pos"), F.sum("neg")
    area = (
        F.when(pos.isNull(), F.lit(NAN)).when(neg == 0, F.lit(1.0)).when(pos == 0, F.lit(0.0))
        .otherwise(F.sum("won") / (pos.cast("double") * neg))
    )
    return totals.select("pos", "neg", won.alias("won")).agg(area.alias("auc"))


def statistics(scored, model, trainer="Online", prediction="prediction", label="sentiment"):
    """(trainer, model, areaUnderRoc, accuracy) of 0/1 predictions, one row from one pass."""
    return scored.agg(
        hard_auc(prediction, label).alias("areaUnderRoc"), accuracy(prediction, label).alias("accuracy")
    ).select(F.lit(trainer).alias("trainer"), F.lit(model.describe()).alias("model"), "areaUnderRoc", "accuracy")
