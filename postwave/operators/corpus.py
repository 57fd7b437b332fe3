"""Class-balanced corpora, collected batch by batch until each class has half of the wanted size."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.sentiment import NEGATIVE, POSITIVE
from ..schema import CORPUS_SIZE

# Running totals sort at most this many batches in one group.
BATCHES_PER_CHUNK = 100_000


def class_counts(labelled):
    return labelled.groupBy("sentiment").agg(F.count("*").alias("count"))


def running_totals(sizes, keys, values):
    """Running sums of ``values`` by batch, per key, as ``<value>_after``; one row per key and batch.

    Batches are summed within chunks of the batch number, and the chunk totals, few as they are, carry over.
    """
    rows = sizes.withColumn("chunk", F.floor(F.col("batch") / BATCHES_PER_CHUNK))
    totals = rows.groupBy(*keys, "chunk").agg(*(F.sum(v).alias(v) for v in values))
    before = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "chunk", *(F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"{v}_before") for v in values)
    )
    inside = Window.partitionBy(*keys, "chunk").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    after = {f"{v}_after": F.col(f"{v}_before") + F.sum(v).over(inside) for v in values}
    return rows.join(offsets, [*keys, "chunk"]).withColumns(after).drop("chunk", *(f"{v}_before" for v in values))


def kept_batches(labelled, total=CORPUS_SIZE):
    """(sentiment, batch): the batches each class takes; it takes them whole while it holds fewer than total / 2 rows.

    One way serves every quota: chunked running totals, so no task sorts all batches of a class.
    """
    quota = total // 2
    sizes = labelled.groupBy("sentiment", "batch").agg(F.count("*").alias("count"))
    sums = running_totals(sizes, ["sentiment"], ["count"])
    return sums.filter(F.col("count_after") - F.col("count") < quota).select("sentiment", "batch")


def balanced_corpus(labelled, total=CORPUS_SIZE):
    """The rows of the kept batches, both classes together."""
    return labelled.join(kept_batches(labelled, total), ["sentiment", "batch"], "left_semi")


def corpus_progress(labelled, total=CORPUS_SIZE):
    """(batch, positive, negative, total): corpus sizes after each batch, up to the one that completes both."""
    quota = total // 2
    classes = {"positive": POSITIVE, "negative": NEGATIVE}
    sizes = labelled.groupBy("batch").agg(*(F.count_if(F.col("sentiment") == y).alias(c) for c, y in classes.items()))
    seen = running_totals(sizes, [], list(classes))

    # A class stops at the size and batch where it first has its half; later batches add nothing.
    full = []
    for c in classes:
        enough = F.col(f"{c}_after") >= quota
        full += [
            F.min(F.when(enough, F.col(f"{c}_after"))).alias(c),
            F.min(F.when(enough, F.col("batch"))).alias(f"{c}_batch"),
        ]
    rows = seen.withColumn("full", seen.agg(F.struct(*full).alias("full")).scalar())
    done = F.when(
        F.col("full.positive_batch").isNotNull() & F.col("full.negative_batch").isNotNull(),
        F.greatest("full.positive_batch", "full.negative_batch"),
    )
    return rows.filter(F.col("batch") <= F.coalesce(done, F.col("batch"))).select(
        "batch",
        *(F.least(f"{c}_after", f"full.{c}").alias(c) for c in classes),
        F.lit(total).cast("bigint").alias("total"),
    )
