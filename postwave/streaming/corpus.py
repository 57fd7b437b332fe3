"""Collect a class-balanced corpus from a live stream, whole micro-batches at a time."""

import math
import threading

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..functions.sentiment import NEGATIVE, POSITIVE
from ..plans.sentiment import training_posts
from ..schema import CORPUS_SIZE, LABELLED_POST_SCHEMA, TRAINING_TRIGGER
from ..sources.posts import read_corpus
from .tables import carried, read_batches, write_batch

PROGRESS = "positive bigint, negative bigint, total bigint"


def start_corpus(posts, work, total=CORPUS_SIZE, trigger=None):
    """Start collecting; returns (query, event). The event is set once both classes hold half of ``total``.

    A class takes a batch while it is below its half; without a ``total`` each class takes all batches, and the event is
    never set. ``progress`` keeps the sizes after each batch.
    """
    quota = math.inf if total is None else total // 2
    complete = threading.Event()

    def on_batch(labelled, batch_id):
        spark = labelled.sparkSession
        before = carried(spark, f"{work}/progress", batch_id)
        held = {POSITIVE: before.positive, NEGATIVE: before.negative} if before else {POSITIVE: 0, NEGATIVE: 0}
        wanted = [c for c, n in held.items() if n < quota]
        if wanted:
            write_batch(labelled.filter(F.col("sentiment").isin(wanted)), f"{work}/corpus", batch_id)
            taken = read_corpus(spark, f"{work}/corpus/batch={batch_id}").groupBy("sentiment").count().collect()
            for row in taken:
                held[row["sentiment"]] += row["count"]
        sizes = spark.createDataFrame([(held[POSITIVE], held[NEGATIVE], total)], PROGRESS)
        write_batch(sizes, f"{work}/progress", batch_id)
        if min(held.values()) >= quota:
            complete.set()

    query = (
        training_posts(posts)
        .select("text", "sentiment")
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(**(trigger or {"processingTime": TRAINING_TRIGGER}))
        .start()
    )
    return query, complete


def collect_corpus(posts, work, total=CORPUS_SIZE, trigger=None):
    """Collect until complete or until the stream has no more posts, stop the stream, return the corpus."""
    query, complete = start_corpus(posts, work, total, trigger)
    drained = threading.Thread(target=wait_for_all, args=(query,), daemon=True)
    drained.start()
    while drained.is_alive() and not complete.wait(0.1):
        pass
    query.stop()
    failed = query.exception()
    if failed is not None and not complete.is_set():
        raise failed
    return read_batches(posts.sparkSession, f"{work}/corpus", LABELLED_POST_SCHEMA)


def wait_for_all(query):
    """Wait until a stream has worked through what is there; returns as well when it is stopped or fails."""
    try:
        query.processAllAvailable()
    except StreamingQueryException:
        return


def read_progress(spark, work):
    """Class sizes after each batch; no rows before the first one."""
    return read_batches(spark, f"{work}/progress", PROGRESS)
