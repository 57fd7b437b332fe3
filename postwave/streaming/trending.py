"""Trending hashtags of a live stream.

The stream's state holds one count per hashtag and open bucket of ``slide`` seconds. Once the watermark closes buckets, the
windows that end there are ranked by the same operators as on a static table. A batch does not read its window again: it
starts from the counts of the last window that was ranked (``counts``, a table that each batch leaves to the next one), adds
the buckets that have closed and takes off those that leave, which it reads from the bucket table by their time. What no later
batch can ask for is deleted.

``work`` holds the stream's checkpoint and these tables, one folder a batch: ``top`` (ranked spans of windows), ``counts``,
``buckets`` (by hour) and ``progress`` (one row: the last ranked end and the batch that left its counts).
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..operators.payload import ordered_payload
from ..operators.trending import live_counts, top_spans, window_ends
from ..schema import LATENESS, SLIDE_SECONDS, TOP_K, TRENDING_TRIGGER, WINDOW_SECONDS
from ..session import discard
from .tables import batch_path, carried, read_batch, read_batches, write_batch

HOUR = 3600
PROGRESS = "ended bigint, counts_batch bigint"
SPANS = "first_end bigint, last_end bigint, rank int, hashtag string, count bigint"

# The top of the live counts as SQL over the view that each batch registers.
TOP_SQL = "SELECT hashtag, count FROM hashtags ORDER BY count DESC, hashtag LIMIT {k}"


def closed_buckets(tagged, slide=SLIDE_SECONDS, lateness=LATENESS):
    counts = (
        tagged.withWatermark("created_at", lateness)
        .groupBy(F.window("created_at", f"{slide} seconds"), "hashtag")
        .agg(F.count("*").alias("count"))
    )
    return counts.select("hashtag", F.floor(F.unix_seconds("window.start") / slide).alias("bucket"), "count")


def write_buckets(closed, path, batch_id, slide):
    """Closed buckets by hour and batch; a replay overwrites its own partitions only."""
    rows = closed.withColumns({"hour": F.floor(F.col("bucket") * slide / HOUR), "batch": F.lit(batch_id)})
    rows.hint("rebalance", "hour").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "hour", "batch"
    ).parquet(path)


def read_buckets(spark, path, since, until, before_batch, slide=SLIDE_SECONDS):
    """Buckets that earlier batches left in [since, until), epoch seconds, or None. Only those hours are listed."""
    hours = ",".join(str(h) for h in range(since // HOUR, (until - 1) // HOUR + 1))
    try:
        rows = spark.read.option("basePath", path).parquet(f"{path}/hour={{{hours}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    own = (F.col("bucket") >= since // slide) & (F.col("bucket") < -(-until // slide))
    # A replay must not see what later batches have written.
    return rows.filter(own & (F.col("batch") < before_batch)).select("hashtag", "bucket", "count")


def held_before(spark, work, state, until, batch_id, window, slide):
    """(counts of the last ranked window, buckets of it that leave by ``until``), or None before the first one."""
    if state is None or state.ended is None:
        return None
    counts = read_batch(spark, f"{work}/counts", state.counts_batch)
    since = state.ended - window
    leaving = read_buckets(spark, f"{work}/buckets", since, min(until - window, state.ended), batch_id, slide) if until > state.ended else None
    if leaving is None:
        leaving = spark.createDataFrame([], "hashtag string, bucket bigint, count bigint")
    return counts, leaving


def forget(spark, work, state, window):
    """Delete the counts and the hours of buckets that neither the next batch nor a replay of this one can ask for."""
    if state is None or state.ended is None:
        return
    newest, oldest = state.counts_batch, (state.ended - window) // HOUR
    for table, name, keep in (("counts", "batch", newest), ("buckets", "hour", oldest)):
        for number in numbered(spark, f"{work}/{table}", name):
            if number < keep:
                discard(spark, f"{work}/{table}/{name}={number}")


def numbered(spark, path, name):
    """The numbers of the partition folders ``name=number`` below a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(where):
        return []
    folders = [status.getPath().getName() for status in store.listStatus(where)]
    return [int(folder.removeprefix(f"{name}=")) for folder in folders if folder.startswith(f"{name}=")]


def start_trending(tagged, work, publish=None, window=WINDOW_SECONDS, slide=SLIDE_SECONDS, k=TOP_K, lateness=LATENESS,
                   every_window=True, trigger=None):
    """Start the job on a stream of (created_at, hashtag); returns the query.

    ``work`` is a shared folder (see above). Each batch ranks every window that ended since the batch before, or only the
    newest one: the top of the live counts, by SQL over the view ``hashtags`` in the batch's own session. ``publish`` gets
    the JSON payloads. ``finish_trending`` ends a bounded stream.
    """

    def on_batch(closed, batch_id):
        spark = closed.sparkSession
        closed = closed.persist()
        try:
            state = carried(spark, f"{work}/progress", batch_id)
            newest = closed.agg(F.max("bucket")).first()[0]
            if newest is None:
                left = (state.ended, state.counts_batch) if state else (None, None)
            else:
                until = (newest + 1) * slide
                held = held_before(spark, work, state, until, batch_id, window, slide)
                write_buckets(closed.filter(F.col("bucket") * slide >= until - window), f"{work}/buckets", batch_id, slide)
                write_batch(live_counts(closed, window // slide, until // slide, held), f"{work}/counts", batch_id)
                if every_window:
                    first = None if held is None else state.ended // slide + 1
                    spans = top_spans(closed, window, slide, k, first, until // slide, held)
                else:
                    spans = newest_spans(spark, work, batch_id, until // slide, k)
                write_batch(spans, f"{work}/top", batch_id)
                if publish:
                    ranked = spark.read.schema(SPANS).parquet(batch_path(f"{work}/top", batch_id))
                    publish(ordered_payload(window_ends(ranked, slide), "window_end"), batch_id)
                left = until, batch_id
            write_batch(spark.createDataFrame([left], PROGRESS), f"{work}/progress", batch_id)
            forget(spark, work, state, window)
        finally:
            closed.unpersist()

    return (
        closed_buckets(tagged, slide, lateness)
        .writeStream.outputMode("append")
        .foreachBatch(on_batch)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(**(trigger or {"processingTime": TRENDING_TRIGGER}))
        .start()
    )


def newest_spans(spark, work, batch_id, end, k):
    """The ranked window that ends at the grid point ``end``: SQL over the view of the live counts."""
    read_batch(spark, f"{work}/counts", batch_id).createOrReplaceTempView("hashtags")
    top = spark.sql(TOP_SQL.format(k=k)).collect()  # k rows
    return spark.createDataFrame([(end, end, i + 1, row["hashtag"], row["count"]) for i, row in enumerate(top)], SPANS)


def finish_trending(spark, work, publish=None, window=WINDOW_SECONDS, slide=SLIDE_SECONDS, k=TOP_K):
    """Rank what a stopped, bounded stream left open: no more posts will come, so its open buckets are closed as they are.

    The open buckets are read from the stream's state; windows are ranked until the last count has left. They become one more
    batch of ``top``. Call it once, after the stream has ended; the stream cannot go on from there.
    """
    batch_id = max(numbered(spark, f"{work}/progress", "batch"), default=-1) + 1
    state = carried(spark, f"{work}/progress", batch_id)
    if state is None:
        return
    kept = spark.read.format("statestore").load(f"{work}/checkpoint")
    bucket = F.floor(F.unix_seconds("key.window.start") / slide)
    open_ = kept.select(F.col("key.hashtag").alias("hashtag"), bucket.alias("bucket"), F.col("value.count").alias("count"))
    if state.ended is None:
        spans = top_spans(open_, window, slide, k)
    else:
        held = held_before(spark, work, state, state.ended + window, batch_id, window, slide)
        spans = top_spans(open_, window, slide, k, state.ended // slide + 1, None, held)
    write_batch(spans, f"{work}/top", batch_id)
    if publish:
        ranked = spark.read.schema(SPANS).parquet(batch_path(f"{work}/top", batch_id))
        publish(ordered_payload(window_ends(ranked, slide), "window_end"), batch_id)


def read_spans(spark, work):
    """Ranked spans of windows: first_end, last_end (grid points), rank, hashtag, count; none before the first batch."""
    return read_batches(spark, f"{work}/top", SPANS).drop("batch")


def read_top(spark, work, slide=SLIDE_SECONDS):
    """window_end (epoch seconds), rank, hashtag, count of each ranked window."""
    return window_ends(read_spans(spark, work), slide)
