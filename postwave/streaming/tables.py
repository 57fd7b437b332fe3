"""Per-batch tables: each micro-batch owns one folder and overwrites it, so a replayed batch changes nothing."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..schema import TRENDING_TOPIC
from . import published


def batch_path(path, batch_id):
    return f"{path}/batch={batch_id}"


def write_batch(df, path, batch_id, fmt="parquet"):
    df.write.mode("overwrite").format(fmt).save(batch_path(path, batch_id))


def read_batch(spark, path, batch_id):
    """The rows of one batch, or None."""
    try:
        return spark.read.parquet(batch_path(path, batch_id))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_batches(spark, path, schema):
    """The rows of all batches, with their number as ``batch``; an empty table before the first batch."""
    whole = spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("bigint")).schema
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def carried(spark, path, batch_id):
    """The one state row the batch before left behind, or None. Every batch writes one, so one small file is read."""
    rows = read_batch(spark, path, batch_id - 1)
    return None if rows is None else rows.first()


def publisher(fmt, path=None, topic=TRENDING_TOPIC, **options):
    """A sink for payload rows (``value``): a topic for ``fmt='kafka'``, the exactly-once files of ``published`` for
    ``fmt='published_rows'``, else one folder of files per batch."""

    def publish(payload, batch_id):
        if fmt == published.FORMAT:
            published.publish_rows(payload, path, batch_id)
        elif fmt == "kafka":
            payload.select("value").write.format(fmt).options(topic=topic, **options).save()
        else:
            write_batch(payload, path, batch_id, fmt)

    return publish


def stop(query, gracefully=True):
    """Stop a stream, after what has arrived when gracefully; the session stays up.

    A stream that has failed raises its error then, also if it ended before: what it left is not its whole result.
    """
    if gracefully:
        query.processAllAvailable()
    query.stop()
