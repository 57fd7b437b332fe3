"""Post sources: batch and stream readers, tracked and searched posts, corpus files."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.sentiment import contains_any
from ..schema import LABELLED_POST_SCHEMA, POST_SCHEMA, SEARCH_SIZE, TRACK_TERMS


def stamped(posts):
    """A post that comes without a creation time gets the time of ingest."""
    return posts.withColumn("created_at", F.coalesce("created_at", F.current_timestamp()))


def spread(df):
    """Deal rows out to all cores when the input has far fewer splits than cores, as small files do.

    Large inputs have enough splits and pass through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def read_posts(spark, path, fmt="parquet", **options):
    """Stored posts, as they are: filters on time, language and retweets reach the scan."""
    return spark.read.schema(POST_SCHEMA).format(fmt).options(**options).load(path)


def stream_posts(spark, path=None, fmt="parquet", **options):
    """Live posts from files, or from a topic whose values are posts as JSON (``fmt='kafka'``)."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        value = F.from_json(F.col("value").cast("string"), POST_SCHEMA)
        return stamped(reader.load().select(value.alias("post")).select("post.*"))
    return stamped(reader.schema(POST_SCHEMA).load(path))


def posts_from_rows(spark, rows):
    """A small local collection as a table; an empty one keeps the schema."""
    return spark.createDataFrame(rows, POST_SCHEMA)


def track(posts, terms=TRACK_TERMS):
    """Posts that contain any of the terms."""
    return posts.filter(contains_any(F.col("text"), terms))


def search(posts, keyword, size=SEARCH_SIZE):
    """(rank, text): the newest English originals that mention the keyword in any case, at most ``size``, newest first."""
    found = (F.col("lang") == "en") & ~F.col("is_retweet") & F.lower("text").contains(keyword.lower())
    newest = [F.desc("created_at"), F.col("post_id")]
    rank = F.row_number().over(Window.orderBy(*newest))
    return posts.filter(found).orderBy(*newest).limit(size).select(rank.alias("rank"), "text")


def fetch_response(posts, keyword, size=SEARCH_SIZE):
    """The search answer as (keyword, text) rows."""
    return search(posts, keyword, size).select(F.lit(keyword).alias("keyword"), "text")


def read_labelled_csv(spark, path, **options):
    return spark.read.schema(LABELLED_POST_SCHEMA).options(**options).csv(path)


def read_corpus(spark, path):
    return spark.read.schema(LABELLED_POST_SCHEMA).parquet(path)


def write_corpus(corpus, path, mode="errorifexists"):
    corpus.select("text", "sentiment").write.mode(mode).parquet(path)
