"""Adapters that read the sample tables as posts and as hashtag streams."""

from pyspark.sql import functions as F

from ..session import shared_dir
from . import replay

# 2024-01-01 00:00:00 UTC; the sample documents carry no time of their own.
EPOCH = 1704067200
SECONDS_PER_POST = 30

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

DOCUMENTS_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def posts_from_documents(documents):
    """The post schema over ``documents``, with hashtags, emoticons, short forms and links appended by id."""
    doc = F.col("doc_id")
    extra = [
        F.concat(F.lit(" #"), "source"),
        F.when(doc % 3 == 0, F.concat(F.lit(" #"), "lang")).otherwise(""),
        F.when((doc % 5).isin(0, 1), " :)").when(doc % 5 == 2, " :(").otherwise(""),
        F.when(doc % 11 == 0, " don't u").otherwise(""),
        F.when(doc % 13 == 0, " http://x.io/a_b soooo").otherwise(""),
    ]
    return documents.select(
        doc.alias("post_id"),
        F.timestamp_seconds(F.lit(EPOCH) + doc * SECONDS_PER_POST).alias("created_at"),
        F.concat("text", *extra).alias("text"),
        "lang",
        F.col("lang").alias("user_lang"),
        (doc % 7 == 0).alias("is_retweet"),
    )


def tags_from_events(events):
    """(created_at, hashtag) per event; the zone-less time is read as UTC."""
    utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    tag = F.concat(F.lit("#"), "event_type", F.lit("_"), (F.col("user_id") % 20).cast("string"))
    return events.select(utc.alias("created_at"), tag.alias("hashtag"))


def read_documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def read_sample_posts(spark, folder):
    return posts_from_documents(read_documents(spark, folder))


def read_sample_tags(spark, folder):
    return tags_from_events(spark.read.parquet(f"{folder}/events.parquet"))


def stream_sample_tags(spark, folder, **options):
    """The events as a stream in the order of their times, in a few steps (see ``replay``)."""
    return replay.replay(spark, replay.ordered_table(read_sample_tags(spark, folder), shared_dir(spark, "tags")), **options)


def stream_sample_posts(spark, folder, **options):
    """The documents as a stream of posts in the order of their times, in a few steps (see ``replay``)."""
    return replay.replay(spark, replay.ordered_table(read_sample_posts(spark, folder), shared_dir(spark, "posts")), **options)
