"""Schemas and operating parameters shared by every layer."""

from pyspark.sql import types as T

POST_SCHEMA = T.StructType([
    T.StructField("post_id", T.LongType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("user_lang", T.StringType()),
    T.StructField("is_retweet", T.BooleanType()),
])

LABELLED_POST_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("sentiment", T.DoubleType()),
])

# Defaults every job starts from.
WINDOW_SECONDS = 3600
SLIDE_SECONDS = 5
TOP_K = 10
TRENDING_TRIGGER = "5 seconds"
TRAINING_TRIGGER = "1 second"
TRENDING_TOPIC = "TrendingHashtagAnalysis"
TRENDING_LANGS = ("en", "de", "fr", "es", "pt", "nl")
TRACK_TERMS = (":)", ":-)", ";-)", ";)", ":(", ":-(")
SEARCH_SIZE = 100
CORPUS_SIZE = 500
FEATURE_WIDTH = 1500
SGD_ITERATIONS = 200
SGD_STEP = 1.0
SGD_TOLERANCE = 0.001

# Ours: how long a stream waits for late posts before it closes a bucket.
LATENESS = "10 minutes"
