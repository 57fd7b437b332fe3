"""Row filters on posts."""

from pyspark.sql import functions as F

from ..functions.sentiment import NEGATIVE, POSITIVE, emoticon_label
from ..schema import TRENDING_LANGS


def originals(posts):
    return posts.filter(~F.col("is_retweet"))


def in_languages(posts, langs=TRENDING_LANGS):
    return posts.filter(F.col("lang").isin(*langs))


def is_english_original():
    return (F.col("user_lang") == "en") & ~F.col("is_retweet")


def english_originals(posts):
    return posts.filter(is_english_original())


def label(posts, text="text", out="sentiment"):
    """Posts with their emoticon label; a post without text has none and is left out."""
    return posts.filter(F.col(text).isNotNull()).withColumn(out, emoticon_label(F.col(text)))


def of_class(labelled, sentiment):
    return labelled.filter(F.col("sentiment") == sentiment)


def split_classes(labelled):
    """Positive and negative rows; ``unionByName`` puts them together again."""
    return of_class(labelled, POSITIVE), of_class(labelled, NEGATIVE)
