"""Tokens, hashed term frequencies and TF-IDF."""

import math
from dataclasses import dataclass

from pyspark.sql import functions as F

from ..functions.stem import stem_text
from ..functions.text import normalize
from ..functions.tokens import unigrams_and_bigrams
from ..functions.vectors import hash_index, weighted
from ..schema import FEATURE_WIDTH


def stemmed(text):
    return stem_text(normalize(text))


def with_tokens(posts, prepare=stemmed, tokenize=unigrams_and_bigrams, text="text", out="tokens"):
    """Tokens of each post: any string -> string ``prepare``, then any string -> array ``tokenize``.

    The prepared text is a column of its own, so that the tokenizer's several uses of it do not repeat the work. Posts
    without text are left out.
    """
    prepared = posts.filter(F.col(text).isNotNull()).withColumn("_prepared", prepare(F.col(text)))
    return prepared.withColumn(out, tokenize(F.col("_prepared"))).drop("_prepared")


def token_rows(df, *keep, tokens="tokens", out="token"):
    """One row per token.

    The outer form keeps Spark from filtering on the array's size first, a filter it would push below the projection
    and so compute every token list twice.
    """
    return df.select(*keep, F.explode_outer(tokens).alias(out)).filter(F.col(out).isNotNull())


def with_term_frequencies(df, tokens="tokens", width=FEATURE_WIDTH, out="features"):
    """Hash the tokens to buckets and count each bucket, all inside the row.

    The bucket list is sorted; the last position of each run of equal buckets gives the bucket and its count.
    """
    hashed = F.sort_array(F.transform(F.col(tokens), lambda t: hash_index(t, width)))
    df = df.withColumn("_buckets", hashed)
    b = F.col("_buckets")
    ends = F.filter(F.sequence(F.lit(1), F.size(b)), lambda i: (i == F.size(b)) | (F.get(b, i) != F.get(b, i - 1)))
    df = df.withColumn("_ends", F.when(F.size(b) == 0, F.array().cast("array<int>")).otherwise(ends))
    e = F.col("_ends")
    idx = F.transform(e, lambda i: F.get(b, i - 1))
    value = F.transform(e, lambda i, n: (i - F.when(n == 0, 0).otherwise(F.get(e, n - 1))).cast("double"))
    return df.withColumn(out, F.struct(idx.alias("idx"), value.alias("value"))).drop("_buckets", "_ends")


@dataclass(frozen=True)
class IdfModel:
    """Inverse document frequencies of ``posts`` posts, one weight per bucket."""

    posts: int
    document_frequency: tuple
    weights: tuple


def document_frequencies(df, features="features"):
    """(idx, df) over all posts, plus the post count as idx -1, in one pass and at most width + 1 rows."""
    buckets = F.explode(F.array_append(F.col(features)["idx"], -1))
    return df.select(buckets.alias("idx")).groupBy("idx").agg(F.count("*").alias("df"))


def fit_idf(df, features="features", width=FEATURE_WIDTH):
    """ln((m + 1) / (df + 1)) per bucket; a bucket no post has weighs ln(m + 1)."""
    found = {r.idx: r.df for r in document_frequencies(df, features).collect()}
    posts = found.pop(-1, 0)
    counts = tuple(found.get(i, 0) for i in range(width))
    return IdfModel(posts, counts, tuple(math.log((posts + 1.0) / (n + 1.0)) for n in counts))


def with_tfidf(df, idf, features="features", out="features"):
    return df.withColumn(out, weighted(F.col(features), idf.weights))


def idf_table(spark, idf):
    rows = [(i, n, w) for i, (n, w) in enumerate(zip(idf.document_frequency, idf.weights)) if n > 0]
    return spark.createDataFrame(rows, "idx int, df bigint, weight double")
