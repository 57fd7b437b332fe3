"""Sentiment plans: training posts, corpus, features, model, scores."""

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sentiment import contains_any
from ..functions.tokens import unigrams_and_bigrams
from ..operators import evaluate, features, filters, model, payload
from ..schema import FEATURE_WIDTH, SEARCH_SIZE, SGD_ITERATIONS, TRACK_TERMS
from ..session import materialize
from ..sources.posts import search, track


def training_posts(posts):
    """Tracked English originals with their emoticon label."""
    return filters.label(filters.english_originals(track(posts)))


def is_training_post():
    """The same choice as a Column, for a pass that needs the other posts too."""
    return contains_any(F.col("text"), TRACK_TERMS) & filters.is_english_original()


@dataclass(frozen=True)
class Featurizer:
    """How text becomes tokens; any string -> string and string -> array Column functions will do."""

    prepare: object = features.stemmed
    tokenize: object = unigrams_and_bigrams
    width: int = FEATURE_WIDTH

    def tokens(self, posts):
        return features.with_tokens(posts, self.prepare, self.tokenize)

    def tf(self, posts):
        return features.with_term_frequencies(self.tokens(posts), width=self.width)

    def fit_idf(self, corpus):
        return features.fit_idf(self.tf(corpus), width=self.width)

    def tfidf(self, posts, idf):
        return features.with_tfidf(self.tf(posts), idf)


DEFAULT = Featurizer()


@dataclass(frozen=True)
class Trained:
    """A model, the IDF of the posts it was trained on, and those posts as (sentiment, term frequencies)."""

    model: model.LogisticModel
    idf: features.IdfModel
    points: DataFrame


def fit(points, iterations=SGD_ITERATIONS, start=None, train_features="tf", width=FEATURE_WIDTH, **options):
    """Train on term frequencies; 'tfidf' trains on what is scored later instead.

    ``points`` (sentiment, features) is read once per fit and iteration: pass a materialized table.
    """
    idf = features.fit_idf(points, width=width)
    rows = points if train_features == "tf" else features.with_tfidf(points, idf)
    return Trained(model.train(rows, start, iterations, width=width, **options), idf, points)


def training_points(labelled, featurizer=DEFAULT):
    """Labelled posts as a materialized (sentiment, features) table: text is tokenised once."""
    return materialize(featurizer.tf(labelled).select("sentiment", "features"), "points")


def corpus_tokens(labelled, featurizer=DEFAULT):
    """(tokens, label) of labelled posts."""
    return featurizer.tokens(labelled).select("tokens", F.col("sentiment").alias("label"))


def score(vectors, trained):
    """Rows with a ``features`` column of term frequencies get a 0/1 ``prediction`` from their TF-IDF."""
    return model.with_prediction(features.with_tfidf(vectors, trained.idf), trained.model)


def evaluate_on(points, trained):
    """The statistics row of a model on labelled vectors."""
    return evaluate.statistics(score(points, trained), trained.model)


def classify_keyword(posts, keyword, trained, featurizer=DEFAULT, size=SEARCH_SIZE, predict=model.scored_posts):
    """Search, featurize, score: (tweet, sentiment). ``predict`` maps (rows with rank, text, features; model) to those."""
    found = featurizer.tfidf(search(posts, keyword, size), trained.idf)
    return predict(found, trained.model)


def classification_result(posts, keyword, trained, featurizer=DEFAULT, size=SEARCH_SIZE):
    predict = partial(model.scored_posts, keep=["rank"])
    return payload.classification_json(classify_keyword(posts, keyword, trained, featurizer, size, predict))


def with_batch(posts, size=20):
    """Consecutive ids stand in for micro-batches on a static table."""
    return posts.withColumn("batch", F.floor(F.col("post_id") / size))
