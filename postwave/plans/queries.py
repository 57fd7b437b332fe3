"""The registered queries: each maps (spark, folder of the sample tables) to a DataFrame.

Times are reported as epoch seconds and long results as one row per post with an md5 of the whole value, so that any
engine can check them.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sentiment, text, tokens
from ..functions.stem import stem_word
from ..operators import corpus, evaluate, features, filters, model, payload, trending
from ..session import materialize
from ..sources import posts as source
from ..sources.tables import read_documents, read_sample_posts, read_sample_tags
from . import sentiment as plan
from .trending import trending_now, trending_time_in_top, trending_windows

SLIDE = 300
KEYWORD = "the"
SAMPLE_CORPUS = 200
TRAIN_STEPS = 5
SEPARATOR = "|"


def digest(array):
    return F.md5(F.array_join(array, SEPARATOR))


def wide_posts(spark, folder):
    """Sample posts on all cores, for text work."""
    return source.spread(read_sample_posts(spark, folder))


def sample_tagged(spark, folder):
    return trending.tagged_posts(read_sample_posts(spark, folder))


def trending_top10(spark, folder):
    return trending_now(read_sample_posts(spark, folder))


def trending_windows_top10(spark, folder):
    return trending_windows(sample_tagged(spark, folder), slide=SLIDE)


def trending_windows_top10_events(spark, folder):
    return trending_windows(read_sample_tags(spark, folder), slide=SLIDE)


def trending_delta_5s(spark, folder):
    return trending.change_points(read_sample_tags(spark, folder))


def trending_time_in_top10_5s(spark, folder):
    return trending_time_in_top(read_sample_tags(spark, folder))


def trending_payload_ordered(spark, folder):
    return payload.ordered_payload(payload.with_rank(trending_top10(spark, folder)))


def trending_payload_windows(spark, folder):
    return payload.ordered_payload(trending_windows_top10(spark, folder), "window_end")


def trending_payload_set(spark, folder):
    return payload.set_payload(trending_top10(spark, folder))


def english_originals(spark, folder):
    return filters.english_originals(read_sample_posts(spark, folder)).select("post_id", "user_lang")


def trending_languages(spark, folder):
    kept = filters.in_languages(filters.originals(read_sample_posts(spark, folder)))
    return kept.groupBy("lang").agg(F.count("*").alias("posts"))


def tracked_posts(spark, folder):
    return source.track(read_sample_posts(spark, folder)).select("post_id", "text")


def keyword_search(spark, folder):
    return source.fetch_response(read_sample_posts(spark, folder), KEYWORD)


def emoticon_labels(spark, folder):
    t = F.col("text")
    return read_sample_posts(spark, folder).select(
        "post_id",
        sentiment.is_positive(t).alias("positive"),
        sentiment.is_negative(t).alias("negative"),
        sentiment.is_neutral(t).alias("neutral"),
        sentiment.emoticon_label(t).alias("sentiment"),
    )


def sentiment_mix(spark, folder):
    labelled = filters.label(read_sample_posts(spark, folder))
    return labelled.groupBy("lang", "sentiment").agg(F.count("*").alias("posts"))


def labelled_union(spark, folder):
    positive, negative = filters.split_classes(filters.label(read_sample_posts(spark, folder)))
    return corpus.class_counts(positive.unionByName(negative))


def normalized(function):
    def query(spark, folder):
        return wide_posts(spark, folder).select("post_id", function(F.col("text")).alias("text"))

    return query


def token_query(tokenize, prepare=lambda c: c):
    def query(spark, folder):
        found = features.with_tokens(wide_posts(spark, folder), prepare, tokenize)
        t = F.col("tokens")
        return found.select(
            "post_id",
            F.size(t).cast("bigint").alias("tokens"),
            F.size(F.array_distinct(t)).cast("bigint").alias("distinct_tokens"),
            digest(t).alias("digest"),
        )

    return query


def top_terms(spark, folder):
    """The most frequent bigrams and unigrams of each language."""
    found = features.with_tokens(wide_posts(spark, folder), text.normalize)
    terms = features.token_rows(found, "lang", out="term")
    counts = terms.groupBy("lang", "term").agg(F.count("*").alias("count"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "term"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= 20)


def stemmed_vocabulary(spark, folder):
    """Stems of the distinct words, with the words and occurrences behind each."""
    documents = source.spread(read_documents(spark, folder))
    words = documents.select(F.explode(tokens.split_words(F.lower("text"))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    stems = counts.select(stem_word("word").alias("stem"), "n")
    return stems.groupBy("stem").agg(F.count("*").alias("words"), F.sum("n").alias("occurrences"))


def sample_training(spark, folder):
    return plan.training_posts(wide_posts(spark, folder))


def balanced_corpus(spark, folder):
    batches = plan.with_batch(plan.training_posts(read_sample_posts(spark, folder)))
    return corpus.balanced_corpus(batches, SAMPLE_CORPUS).select("post_id", "sentiment", "batch")


def balanced_corpus_counts(spark, folder):
    return corpus.class_counts(balanced_corpus(spark, folder))


def corpus_progress(spark, folder):
    batches = plan.with_batch(plan.training_posts(read_sample_posts(spark, folder)))
    return corpus.corpus_progress(batches, SAMPLE_CORPUS)


def hashed_tf(spark, folder):
    v = plan.DEFAULT.tf(wide_posts(spark, folder))
    idx, value = F.col("features.idx"), F.col("features.value")
    mixed = F.zip_with(idx, value, lambda i, x: i * x)

    def add(a, x):
        return a + x

    return v.select(
        "post_id",
        F.size(idx).cast("bigint").alias("buckets"),
        F.aggregate(value, F.lit(0.0), add).cast("bigint").alias("tokens"),
        F.aggregate(mixed, F.lit(0.0), add).cast("bigint").alias("checksum"),
    )


def idf_weights(spark, folder):
    idf = plan.DEFAULT.fit_idf(wide_posts(spark, folder))
    return features.idf_table(spark, idf).withColumn("weight", F.round("weight", 6))


def tfidf(spark, folder):
    vectors = materialize(plan.DEFAULT.tf(wide_posts(spark, folder)).select("post_id", "features"), "vectors")
    weighted = features.with_tfidf(vectors, features.fit_idf(vectors))
    value = F.col("features.value")
    return weighted.select(
        "post_id",
        F.round(F.aggregate(value, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
        F.round(F.array_max(value), 6).alias("largest"),
    )


def sample_fit(spark, folder, steps):
    return plan.fit(plan.training_points(sample_training(spark, folder)), steps, tolerance=0.0)


def sgd_first_step(spark, folder):
    return weights_of(spark, sample_fit(spark, folder, 1).model)


def sgd_trained_weights(spark, folder):
    return weights_of(spark, sample_fit(spark, folder, TRAIN_STEPS).model)


def weights_of(spark, fitted):
    table = model.weights_table(spark, fitted).filter(F.col("weight") != 0)
    return table.select("idx", F.round("weight", 6).alias("weight"))


def score_posts(spark, folder):
    """Every post, scored by a model of one training step on the training posts among them."""
    posts = filters.label(wide_posts(spark, folder)).withColumn("training", plan.is_training_post())
    vectors = plan.DEFAULT.tf(posts).select("post_id", "training", "sentiment", "features")
    vectors = materialize(vectors, "vectors")
    scored = plan.score(vectors, plan.fit(vectors.filter("training"), 1))
    return scored.select("post_id", F.col("prediction").cast("string").alias("sentiment"))


def model_metrics(spark, folder):
    trained = sample_fit(spark, folder, 1)
    return rounded_metrics(plan.evaluate_on(trained.points, trained))


def rounded_metrics(rows):
    return rows.withColumns({c: F.round(c, 6) for c in ("areaUnderRoc", "accuracy")})


def model_metrics_json(spark, folder):
    return payload.statistics_json(model_metrics(spark, folder))


def sgd_trained_metrics(spark, folder):
    """Emoticon-free check: train on the quality labels of the English documents, evaluate on the same rows."""
    quality = spark.read.parquet(f"{folder}/labels.parquet").select(
        F.col("doc_id").alias("post_id"), F.col("quality").cast("double").alias("sentiment")
    )
    english = filters.english_originals(wide_posts(spark, folder)).join(quality, "post_id")
    trained = plan.fit(plan.training_points(english), TRAIN_STEPS, tolerance=0.0)
    return rounded_metrics(plan.evaluate_on(trained.points, trained))


def length_auc(spark, folder):
    """Area under the ROC curve of a many-valued score: how well text length tells quality."""
    quality = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    scores = read_documents(spark, folder).select("doc_id", F.length("text").cast("double").alias("prediction"))
    auc = evaluate.area_under_roc(scores.join(quality, "doc_id"))
    return auc.select(F.round("auc", 6).alias("auc"))


def classify_keyword(spark, folder):
    return plan.classify_keyword(read_sample_posts(spark, folder), KEYWORD, sample_fit(spark, folder, 1))


def classification_payload(spark, folder):
    return plan.classification_result(read_sample_posts(spark, folder), KEYWORD, sample_fit(spark, folder, 1))


BATCH_QUERIES = {
    "trending_top10": trending_top10,
    "trending_windows_top10": trending_windows_top10,
    "trending_windows_top10_events": trending_windows_top10_events,
    "trending_delta_5s": trending_delta_5s,
    "trending_time_in_top10_5s": trending_time_in_top10_5s,
    "trending_payload_ordered": trending_payload_ordered,
    "trending_payload_windows": trending_payload_windows,
    "trending_payload_set": trending_payload_set,
    "trending_languages": trending_languages,
    "english_originals": english_originals,
    "tracked_posts": tracked_posts,
    "keyword_search": keyword_search,
    "emoticon_labels": emoticon_labels,
    "sentiment_mix": sentiment_mix,
    "labelled_union": labelled_union,
    "normalize_emoticons": normalized(text.normalize_sentiment),
    "normalize_shortforms": normalized(text.normalize_short_forms),
    "normalize_noise": normalized(text.normalize_noise),
    "normalize_all": normalized(text.normalize),
    "unigrams": token_query(tokens.unigrams),
    "bigrams": token_query(tokens.bigrams),
    "trigrams": token_query(tokens.trigrams),
    "token_pipeline": token_query(tokens.unigrams_and_bigrams, text.normalize),
    "token_pipeline_stemmed": token_query(tokens.unigrams_and_bigrams, features.stemmed),
    "term_frequency": top_terms,
    "stemmed_vocabulary": stemmed_vocabulary,
    "balanced_corpus": balanced_corpus,
    "balanced_corpus_counts": balanced_corpus_counts,
    "corpus_progress": corpus_progress,
    "hashed_tf": hashed_tf,
    "idf_weights": idf_weights,
    "tfidf": tfidf,
    "sgd_first_step": sgd_first_step,
    "sgd_trained_weights": sgd_trained_weights,
    "sgd_trained_metrics": sgd_trained_metrics,
    "score_posts": score_posts,
    "model_metrics": model_metrics,
    "model_metrics_json": model_metrics_json,
    "length_auc": length_auc,
    "classify_keyword": classify_keyword,
    "classification_payload": classification_payload,
}
