"""Corpus, features, model and evaluation, against direct code and Spark's own MLlib."""

import math
import random

import pytest
from pyspark.sql import functions as F

from postwave.functions.tokens import split_words
from postwave.functions.vectors import hash_index
from postwave.operators import corpus, evaluate, features, model
from postwave.plans.sentiment import Featurizer, Trained, classify_keyword, evaluate_on
from postwave.sources.posts import fetch_response, posts_from_rows, search
from test_text import post

WORDS = Featurizer(prepare=lambda c: c, tokenize=split_words)


def labelled(spark, seed=1, batches=30, rare=0.2):
    rng = random.Random(seed)
    rows = [(i, b, 1.0 if rng.random() > rare else 0.0) for b in range(batches) for i in range(rng.randrange(1, 6))]
    return rows, spark.createDataFrame(rows, "i int, batch bigint, sentiment double")


def direct_corpus(rows, total):
    held, kept, progress = {1.0: 0, 0.0: 0}, [], []
    for b in sorted({r[1] for r in rows}):
        start = dict(held)
        for r in rows:
            if r[1] == b and start[r[2]] < total // 2:
                kept.append(r)
                held[r[2]] += 1
        progress.append((b, held[1.0], held[0.0], total))
        if min(held.values()) >= total // 2:
            break
    return kept, progress


@pytest.mark.parametrize("total", [2, 8, 20, 400])
def test_balanced_corpus(spark, total):
    rows, df = labelled(spark, total)
    kept, progress = direct_corpus(rows, total)
    # A class that fills early stops; the other goes on until both are full.
    got = [(r.i, r.batch, r.sentiment) for r in corpus.balanced_corpus(df, total).collect()]
    assert sorted(got) == sorted(kept)
    assert sorted(map(tuple, corpus.corpus_progress(df, total).collect())) == progress


@pytest.mark.parametrize("total", [8, 40])
def test_totals_carry_over_chunks(spark, monkeypatch, total):
    monkeypatch.setattr(corpus, "BATCHES_PER_CHUNK", 7)
    rows, df = labelled(spark, total)
    kept, progress = direct_corpus(rows, total)
    got = [(r.i, r.batch, r.sentiment) for r in corpus.balanced_corpus(df, total).collect()]
    assert sorted(got) == sorted(kept)
    assert sorted(map(tuple, corpus.corpus_progress(df, total).collect())) == progress


def test_quota_may_overshoot_by_one_batch(spark):
    df = spark.createDataFrame([(b, 1.0) for b in (1, 2, 3) for _ in range(3)], "batch bigint, sentiment double")
    assert corpus.balanced_corpus(df, 8).groupBy("batch").count().orderBy("batch").collect() == [(1, 3), (2, 3)]


def test_hashing_equals_mllib(spark):
    words = ["a", "ab", "abc", "abcd", "abcde", "good day", "", "username", "çé", "日本", "x" * 37]
    theirs = spark._jvm.org.apache.spark.mllib.feature.HashingTF(1500)
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", hash_index(F.col("w"), 1500).alias("i"))
    assert {r.w: r.i for r in got.collect()} == {w: theirs.indexOf(w) for w in words}


def test_term_frequencies(spark):
    rows = [(1, ["a", "b", "a"]), (2, []), (3, ["c"])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    at = {r.w: r.i for r in spark.createDataFrame([("a",), ("b",), ("c",)], "w string")
          .select("w", hash_index(F.col("w"), 1500).alias("i")).collect()}
    got = {r.id: dict(zip(r.features.idx, r.features.value)) for r in features.with_term_frequencies(df).collect()}
    assert got == {1: {at["a"]: 2.0, at["b"]: 1.0}, 2: {}, 3: {at["c"]: 1.0}}


def test_idf(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],)], "tokens array<string>")
    idf = features.fit_idf(features.with_term_frequencies(df))
    assert idf.posts == 2
    assert sorted(set(round(w, 12) for w in idf.weights)) == [0.0, round(math.log(1.5), 12), round(math.log(3), 12)]
    empty = features.fit_idf(features.with_term_frequencies(df.limit(0)))
    assert empty.posts == 0 and set(empty.weights) == {0.0}


def test_idf_equals_mllib(spark):
    from pyspark.mllib.feature import IDF
    from pyspark.mllib.linalg import Vectors

    rng = random.Random(3)
    rows = [([f"w{rng.randrange(60)}" for _ in range(rng.randrange(0, 12))],) for _ in range(50)]
    v = features.with_term_frequencies(spark.createDataFrame(rows, "tokens array<string>"), width=40)
    vectors = [Vectors.sparse(40, dict(zip(r.features.idx, r.features.value))) for r in v.collect()]
    theirs = IDF().fit(spark.sparkContext.parallelize(vectors, 2)).idf().toArray()
    assert features.fit_idf(v, width=40).weights == pytest.approx(theirs, abs=1e-12)


def points(spark, seed=4, n=60, width=25):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        idx = sorted(rng.sample(range(width), rng.randrange(1, 6)))
        rows.append((float(rng.random() < 0.4 + 0.02 * idx[0]), (idx, [float(rng.randrange(1, 4)) for _ in idx])))
    return rows, spark.createDataFrame(rows, "sentiment double, features struct<idx:array<int>,value:array<double>>")


@pytest.mark.parametrize("iterations, tolerance", [(1, 0.0), (4, 0.0), (60, 0.05)])
def test_training_equals_mllib(spark, iterations, tolerance):
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.regression import LabeledPoint
    from pyspark.mllib.linalg import Vectors

    rows, df = points(spark)
    data = spark.sparkContext.parallelize(
        [LabeledPoint(y, Vectors.sparse(25, dict(zip(*f)))) for y, f in rows], 2).cache()
    start = [0.01 * i for i in range(25)]
    theirs = LogisticRegressionWithSGD.train(
        data, iterations=iterations, step=1.0, miniBatchFraction=1.0, initialWeights=start, regParam=0.0, regType=None,
        intercept=False, convergenceTol=tolerance)
    ours = model.train(df, model.LogisticModel(tuple(start)), iterations, tolerance=tolerance, width=25)
    assert ours.weights == pytest.approx(theirs.weights.toArray(), abs=1e-9)
    assert ours.version == 1
    predicted = model.with_prediction(df, ours).collect()
    assert [r.prediction for r in predicted] == [float(theirs.predict(Vectors.sparse(25, dict(zip(*f))))) for _, f in rows]


def test_no_rows_leave_the_model_alone(spark):
    _, df = points(spark)
    start = model.LogisticModel((1.0,) * 25, 7)
    assert model.train(df.limit(0), start, 3, width=25) is start


def pairs(spark, rows):
    return spark.createDataFrame(rows, "prediction double, label double")


def test_hard_metrics(spark):
    rows = [(1.0, 1.0)] * 7 + [(0.0, 1.0)] * 3 + [(1.0, 0.0)] * 4 + [(0.0, 0.0)] * 16
    r = pairs(spark, rows).agg(evaluate.hard_auc().alias("auc"), evaluate.accuracy().alias("acc")).first()
    assert (r.auc, r.acc) == (pytest.approx(0.75), pytest.approx(23 / 30))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("levels", [2, 7, 100000])
def test_auc(spark, seed, levels):
    rng = random.Random(seed)
    rows = [(float(rng.randrange(levels)), float(rng.random() < 0.3)) for _ in range(3000)]
    won = sum((p > n) + (p == n) / 2 for p, y in rows if y for n, z in rows if not z)
    positives = sum(y for _, y in rows)
    auc = evaluate.area_under_roc(pairs(spark, rows)).first().auc
    assert auc == pytest.approx(won / (positives * (len(rows) - positives)), abs=1e-12)
    if levels < 1000:  # MLlib bins more distinct scores than that.
        from pyspark.mllib.evaluation import BinaryClassificationMetrics

        theirs = BinaryClassificationMetrics(spark.sparkContext.parallelize(rows, 2)).areaUnderROC
        assert auc == pytest.approx(theirs, abs=1e-9)


@pytest.mark.parametrize("rows, expected", [
    ([(1.0, 1.0), (0.0, 1.0)], 1.0), ([(1.0, 0.0), (0.0, 0.0)], 0.0), ([], math.nan),
])
def test_one_class(spark, rows, expected):
    df = pairs(spark, rows)
    hard = df.agg(evaluate.hard_auc().alias("auc"), evaluate.accuracy().alias("acc")).first()
    assert hard.auc == pytest.approx(expected, nan_ok=True)
    assert evaluate.area_under_roc(df).first().auc == pytest.approx(expected, nan_ok=True)
    if not rows:
        assert math.isnan(hard.acc)


def test_search_and_classify(spark):
    posts = posts_from_rows(spark, [
        post(3, "The Sun is good"), post(1, "sun bad"), post(2, "sun", lang="de"), post(4, "sun", retweet=True),
        post(5, "rain"),
    ])
    assert [r.text for r in search(posts, "SUN").collect()] == ["sun bad", "The Sun is good"]
    assert [tuple(r) for r in fetch_response(posts, "sun", 1).collect()] == [("sun", "sun bad")]
    idf = WORDS.fit_idf(posts)
    at = {r.w: r.i for r in spark.createDataFrame([("good",), ("bad",)], "w string")
          .select("w", hash_index(F.col("w"), 1500).alias("i")).collect()}
    weights = [0.0] * 1500
    weights[at["good"]], weights[at["bad"]] = 1.0, -1.0
    trained = Trained(model.LogisticModel(tuple(weights)), idf, None)
    scored = classify_keyword(posts, "sun", trained, WORDS)
    assert {tuple(r) for r in scored.collect()} == {("The Sun is good", "1.0"), ("sun bad", "0.0")}
    judged = posts.filter("post_id in (1, 3)").withColumn("sentiment", (F.col("post_id") == 3).cast("double"))
    row = evaluate_on(WORDS.tf(judged), trained).first()
    assert (row.trainer, row.areaUnderRoc, row.accuracy) == ("Online", 1.0, 1.0)
    assert "numFeatures = 1500" in row.model
