"""What the plans must look like at scale: pruned scans, no shuffle where a row is enough, no cross joins."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from postwave.operators import corpus, model, trending
from postwave.operators.features import IdfModel, with_term_frequencies, with_tfidf
from postwave.plans import sentiment
from postwave.plans.trending import trending_now, trending_windows
from postwave.session import shared_dir
from postwave.sources.posts import read_posts, spread
from postwave.sources.tables import read_sample_posts


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def posts(spark, samples):
    """Posts as a table of their own, the way a user would hold them; plans name all filters of a scan."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    path = shared_dir(spark, "posts")
    read_sample_posts(spark, samples).write.parquet(path)
    return read_posts(spark, path)


def test_trending_scan_is_pruned_and_ends_in_a_top_k(posts):
    plan = plan_of(trending_now(posts))
    assert "TakeOrderedAndProject" in plan
    assert "IsNotNull(created_at), IsNotNull(is_retweet)" in plan and "Not(EqualTo(is_retweet,true))" in plan
    assert "GreaterThanOrEqual(created_at,ScalarSubquery" in plan
    schemas = {line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema: " in line}
    assert schemas == {
        "struct<created_at:timestamp>", "struct<created_at:timestamp,text:string,lang:string,is_retweet:boolean>"
    }


def test_a_given_end_reaches_the_scan(posts):
    plan = plan_of(trending_now(posts, end=1704070800))
    assert "created_at" in plan and "timestamp_seconds" not in plan


def test_windows_are_ranked_with_a_partial_limit(posts):
    plan = plan_of(trending_windows(trending.tagged_posts(posts), slide=300))
    # Leaders of a part before and after their exchange; the spans are ranked where their part lies.
    assert plan.count("WindowGroupLimit") == 3


def test_vectors_scores_and_weights_need_no_shuffle(posts):
    tf = with_term_frequencies(sentiment.DEFAULT.tokens(posts))
    idf = IdfModel(3, (1,) * 1500, (0.5,) * 1500)
    scored = model.with_prediction(with_tfidf(tf, idf), model.LogisticModel((0.1,) * 1500))
    assert "Exchange" not in plan_of(scored.select("post_id", "prediction"))


def test_text_is_prepared_once(posts):
    """One stemming pass, and no token expression repeated by a pushed-down filter."""
    tokens = sentiment.DEFAULT.tokens(posts)
    plan = plan_of(tokens.select(F.size("tokens")))
    assert plan.count("ArrowEvalPython") == 1
    from postwave.operators.features import token_rows

    assert plan_of(token_rows(tokens)).count("split(rtrim") == plan_of(tokens.select("tokens")).count("split(rtrim")


@pytest.mark.parametrize("total", [500, 400_000])
def test_corpus_join_is_left_to_the_planner(posts, total):
    labelled = sentiment.with_batch(sentiment.training_posts(posts))
    logical = corpus.balanced_corpus(labelled, total)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in logical


def test_only_the_last_window_is_scanned(spark):
    """The time bound reaches the row groups of a time-ordered table."""
    path = shared_dir(spark, "ordered")
    rows = spark.range(0, 1600, 1, 16).select(
        F.col("id").alias("post_id"), F.timestamp_seconds(F.col("id") * 600).alias("created_at"), F.lit("a #b").alias("text"),
        F.lit("en").alias("lang"), F.lit("en").alias("user_lang"), F.lit(False).alias("is_retweet"),
    )
    rows.write.parquet(path)
    top = trending_now(read_posts(spark, path))
    assert [tuple(r) for r in top.collect()] == [("#b", 6)]
    text_scans = [line for line in metric_lines(top) if "text" in line[0]]
    assert text_scans and all(n <= 100 for _, n in text_scans)


def metric_lines(df):
    """(columns, rows read) of each parquet scan that ran."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            found.append((node.output().mkString(","), node.metrics().apply("numOutputRows").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_spread_leaves_large_inputs_alone(spark):
    many = spark.range(0, 100, 1, 64)
    assert spread(many).rdd.getNumPartitions() == 64
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


CHEAP = [n for n in contract.queries() if n.startswith(("trending", "balanced", "corpus", "emoticon", "term", "length"))]


@pytest.mark.parametrize("name", CHEAP)
def test_no_cross_joins(spark, samples, name):
    plan = plan_of(contract.queries()[name](spark, samples))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
