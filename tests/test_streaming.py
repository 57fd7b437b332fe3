"""Streams against their batch forms, in several micro-batches, with replays and restarts."""

import json
import os
import random
import subprocess
import sys
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from postwave.functions.tokens import split_words
from postwave.operators import trending
from postwave.operators.features import fit_idf
from postwave.operators.model import LogisticModel, train
from postwave.plans.stream_queries import stream_corpus
from postwave.plans.sentiment import Featurizer, classify_keyword, training_points, training_posts
from postwave.schema import POST_SCHEMA
from postwave.session import shared_dir
from postwave.sources.posts import read_posts, stream_posts, write_corpus, read_corpus, read_labelled_csv
from postwave.streaming.corpus import collect_corpus, read_progress
from postwave.streaming.tables import publisher, stop
from postwave.streaming.training import latest_model, latest_trained, read_metrics, start_training
from postwave.sources import replay
from postwave.sources.tables import read_sample_posts
from postwave.streaming import published
from postwave.streaming.trending import finish_trending, held_before, read_buckets, read_top, start_trending, write_buckets

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)
ONE_FILE = {"maxFilesPerTrigger": 1}
NOW = {"availableNow": True}
WORDS = Featurizer(prepare=lambda c: c, tokenize=split_words, width=50)


def feed(spark, folder, batches):
    """Write batches as files in arrival order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, POST_SCHEMA).coalesce(1).write.mode("append").json(folder)
        time.sleep(0.02)


def timed_posts(seed=1, batches=4, gap=None):
    rng = random.Random(seed)
    out, start = [], 0
    for b in range(batches):
        start += 4000 if gap == b else 0
        times = sorted(rng.randrange(start, start + 900) for _ in range(40))
        start += 900
        out.append([(b * 100 + i, BASE + timedelta(seconds=t), f"x #{rng.choice('aaabcd')} y", "en", "en", False)
                    for i, t in enumerate(times)])
    return out


def check_trending(spark, batches, **options):
    source, work = shared_dir(spark, "in"), shared_dir(spark, "work")
    feed(spark, source, batches)
    posts = stream_posts(spark, source, "json", **ONE_FILE)
    start_trending(trending.tagged_posts(posts), work, publisher("json", f"{work}/payload"), window=600, slide=30, k=3,
                   lateness="1 minute", trigger=NOW, **options).awaitTermination()
    newest = max(r[1] for b in batches for r in b).timestamp() - 60
    tagged = trending.tagged_posts(read_posts(spark, source, "json"))
    batch = trending.top_per_window(trending.bucket_counts(tagged, 30), 600, 30, 3)
    last = spark.read.parquet(f"{work}/progress").agg(F.max("ended")).first()[0]
    assert newest - 1000 < last <= newest
    return work, {tuple(r) for r in read_top(spark, work, 30).collect()}, {tuple(r) for r in batch.collect() if r.window_end <= last}


def test_trending_stream_equals_batch(spark):
    work, got, want = check_trending(spark, timed_posts())
    assert got == want
    assert len(set(r.batch for r in spark.read.parquet(f"{work}/top").collect())) > 2
    lines = spark.read.schema("window_end bigint, value string").json(f"{work}/payload").collect()
    for line in lines:
        names = [x["hashtag"] for x in json.loads(line.value)]
        assert names == [n for e, _, n, _ in sorted(want) if e == line.window_end]


def test_trending_stream_with_a_gap_longer_than_the_window(spark):
    _, got, want = check_trending(spark, timed_posts(3, gap=2))
    assert got == want


def test_newest_window_only(spark):
    work, got, want = check_trending(spark, timed_posts(5), every_window=False)
    assert got < want
    per_batch = spark.read.parquet(f"{work}/top").groupBy("batch").agg(F.countDistinct("first_end").alias("n"))
    assert {r.n for r in per_batch.collect()} == {1}


def test_finished_stream_has_every_window(spark):
    work, _, _ = check_trending(spark, timed_posts(8, gap=2))
    finish_trending(spark, work, window=600, slide=30, k=3)
    posts = spark.createDataFrame([r for b in timed_posts(8, gap=2) for r in b], POST_SCHEMA)
    tagged = trending.tagged_posts(posts)
    batch = trending.top_per_window(trending.bucket_counts(tagged, 30), 600, 30, 3)
    assert sorted(map(tuple, read_top(spark, work, 30).collect())) == sorted(map(tuple, batch.collect()))


def test_a_batch_reads_the_leaving_buckets_only(spark):
    path = shared_dir(spark, "buckets")
    rows = [("#a", b, 1) for b in range(0, 4000)]
    for batch in (0, 1):
        own = spark.createDataFrame(rows[batch * 2000 : (batch + 1) * 2000], "hashtag string, bucket bigint, count bigint")
        write_buckets(own, f"{path}/buckets", batch, 5)
    found = read_buckets(spark, f"{path}/buckets", 10000, 10050, 2)
    assert sorted(r.bucket for r in found.collect()) == list(range(2000, 2010))
    assert len(found.inputFiles()) < len(spark.read.parquet(f"{path}/buckets").inputFiles())
    assert read_buckets(spark, f"{path}/buckets", 10000, 10050, 1).count() == 0  # a replay of batch 1

    class State:
        ended, counts_batch = 19995, 1

    spark.createDataFrame([("#a", 720)], "hashtag string, count bigint").write.parquet(f"{path}/counts/batch=1")
    counts, leaving = held_before(spark, path, State, 20045, 2, 3600, 5)
    assert counts.collect() == [("#a", 720)] and leaving.count() == 10


def test_replay_in_steps_with_a_restart(spark):
    posts = spark.createDataFrame([r for b in timed_posts(9) for r in b], POST_SCHEMA)
    path = replay.ordered_table(posts, shared_dir(spark, "table"))
    work = shared_dir(spark, "replay")

    def run(batches):
        seen = []

        def on_batch(rows, batch_id):
            seen.append(sorted(r.created_at for r in rows.collect()))

        rows = replay.replay(spark, path, steps=8, track=["#a", "#b"])
        query = rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", work).trigger(processingTime="0 seconds").start()
        until = time.time() + 60
        while batches and query.isActive and len(seen) < batches and time.time() < until:
            time.sleep(0.01)
        stop(query, gracefully=not batches)
        return seen

    first = run(3)
    second = run(None)
    # The batch that was not committed is read again.
    batches = [b for b in first + second if b]
    unique = [b for i, b in enumerate(batches) if b not in batches[:i]]
    assert unique == sorted(unique) and len(unique) >= 6
    wanted = posts.filter("text like '%#a%' or text like '%#b%'")
    assert sorted(t for b in unique for t in b) == sorted(r.created_at for r in wanted.collect())


def test_replay_of_times_without_statistics(spark):
    """Sessions write 96-bit times by default, which have no statistics: all rows arrive nevertheless, as instants."""
    posts = spark.createDataFrame([*(r for b in timed_posts(9) for r in b), (-1, None, "x", "en", "en", False)], POST_SCHEMA)
    before = spark.conf.get(replay.WRITTEN_TIMES)
    spark.conf.set(replay.WRITTEN_TIMES, "INT96")
    try:
        plain = shared_dir(spark, "plain")
        posts.repartition(3).write.parquet(plain)
        ordered = replay.ordered_table(posts, shared_dir(spark, "table"))
        assert spark.conf.get(replay.WRITTEN_TIMES) == "INT96"
    finally:
        spark.conf.set(replay.WRITTEN_TIMES, before)
    for path in (plain, ordered):
        work, rows = shared_dir(spark, "replay"), replay.replay(spark, path, steps=4)
        assert dict(rows.dtypes)["created_at"] == "timestamp"
        stop(published.publish_stream(rows.select("post_id", F.unix_micros("created_at").alias("t")), f"{work}/rows", f"{work}/checkpoint"))
        got = published.read_published(spark, f"{work}/rows", "post_id bigint, t bigint")
        wanted = posts.filter("created_at is not null").select("post_id", F.unix_micros("created_at").alias("t"))
        assert sorted(got.collect()) == sorted(wanted.collect())


def test_published_rows_appear_once(spark):
    path = shared_dir(spark, "published")
    rows = spark.createDataFrame([(i, f"é{i}") for i in range(20)], "id bigint, value string").repartition(3)
    assert published.read_published(spark, path, rows.schema).count() == 0
    published.publish_rows(rows, path, 0)
    published.publish_rows(rows.limit(5), path, 0)  # a replay leaves the batch as it is
    published.publish_rows(rows.filter("false"), path, 1)
    again = spark.read.json(f"{path}/rows")
    assert sorted(published.read_published(spark, path, rows.schema).collect()) == sorted(rows.collect())
    assert again.count() == 20
    failing = rows.select(F.raise_error(F.lit("no")).cast("bigint").alias("id"), "value")
    try:
        published.publish_rows(failing, path, 2)
    except Exception:  # noqa: BLE001, S110
        pass
    assert published.read_published(spark, path, rows.schema).count() == 20


def test_any_split_gives_the_same_windows(spark):
    """The same posts in two, four or seven time-ordered files close the same windows."""
    rows = sorted((r for b in timed_posts(7) for r in b), key=lambda r: r[1])
    results = []
    for parts in (2, 7):
        size = -(-len(rows) // parts)
        _, got, want = check_trending(spark, [rows[i:i + size] for i in range(0, len(rows), size)])
        assert got == want
        results.append(got)
    common = min(max(e for e, *_ in r) for r in results)
    assert len({frozenset(x for x in r if x[0] <= common) for r in results}) == 1


def labelled_posts(seed, batches, size=12):
    rng = random.Random(seed)
    out = []
    for b in range(batches):
        rows = []
        for i in range(size):
            positive = rng.random() < 0.7
            words = " ".join(rng.choice(["sun", "fun", "sea"] if positive else ["rain", "mud", "sea"]) for _ in range(4))
            rows.append((b * 100 + i, BASE, f"{words} {':)' if positive else ':('}", "en", "en", i % 6 == 5))
        out.append(rows)
    return out


def test_corpus_stream(spark):
    batches = labelled_posts(1, 6)
    source, work = shared_dir(spark, "in"), shared_dir(spark, "work")
    feed(spark, source, batches)
    corpus = collect_corpus(stream_posts(spark, source, "json", **ONE_FILE), work, 20, NOW)
    held, progress = [0, 0], []
    for rows in batches:
        new = [0, 0]
        for r in rows:
            if not r[5]:
                new[":)" in r[2]] += 1
        held = [h + n if h < 10 else h for h, n in zip(held, new)]
        progress.append((held[1], held[0], 20))
    assert {r.sentiment: r["count"] for r in corpus.groupBy("sentiment").count().collect()} == {0.0: held[0], 1.0: held[1]}
    got = [tuple(r)[:3] for r in read_progress(spark, work).orderBy("batch").collect()]
    assert got == progress[:len(got)] and min(got[-1][:2]) >= 10


def test_corpus_of_a_whole_stream(spark):
    batches = labelled_posts(1, 6)
    source, work = shared_dir(spark, "in"), shared_dir(spark, "work")
    feed(spark, source, batches)
    corpus = collect_corpus(stream_posts(spark, source, "json", **ONE_FILE), work, None, NOW)
    assert sorted(r.text for r in corpus.collect()) == sorted(r[2] for rows in batches for r in rows if not r[5])


def test_stream_corpus_reads_every_post(spark, samples):
    posts = training_posts(read_sample_posts(spark, samples))
    counts = {r.sentiment: r["count"] for r in stream_corpus(spark, samples).collect()}
    assert counts == {r.sentiment: r["count"] for r in posts.groupBy("sentiment").count().collect()}


def test_corpus_files(spark):
    folder = shared_dir(spark, "corpus")
    rows = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "text string, sentiment double")
    write_corpus(rows, folder)
    assert sorted(read_corpus(spark, folder).collect()) == sorted(rows.collect())
    rows.write.csv(f"{folder}-csv")
    assert sorted(read_labelled_csv(spark, f"{folder}-csv").collect()) == sorted(rows.collect())


def test_training_stream_equals_repeated_training(spark):
    batches = labelled_posts(2, 3)
    batches.insert(1, [(1, BASE, "no emoticon", "en", "en", False)])
    source, work = shared_dir(spark, "in"), shared_dir(spark, "work")
    feed(spark, source, batches)
    points = training_points(training_posts(read_posts(spark, source, "json")), WORDS)
    query = start_training(stream_posts(spark, source, "json", **ONE_FILE), work, points, WORDS, iterations=3, trigger=NOW)
    query.awaitTermination()
    expected = LogisticModel.zeros(50)
    for rows in batches:
        batch = WORDS.tf(training_posts(spark.createDataFrame(rows, POST_SCHEMA)))
        expected = train(batch, expected, 3, width=50)
    got = latest_model(spark, work)
    assert got.version == 3
    assert all(abs(a - b) < 1e-12 for a, b in zip(got.weights, expected.weights))
    metrics = read_metrics(spark, work).orderBy("version").collect()
    assert [r.version for r in metrics] == [1, 2, 3]
    assert metrics[-1].accuracy > 0.8
    stored = latest_trained(spark, work)
    assert stored.model == got and stored.idf == fit_idf(points, width=50)
    found = classify_keyword(read_posts(spark, source, "json"), "sun", stored, WORDS)
    assert {r.sentiment for r in found.collect()} == {"1.0"}


def test_streams_without_rows(spark, tmp_path):
    work = shared_dir(spark, "work")
    corpus = collect_corpus(stream_posts(spark, str(tmp_path), "json"), work, 20, NOW)
    assert corpus.select("text", "sentiment").collect() == [] and "batch" in corpus.columns
    assert read_progress(spark, work).collect() == [] and read_metrics(spark, work).collect() == []
    assert latest_model(spark, work) is None and latest_trained(spark, work) is None
    assert read_top(spark, work).collect() == []


def test_a_restart_goes_on_from_the_stored_weights(spark):
    first, second = labelled_posts(4, 1), labelled_posts(5, 1)
    source, work = shared_dir(spark, "in"), shared_dir(spark, "work")
    for batches in (first, second):
        feed(spark, source, batches)
        start_training(stream_posts(spark, source, "json"), work, featurizer=WORDS, iterations=2,
                       trigger=NOW).awaitTermination()
    assert latest_model(spark, work).version == 2


def test_graceful_stop_keeps_the_session(spark):
    source, work = shared_dir(spark, "in"), shared_dir(spark, "work")
    feed(spark, source, labelled_posts(6, 1))
    query = start_training(stream_posts(spark, source, "json"), work, featurizer=WORDS, iterations=1)
    stop(query)
    assert not query.isActive and latest_model(spark, work).version == 1
    assert spark.range(3).count() == 3


def test_a_failed_stream_is_no_empty_result(spark):
    def fail(batch, number):
        raise ValueError("no batch is written")

    query = spark.readStream.format("rate").load().writeStream.foreachBatch(fail).start()
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    with pytest.raises(StreamingQueryException):
        stop(query)
    assert not query.isActive


@pytest.mark.parametrize("kind", [replay.PostReplay, published.PublishedRows])
def test_sources_and_sinks_need_no_package_on_the_workers(kind, tmp_path):
    (tmp_path / "kind").write_bytes(cloudpickle.dumps(kind))
    code = "import pickle, sys; print(pickle.load(open('kind', 'rb')).name(), 'postwave' in sys.modules)"
    bare = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=bare, capture_output=True, text=True)
    assert run.stdout.split() == [kind.name(), "False"], run.stderr
