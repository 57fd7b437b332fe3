"""Sliding windows against a direct count, including skew and dense slides."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from postwave.operators import payload, trending
from postwave.plans.trending import trending_now
from postwave.schema import POST_SCHEMA

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)


def make_tags(spark, seed, n, span, names, hot=0.4):
    """Tags at random seconds; a hot one holds a large share of all rows."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        name = "#hot" if rng.random() < hot else f"#{rng.randrange(names)}"
        rows.append((BASE + timedelta(seconds=rng.randrange(span)), name))
    return rows, spark.createDataFrame(rows, "created_at timestamp, hashtag string")


def direct_counts(rows, window, slide):
    counts = {}
    for t, name in rows:
        bucket = int(t.timestamp()) // slide
        for end in range(bucket + 1, bucket + window // slide + 1):
            counts.setdefault(end * slide, Counter())[name] += 1
    return counts


def direct_top(rows, window, slide, k):
    out = set()
    for end, names in direct_counts(rows, window, slide).items():
        ranked = sorted(names.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
        out |= {(end, i + 1, name, n) for i, (name, n) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("window, slide, k", [(3600, 300, 3), (600, 5, 2), (600, 5, 1), (600, 5, 10), (60, 60, 2)])
def test_top_per_window(spark, window, slide, k):
    rows, tagged = make_tags(spark, window + k, 400, 5000, 8)
    top = trending.top_per_window(trending.bucket_counts(tagged, slide), window, slide, k)
    assert {tuple(r) for r in top.collect()} == direct_top(rows, window, slide, k)


def test_pruning_keeps_dense_leaders(spark):
    """Steady leaders set a bar above the tail, which is then dropped, and the result stays exact."""
    rows = [(BASE + timedelta(seconds=s), f"#lead{i}") for s in range(0, 4000, 5) for i in range(2) for _ in range(2)]
    rows += [(BASE + timedelta(seconds=37 * i), f"#tail{i}") for i in range(100)]
    tagged = spark.createDataFrame(rows, "created_at timestamp, hashtag string")
    buckets = trending.bucket_counts(tagged, 5)
    runs = trending.window_runs(buckets, 120)
    assert trending.contenders(runs, 120, 2).count() < runs.filter("count > 0").count()
    top = trending.top_per_window(buckets, 600, 5, 2)
    assert {tuple(r) for r in top.collect()} == direct_top(rows, 600, 5, 2)


def test_change_points_hold_until_the_next(spark):
    rows, tagged = make_tags(spark, 5, 200, 4000, 4)
    counts = direct_counts(rows, 600, 5)
    points = {}
    for r in trending.change_points(tagged, 600, 5).collect():
        points.setdefault(r.hashtag, []).append((r.window_end, r["count"]))
    for name, steps in points.items():
        steps.sort()
        assert all(a[1] != b[1] for a, b in zip(steps, steps[1:]))
        for (end, n), (stop, _) in zip(steps, steps[1:]):
            assert all(counts.get(e, {}).get(name, 0) == n for e in range(end, stop, 5))
        assert steps[-1][1] == 0


@pytest.mark.parametrize("slide, take", [(60, (50, -50)), (5, (300, -300)), (5, (300, 301)), (5, (0, None))])
def test_range_limits(spark, slide, take):
    rows, tagged = make_tags(spark, 9, 100, 2000, 4)
    everything = direct_top(rows, 600, slide, 3)
    ends = sorted({e for e, *_ in everything}) if take[1] == 301 else sorted(e for e, *_ in everything)
    lo, hi = ends[take[0]], None if take[1] is None else ends[take[1]]
    top = trending.top_per_window(trending.bucket_counts(tagged, slide), 600, slide, 3, lo, hi)
    want = {r for r in everything if lo < r[0] and (hi is None or r[0] <= hi)}
    assert want and {tuple(r) for r in top.collect()} == want


def test_trending_now(spark):
    rows, _ = make_tags(spark, 11, 300, 9000, 6)
    posts = spark.createDataFrame(
        [(i, t, f"x {name}", "en", "en", False) for i, (t, name) in enumerate(rows)], POST_SCHEMA)
    counts = direct_counts(rows, 3600, 5)
    for end in (None, max(counts) - 7200):
        names = counts[int(max(t for t, _ in rows).timestamp()) // 5 * 5 + 5 if end is None else end]
        want = sorted(names.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        assert [tuple(r) for r in trending_now(posts, end, k=3).collect()] == want


def test_top_breaks_ties_by_name(spark):
    counts = spark.createDataFrame([("#b", 2), ("#a", 2), ("#c", 1)], "hashtag string, count bigint")
    assert [r.hashtag for r in trending.top_hashtags(counts, 1).collect()] == ["#a"]


def test_payloads(spark):
    top = spark.createDataFrame([("#b", 1), ("#a", 2)], "hashtag string, count bigint")
    ordered = payload.ordered_payload(payload.with_rank(top)).first().value
    assert ordered == '[{"hashtag":"#a","count":2},{"hashtag":"#b","count":1}]'
    as_set = json.loads(payload.set_payload(top).first().value)
    assert list(as_set) == ["collect_set(hashtag_and_count)"]
    assert sorted(x["hashtag"] for x in as_set["collect_set(hashtag_and_count)"]) == ["#a", "#b"]


def test_groups_stay_small_under_skew(spark):
    """A hashtag with most rows in one bucket is one row after the first step."""
    rows = [(BASE, "#hot")] * 5000 + [(BASE, "#cold")]
    tagged = spark.createDataFrame(rows, "created_at timestamp, hashtag string")
    assert trending.bucket_counts(tagged).count() == 2
    sizes = trending.window_runs(trending.bucket_counts(tagged), 720).groupBy("hashtag", "chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 720
