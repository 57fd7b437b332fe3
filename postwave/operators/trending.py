"""Hashtag counts over sliding windows.

Time runs on a grid of ``slide`` seconds. A post in bucket b (grid cell [b, b+1)) is inside the windows that end at
b+1 .. b+width, where width = window / slide. Posts are reduced to one row per (hashtag, bucket) first, so a hot hashtag
costs as many rows as there are buckets, never as many as there are posts.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..schema import SLIDE_SECONDS, TOP_K, WINDOW_SECONDS
from .filters import in_languages, originals

# Window ends of a part, within which leaders are sought; no more than a chunk has.
PART = 60


def hashtag_words(posts, *keep):
    """One row per word that starts with '#', written as it stands."""
    words = posts.filter(F.col("text").contains("#")).select(
        *keep, F.explode(F.split("text", " ")).alias("hashtag")
    )
    return words.filter(F.col("hashtag").startswith("#"))


def tagged_posts(posts):
    """(created_at, hashtag) of the originals in the tracked languages."""
    return hashtag_words(in_languages(originals(posts)), "created_at")


def hashtag_counts(tagged):
    return tagged.groupBy("hashtag").agg(F.count("*").alias("count"))


def top_hashtags(counts, k=TOP_K):
    """The k largest counts; equal counts go by name."""
    return counts.select("hashtag", "count").orderBy(F.desc("count"), "hashtag").limit(k)


def last_window_start(posts, window=WINDOW_SECONDS, slide=SLIDE_SECONDS):
    """Start of the last window, as a scalar subquery; it ends at the first grid point after the newest post.

    The subquery reads the time column only. It returns the bound as a timestamp, ready for use: an expression around it
    would keep the filter from the scan, and row groups of the whole history would be read.
    """
    end = F.floor(F.unix_seconds(F.max("created_at")) / slide) * slide + slide
    return posts.agg(F.timestamp_seconds(end - window).alias("start")).scalar()


def since(posts, start):
    """Posts at or after ``start``, a timestamp Column."""
    return posts.filter(F.col("created_at") >= start)


def before(posts, end):
    return posts.filter(F.col("created_at") < end)


def bucket_counts(tagged, slide=SLIDE_SECONDS):
    bucket = F.floor(F.unix_seconds("created_at") / slide)
    return tagged.groupBy("hashtag", bucket.alias("bucket")).agg(F.count("*").alias("count"))


def window_runs(buckets, width, first=None, last=None, held=None):
    """Runs of window ends with one count: (hashtag, chunk, first_end, last_end, count, changed).

    Each bucket adds its count at its first window end and takes it off after its last one; the running sum per hashtag
    is the window count. Time is cut into chunks of ``width`` ends and a bucket that reaches into the next chunk is
    carried over, so a group is one hashtag in one chunk, at most ``width`` rows, however long the history is.
    ``changed`` is false where a run starts only because a chunk does. ``first`` and ``last`` keep to those ends; all
    that came before then adds up to one step per hashtag.

    ``held`` stands for the buckets before: (counts of the window that ends before ``first``; the buckets of that window that
    leave by ``last``). All of it has left once the first chunk, which then starts at ``first``, is over.
    """
    start, stop = F.col("bucket") + 1, F.col("bucket") + width + 1
    origin = 0 if held is None else first
    if first is not None:
        buckets = buckets.filter(stop > first)
        start = F.greatest(start, F.lit(first))
    if last is not None:
        buckets = buckets.filter(start <= last)
        stop = F.least(stop, F.lit(last + 1))
    spans = buckets.select("hashtag", "count", start.alias("start"), stop.alias("stop"))
    chunk_of = lambda end: F.floor((end - origin) / width)
    spans = spans.select("*", F.explode(F.sequence(chunk_of(F.col("start")), chunk_of(F.col("stop")))).alias("chunk"))
    opens = F.col("chunk") * width + origin
    closes = opens + width
    enter = F.struct(
        F.greatest("start", opens).alias("first_end"),
        F.col("count").alias("delta"),
        F.when(F.col("start") >= opens, F.col("count")).otherwise(0).alias("change"),
    )
    leave = F.struct(F.col("stop").alias("first_end"), (-F.col("count")).alias("delta"), (-F.col("count")).alias("change"))
    steps = spans.select("hashtag", "chunk", F.inline(F.array(enter, leave)))
    if held is not None:
        counts, leaving = held
        zero, gone = F.lit(0).cast("bigint"), -F.col("count")
        end = F.col("bucket") + width + 1
        leaving = leaving if last is None else leaving.filter(end <= last)
        steps = steps.unionAll(counts.select("hashtag", zero, F.lit(first).cast("bigint"), "count", zero)).unionAll(
            leaving.select("hashtag", zero, end, gone, gone)
        )
    # Dealt out by chunk at once: the sums, the running sums and the parts of the chunk all stay there.
    sums = (
        steps.filter(F.col("first_end") < closes)
        .repartition("hashtag", "chunk")
        .groupBy("hashtag", "chunk", "first_end")
        .agg(F.sum("delta").alias("delta"), F.sum("change").alias("change"))
    )
    until = closes if last is None else F.least(closes, F.lit(last + 1))
    in_order = Window.partitionBy("hashtag", "chunk").orderBy("first_end")
    return sums.select(
        "hashtag",
        "chunk",
        "first_end",
        (F.lead("first_end").over(in_order)).alias("next_end"),
        F.sum("delta").over(in_order).alias("count"),
        (F.col("change") != 0).alias("changed"),
    ).select(
        "hashtag",
        "chunk",
        "first_end",
        (F.coalesce("next_end", until) - 1).alias("last_end"),
        "count",
        "changed",
    )


def change_points(tagged, window=WINDOW_SECONDS, slide=SLIDE_SECONDS):
    """(hashtag, window_end, count) wherever a hashtag's window count changes; it holds until the next row."""
    runs = window_runs(bucket_counts(tagged, slide), window // slide)
    return runs.filter("changed").select("hashtag", (F.col("first_end") * slide).alias("window_end"), "count")


def contenders(runs, size, k, first=None, last=None):
    """Runs, cut into parts of ``size`` ends, that can reach a top k, exactly: (hashtag, chunk, part,
    first_end, last_end, count).

    If a hashtag's least count within a part is above another one's peak there (or equal to it, with the lesser name), it is
    ahead at every end of the part. So the k-th best by least count keeps out all that peak below it. ``first`` and ``last``:
    the ends that the runs keep to.
    """
    part = F.explode(F.sequence(F.floor(F.col("first_end") / size), F.floor(F.col("last_end") / size))).alias("part")
    pieces = runs.select("hashtag", "chunk", "first_end", "last_end", "count", part)
    opens = F.col("part") * size
    pieces = pieces.withColumns(
        {"first_end": F.greatest("first_end", opens), "last_end": F.least("last_end", opens + size - 1)}
    )
    ends = F.least(opens + size - 1, F.lit(last)) if last is not None else opens + size - 1
    ends = ends + 1 - (F.greatest(opens, F.lit(first)) if first is not None else opens)
    # The runs are still dealt out by hashtag and chunk, so only the leaders travel.
    group = Window.partitionBy("hashtag", "chunk", "part")
    whole = F.sum(F.col("last_end") - F.col("first_end") + 1).over(group) == ends
    tags = pieces.select(
        "*",
        F.max("count").over(group).alias("peak"),
        F.when(whole, F.min("count").over(group)).otherwise(0).alias("least"),
        (F.col("first_end") == F.min("first_end").over(group)).alias("opening"),
    )
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("least"), "hashtag"))
    leaders = tags.filter("opening and least > 0").select("part", "least", "hashtag", rank.alias("nth"))
    last_leader = F.max_by(F.struct("least", "hashtag"), "nth").alias("leader")
    bar = leaders.filter(F.col("nth") <= k).groupBy("part").agg(last_leader, F.count("*").alias("full"))
    bar = bar.filter(F.col("full") == k).select("part", F.col("leader.least").alias("bar"), F.col("leader.hashtag").alias("bar_tag"))
    ahead = (F.col("peak") > F.col("bar")) | ((F.col("peak") == F.col("bar")) & (F.col("hashtag") <= F.col("bar_tag")))
    kept = tags.join(bar, "part", "left").filter(F.col("bar").isNull() | ahead)
    return kept.select("hashtag", "chunk", "part", "first_end", "last_end", "count")


def steady_spans(runs):
    """Cut runs at every end where any run of their part starts or stops: (part, first_end, last_end, hashtag, count).

    Between two cuts no count changes, so one ranking serves the whole span. A part has at most one cut for each of its ends.
    """
    group = Window.partitionBy("part")
    cuts = F.array_union(F.collect_set("first_end").over(group), F.collect_set(F.col("last_end") + 1).over(group))
    spans = F.zip_with(
        F.slice("cuts", 1, F.size("cuts") - 1),
        F.slice("cuts", 2, F.size("cuts") - 1),
        lambda a, b: F.struct(a.alias("first_end"), (b - 1).alias("last_end")),
    )
    inside = F.filter(spans, lambda s: (s["first_end"] >= F.col("first_end")) & (s["last_end"] <= F.col("last_end")))
    cut = runs.withColumn("cuts", F.array_sort(cuts))
    return cut.select("part", "hashtag", "count", F.inline(inside))


def top_spans(buckets, window=WINDOW_SECONDS, slide=SLIDE_SECONDS, k=TOP_K, first=None, last=None, held=None):
    """Top k for spans of window ends: (first_end, last_end, rank, hashtag, count), ends on the grid.

    A part keeps only the hashtags that can lead there, so what is ranked grows with the changes among leaders and not with
    all counts times all ends.
    """
    width = window // slide
    live = window_runs(buckets, width, first, last, held).filter(F.col("count") > 0)
    spans = steady_spans(contenders(live, min(PART, width), k, first, last))
    rank = F.row_number().over(Window.partitionBy("part", "first_end").orderBy(F.desc("count"), "hashtag"))
    ranked = spans.select("first_end", "last_end", rank.alias("rank"), "hashtag", "count")
    return ranked.filter(F.col("rank") <= k)


def window_ends(spans, slide=SLIDE_SECONDS):
    """(window_end in epoch seconds, rank, hashtag, count) of each window of the spans."""
    ends = spans.select(F.explode(F.sequence("first_end", "last_end")).alias("end"), "rank", "hashtag", "count")
    return ends.select((F.col("end") * slide).alias("window_end"), "rank", "hashtag", "count")


def live_counts(buckets, width, last, held=None):
    """(hashtag, count) of the window that ends at the grid point ``last``, from its buckets, or from what was held before."""
    rows = buckets.filter(F.col("bucket") + width >= last).select("hashtag", "count")
    if held is not None:
        counts, leaving = held
        leaving = leaving.filter(F.col("bucket") + width < last)
        rows = rows.unionAll(counts.select("hashtag", "count")).unionAll(leaving.select("hashtag", -F.col("count")))
    return rows.groupBy("hashtag").agg(F.sum("count").alias("count")).filter(F.col("count") > 0)


def top_per_window(buckets, window=WINDOW_SECONDS, slide=SLIDE_SECONDS, k=TOP_K, after=None, until=None):
    """Top k of every window: (window_end in epoch seconds, rank, hashtag, count).

    ``after`` and ``until`` (epoch seconds, after < end <= until) limit the windows.
    """
    first = None if after is None else after // slide + 1
    last = None if until is None else until // slide
    return window_ends(top_spans(buckets, window, slide, k, first, last), slide)


def time_in_top(spans):
    """Per hashtag: windows spent in the top k, best rank, highest count there."""
    windows = F.sum(F.col("last_end") - F.col("first_end") + 1)
    return spans.groupBy("hashtag").agg(
        windows.alias("windows"), F.min("rank").alias("best_rank"), F.max("count").alias("peak")
    )
