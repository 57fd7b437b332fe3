"""Trending plans: from posts or tagged events to top hashtags and payloads."""

from pyspark.sql import functions as F

from ..operators import trending as op
from ..schema import SLIDE_SECONDS, TOP_K, WINDOW_SECONDS


def trending_now(posts, end=None, window=WINDOW_SECONDS, slide=SLIDE_SECONDS, k=TOP_K):
    """Top hashtags of the window that ends at ``end`` (epoch seconds), by default the last one.

    The time bound filters the posts before their text is split; nothing is newer than the last window's end.
    """
    if end is None:
        recent = op.since(posts, op.last_window_start(posts, window, slide))
    else:
        recent = op.before(op.since(posts, F.timestamp_seconds(F.lit(end - window))), F.timestamp_seconds(F.lit(end)))
    return op.top_hashtags(op.hashtag_counts(op.tagged_posts(recent)), k)


def trending_windows(tagged, window=WINDOW_SECONDS, slide=SLIDE_SECONDS, k=TOP_K):
    """Top hashtags of every window."""
    return op.top_per_window(op.bucket_counts(tagged, slide), window, slide, k)


def trending_time_in_top(tagged, window=WINDOW_SECONDS, slide=SLIDE_SECONDS, k=TOP_K):
    """How long each hashtag was in the top k, over all windows."""
    return op.time_in_top(op.top_spans(op.bucket_counts(tagged, slide), window, slide, k))
