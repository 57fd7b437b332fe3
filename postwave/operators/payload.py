"""JSON payloads. Each collects a result whose size a limit already bounds."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def with_rank(top):
    """Ranks of a bounded top-k table."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("count"), "hashtag")))


def ordered_payload(ranked, *keys):
    """One row (per key): ``[{"hashtag":..,"count":..},..]`` by rank."""
    rows = F.array_sort(F.collect_list(F.struct("rank", "hashtag", "count")))
    value = F.to_json(F.transform(rows, lambda r: F.struct(r["hashtag"].alias("hashtag"), r["count"].alias("count"))))
    return ranked.groupBy(*keys).agg(value.alias("value"))


def set_payload(top):
    """One row: the set of (hashtag, count), sorted by name, below the key the collecting expression names."""
    one = top.select(F.struct("hashtag", "count").alias("hashtag_and_count"))
    gathered = one.agg(F.sort_array(F.collect_set("hashtag_and_count")).alias("collect_set(hashtag_and_count)"))
    return gathered.select(F.to_json(F.struct("*")).alias("value"))


def statistics_json(statistics):
    return statistics.select(F.to_json(F.struct("trainer", "model", "areaUnderRoc", "accuracy")).alias("value"))


def classification_json(scored):
    """One row for a searched, hence bounded, set of scored posts, by their ``rank`` in the search."""
    rows = F.array_sort(F.collect_list(F.struct("rank", "tweet", "sentiment")))
    posts = F.transform(rows, lambda r: F.struct(r["tweet"].alias("tweet"), r["sentiment"].alias("sentiment")))
    return scored.agg(F.to_json(F.struct(posts.alias("onlineModelResult"))).alias("value"))
