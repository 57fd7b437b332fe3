"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame operations only.

* Sizes: words of a document, runs of other than white space. Targets: the sources by code point (null last) weigh 5, 2, 1
  and so on, and share 1.5 times all words; a target stops at twice its source's words, and the excess is shared among the
  others by weight, until none is above.
* Schedule: point i is the fraction of i times the golden ratio. It falls into one source's part of the cumulative quotas
  (targets rounded down) and is a slot of that source; any number of sources will do. Slots are ranked per source; a source gets just the blocks that its target fills, so slots
  that its points fall short of (or exceed) by the sequence's small discrepancy are added (or dropped) at the end.
* Blocks: a source's documents in a shuffled order (a hash of the id) make one line of words, cut into blocks of 512 words.
  Slot r takes block r of that line, which starts anew after its end; the last slot takes what its target still lacks. So a
  source's taken words are its target rounded down, and no document is taken more than twice.

Ranks and places are running sums over chunks first (of slot numbers, of hash ranges), then within a chunk, so no task
orders all rows of a source, however large its share. Slots and blocks meet in an equi-join on (source, block). ``slots`` lists
the mix in that order; what is taken of a document is the sum over its parts there.

Null text has size 0 and is taken 0 times; null sources are one source; repeated rows have a place each, and ``mix`` repeats
equal rows alike, by what is taken of them together; an empty table gives an empty one; other columns are ignored (kept by ``mix``).
"""

from math import sqrt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
BLOCK = 512
GOLDEN = (sqrt(5) - 1) / 2
SLOT_CHUNK = 1 << 14
HASH_BITS = 14  # bits of the shuffling hash that number a chunk of documents
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs):
    """doc_id, source, size, spot (a hash that shuffles) of each document."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")
    return docs.select("doc_id", "source", size, F.xxhash64("doc_id", "text").alias("spot"))


def numbered(sources):
    """Sources with their ``number`` by code point, null last: ranges of the order first, then within a range."""
    order = [F.col("source").isNull(), F.col("source")]
    ranges = materialize(sources.orderBy(*order).withColumn("source_range", F.spark_partition_id()), "sources")
    number = running(ranges.withColumn("one", F.lit(1)), [], "source_range", order, "one", "number")
    return number.drop("one", "source_range")


def targets(sized, weights=WEIGHTS, share=SHARE, most=MOST):
    """(number, source, source_size, target, quota, blocks) of each source, and (slots, quota) of all.

    The excess over a limit goes to the sources below theirs, by weight, until none is above. A round is one sum over the
    sources: those whose part of what is left reaches their limit are full, and stay so, as the parts only grow.
    """
    sources = sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("number"), F.lit(len(weights))).cast("int") + 1)
    rows = numbered(sources).withColumns({"weight": weight, "limit": most * F.col("source_size")})
    rows = materialize(rows, "weights")
    whole = rows.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    all_ = share * (whole.size or 0)
    left, total, n_full = all_, whole.weight, -1
    while total:
        part = F.lit(float(left)) * F.col("weight") / F.lit(float(total))
        full = part >= F.col("limit")
        found = rows.agg(
            F.count(F.when(full, 1)).alias("full"), F.sum(F.when(full, F.col("limit"))).alias("taken"), F.sum(F.when(~full, F.col("weight"))).alias("weight")
        ).first()
        if found.full == n_full:
            break
        n_full, left, total = found.full, all_ - (found.taken or 0), found.weight
    target = F.col("limit").cast("double")
    if total:
        target = F.when(part >= F.col("limit"), target).otherwise(part)
    goal = rows.select("number", "source", "source_size", target.alias("target"))
    quota = F.floor("target").cast("bigint")
    goal = materialize(goal.withColumn("quota", quota).withColumn("blocks", F.ceil(F.col("quota") / BLOCK).cast("bigint")), "targets")
    sums = goal.agg(F.sum("blocks").alias("slots"), F.sum("quota").alias("quota")).first()
    return goal, (sums.slots or 0, sums.quota or 0)


def running(rows, keys, chunk, order, value, name):
    """``name``: the sum of ``value`` over the rows of the same keys that come before, by chunk and then by order."""
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, chunk).agg(F.sum(value).alias("chunk_sum"))
    sums = sums.select(*keys, chunk, F.coalesce(F.sum("chunk_sum").over(before), F.lit(0)).alias("chunk_start"))
    within = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumn("inner_start", F.coalesce(F.sum(value).over(within), F.lit(0)))
    start = (F.col("chunk_start") + F.col("inner_start")).cast("bigint").alias(name)
    return inner.join(sums, [*keys, chunk]).select(*rows.columns, start)


def schedule(goal, slots, quota):
    """(slot, number, rank): the slots of the mix in order, each with its source and the source's block that it takes.

    Slot i belongs to the source in whose part of the cumulative quotas point i lies: that of the last edge before it. Points
    and edges are counted in order, by ranges of the unit interval first.
    """
    spark = goal.sparkSession
    upto = running(goal.withColumn("source_chunk", F.floor(F.col("number") / SLOT_CHUNK)), [], "source_chunk", ["number"], "quota", "before")
    edges = upto.filter("number > 0").select(
        (F.col("before") / float(max(quota, 1))).alias("place"), F.lit(None).cast("bigint").alias("slot"), F.lit(1).alias("edge")
    )
    turn = (F.col("id") + 1) * F.lit(GOLDEN)
    points = spark.range(slots).select((turn - F.floor(turn)).alias("place"), F.col("id").alias("slot"), F.lit(0).alias("edge"))
    ranges = max(1, slots // SLOT_CHUNK)
    placed = edges.unionAll(points).withColumn("place_range", F.floor(F.col("place") * ranges))
    order = ["place", F.desc("edge"), "slot"]
    located = running(placed, [], "place_range", order, "edge", "number").filter("edge = 0").select("slot", "number", F.lit(1).alias("one"))
    drawn = located.withColumn("slot_chunk", F.floor(F.col("slot") / SLOT_CHUNK))
    drawn = materialize(running(drawn, ["number"], "slot_chunk", ["slot"], "one", "rank").select("slot", "number", "rank"), "drawn")
    counts = drawn.groupBy("number").agg(F.count(F.lit(1)).alias("drawn"))
    # Points fall short of a source's blocks, or exceed them, by the small discrepancy of the sequence.
    short = goal.join(counts, "number", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0))).filter("drawn < blocks")
    short = short.withColumns({"lacking": F.col("blocks") - F.col("drawn"), "source_chunk": F.floor(F.col("number") / SLOT_CHUNK)})
    added = running(short, [], "source_chunk", ["number"], "lacking", "added")
    added = added.select("number", "drawn", "added", F.explode(F.sequence("drawn", F.col("blocks") - 1)).alias("rank"))
    added = added.select((F.lit(slots) + F.col("added") + F.col("rank") - F.col("drawn")).alias("slot"), "number", "rank")
    kept = drawn.join(goal.select("number", "blocks"), "number").filter("rank < blocks")
    return kept.select("slot", "number", "rank").unionAll(added)


def block_parts(docs):
    """(number, rank, ..., words): the part of a document that lies in a block of its source's line; and the sources."""
    sized = materialize(sizes(docs), "sizes")
    goal, sums = targets(sized)
    sources = goal.drop("blocks")
    own = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    own = own.withColumn("spot_chunk", F.shiftrightunsigned("spot", 64 - HASH_BITS))
    placed = running(own, ["number"], "spot_chunk", ["spot", "doc_id"], "size", "place")
    # A document lies on the line once in each pass; what is beyond the quota is not taken.
    passes = placed.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))))
    start = F.col("place") + F.col("pass") * F.col("source_size")
    passes = passes.withColumn("start", start).withColumn("stop", F.least(F.col("start") + F.col("size"), F.col("quota")))
    covered = F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("stop") - 1) / BLOCK))
    parts = passes.withColumn("rank", F.explode_outer(F.when(F.col("start") < F.col("stop"), covered)))
    low, high = F.greatest("start", F.col("rank") * BLOCK), F.least("stop", (F.col("rank") + 1) * BLOCK)
    return parts.withColumn("words", F.coalesce(high - low, F.lit(0))), goal, sums


def slots(docs):
    """(slot, source, block, doc_id, first_word, words): the mix in order, the documents' parts that each slot takes.

    ``first_word`` counts the document's words from 0.
    """
    parts, goal, sums = block_parts(docs)
    own = parts.filter("words > 0").join(schedule(goal, *sums), ["number", "rank"])
    first = F.greatest(F.col("rank") * BLOCK - F.col("start"), F.lit(0)).cast("bigint")
    return own.select("slot", "source", F.col("rank").alias("block"), "doc_id", first.alias("first_word"), "words")


def take(docs):
    """doc_id, spot, size, source_size, target, taken, first_slot (null: none) of each document, from the slots of its parts."""
    parts, goal, sums = block_parts(docs)
    found = parts.join(schedule(goal, *sums), ["number", "rank"], "left")
    key = ["doc_id", "spot", "size", "source_size", "target", "number", "place"]
    words = F.sum(F.when(F.col("slot").isNotNull(), F.col("words")).otherwise(0)).cast("bigint").alias("taken")
    # Empty documents may share a place, so rows that are alike are counted and dealt out again.
    found = found.withColumn("first_part", (F.col("pass") == 0) & (F.coalesce("rank", F.lit(-1)) <= F.floor(F.col("start") / BLOCK)))
    grouped = found.groupBy(*key).agg(
        words, F.min(F.when(F.col("words") > 0, F.col("slot"))).alias("first_slot"), F.count(F.when(F.col("first_part"), 1)).alias("rows")
    )
    again = grouped.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "rows")))
    return again.select("doc_id", "spot", "size", "source_size", "target", "taken", "first_slot")


def mixed_sizes(docs):
    """doc_id, size, source_size, target, taken, first_slot of each document."""
    return take(docs).drop("spot")


def mix(docs):
    """The documents of the mix with all columns: a document as often as its words are taken, rounded (0, 1 or 2 times)."""
    taken = take(docs).groupBy("doc_id", "spot").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    taken = taken.filter("size > 0").select(F.struct("doc_id", "spot").alias("taken_key"), copies.alias("copies")).filter("copies > 0")
    own = F.struct(docs["doc_id"].alias("doc_id"), F.xxhash64(docs["doc_id"], docs["text"]).alias("spot")).alias("own_key")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("document"), own)
    rows = rows.join(taken, F.col("own_key").eqNullSafe(F.col("taken_key")))
    return rows.select("document", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("document.*")
