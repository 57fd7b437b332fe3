"""Decontamination by suffix arrays over the training documents.

The documents of a task are cut into shards of about 4 MB. A shard numbers its words by the words of the test items (all
others are 0) and sorts the suffixes that can match a test suffix: those that start with two words that follow each other
in a test item (one word if some item has a single word). Every suffix of every test item is then searched in the sorted
array, all at once, by binary search for one word after the other; the range that is left when no word follows gives the
longest verbatim match of each test suffix and the places where it occurs.

A test suffix of ten words or more whose match has ten or more is an occurring window, as is a whole item of fewer words.
Items whose words add up to more than ``BLOCK_WORDS`` are searched in several blocks, each in a pass over the documents.

Items with a null id are searched like others: their hits count and their places have a null item_id, but ``items`` and
what is made of it (n_items, items_sha256) leave them out. Null and empty texts have no words and are never hit; repeated rows are searched one by one; no items give no hit; other
columns are kept by ``clean_documents`` and ignored elsewhere. Words are found by 64-bit hashes and then compared byte by byte.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from . import arrays

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 1 << 20  # words of test items that a task holds at once (about 30 MB)
ITEM_WORDS = "item_id string, words binary, sizes binary, texts binary"
MATCHES = "doc_id bigint, start bigint, length bigint, item_id string, item_start bigint"
HITS = "doc_id bigint, text_hash bigint, n_words bigint, hit array<bigint>, items array<string>"


class Tests:
    """The words of test items, numbered, and their suffixes.

    ``items``: list of (item_id, hashes of the words, sizes of the words, bytes of the words one after the other).
    """

    def __init__(self, items, window=WINDOW):
        items = [item for item in items if len(item[1])]
        self.window, self.names = window, [item[0] for item in items]
        lengths = np.array([len(item[1]) for item in items], dtype=np.int64)
        words = np.concatenate([item[1] for item in items] or [np.zeros(0, np.uint64)])
        sizes = np.concatenate([item[2] for item in items] or [np.zeros(0, np.int64)]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(item[3] for item in items), np.uint8)
        starts = np.cumsum(sizes) - sizes
        self.vocabulary, first = np.unique(words, return_index=True)
        self.word_starts, self.word_sizes = starts[first], sizes[first]
        place = np.searchsorted(self.vocabulary, words)
        if not self.like(place, self.bytes, starts, sizes).all():
            raise ValueError("two words of the test items share a hash of 64 bits")
        numbers = np.searchsorted(self.vocabulary, words).astype(np.int64) + 1
        self.ends = np.repeat(np.cumsum(lengths), lengths)  # where the item of each suffix ends
        self.item = np.repeat(np.arange(len(items)), lengths)
        self.starts = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.depth = int(lengths.max()) if len(lengths) else 0
        self.numbers = np.append(numbers, np.zeros(self.depth + 1, np.int64))
        self.need = np.minimum(window, lengths)[self.item]  # words of a window of the item
        self.pair = bool(len(lengths)) and int(lengths.min()) > 1
        follows = np.flatnonzero(self.ends - np.arange(len(words)) > 1)
        self.heads = np.unique(self.head(self.numbers, follows) if self.pair else numbers)

    def like(self, place, data, starts, sizes):
        """Which words have the bytes of the item words at these places."""
        out = self.word_sizes[place] == sizes
        i = np.flatnonzero(out)
        out[i] = arrays.same_bytes(data, starts[i], self.bytes, self.word_starts[place[i]], sizes[i])
        return out

    def number(self, hashes, data, starts, ends):
        """The number of each word of ``data``, 0 for a word that no item has."""
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[place] == hashes)
        known = known[self.like(place[known], data, starts[known], (ends - starts)[known])]
        out = np.zeros(len(hashes), dtype=np.int64)
        out[known] = place[known] + 1
        return out

    def head(self, numbers, at):
        return numbers[at] * (len(self.vocabulary) + 1) + numbers[at + 1] if self.pair else numbers[at]


def suffix_array(numbers, tests):
    """The sorted suffixes of a shard that can match a test suffix; ``numbers`` ends with zeros for every depth.

    A 0 matches nothing, so a suffix is sorted up to its first 0 or to the longest test suffix. Groups of suffixes that
    are equal so far are sorted by their next word until none is open.
    """
    at = np.flatnonzero(numbers[: len(numbers) - tests.depth - 1])
    at = at[np.isin(tests.head(numbers, at), tests.heads)]
    group = np.zeros(len(at), dtype=np.int64)
    active = np.arange(len(at))
    for depth in range(tests.depth):
        word = numbers[at[active] + depth]
        order = np.lexsort((word, group[active]))
        at[active] = at[active][order]
        word, same = word[order], group[active]
        new = np.ones(len(active), dtype=bool)
        new[1:] = (same[1:] != same[:-1]) | (word[1:] != word[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(active)))
        group[active] = active[np.repeat(first, size)]
        active = active[(np.repeat(size, size) > 1) & (word > 0)]
        if not len(active):
            break
    return at


def search(numbers, array, tests):
    """(match length, low, high, window low, window high) of every test suffix.

    low to high is the range of the array with the longest match, window low to high the range of those suffixes whose
    match has a whole window.
    """
    n = len(tests.item)
    low, high = np.zeros(n, np.int64), np.full(n, len(array), np.int64)
    length, window_low, window_high = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    live = np.arange(n) if len(array) else np.zeros(0, np.int64)
    for depth in range(tests.depth):
        live = live[live + depth < tests.ends[live]]
        if not len(live):
            break
        word = tests.numbers[live + depth]
        edges = []
        for least in (word, word + 1):  # first place with at least the word, and with more
            a, b = low[live].copy(), high[live].copy()
            while (a < b).any():
                middle = (a + b) // 2
                below = (a < b) & (numbers[array[np.minimum(middle, len(array) - 1)] + depth] < least)
                a, b = np.where(below, middle + 1, a), np.where(below | (a >= b), b, middle)
            edges.append(a)
        found = edges[0] < edges[1]
        live = live[found]
        low[live], high[live], length[live] = edges[0][found], edges[1][found], depth + 1
        full = live[tests.need[live] == depth + 1]
        window_low[full], window_high[full] = low[full], high[full]
    return length, low, high, window_low, window_high


def expand(low, high):
    """(query, place) for each place of each range."""
    size = high - low
    query = np.repeat(np.arange(len(low)), size)
    return query, np.arange(len(query)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)


class Shard:
    """The words of a run of documents, numbered, with its suffix array."""

    def __init__(self, column, tests):
        data, offsets = arrays.utf8(column)
        data = arrays.LOWER[data]
        starts, ends, self.at = arrays.words(data, offsets)
        hashes = arrays.hashes(data, starts, ends)
        self.rows, self.n_words = arrays.rows_of(self.at), np.diff(self.at)
        # A 0 after each document, so no match crosses its end.
        self.place = np.arange(len(hashes)) + self.rows
        self.back = np.full(len(hashes) + len(self.n_words), -1, dtype=np.int64)
        self.back[self.place] = np.arange(len(hashes))
        self.numbers = np.zeros(len(self.back) + tests.depth + 1, dtype=np.int64)
        if tests.names:
            self.numbers[self.place] = tests.number(hashes, data, starts, ends)
        self.array = suffix_array(self.numbers, tests) if tests.names else np.zeros(0, np.int64)

    def hits(self, tests):
        """(hit words in ascending order, (row, item) of occurring windows)."""
        _, _, _, low, high = search(self.numbers, self.array, tests)
        query, place = expand(low, high)
        start = self.back[self.array[place]]
        cover = np.zeros(len(self.rows) + 1, dtype=np.int64)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + tests.need[query], -1)
        pairs = np.unique(np.stack([self.rows[start], tests.item[query]], axis=1), axis=0) if len(start) else np.zeros((0, 2), np.int64)
        return np.flatnonzero(np.cumsum(cover[:-1]) > 0), pairs

    def matches(self, tests, least):
        """(row, first word, length, item, first word in the item) of longest matches that can't grow to the left."""
        length, low, high, _, _ = search(self.numbers, self.array, tests)
        low = np.where(length >= np.minimum(least, tests.need), low, high)
        query, place = expand(low, high)
        spot = self.array[place]
        grows = (tests.starts[query] > 0) & (spot > 0)
        grows &= self.numbers[np.maximum(spot - 1, 0)] == tests.numbers[np.maximum(query - 1, 0)]
        query, start = query[~grows], self.back[spot[~grows]]
        row = self.rows[start]
        return row, start - self.at[row], length[query], tests.item[query], tests.starts[query]


def item_blocks(items, block_words=BLOCK_WORDS):
    """Test items in blocks of at most ``block_words`` words (one item at least), each a list as ``Tests`` takes it.

    The blocks are read one after the other; a task holds one block, the plan carries the words and 12 bytes for each.
    """

    def hashed(batches):
        for piece in arrays.pieces(batches):
            data, offsets = arrays.utf8(piece.column("text"))
            data = arrays.LOWER[data]
            starts, ends, at = arrays.words(data, offsets)
            hashes, sizes, texts = arrays.hashes(data, starts, ends), (ends - starts).astype(np.int32), data[arrays.WORD[data]]
            upto = np.concatenate([[0], np.cumsum(sizes)])[at]
            parts = [(hashes[i:j].tobytes(), sizes[i:j].tobytes(), texts[a:b].tobytes()) for i, j, a, b in zip(at[:-1], at[1:], upto[:-1], upto[1:])]
            columns = [pa.array([p[k] for p in parts], pa.binary()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([piece.column("item_id").cast(pa.string()), *columns], names=["item_id", "words", "sizes", "texts"])

    rows = items.select("item_id", "text").mapInArrow(hashed, ITEM_WORDS).filter("length(words) > 0")
    block, held = [], 0
    for row in rows.toLocalIterator():
        words = np.frombuffer(row.words, np.uint64)
        if block and held + len(words) > block_words:
            yield block
            block, held = [], 0
        block.append((row.item_id, words, np.frombuffer(row.sizes, np.int32), bytes(row.texts)))
        held += len(words)
    yield block


def block_hits(docs, tests):
    """``HITS`` of the documents for one block of tests."""

    def find(batches):
        for piece in arrays.pieces(batches, limit=SHARD_BYTES):
            shard = Shard(piece.column("text"), tests)
            words, pairs = shard.hits(tests)
            row = shard.rows[words]
            cuts = np.searchsorted(row, np.arange(1, piece.num_rows))
            inner = np.split(words - shard.at[row], cuts)
            named = np.split(pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(1, piece.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("text_hash"),
                    pa.array(shard.n_words, pa.int64()),
                    pa.array(inner, pa.list_(pa.int64())),
                    pa.array([[tests.names[i] for i in x if tests.names[i] is not None] for x in named], pa.list_(pa.string())),
                ],
                names=["doc_id", "text_hash", "n_words", "hit", "items"],
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(find, HITS)


def hits(docs, items, window=WINDOW, block_words=BLOCK_WORDS):
    """doc_id, n_words, hit (numbers of the hit words), items (item ids as strings, sorted) of each document."""
    found = [block_hits(docs, Tests(block, window)) for block in item_blocks(items, block_words)]
    if len(found) == 1:
        merged = found[0].withColumn("copies", F.lit(1))
    else:
        merged = reduce(lambda a, b: a.unionAll(b), found).groupBy("doc_id", "text_hash", "n_words").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit")))).alias("hit"),
            F.flatten(F.collect_list("items")).alias("items"),
            (F.count(F.lit(1)) / len(found)).cast("int").alias("copies"),
        )
    merged = merged.withColumn("items", F.array_sort(F.array_distinct("items")))
    once = merged.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return once.select("doc_id", "n_words", "hit", "items")


def matches(docs, items, least=WINDOW, block_words=BLOCK_WORDS):
    """``MATCHES``: the longest verbatim matches of test suffixes of ``least`` words or more (or of a whole shorter item).

    start and item_start count words from 0.
    """

    def of_block(block):
        tests = Tests(block, least)

        def find(batches):
            for piece in arrays.pieces(batches, limit=SHARD_BYTES):
                row, start, length, item, item_start = Shard(piece.column("text"), tests).matches(tests, least)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").take(pa.array(row)),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array([tests.names[i] for i in item], pa.string()),
                        pa.array(item_start, pa.int64()),
                    ],
                    names=["doc_id", "start", "length", "item_id", "item_start"],
                )

        return docs.select("doc_id", "text").mapInArrow(find, MATCHES)

    return reduce(lambda a, b: a.unionAll(b), [of_block(block) for block in item_blocks(items, block_words)])


def contamination(docs, items, window=WINDOW, block_words=BLOCK_WORDS):
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document."""
    n_hit = F.size("hit").cast("bigint")
    return hits(docs, items, window, block_words).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs, items, window=WINDOW, block_words=BLOCK_WORDS):
    """The documents without a hit, with all columns; a block of tests is a filter over those that the last one left."""
    for block in item_blocks(items, block_words):
        tests = Tests(block, window)

        def clean(batches, tests=tests):
            for piece in arrays.pieces(batches, limit=SHARD_BYTES):
                shard = Shard(piece.column("text"), tests)
                keep = np.ones(piece.num_rows, dtype=bool)
                keep[shard.rows[shard.hits(tests)[0]]] = False
                yield piece.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
