"""The best documents of each query item by an integer BM25-like score, as products of dense tiles.

Terms are runs of the bytes 0-9, A-Z, a-z (A-Z count as a-z) and of all bytes of characters beyond ASCII. With N documents
that have a term, L terms in all, n terms in a document, df documents that hold a term and tf its occurrences in one:

* weight of a term: w = floor(1000 ln((2N + 2) / (2df + 1)))
* length of a document: m = 10 + 90 n N div L
* impact of a term in a document: (10^9 tf) div (1000 tf + 8m), less than 10^6
* score: the sum of w times impact over the item's different terms

1. A block of items (``BLOCK_BYTES`` of different terms) is sent to the tasks. One pass over the whole texts leaves n and the
   (term number, tf) of the block's terms for each document, in a table; N, L and df are sums over it.
2. Items lie in tiles of ``ITEMS``, each with the compact vocabulary of its own items: a matrix of weights, items by terms.
   ``DOCUMENTS`` documents at a time give a matrix of impacts, terms by documents. Both are float64 and are multiplied by
   BLAS in strips of terms so narrow that w times 10^6 times the strip's terms stays below 2^53: each partial sum is a whole
   number and exact. Strips are added up as 64-bit integers.
3. A task keeps the ``k`` best of each item. A tile's documents come in with its k-th best score or more, so no tie is lost
   before doc_id decides. The tasks' best are ranked in two steps, by item and salt first.

A null or empty text has no terms and is never found; equal scores go by ascending doc_id (null last); repeated rows are
ranked one by one; items with null text have no documents, those with a null item_id are ranked too, and each row of a
repeated item_id by itself; an empty table gives an empty one; other columns are ignored.
"""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import discard, shared_dir, write_table
from . import arrays

TOP = 10
BLOCK_BYTES = 4 << 20  # bytes of terms of the items that a task holds at once
ITEMS = 256
STRIP = 4096  # terms of a strip at most
DOCUMENTS = 512
EXACT = 1 << 53  # whole numbers below it are exact in float64
MOST_IMPACT = 10**6
SALTS = 64
LOWER = bytes(range(256)).lower()
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
IMPACTS = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"


def terms_of(text):
    return TERM.findall((text or "").encode("utf-8").translate(LOWER))


def item_blocks(items, block_bytes=BLOCK_BYTES):
    """Items in blocks of at most ``block_bytes`` of different terms (one item at least): lists of (item_id, terms)."""

    def tokenize(batches):
        for piece in arrays.pieces(batches):
            found = [sorted(set(terms_of(x.as_py()))) for x in piece.column("text")]
            yield pa.RecordBatch.from_arrays([piece.column("item_id"), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])

    rows = items.select("item_id", "text")
    schema = rows.select("item_id", F.array(F.lit("").cast("binary")).alias("terms")).schema
    block, held = [], 0
    for row in rows.mapInArrow(tokenize, schema).filter(F.size("terms") > 0).toLocalIterator():
        size = sum(map(len, row.terms))
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((row.item_id, [bytes(x) for x in row.terms]))
        held += size
    if block:
        yield block


def impacts(docs, numbers):
    """``IMPACTS``: n of each document and the occurrences of the terms that ``numbers`` (a broadcast dict) numbers."""

    def count(batches):
        number = numbers.value.get
        for piece in arrays.pieces(batches):
            lengths, terms, tfs = [], [], []
            for text in piece.column("text"):
                found = terms_of(text.as_py())
                counts = Counter(map(number, found))
                counts.pop(None, None)
                lengths.append(len(found))
                terms.append(list(counts.keys()))
                tfs.append(list(counts.values()))
            columns = [pa.array(lengths, pa.int64())] + [pa.array(x, pa.list_(pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns], names=["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(count, IMPACTS)


class Tile:
    """The weights of some items: items by the terms that any of them has."""

    def __init__(self, items, weights, first):
        self.first = first  # number of the first item in its block
        self.terms = np.unique(np.concatenate([np.asarray(x, dtype=np.int64) for x in items]))
        self.weights = np.zeros((len(items), len(self.terms)))
        for i, own in enumerate(items):
            self.weights[i, np.searchsorted(self.terms, own)] = weights[own]
        most = int(self.weights.max()) if self.weights.size else 0
        self.strip = max(1, min(STRIP, (EXACT - 1) // (max(most, 1) * MOST_IMPACT)))

    def scores(self, rows, terms, impact, n_rows):
        """An int64 matrix of scores, items by documents; rows, terms, impact: a tile of documents in long form."""
        place = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        own = self.terms[place] == terms
        rows, place, impact = rows[own], place[own], impact[own]
        out = np.zeros((len(self.weights), n_rows), dtype=np.int64)
        for start in range(0, len(self.terms), self.strip):
            stop = min(start + self.strip, len(self.terms))
            part = (place >= start) & (place < stop)
            dense = np.zeros((stop - start, n_rows))
            dense[place[part] - start, rows[part]] = impact[part]
            out += (self.weights[:, start:stop] @ dense).astype(np.int64)
        return out


class Best:
    """The k best (score, document) of each item so far; ties go by document, one without an id last."""

    def __init__(self, n_items, k):
        self.k, self.least = k, np.zeros(n_items, dtype=np.int64)
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.no_id = np.zeros(0, bool)

    def add(self, scores, docs, no_id):
        floor = self.least
        if scores.shape[1] > self.k:
            floor = np.maximum(floor, np.partition(scores, -self.k, axis=1)[:, -self.k])
        item, column = np.nonzero(scores >= np.maximum(floor, 1)[:, None])
        item, doc = np.concatenate([self.item, item]), np.concatenate([self.doc, docs[column]])
        score = np.concatenate([self.score, scores[item[len(self.item) :], column]])
        none = np.concatenate([self.no_id, no_id[column]])
        order = np.lexsort((doc, none, -score, item))
        item = item[order]
        first = np.searchsorted(item, item)
        kept = np.arange(len(item)) - first < self.k
        self.item, order = item[kept], order[kept]
        self.score, self.doc, self.no_id = score[order], doc[order], none[order]
        full = np.arange(len(item))[kept] - first[kept] == self.k - 1
        self.least[self.item[full]] = self.score[full]


def tile_tops(table, tiles, n_docs, n_terms, n_items, k):
    """(item, doc_id, score): the k best documents of each item in each task."""

    def rank(batches):
        parts = tiles.value
        best = [Best(len(tile.weights), k) for tile in parts]
        for batch in batches:
            for start in range(0, batch.num_rows, DOCUMENTS):
                docs = batch.slice(start, DOCUMENTS)
                lists = [docs.column(name) for name in ("terms", "tfs")]
                rows = np.repeat(np.arange(docs.num_rows), lists[0].value_lengths().to_numpy(zero_copy_only=False))
                terms, tfs = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
                m = np.array([10 + 90 * n * n_docs // n_terms for n in docs.column("n").to_pylist()], dtype=np.int64)
                impact = 10**9 * tfs // (1000 * tfs + 8 * m[rows])
                ids = docs.column("doc_id")
                no_id, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
                for tile, top in zip(parts, best):
                    top.add(tile.scores(rows, terms, impact, docs.num_rows), ids, no_id)
        for tile, top in zip(parts, best):
            columns = [pa.array((top.item + tile.first).astype(np.int32)), pa.array(top.doc, mask=top.no_id), pa.array(top.score)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return table.filter(F.size("terms") > 0).select("doc_id", "n", "terms", "tfs").mapInArrow(rank, "item int, doc_id bigint, score bigint")


def top_rows(rows, keys, order, k):
    """``rows`` with their ``rank`` from 1 to k among those of the same keys; the keys are salted first."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, "salt").orderBy(*order)))
    last = first.filter(F.col("rank") <= k).drop("salt", "rank")
    return last.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def rank_block(docs, block, item_field, k, path):
    """Append the ranked documents of a block of items to the table at ``path``."""
    spark = docs.sparkSession
    vocabulary = sorted({term for _, terms in block for term in terms})
    number = {term: i for i, term in enumerate(vocabulary)}
    numbers = spark.sparkContext.broadcast(number)
    work = shared_dir(spark, "impacts")
    table = write_table(impacts(docs, numbers), work)
    total = table.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    counts = table.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(vocabulary))
    for row in counts.collect():  # at most one row for each term of the block
        weights[row.term] = math.floor(1000 * math.log((2 * total.docs + 2) / (2 * row.df + 1)))
    own = [[number[term] for term in terms] for _, terms in block]
    tiles = spark.sparkContext.broadcast([Tile(own[i : i + ITEMS], weights, i) for i in range(0, len(own), ITEMS)])
    tops = tile_tops(table, tiles, total.docs, total.terms or 1, len(block), k)
    ranked = top_rows(tops, ["item"], [F.desc("score"), F.col("doc_id").asc_nulls_last()], k)
    named = StructType([StructField("item", IntegerType()), item_field])
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], named)
    ranked.join(names, "item").select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(path)
    discard(spark, work)
    numbers.destroy()
    tiles.destroy()


def best_documents(docs, items, k=TOP, block_bytes=BLOCK_BYTES):
    """item_id, rank, doc_id, score of the k best documents of each item with a score above 0."""
    spark, path = docs.sparkSession, shared_dir(docs.sparkSession, "ranked")
    item_field = items.select("item_id").schema[0]
    schema = StructType([item_field, StructField("rank", IntegerType()), StructField("doc_id", LongType()), StructField("score", LongType())])
    spark.createDataFrame([], schema).write.parquet(path)
    for block in item_blocks(items, block_bytes):
        rank_block(docs, block, item_field, k, path)
    return spark.read.schema(schema).parquet(path)
