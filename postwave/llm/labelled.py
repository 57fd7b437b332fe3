"""Bounded, repeat-free samples of labelled documents to fit classifiers on, and the split into learned and held-out rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import materialize
from . import arrays

SHINGLE = 5


def remainder(doc_id, modulus):
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def least_shingle(column, n=SHINGLE):
    """The least hash of a run of n words of each text; of its words if it has fewer; 0 without words."""
    words, at = arrays.word_hashes(column)
    out = np.zeros(len(at) - 1, dtype=np.uint64)
    for size in (1, n):
        keys, rows = arrays.grams(words, at, size)
        found, first = np.unique(rows, return_index=True)
        if len(found):
            out[found] = np.minimum.reduceat(keys, first)
    return out


def sample(docs, labels, label, rows, modulus, held_out):
    """(doc_id, label, part) of at most ``rows`` labelled documents whose remainder is not ``held_out``.

    Rows are taken by a hash of the id, so a sample is the same in each run; conflicting labels of an id count as the
    greater; rows without an id or a label are left out. Of documents with the same least shingle, as copies have, only the
    first stays: a text that was copied a thousand times must not count a thousand times. ``part`` is 0 to 9, by a hash.
    The result is a written table; its bound makes it fit for a broadcast.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), modulus) != held_out))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def sign(batches):
        for piece in arrays.pieces(batches):
            marks = pa.array(least_shingle(piece.column("text")).view(np.int64))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("label"), marks], names=["doc_id", "label", "mark"])

    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    marked = texts.mapInArrow(sign, "doc_id bigint, label int, mark bigint")
    first = marked.groupBy("mark").agg(F.min(F.struct("doc_id", "label")).alias("row")).select("row.*")
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("part")), F.lit(10)).cast("int").alias("part")
    return materialize(first.groupBy("doc_id").agg(F.max("label").alias("label")).select("*", part), "sample")
