"""Counts of n-grams over a whole corpus, brought back to where the texts are.

Texts lie in slices of bounded size. A slice counts its own n-grams first and sends one entry for each different one, so
even an n-gram of every text is one entry a slice. Entries are dealt out by ranges of the hash (buckets), summed there, and
the totals go back to the slice in the order of its entries, so they need no hashes. Texts and entries travel compressed,
entries as sorted runs of bytes and not as one row each.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from . import arrays

SLICE_BYTES = 4 << 20
BUCKET_ENTRIES = 2 << 20
BYTES_PER_WORD = 6
ALL = np.uint64(0x5851F42D4C957F2D)  # the entry that counts everything in a slice

ENTRIES = "bucket int, slice int, size int, hashes binary, counts binary"
TOTALS = "bucket int, slice int, size int, totals binary"


def sizes(texts, orders):
    """(number of slices, bits of a bucket's number) for a table of texts."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    entries = max(1, size * orders // BYTES_PER_WORD)
    return max(1, -(-size // SLICE_BYTES)), max(1, (entries // BUCKET_ENTRIES).bit_length())


def codec():
    return pa.Codec("zstd", 3)


def pack(batch):
    """The batch with its column ``text`` (null: empty) compressed as ``packed``, and its bytes as ``bytes``."""
    texts = [x.encode("utf-8") if x else b"" for x in batch.column("text").to_pylist()]
    zstd = codec()
    columns = {name: batch.column(name) for name in batch.schema.names if name != "text"}
    columns["packed"] = pa.array([zstd.compress(x, asbytes=True) for x in texts], pa.binary())
    columns["bytes"] = pa.array([len(x) for x in texts], pa.int64())
    return pa.RecordBatch.from_pydict(columns)


def unpack(table):
    """The column of texts of a table with the columns of ``pack``."""
    zstd, sizes = codec(), table.column("bytes").to_pylist()
    texts = [zstd.decompress(x, n, asbytes=True) for x, n in zip(table.column("packed").to_pylist(), sizes)]
    return pa.array(texts, pa.binary()).cast(pa.large_string())


def shut(values):
    return codec().compress(arrays.planes(values), asbytes=True)


def opened(column, sizes, dtype):
    """The arrays of a column that ``shut`` made."""
    zstd, width = codec(), np.dtype(dtype).itemsize
    return [arrays.from_planes(zstd.decompress(x, n * width, asbytes=True), dtype) for x, n in zip(column.to_pylist(), sizes)]


def entry_rows(number, hashes, counts, bits):
    """The entries of a slice, sorted by hash, as one row for each bucket."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    found, first = np.unique(bucket, return_index=True)
    edges = np.append(first, len(hashes))
    cut = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
    return pa.table(
        {
            "bucket": pa.array(found.astype(np.int32)),
            "slice": pa.array(np.full(len(found), number, np.int32)),
            "size": pa.array(np.diff(edges).astype(np.int32)),
            "hashes": pa.array([shut(np.diff(hashes[i:j], prepend=np.uint64(0))) for i, j in cut], pa.binary()),
            "counts": pa.array([shut(counts[i:j].astype(np.int64)) for i, j in cut], pa.binary()),
        }
    )


def corpus_counts(texts, count_slice, bits):
    """``TOTALS`` for each slice: the sums over all slices of its entries, in the order of their hashes.

    ``texts`` is dealt out by its column ``slice``; ``count_slice`` makes (sorted different hashes, counts) of an Arrow
    table of one slice.
    """

    def local(table):
        return entry_rows(table.column("slice")[0].as_py(), *count_slice(table), bits)

    def total(table):
        sizes = table.column("size").to_pylist()
        hashes = np.concatenate([np.cumsum(x, dtype=np.uint64) for x in opened(table.column("hashes"), sizes, np.uint64)])
        counts = np.concatenate(opened(table.column("counts"), sizes, np.int64))
        keys, inverse = np.unique(hashes, return_inverse=True)
        sums = np.bincount(inverse, weights=counts, minlength=len(keys)).astype(np.int64)[inverse]
        parts = np.split(sums, np.cumsum(sizes)[:-1])
        own = [table.column(name) for name in ("bucket", "slice", "size")]
        return pa.table([*own, pa.array([shut(x) for x in parts], pa.binary())], names=["bucket", "slice", "size", "totals"])

    own = texts.groupBy("slice").applyInArrow(local, ENTRIES)
    return own.groupBy("bucket").applyInArrow(total, TOTALS)


def totals_of(table):
    """The totals that came back to a slice, in the order of its entries."""
    table = table.sort_by("bucket")
    return np.concatenate(opened(table.column("totals"), table.column("size").to_pylist(), np.int64))
