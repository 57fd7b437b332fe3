"""Texts of Arrow batches as NumPy byte arrays: words, lines and hashes without a Python object per word.

A word is a run of the bytes 0-9, a-z (A-Z count as a-z) and of all bytes of characters beyond ASCII, which is the same
as the pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` over a text whose A-Z are lower-cased. Hashes have 64 bits; a
null text counts as an empty one.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20  # bytes of text that are worked on at once
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, dtype=bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x):
    """The splitmix64 finalizer; spreads every input bit over the result."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


WORD_BYTES = 8
SPANS = 1 << 16  # spans that are hashed or compared at once


def utf8(column):
    """(bytes, row offsets) of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches, column="text", limit=PIECE):
    """The batches again, cut into runs of rows with about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // limit, prepend=0)) if len(sizes) else []
        edges = [0, *cuts, batch.num_rows]
        for i, j in zip(edges, edges[1:]):
            if j > i:
                yield batch.slice(i, j - i)


def runs(inside, offsets):
    """(starts, ends) of the runs of true positions; no run crosses a row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(len(inside) + 1, dtype=bool)
    first[offsets[(offsets <= len(inside))]] = True
    before, after = np.roll(inside, 1), np.roll(inside, -1)
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    last = first[1:].copy()
    last[-1] = True
    ends = np.flatnonzero(inside & (~after | last)) + 1
    return starts, ends


def padded(data):
    """The bytes as a view of 8-byte words, one starting at each byte."""
    whole = np.concatenate([data, np.zeros(WORD_BYTES, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", whole.data, strides=(1,))


def word_places(sizes):
    """(span, number in the span, bytes) of the 8-byte words that cover spans of these sizes."""
    count = -(-sizes // WORD_BYTES)
    span = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(span)) - np.repeat(np.cumsum(count) - count, count)
    return span, number, np.minimum(sizes[span] - number * WORD_BYTES, WORD_BYTES)


def words_at(view, places, sizes):
    """The words at these places, the bytes beyond their size as zeros."""
    return view[places] & (np.uint64(2**64 - 1) >> (np.uint64(64) - (sizes.astype(np.uint64) << np.uint64(3))))


def hashes(data, starts, ends, seed=0):
    """A 64-bit hash of each span of bytes: its 8-byte words are mixed, each with its number, and added up.

    No sum of bytes times powers is in it, so regular texts do not collide; another ``seed`` gives another hash.
    """
    out, view, key = np.empty(len(starts), dtype=np.uint64), padded(data), mix(np.array([seed], dtype=np.uint64) + BASE)
    for i in range(0, len(starts), SPANS):
        first, sizes = starts[i : i + SPANS], (ends - starts)[i : i + SPANS]
        span, number, size = word_places(sizes)
        word = words_at(view, first[span] + number * WORD_BYTES, size)
        mixed = mix(word ^ mix(number.astype(np.uint64) * BASE + key)) if len(span) else word
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        upto = np.cumsum(-(-sizes // WORD_BYTES))
        out[i : i + SPANS] = sums[upto] - sums[upto - -(-sizes // WORD_BYTES)] + sizes.astype(np.uint64) * key
    return mix(out)


def same_bytes(data, starts, other, other_starts, sizes):
    """Which spans of ``data`` have the same bytes as spans of ``other`` of the same size."""
    out, view, other_view = np.ones(len(starts), dtype=bool), padded(data), padded(other)
    for i in range(0, len(starts), SPANS):
        part = slice(i, i + SPANS)
        span, number, size = word_places(sizes[part])
        at = number * WORD_BYTES
        unlike = words_at(view, starts[part][span] + at, size) != words_at(other_view, other_starts[part][span] + at, size)
        out[i + span[unlike]] = False
    return out


def words(data, offsets):
    """(starts, ends, offsets of each row's words) of the words."""
    starts, ends = runs(WORD[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


def word_hashes(column):
    """(hash of each word, offsets of each row's words)."""
    data, offsets = utf8(column)
    starts, ends, at = words(data, offsets)
    return hashes(LOWER[data], starts, ends), at


def rows_of(offsets):
    """The row of each item, from the offsets of each row's items."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def grams(words, at, n):
    """(hash, row) of the runs of n words; none crosses a row."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = rows_of(at)
    whole = rows[:count] == rows[n - 1 :]
    out = words[:count].copy()
    for k in range(1, n):
        out = out * BASE + words[k : k + count]
    return mix(out[whole] + np.uint64(n)), rows[:count][whole]


def planes(values):
    """Numbers as bytes, all first bytes first: the many zero bytes of small numbers compress away."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data, dtype):
    """Inverse of ``planes``."""
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)
