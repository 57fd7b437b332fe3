"""Repeated runs of lines, removed from all places but the first.

``passage_summary`` and ``clean_passages`` find every repeated run. Its units are single lines of ten words or 60 bytes and,
where one of them is shorter, pairs of lines that are not empty, with the empty lines between them. A unit that has an
earlier place with the same bytes (least doc_id, null last, then place in the text) loses its lines; empty lines between two
lines that go, go too. A run of two lines or more is covered by its units, so its context doesn't matter. A line goes only
where it has an earlier place, so the first place of each line stays. Units are compared by two 64-bit hashes and then, those
that occur more than once, byte by byte.

``summary`` and ``clean`` are the coarser form, which moves less: runs are found as content-defined chunks, so a short
passage whose borders lie within chunks of its context stays. A chunk ends after a line where a rolling hash over that line's and the line before's hash is 0 modulo 3, so its borders
depend on the text near them only: what stands before a passage does not shift the chunks within it. Chunks of two lines or
more are taken into account. Those with the same two 64-bit hashes are compared byte by byte, as the text of a chunk is a
grouping key; if they differ nowhere, the first (least doc_id, null last, then place in the text) stays and the others go.

A batch sends a repeated chunk's text once with its count, so a chunk of every document is one row a batch; places travel
without text. Null and empty texts have one empty line and lose nothing; of repeated rows (same doc_id and text) the
copies lose their multi-line chunks, all but one row at least keeps them; an empty table gives an empty one; other columns
are kept by ``clean``.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import materialize
from . import arrays

WINDOW = 2
MODULUS = 3
LEAST_LINES = 2
TEXTS = "chunk_hash bigint, chunk_check bigint, chunk_text binary, n bigint"
PLACES = "doc_id bigint, text_hash bigint, chunk int, chunk_hash bigint, chunk_check bigint"
NEWLINE = 10
LEAST_WORDS = 10  # of a line that counts by itself
LEAST_BYTES = 60  # the same for scripts that do not part words
UNITS = "doc_id bigint, text_hash bigint, first int, last int, unit_hash bigint, unit_check bigint"
UNIT_TEXTS = "unit_hash bigint, unit_check bigint, unit_text binary"


def lines(data, offsets):
    """(starts, ends, offsets of each row's lines) of the lines; a line ends after its line end."""
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:] = data == NEWLINE
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


def without_ends(data, starts, ends):
    """Where the lines end without their line end, so the last line of a text is like the same line elsewhere."""
    return ends - ((ends > starts) & (data[np.maximum(ends, 1) - 1] == NEWLINE)) if len(starts) else ends


def chunks(data, offsets, window=WINDOW, modulus=MODULUS):
    """(first line, lines, row, start, end) of each chunk of lines."""
    starts, ends, at = lines(data, offsets)
    rows = arrays.rows_of(at)
    plain = without_ends(data, starts, ends)
    keys = arrays.hashes(data, starts, plain)
    rolled = np.zeros(len(keys), dtype=np.uint64)
    for back in range(window):
        reached = np.flatnonzero(np.arange(len(keys)) - back >= at[rows])
        rolled[reached] = rolled[reached] * arrays.BASE + keys[reached - back]
    last = arrays.mix(rolled) % np.uint64(modulus) == 0
    last[at[1:][at[1:] > at[:-1]] - 1] = True
    final = np.flatnonzero(last)
    first = np.concatenate([[0], final[:-1] + 1]) if len(final) else final
    return first, final - first + 1, rows[first], starts[first], plain[final], at


def multi_line(column, least=LEAST_LINES):
    """(row, chunk number in the row, start, end, hash, check) of the chunks with ``least`` lines or more, and the bytes."""
    data, offsets = arrays.utf8(column)
    first, size, row, start, end, _ = chunks(data, offsets)
    number = np.arange(len(first)) - np.searchsorted(row, row)
    wide = size >= least
    start, end = start[wide], end[wide]
    check = arrays.hashes(data, start, end, 1)
    return data, row[wide], number[wide], start, end, arrays.hashes(data, start, end), check


def chunk_texts(docs):
    """``TEXTS``: the text of each multi-line chunk, once a batch, and how often the batch has it."""

    def find(batches):
        for piece in arrays.pieces(batches):
            data, _, _, start, end, keys, check = multi_line(piece.column("text"))
            _, first, inverse, n = np.unique(arrays.mix(keys) ^ check, return_index=True, return_inverse=True, return_counts=True)
            raw = data.tobytes()
            texts = [raw[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())]
            # Chunks that share both hashes but not their bytes go out by themselves.
            odd = [i for i, k in enumerate(inverse.tolist()) if i != first[k] and raw[start[i] : end[i]] != texts[k]]
            n -= np.bincount(inverse[odd], minlength=len(n)).astype(n.dtype) if odd else 0
            texts += [raw[start[i] : end[i]] for i in odd]
            where = np.append(first, odd).astype(np.int64)
            columns = [keys[where].view(np.int64), check[where].view(np.int64)]
            columns = [pa.array(x) for x in columns] + [pa.array(texts, pa.binary()), pa.array(np.append(n, [1] * len(odd)).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk_hash", "chunk_check", "chunk_text", "n"])

    return docs.select("text").mapInArrow(find, TEXTS)


def chunk_places(docs):
    """``PLACES`` of the multi-line chunks."""

    def find(batches):
        for piece in arrays.pieces(batches):
            _, row, number, _, _, keys, check = multi_line(piece.column("text"))
            own = [piece.column(x).take(pa.array(row)) for x in ("doc_id", "text_hash")]
            found = [pa.array(number, pa.int32()), pa.array(keys.view(np.int64)), pa.array(check.view(np.int64))]
            yield pa.RecordBatch.from_arrays([*own, *found], names=["doc_id", "text_hash", "chunk", "chunk_hash", "chunk_check"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(find, PLACES)


def repeated(docs):
    """(chunk_hash, chunk_check) of the chunks that occur more than once and are the same in every byte."""
    key = ["chunk_hash", "chunk_check"]
    same = chunk_texts(docs).groupBy(*key, "chunk_text").agg(F.sum("n").alias("n"))
    return same.groupBy(*key).agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n")).filter("texts = 1 and n > 1").select(*key)


def removals(docs):
    """(doc_id, text_hash, gone): the numbers of the chunks that a document loses."""
    key = ["chunk_hash", "chunk_check"]
    places = materialize(chunk_places(docs).join(repeated(docs), key), "places")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "chunk")
    first = places.groupBy(*key).agg(F.min(order).alias("first"))
    rest = places.join(first, key).filter(order != F.col("first"))
    return rest.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("chunk")).alias("gone"))


def cut(text, gone):
    """(text without the chunks, chunks removed, lines removed); what is left keeps its line ends."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    offsets = np.array([0, len(data)], dtype=np.int64)
    first, size, _, start, _, _ = chunks(data, offsets)
    stop = np.append(start[1:], len(data))
    kept = np.ones(len(first), dtype=bool)
    kept[gone] = False
    raw = data.tobytes()
    left = b"".join([raw[s:e] for s, e in zip(start[kept].tolist(), stop[kept].tolist())])
    if not kept[-1]:
        left = left.removesuffix(b"\n")
    return left.decode("utf-8"), len(gone), int(size[~kept].sum())


def shortened(docs, gone, cut):
    """(document, chunks_removed, lines_removed): the documents after ``cut(text, gone)`` where they have a row in ``gone``."""
    # The removals grow with the documents, so they are never broadcast.
    gone = gone.hint("merge").select(F.struct("doc_id", "text_hash").alias("lost_key"), "gone")
    own = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash"))
    document = F.struct(*[docs[c] for c in docs.columns])
    rows = docs.select(document.alias("document"), own.alias("own_key"))
    rows = rows.join(gone, F.col("own_key").eqNullSafe(F.col("lost_key")), "left").select("document", "gone")
    schema = rows.select("document", F.lit(0).alias("chunks_removed"), F.lit(0).alias("lines_removed")).schema
    at = docs.columns.index("text")

    def shorten(batches):
        for batch in batches:
            whole, lost = batch.column("document"), batch.column("gone").to_pylist()
            texts = [x for x in whole.field(at).to_pylist()]
            removed, n_lines = [0] * len(texts), [0] * len(texts)
            for i, own in enumerate(lost):
                if own:
                    texts[i], removed[i], n_lines[i] = cut(texts[i], own)
            fields = [pa.array(texts, pa.string()) if k == at else whole.field(k) for k in range(len(whole.type))]
            names = [whole.type.field(k).name for k in range(len(whole.type))]
            columns = [pa.StructArray.from_arrays(fields, names), pa.array(removed, pa.int32()), pa.array(n_lines, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["document", "chunks_removed", "lines_removed"])

    return rows.mapInArrow(shorten, schema)


def described(cleaned):
    text = F.coalesce("document.text", F.lit("")).cast("binary")
    return cleaned.select("document.doc_id", "chunks_removed", "lines_removed", F.sha2(text, 256).alias("text_sha256"))


def clean(docs):
    """The documents with all columns, their text without repeated chunks, as (document, chunks_removed, lines_removed)."""
    return shortened(docs, removals(docs), cut)


def summary(docs):
    """doc_id, chunks_removed, lines_removed, text_sha256 (of the text that is left) of each document."""
    return described(clean(docs))


def units(column):
    """(row, first line, last line, hash, check) of the units of each text."""
    data, offsets = arrays.utf8(column)
    starts, ends, at = lines(data, offsets)
    plain = without_ends(data, starts, ends)
    full = np.flatnonzero(plain > starts)
    row, starts, plain = arrays.rows_of(at)[full], starts[full], plain[full]
    number = full - at[row]
    word = arrays.words(data, offsets)[0]
    n_words = np.searchsorted(word, plain) - np.searchsorted(word, starts)
    long = (n_words >= LEAST_WORDS) | (plain - starts >= LEAST_BYTES)
    alone = np.flatnonzero(long)
    # Two long lines are found one by one.
    a = np.flatnonzero((row[1:] == row[:-1]) & ~(long[1:] & long[:-1]))
    apart = (number[a + 1] - number[a]).astype(np.uint64)

    def keys(seed):
        line = arrays.hashes(data, starts, plain, seed)
        return np.concatenate([arrays.mix(arrays.mix(line[a] + apart) * arrays.BASE + line[a + 1]), line[alone]])

    where, last = np.concatenate([a, alone]), np.concatenate([a + 1, alone])
    return row[where], number[where], number[last], keys(0), keys(1)


def unit_places(docs):
    """``UNITS`` of the documents."""

    def find(batches):
        for piece in arrays.pieces(batches):
            row, first, last, key, check = units(piece.column("text"))
            own = [piece.column(x).take(pa.array(row)) for x in ("doc_id", "text_hash")]
            found = [pa.array(x, pa.int32()) for x in (first, last)] + [pa.array(x.view(np.int64)) for x in (key, check)]
            yield pa.RecordBatch.from_arrays([*own, *found], names=["doc_id", "text_hash", "first", "last", "unit_hash", "unit_check"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(find, UNITS)


def unlike(docs, found):
    """(unit_hash, unit_check) of the repeated units whose bytes differ somewhere. A batch sends a text once."""
    listed = found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "last", "unit_hash", "unit_check")).alias("units"))
    listed = listed.hint("merge").select(F.struct("doc_id", "text_hash").alias("listed_key"), "units")
    own = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash"))
    rows = docs.select("text", own.alias("own_key")).join(listed, F.col("own_key").eqNullSafe(F.col("listed_key"))).select("text", "units")

    def read(batches):
        for piece in arrays.pieces(batches):
            data, offsets = arrays.utf8(piece.column("text"))
            starts, ends, at = lines(data, offsets)
            plain, raw, wanted = without_ends(data, starts, ends), data.tobytes(), piece.column("units")
            sizes = wanted.value_lengths().to_numpy(zero_copy_only=False)
            first, last, key, check = (wanted.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(4))
            line = np.repeat(at[:-1], sizes)
            spans = zip(key.tolist(), check.tolist(), starts[line + first].tolist(), plain[line + last].tolist())
            texts = list({(k, c, raw[s:e]) for k, c, s, e in spans})
            columns = [pa.array([t[i] for t in texts], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["unit_hash", "unit_check", "unit_text"])

    same = rows.mapInArrow(read, UNIT_TEXTS).distinct()
    return same.groupBy("unit_hash", "unit_check").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").drop("texts")


def passage_removals(docs):
    """(doc_id, text_hash, gone): the (first, last) lines of the units that a document loses."""
    key = ["unit_hash", "unit_check"]
    places = unit_places(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "first")
    seen = places.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("earliest")).filter("n > 1")
    found = places.join(seen, key).select(*places.columns, (order != F.col("earliest")).alias("later"))
    found = materialize(found, "units")
    later = found.filter("later").join(unlike(docs, found), key, "left_anti")
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "last")).alias("gone"))


def cut_lines(text, gone):
    """(text without the lines of the units, runs removed, lines removed); what is left keeps its line ends."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    starts, ends, _ = lines(data, np.array([0, len(data)], dtype=np.int64))
    kept = np.ones(len(starts), dtype=bool)
    for unit in gone:
        kept[unit["first"] : unit["last"] + 1] = False
    full = np.flatnonzero(without_ends(data, starts, ends) > starts)
    both = np.flatnonzero(~kept[full[1:]] & ~kept[full[:-1]])
    for i, j in zip(full[both].tolist(), full[both + 1].tolist()):
        kept[i:j] = False
    raw = data.tobytes()
    left = b"".join([raw[s:e] for s, e in zip(starts[kept].tolist(), ends[kept].tolist())])
    if not kept[-1]:
        left = left.removesuffix(b"\n")
    runs = np.count_nonzero(~kept[1:] & kept[:-1]) + int(not kept[0])
    return left.decode("utf-8"), runs, int((~kept).sum())


def clean_passages(docs):
    """The documents with all columns, their text without repeated units, as (document, chunks_removed, lines_removed)."""
    return shortened(docs, passage_removals(docs), cut_lines)


def passage_summary(docs):
    """doc_id, chunks_removed (runs of lines), lines_removed, text_sha256 (of the text that is left) of each document."""
    return described(clean_passages(docs))
