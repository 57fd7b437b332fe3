"""Token ids in patched frame-of-reference blocks: written as shards, read back whole or by range.

A shard holds the ids of a run of documents in ascending order of their doc_id (null last, equal ids by text); each
document ends with one end id. Ids are cut into blocks of 128. A block stores the difference of each id to the block's
minimum in as few bits as serve 90 % of them; a larger difference keeps its low bits there, and its high bits go to the
exception list. The table of a format's files has one row a shard:

==============  ============================================================================================
shard           number of the shard: its task above 32 bits, its place there below; they hold ascending ranges of doc_id
doc_ids         the documents' ids, in order (a list; null allowed)
lengths         uint32 little endian: ids of each document, with the end id
n_tokens        ids in the shard
minima          uint32 of each block: its least id
widths          uint8 of each block: bits of a packed difference
starts          uint64 of each block: the byte of ``packed`` at which the block starts (the block index)
packed          the packed differences; a block takes 16 bytes for each bit of its width
n_exceptions    uint8 of each block
positions       uint8: place of each exception in its block
patches         uint32: the high bits of each exception
==============  ============================================================================================

A task writes its shards one after the other and holds one at a time, however many copies of a row its range has. Rows go
through Spark's own Parquet writer, which works on any store, commits whole tasks only and so survives lost
executors. A block can be read alone: ``starts`` finds its bits, running sums of ``n_exceptions`` its exceptions.

Null and empty texts have the end id alone; repeated rows stay; an empty table gives no shard; other columns are ignored.
"""

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import shared_dir
from . import arrays

BLOCK = 128
PERCENTILE = 90
SHARD_BYTES = 2 << 20  # bytes of text after which a shard ends
SHARDS_PER_TASK = 4
SECTION = BLOCK << 11  # ids that are packed at once
TASKS_PER_GROUP = 1000
END_ID = 0
MOST_KNOWN = 500_000  # segments a worker keeps the ids of
MOST_KNOWN_BYTES = 8 << 20  # and their bytes
JOINT_BYTES = 1 << 18  # bytes of segments that are encoded in one text

SHARD_SCHEMA = (
    "shard bigint, doc_ids array<bigint>, lengths binary, n_tokens bigint, minima binary, widths binary, starts binary, "
    "packed binary, n_exceptions binary, positions binary, patches binary"
)
_tokenizers, _known = {}, {}


def pack(values, width):
    """Rows of 128 numbers below 2^width as rows of 4 x width 32-bit words; number j starts at bit j x width."""
    out = np.zeros((2 * width, len(values)), dtype=np.uint64)
    columns = np.ascontiguousarray(values.T).astype(np.uint64)
    for j in range(BLOCK):
        word, shift = divmod(j * width, 64)
        out[word] |= columns[j] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= columns[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T.astype("<u8")).view("<u4")


def unpack(words, width):
    """Inverse of ``pack``."""
    columns = np.ascontiguousarray(words.T).astype(np.uint64)
    out, mask = np.empty((BLOCK, len(words)), dtype=np.uint64), np.uint64((1 << width) - 1)
    for j in range(BLOCK):
        word, shift = divmod(j * width, 32)
        value = columns[word] >> np.uint64(shift)
        if shift + width > 32:
            value = value | (columns[word + 1] << np.uint64(32 - shift))
        out[j] = value & mask
    return np.ascontiguousarray(out.T.astype(np.uint32))


def bits(values):
    """Bits that each number needs."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.uint8)


def encode_blocks(ids):
    """The block columns of ``SHARD_SCHEMA`` for an array of ids; the last block is filled up with its last id.

    Blocks are independent, so a section of them is packed at a time.
    """
    sections = [encode_section(ids[i : i + SECTION]) for i in range(0, len(ids), SECTION)] or [encode_section(ids)]
    sizes = np.cumsum([0] + [len(x["packed"]) for x in sections])
    for part, before in zip(sections, sizes.tolist()):
        part["starts"] = (np.frombuffer(part["starts"], "<u8") + np.uint64(before)).tobytes()
    return {name: b"".join(part[name] for part in sections) for name in sections[0]}


def encode_section(ids):
    blocks = -(-len(ids) // BLOCK)
    grid = np.full(blocks * BLOCK, ids[-1] if len(ids) else 0, dtype=np.uint32)
    grid[: len(ids)] = ids
    grid = grid.reshape(blocks, BLOCK)
    minima = grid.min(axis=1) if blocks else np.zeros(0, np.uint32)
    above = grid - minima[:, None]
    rank = -(-BLOCK * PERCENTILE // 100) - 1
    widths = bits(np.partition(above, rank, axis=1)[:, rank]) if blocks else np.zeros(0, np.uint8)
    starts = np.cumsum(widths.astype(np.uint64) * np.uint64(16)) - widths.astype(np.uint64) * np.uint64(16)
    packed = np.zeros(int(widths.sum()) * 16, dtype=np.uint8)
    low = above & ((np.uint64(1) << widths.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    for width in np.unique(widths[widths > 0]):
        of = np.flatnonzero(widths == width)
        rows = pack(low[of], int(width)).view(np.uint8).reshape(len(of), -1)
        packed[(starts[of].astype(np.int64)[:, None] + np.arange(rows.shape[1])).ravel()] = rows.ravel()
    high = (above.astype(np.uint64) >> widths.astype(np.uint64)[:, None]).astype("<u4")
    block, position = np.nonzero(high)
    return {
        "minima": minima.astype("<u4").tobytes(),
        "widths": widths.tobytes(),
        "starts": starts.astype("<u8").tobytes(),
        "packed": packed.tobytes(),
        "n_exceptions": np.bincount(block, minlength=blocks).astype(np.uint8).tobytes(),
        "positions": position.astype(np.uint8).tobytes(),
        "patches": high[block, position].tobytes(),
    }


def decode_blocks(shard, first=0, last=None):
    """The ids of the blocks first to last (excluded) of a shard, a mapping with the columns of ``SHARD_SCHEMA``."""
    widths = np.frombuffer(shard["widths"], np.uint8)
    last = len(widths) if last is None else last
    counts = np.frombuffer(shard["n_exceptions"], np.uint8).astype(np.int64)
    skipped = int(counts[:first].sum())
    widths, counts = widths[first:last], counts[first:last]
    starts = np.frombuffer(shard["starts"], "<u8")[first:last].astype(np.int64)
    minima = np.frombuffer(shard["minima"], "<u4")[first:last]
    packed = np.frombuffer(shard["packed"], np.uint8)
    out = np.zeros((len(widths), BLOCK), dtype=np.uint32)
    for width in np.unique(widths[widths > 0]):
        of = np.flatnonzero(widths == width)
        rows = packed[starts[of][:, None] + np.arange(16 * int(width))]
        out[of] = unpack(np.ascontiguousarray(rows).view("<u4"), int(width))
    found = slice(skipped, skipped + int(counts.sum()))
    block = np.repeat(np.arange(len(widths)), counts)
    position = np.frombuffer(shard["positions"], np.uint8)[found]
    patch = np.frombuffer(shard["patches"], "<u4")[found]
    out[block, position] |= (patch.astype(np.uint64) << widths[block].astype(np.uint64)).astype(np.uint32)
    return (out + minima[:, None]).ravel()


def read_range(shard, start, stop):
    """The ids start to stop (excluded) of a shard; only the blocks that hold them are unpacked."""
    stop = min(stop, shard["n_tokens"])
    if start >= stop:
        return np.zeros(0, np.uint32)
    first = start // BLOCK
    return decode_blocks(shard, first, -(-stop // BLOCK))[start - first * BLOCK : stop - first * BLOCK]


def tokenizer(path):
    """The tokenizer of a worker, loaded once; strings of special tokens in a text are ordinary text."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
        _tokenizers[path].encode_special_tokens = True
    return _tokenizers[path]


SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
CLOSED = np.zeros(256, dtype=bool)  # bytes that are no space and end a character which is none
CLOSED[33:127] = True
TWO_BYTES = np.zeros(256, dtype=bool)  # first bytes of two-byte characters from U+00C0, of which none is a space
TWO_BYTES[0xC3:0xE0] = True
SEEDS = 64  # hashes that are tried for segments that share one


def segments(data, offsets):
    """(starts, ends, offsets of each row's segments) of the parts of a text that byte-level BPE encodes alone.

    Its pre-tokenizer always cuts where white space follows another character, so the ids of a text are those of the
    parts between such places, and each different part of a shard is encoded once. Where the character before is not
    surely no white space, nothing is cut; that only makes a part longer.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = np.zeros(len(data) + 1, dtype=bool)
    closed = CLOSED[data]
    closed[1:] |= TWO_BYTES[data[:-1]]
    cut[1:-1] = SPACE[data[1:]] & closed[:-1]
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


def spread(starts, sizes):
    """The places of spans, one after the other."""
    upto = np.cumsum(sizes, dtype=np.int64)
    return np.repeat(starts - (upto - sizes), sizes) + np.arange(int(upto[-1]) if len(upto) else 0)


class Known:
    """Ids and bytes of the segments that a worker has met, by hash.

    When full it keeps those that were met again, or none if they fill half of it; that changes no result.
    """

    def __init__(self, path, most=MOST_KNOWN, most_bytes=MOST_KNOWN_BYTES):
        self.path, self.most, self.most_bytes, self.tokenizer = path, most, most_bytes, tokenizer(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.sizes[number] = len(token)  # byte-level tokens have one character for each byte
        self.clear()

    def clear(self):
        self.keys, self.base, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.text_base, self.text_size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.text, self.text_used = np.zeros(1 << 16, np.uint8), 0
        self.again = np.zeros(0, bool)

    def make_room(self, segments, text_bytes):
        if len(self.keys) + segments > self.most or self.text_used + text_bytes > self.most_bytes:
            self.keep(np.flatnonzero(self.again))

    def keep(self, chosen):
        """Forget all but the chosen segments, in the order of their keys; these are old ones from now on."""
        keys, size, text_size = self.keys[chosen], self.size[chosen], self.text_size[chosen]
        ids, text = self.flat[spread(self.base[chosen], size)], self.text[spread(self.text_base[chosen], text_size)]
        self.clear()
        if len(keys) <= self.most // 2 and len(text) <= self.most_bytes // 2:
            self.add(keys, ids, size, text, text_size)

    def places(self, keys):
        return np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))

    def find(self, keys):
        """(places, which keys are there); those have been met again."""
        place = self.places(keys)
        there = self.keys[place] == keys if len(self.keys) else np.zeros(len(keys), bool)
        self.again[place[there]] = True
        return place, there

    def like(self, place, data, starts, sizes):
        """Which spans have the bytes of the segments at these places."""
        out = self.text_size[place] == sizes
        i = np.flatnonzero(out)
        out[i] = arrays.same_bytes(data, starts[i], self.text[: self.text_used], self.text_base[place[i]], sizes[i])
        return out

    @staticmethod
    def grown(flat, used, more):
        need = used + len(more)
        if need > len(flat):
            flat = np.concatenate([flat, np.zeros(max(need - len(flat), len(flat)), flat.dtype)])
        flat[used:need] = more
        return flat, need

    def add(self, keys, ids, size, text, sizes):
        """Keep segments by key: their ids and their text, each one after the other, and the sizes of both."""
        base, text_base = self.used + np.cumsum(size) - size, self.text_used + np.cumsum(sizes) - sizes
        self.flat, self.used = self.grown(self.flat, self.used, ids)
        self.text, self.text_used = self.grown(self.text, self.text_used, text)
        merged = np.concatenate([self.keys, keys])
        order = np.argsort(merged, kind="stable")
        self.keys = merged[order]
        new_again = np.zeros(len(keys), bool)
        columns = ("base", base), ("size", size), ("text_base", text_base), ("text_size", sizes), ("again", new_again)
        for name, new in columns:
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, new.astype(old.dtype)])[order])

    def learn(self, data, starts, ends, keys):
        """Encode the segments and keep their ids, ``JOINT_BYTES`` of them at a time."""
        upto = np.cumsum(ends - starts)
        cuts = np.flatnonzero(np.diff(upto // JOINT_BYTES, prepend=0))
        for i, j in zip([0, *cuts], [*cuts, len(starts)]):
            if j > i:
                self.learn_part(data, starts[i:j], ends[i:j], keys[i:j])

    def learn_part(self, data, starts, ends, keys):
        """Segments that start with white space and end in no white space are encoded in one text.

        Between them lies such a place at which the pre-tokenizer always cuts; the bytes of the tokens tell where each ends.
        """
        closed = CLOSED[data[ends - 1]] | ((ends - starts > 1) & TWO_BYTES[data[np.maximum(ends, 2) - 2]])
        joint = SPACE[data[starts]] & closed
        order = np.concatenate([np.flatnonzero(joint), np.flatnonzero(~joint)])
        starts, sizes, together = starts[order], (ends - starts)[order], int(joint.sum())
        upto, flat = np.cumsum(sizes), data[spread(starts, sizes)]
        middle = int(sizes[:together].sum())
        ids = np.array(self.encode([flat[:middle].tobytes().decode("utf-8")])[0].ids, dtype=np.uint32)
        count = np.diff(np.searchsorted(np.cumsum(self.sizes[ids]), upto[:together]) + 1, prepend=0)
        edges = [middle, *upto[together:].tolist()]
        parts = [flat[i:j].tobytes().decode("utf-8") for i, j in zip(edges, edges[1:])]
        found = [x.ids for x in self.encode(parts)] if parts else []
        ids = np.concatenate([ids, np.array([i for x in found for i in x], dtype=np.uint32)])
        count = np.concatenate([count, np.array([len(x) for x in found], dtype=np.int64)])
        self.add(keys[order], ids, count, flat, sizes)

    def encode(self, texts):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)


def known_segments(path):
    """The worker's ``Known`` for a tokenizer file; it serves all tasks that the worker runs."""
    if path not in _known:
        _known[path] = Known(path)
    return _known[path]


def encode_texts(column, known):
    """(ids, ids of each row with its end id) of a string column."""
    data, offsets = arrays.utf8(column)
    starts, ends, at = segments(data, offsets)
    sizes, keys = ends - starts, arrays.hashes(data, starts, ends)
    for seed in range(1, SEEDS):
        found, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        known.make_room(len(found), int(sizes[where].sum()))
        place, there = known.find(found)
        if not there.all():
            fresh = np.sort(where[~there])
            known.learn(data, starts[fresh], ends[fresh], keys[fresh])
            place = known.places(found)
        # A hash may be shared, bytes may not: what is not like its entry gets another hash.
        unlike = np.flatnonzero(~known.like(place[inverse], data, starts, sizes))
        if not len(unlike):
            break
        keys[unlike] = arrays.hashes(data, starts[unlike], ends[unlike], seed)
    else:
        raise ValueError("segments share all their hashes")
    base, size = known.base[place], known.size[place]
    count = size[inverse]
    total = np.concatenate([[0], np.cumsum(count)])
    lengths = total[at[1:]] - total[at[:-1]] + 1
    out = np.full(int(lengths.sum()), END_ID, dtype=np.uint32)
    inner = np.arange(int(total[-1])) - np.repeat(total[:-1], count)
    is_end = np.zeros(len(out), dtype=bool)
    is_end[np.cumsum(lengths) - 1] = True
    out[~is_end] = known.flat[np.repeat(base[inverse], count) + inner]
    return out, lengths


def sorted_ranges(docs, shard_bytes=SHARD_BYTES):
    """(doc_id, text) in partitions by ranges of doc_id, sorted, with text for about ``SHARDS_PER_TASK`` shards each."""
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("n")).first()
    tasks = max(1, min(size.n, -(-(size.size or 0) // (SHARDS_PER_TASK * shard_bytes))))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    return docs.repartitionByRange(tasks, *order).sortWithinPartitions(*order, "text")


def shard_row(number, doc_ids, ids, lengths):
    """A batch of one row of ``SHARD_SCHEMA``."""
    ids = np.concatenate(ids)
    row = {
        "shard": number,
        "doc_ids": doc_ids,
        "lengths": np.concatenate(lengths).astype("<u4").tobytes(),
        "n_tokens": len(ids),
    } | encode_blocks(ids)
    kinds = {"shard": pa.int64(), "doc_ids": pa.list_(pa.int64()), "n_tokens": pa.int64()}
    schema = pa.schema([(k, kinds.get(k, pa.binary())) for k in row])
    return pa.RecordBatch.from_pylist([row], schema=schema)


def encode(docs, tokenizer_path, shard_bytes=SHARD_BYTES):
    """Rows of ``SHARD_SCHEMA`` from each partition of sorted documents."""

    def write(batches):
        from pyspark import TaskContext

        known, number = known_segments(tokenizer_path), TaskContext.get().partitionId() << 32
        doc_ids, ids, lengths, held = [], [], [], 0
        for piece in arrays.pieces(batches, limit=min(arrays.PIECE, shard_bytes)):
            found, size = encode_texts(piece.column("text"), known)
            ids.append(found)
            lengths.append(size)
            doc_ids += piece.column("doc_id").to_pylist()
            held += pc.sum(pc.binary_length(piece.column("text"))).as_py() or 0
            if held >= shard_bytes:
                yield shard_row(number, doc_ids, ids, lengths)
                doc_ids, ids, lengths, held, number = [], [], [], 0, number + 1
        if doc_ids:
            yield shard_row(number, doc_ids, ids, lengths)

    return sorted_ranges(docs, shard_bytes).mapInArrow(write, SHARD_SCHEMA)


def write_tokens(docs, tokenizer_path, path, shard_bytes=SHARD_BYTES):
    """Write the shards of ``docs`` below ``path``."""
    encode(docs, tokenizer_path, shard_bytes).write.parquet(path)


def shard_starts(shards):
    """(shard, shard_start): ids before each shard. Sums of groups of tasks first, so no task orders all shards."""
    group = F.floor(F.shiftright("shard", 32) / TASKS_PER_GROUP)
    size = shards.select("shard", "n_tokens", group.alias("shard_group"))
    before = Window.orderBy("shard_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = size.groupBy("shard_group").agg(F.sum("n_tokens").alias("n"))
    groups = groups.select("shard_group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("group_start"))
    within = Window.partitionBy("shard_group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inner = size.withColumn("inner_start", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return inner.join(groups, "shard_group").select("shard", (F.col("group_start") + F.col("inner_start")).alias("shard_start"))


def read_tokens(spark, path):
    """doc_id, start, n_tokens, ids_crc32 of each document, from the written files."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                # A shard at a time: the others of the batch stay in Arrow's buffers.
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                ids = decode_blocks(row)[: row["n_tokens"]].astype("<u4")
                lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(lengths), pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(ends - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["shard", "doc_id", "inner", "n_tokens", "ids_crc32"],
                )

    found = shards.mapInArrow(read, "shard bigint, doc_id bigint, inner bigint, n_tokens bigint, ids_crc32 bigint")
    start = (F.col("shard_start") + F.col("inner")).alias("start")
    return found.join(shard_starts(shards), "shard").select("doc_id", start, "n_tokens", "ids_crc32")


def token_table(docs, tokenizer_path):
    """Encode documents, write the files to the shared folder, and describe each document from the files read back."""
    path = shared_dir(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer_path, path)
    return read_tokens(docs.sparkSession, path)
