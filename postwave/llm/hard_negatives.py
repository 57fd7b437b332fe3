"""Hard negatives of anchors, by threshold joins over inverted indexes of the rows.

Rows without a label, a vector or an id, and rows with a null or non-finite component, take no part. Where vec_id is divisible
by 7 the label first becomes (label + 1) % 10; a component x becomes floor(256 x). A score is the integer inner product with
an anchor, a row whose vec_id is divisible by 50. An anchor's positives are its first 5 other rows of the same label (higher
scores first, ties by smaller vec_id), and its negatives for a positive of score p the first 3 rows of other labels with a
score between p / 2 and 95 p / 100.

Anchors come in blocks (``ANCHORS``), each against all rows, which stay where they are read. A block asks for *windows*: the
first k rows of the same label, or of other labels with a score in a range. A round joins the rows with the block by
thresholds, one for each anchor, in the manner of L2AP:

* A task takes ``CHUNK`` rows at a time and indexes them by dimension, in the order of their energy over the block's anchors.
  Of each row it leaves out the first dimensions whose norm times that of any anchor stays below its threshold.
* The scores of all anchors add up over strips of the index. After each strip, a pair goes if its partial score and the
  product of the norms of what is left, of row and anchor, cannot reach the anchor's threshold.
* What is left is verified with the whole vectors, and the k best of each window are kept.

Thresholds start at the best score of the window in a sample of ``SAMPLE`` rows, which more than k rows of a large table
exceed. Windows that do not fill go into the next round with the k-th best of the sample, and at last with none but the
window's own bound, so the sample decides about speed and not about results. The windows' rows so far decide whether they are
full, and hold whatever lies above their threshold.

Vectors of different length count as filled up with zeros; rows with the anchor's own vec_id are none of its partners; of
repeated rows of an anchor one is the anchor (the least by label and vector) and each is a partner of others; an empty table
gives an empty one; other columns are ignored. Scores are exact: in float64 while norms are below 2^26, else in 64-bit
integers; components saturate at 2^31.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ..session import shared_dir
from .lexical_rank import top_rows

ANCHORS = 2048
CHUNK = 4096  # rows that a task indexes at once
STRIP = 16  # dimensions between two prunings
SAMPLE = 2048
EVERY = 50
POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95  # percent of the positive's score
NONE = np.iinfo(np.int64).min
TOP = np.iinfo(np.int64).max
FOUND = "anchor int, window int, vec_id bigint, score bigint"


def label_of(vec_id, label):
    """The label after the change of every seventh row."""
    return F.when(vec_id % 7 == 0, F.pmod(label.cast("bigint") + 1, F.lit(10))).otherwise(label.cast("bigint"))


def labelled_rows(embeddings):
    """(vec_id, label, embedding) of the rows that can take part; components are checked where the vectors are read."""
    some = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    rows = embeddings.filter(some)
    return rows.select("vec_id", label_of(F.col("vec_id"), F.col("label")).alias("label"), "embedding")


def matrix(column, width=0):
    """(int64 matrix of the components, which rows are sound) of a column of vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    finite = np.isfinite(values)
    sound = np.ones(len(sizes), dtype=bool)
    sound[rows[~finite]] = False
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), dtype=np.int64)
    limit = float(2**31)
    out[rows[finite], place[finite]] = np.clip(np.floor(256.0 * values[finite]), -limit, limit).astype(np.int64)
    return out, sound


def widen(vectors, width):
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1]))) if vectors.shape[1] < width else vectors


class Block:
    """Anchors with their vectors, labels and windows. ``low``, ``high``: the score bounds of each window (anchors by windows)."""

    def __init__(self, ids, labels, vectors, same, k, low, high):
        self.ids, self.labels, self.vectors, self.same, self.k = ids, labels, vectors, same, k
        self.low, self.high = low, high
        self.threshold = low.copy()  # of each window; above its high bound where nothing is wanted

    def least(self):
        """The threshold of each anchor, that of its lowest open window."""
        return self.threshold.min(axis=1, initial=TOP)


def exact_dtype(a, b):
    """float64 where inner products of the rows of a and b are exact in it."""
    norm = lambda x: float(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)).max(initial=0.0))
    return np.float64 if norm(a) * norm(b) < 2.0**52 else np.int64


class Index:
    """An inverted index of a chunk of rows: strips of dimensions, without what no anchor can reach its threshold by."""

    def __init__(self, vectors, anchors, least):
        dtype = exact_dtype(vectors, anchors)
        order = np.argsort((anchors.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.rows, self.anchors = vectors[:, order].astype(dtype), anchors[:, order].astype(dtype)
        # Norms of the first j dimensions, a little too large so that rounding loses no pair.
        prefix = lambda x: np.sqrt(np.cumsum(np.pad(x.astype(np.float64) ** 2, ((0, 0), (1, 0))), axis=1)) * (1 + 1e-9)
        self.row_norms, self.anchor_norms, self.least = prefix(self.rows), prefix(self.anchors), least
        # The least norm a row must have to reach the threshold of some anchor.
        norms = self.anchor_norms[:, -1]
        need = np.where(least > 0, least / np.maximum(norms, 1e-300), 0.0).min(initial=np.inf)
        self.first = (self.row_norms < need).sum(axis=1) - 1  # dimensions left out; -1: none to leave out
        self.first = np.clip(self.first, 0, vectors.shape[1])
        self.indexed = np.where(np.arange(vectors.shape[1]) >= self.first[:, None], self.rows, 0)

    def pairs(self, allowed):
        """(anchor, row, score) of the allowed pairs that reach the anchor's threshold; ``allowed``: anchors by rows."""
        width = self.rows.shape[1]
        live = allowed & (self.first < width)
        partial = np.zeros(allowed.shape, dtype=self.rows.dtype)
        anchors, rows = np.arange(len(self.anchors)), np.arange(len(self.rows))
        for stop in range(width, 0, -STRIP):
            start = max(stop - STRIP, 0)
            partial += self.anchors[np.ix_(anchors, range(start, stop))] @ self.indexed[np.ix_(rows, range(start, stop))].T
            # What a pair can still gain: the dimensions before the strip, and those of the row that were left out.
            rest = np.maximum(self.row_norms[rows, start], self.row_norms[rows, self.first[rows]])
            bound = partial + self.anchor_norms[anchors, max(start, int(self.first[rows].max(initial=0)))][:, None] * rest
            live &= bound >= self.least[anchors][:, None]
            some_row, some_anchor = live.any(axis=0), live.any(axis=1)
            if not some_row.all() or not some_anchor.all():
                keep = np.ix_(some_anchor, some_row)
                anchors, rows, live, partial = anchors[some_anchor], rows[some_row], live[keep], partial[keep]
            if not live.size:
                break
        a, r = np.nonzero(live)
        a, r = anchors[a], rows[r]
        score = np.zeros(len(a), dtype=np.int64)
        for i in range(0, len(a), 1 << 16):
            part = slice(i, i + (1 << 16))
            score[part] = np.einsum("ij,ij->i", self.anchors[a[part]], self.rows[r[part]]).astype(np.int64)
        sure = score >= self.least[a]
        return a[sure], r[sure], score[sure]


def best_of(anchor, window, vec_id, score, k):
    """The k first rows of each window: their places."""
    order = np.lexsort((vec_id, -score, window, anchor))
    group = anchor[order] * (int(window.max(initial=0)) + 1) + window[order]
    return order[np.arange(len(order)) - np.searchsorted(group, group) < k]


def join_chunk(block, ids, labels, vectors):
    """(anchor, window, vec_id, score): the k best rows of each window at its threshold or above, in a chunk of rows."""
    width = max(vectors.shape[1], block.vectors.shape[1])
    vectors, anchors = widen(vectors, width), widen(block.vectors, width)
    least, out = block.least(), []
    open_ = np.flatnonzero(least < TOP)
    # Partners of the same label: each label by itself. Of other labels: all rows at once.
    groups = np.unique(block.labels[open_]) if block.same else [None]
    for label in groups:
        mine = open_ if label is None else open_[block.labels[open_] == label]
        rows = np.arange(len(ids)) if label is None else np.flatnonzero(labels == label)
        if not len(mine) or not len(rows):
            continue
        allowed = block.ids[mine][:, None] != ids[rows]
        if label is None:
            allowed &= block.labels[mine][:, None] != labels[rows]
        a, r, score = Index(vectors[rows], anchors[mine], least[mine]).pairs(allowed)
        a, vec_id = mine[a], ids[rows[r]]
        for w in range(block.low.shape[1]):
            inside = np.flatnonzero((score >= block.threshold[a, w]) & (score <= block.high[a, w]))
            best = inside[best_of(a[inside], np.zeros(len(inside), np.int64), vec_id[inside], score[inside], block.k)]
            out.append((a[best], np.full(len(best), w), vec_id[best], score[best]))
    columns = list(zip(*out)) or [(np.zeros(0, np.int64),)] * 4
    return [np.concatenate(x).astype(np.int64) for x in columns]


def chunks(batches):
    """(ids, labels, vectors) of ``CHUNK`` sound rows at a time."""
    held = []

    def take(rows):
        table = pa.Table.from_batches(rows)
        vectors, sound = matrix(table.column("embedding"))
        ids, labels = (table.column(n).to_numpy()[sound].astype(np.int64) for n in ("vec_id", "label"))
        return ids, labels, vectors[sound]

    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            held.append(batch.slice(start, CHUNK))
            if sum(x.num_rows for x in held) >= CHUNK:
                yield take(held)
                held = []
    if held:
        yield take(held)


def threshold_join(rows, block):
    """``FOUND``: the k first rows of each open window of a block at its threshold or above, over all rows."""
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def join(batches):
        own = sent.value
        kept = [np.zeros(0, np.int64)] * 4
        for ids, labels, vectors in chunks(batches):
            both = [np.concatenate(x) for x in zip(kept, join_chunk(own, ids, labels, vectors))]
            best = best_of(*both, own.k)
            kept = [x[best] for x in both]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x).cast(k) for x, k in zip(kept, kinds)], names=["anchor", "window", "vec_id", "score"])

    found = rows.mapInArrow(join, FOUND)
    return top_rows(found, ["anchor", "window"], [F.desc("score"), F.col("vec_id")], block.k)


def fill(rows, block, sample):
    """{(anchor, window): [(vec_id, score), ...]} of all windows of a block, after rounds at falling thresholds."""
    anchor, window, _, score = join_chunk(block, *sample)
    guess = np.full((2, *block.low.shape), NONE)
    order = np.lexsort((-score, window, anchor))
    anchor, window, score = anchor[order], window[order], score[order]
    group = anchor * block.low.shape[1] + window
    rank = np.arange(len(group)) - np.searchsorted(group, group)
    for row, nth in ((0, 0), (1, block.k - 1)):
        at = rank == nth
        guess[row, anchor[at], window[at]] = score[at]
    full, open_ = {}, block.low <= block.high
    for threshold in (*np.maximum(guess, block.low), block.low):
        block.threshold = np.where(open_, threshold, TOP)
        if not (block.threshold < TOP).any():
            break
        found = {}
        for row in threshold_join(rows, block).collect():  # at most k rows for each window of the block
            found.setdefault((row.anchor, row["window"]), []).append((row["rank"], row.vec_id, row.score))
        for key, best in found.items():
            if len(best) == block.k or threshold[key] <= block.low[key]:
                full[key] = [(vec_id, score) for _, vec_id, score in sorted(best)]
                open_[key] = False
        open_ &= threshold > block.low
    return full


def anchor_blocks(rows, anchors=ANCHORS):
    """(ids, labels, vectors) of the sound anchors, ``anchors`` at a time."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    own = rows.filter((F.col("vec_id") % EVERY == 0) & sound)
    first = own.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row"))
    held = []
    for row in first.select("vec_id", "row.label", "row.embedding").toLocalIterator():
        held.append(row)
        if len(held) == anchors:
            yield as_arrays(held)
            held = []
    if held:
        yield as_arrays(held)


def as_arrays(rows):
    vectors, sound = matrix(pa.array([r.embedding for r in rows], pa.list_(pa.float64())))
    ids, labels = (np.array([r[n] for r in rows], dtype=np.int64)[sound] for n in ("vec_id", "label"))
    return ids, labels, vectors[sound]


def mine(embeddings, anchors=ANCHORS):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of the hard negatives."""
    spark, rows = embeddings.sparkSession, labelled_rows(embeddings)
    path = shared_dir(spark, "negatives")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    sample = as_arrays(rows.orderBy(F.xxhash64("vec_id", "label"), "vec_id").limit(SAMPLE).collect())
    for ids, labels, vectors in anchor_blocks(rows, anchors):
        shape = (len(ids), 1)
        positives = fill(rows, Block(ids, labels, vectors, True, POSITIVES, np.full(shape, NONE), np.full(shape, TOP - 1)), sample)
        low, high = np.full((len(ids), POSITIVES), TOP), np.full((len(ids), POSITIVES), NONE)
        for (a, _), best in positives.items():
            for w, (_, p) in enumerate(best):
                low[a, w], high[a, w] = -(-LEAST * p // 100), MOST * p // 100
        negatives = fill(rows, Block(ids, labels, vectors, False, NEGATIVES, low, high), sample)
        out = [
            (int(ids[a]), positives[a, 0][w][0], i + 1, vec_id, positives[a, 0][w][1], score)
            for (a, w), best in negatives.items()
            for i, (vec_id, score) in enumerate(best)
        ]
        if out:  # at most 15 rows for each anchor of the block
            spark.createDataFrame(out, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
