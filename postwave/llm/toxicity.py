"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features: densities of three lexicons (a fixed list of insults, words learned from the labels, and beginnings of words
learned from the labels), their hits, how many hits stand near a word for "you", hits that were written with digits or
signs for letters, capitals, punctuation, signs inside words, letters repeated three times, and the length. Tokens are
split at white space and folded: lower case, digits and signs that stand for letters as those letters, nothing else but
letters; so ``1d1ot``, ``i.d.i.o.t`` and ``Idiot!`` are the same token.

A bounded sample of the labelled rows is learned from (``labelled``): parts 0 to 3 give the lexicons, 4 to 7 the trees, 8
and 9 the calibration. Features and scores cover every row. Null counts as empty; empty texts are scored like all others;
repeated rows are scored alike; an empty table gives an empty one; without labels of both classes each score is the share
of label 1 (0.0 without any); other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from ..session import materialize
from . import arrays, labelled

FIT_ROWS = 100_000
LEXICON = 400  # most entries of each learned lexicon
LEAST_DOCS = 4  # toxic documents that have an entry, at least
LEAST_RATIO = 12.0  # of an entry's share of toxic documents to its share of others
THRESHOLD = 0.3
NEAR = 5
STEMS = (4, 5, 6)  # bytes of a learned beginning

# Insults, words that address the reader, letters for digits and signs.
INSULTS = (
    "ass asshole bastard bitch clown coward creep cretin crap cunt damn degenerate dickhead disgusting dumb dumbass fag filth "
    "filthy fool freak fuck fucking garbage hate hateful idiot idiotic idiots imbecile jerk kill loser losers lunatic moron "
    "moronic morons nazi parasite pathetic pig piss pussy rat retard retarded scum scumbag shit shitty slut stupid subhuman "
    "trash ugly vermin vile whore worthless wretch"
).split()
YOU = "you your yours yourself youre ur u thou du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos ti tus usted ustedes vosotros".split()
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

NAMES = (
    "insults learned stems hits near_you near_share hidden hidden_share capitals shouted punctuation exclamations signs_inside "
    "elongated length"
).split()

FOLD = np.zeros(256, dtype=np.uint8)  # 0: dropped
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)
for _sign, _letter in LEET.items():
    FOLD[ord(_sign)] = ord(_letter)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def hash_words(words):
    """Sorted hashes of words, as ``Tokens`` makes them."""
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return np.sort(arrays.hashes(data, np.concatenate([[0], ends[:-1]]), ends))


class Tokens:
    """Folded tokens of a column of texts. ``hidden``: a digit or sign stands between the token's letters."""

    def __init__(self, column):
        self.data, self.offsets = arrays.utf8(column)
        data = self.data
        # Signs at the ends of a token are punctuation, not letters: a token runs from its first to its last letter.
        starts, ends = arrays.runs(~SPACE[data], self.offsets)
        letters = np.concatenate([[0], np.cumsum(LETTER[data])])
        spots = np.flatnonzero(LETTER[data])
        has = letters[ends] > letters[starts]
        starts, ends = starts[has], ends[has]
        self.first = spots[letters[starts]] if len(starts) else starts
        self.last = spots[letters[ends] - 1] if len(starts) else starts
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        inside[self.first] += 1
        inside[self.last + 1] -= 1
        kept = (np.cumsum(inside[:-1]) > 0) & (FOLD[data] > 0)
        place = np.concatenate([[0], np.cumsum(kept)])
        self.folded = FOLD[data[kept]]
        self.starts, self.ends = place[self.first], place[self.last + 1]
        self.hidden = letters[self.last + 1] - letters[self.first] < self.last + 1 - self.first
        self.rows = np.searchsorted(self.offsets, self.first, side="right") - 1

    def words(self):
        return arrays.hashes(self.folded, self.starts, self.ends)

    def stems(self, n):
        """(hashes of the first n bytes, tokens that have them)."""
        long = np.flatnonzero(self.ends - self.starts >= n)
        return arrays.hashes(self.folded, self.starts[long], self.starts[long] + n), long

    def entries(self):
        """(kind, hash, token) of each word (kind 0) and each beginning (kind n) of each token."""
        found = [(0, self.words(), np.arange(len(self.starts)))] + [(n, *self.stems(n)) for n in STEMS]
        kind = np.concatenate([np.full(len(keys), k) for k, keys, _ in found])
        return kind, np.concatenate([x[1] for x in found]), np.concatenate([x[2] for x in found])


def member(keys, sorted_keys):
    if not len(sorted_keys):
        return np.zeros(len(keys), dtype=bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)] == keys


def learn_lexicon(texts, size=LEXICON):
    """{0: word hashes, n: hashes of beginnings} with far more toxic than other documents, from (text, label) rows."""

    def count(batches):
        for piece in arrays.pieces(batches):
            tokens = Tokens(piece.column("text"))
            kind, keys, token = tokens.entries()
            label = piece.column("label").to_numpy()
            once = np.unique(arrays.mix(keys + tokens.rows[token].astype(np.uint64) * arrays.BASE) ^ kind.astype(np.uint64), return_index=True)[1]
            kind, keys, toxic = kind[once], keys[once], label[tokens.rows[token[once]]]
            order = np.lexsort((keys, kind))
            kind, keys, toxic = kind[order], keys[order], toxic[order]
            first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (kind[1:] != kind[:-1]))) if len(keys) else np.zeros(0, np.int64)
            ones = np.add.reduceat(toxic, first) if len(first) else first
            n = np.diff(np.append(first, len(keys)))
            columns = [pa.array(kind[first], pa.int32()), pa.array(keys[first].view(np.int64)), pa.array(ones, pa.int64()), pa.array(n - ones, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "entry", "ones", "zeros"])

    n_ones, n_zeros = texts.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1)) - F.coalesce(F.sum("label"), F.lit(0))).first()
    counts = texts.select("text", "label").mapInArrow(count, "kind int, entry bigint, ones bigint, zeros bigint")
    counts = counts.groupBy("kind", "entry").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    ratio = (F.col("ones") / max(n_ones, 1)) / ((F.col("zeros") + 1) / max(n_zeros, 1))
    good = counts.filter((F.col("ones") >= LEAST_DOCS) & (ratio >= LEAST_RATIO))
    lexicon = {}
    for kind in (0, *STEMS):
        best = good.filter(F.col("kind") == kind).orderBy(F.desc(ratio), "entry").limit(size).select("entry")
        lexicon[kind] = np.sort(np.array([r.entry for r in best.collect()], dtype=np.int64).view(np.uint64))
    return lexicon


def dense(column, lexicon):
    """A row of the features ``NAMES`` for each text."""
    tokens = Tokens(column)
    data, offsets, n = tokens.data, tokens.offsets, len(tokens.offsets) - 1
    per_row = lambda marks: np.bincount(tokens.rows, weights=marks, minlength=n)
    sums = lambda marks: np.diff(np.concatenate([[0], np.cumsum(marks)])[offsets])
    words = tokens.words()
    insult, learned = member(words, hash_words(INSULTS)), member(words, lexicon.get(0, []))
    stem = np.zeros(len(words), dtype=bool)
    for size in STEMS:
        keys, long = tokens.stems(size)
        stem[long] |= member(keys, lexicon.get(size, []))
    any_hit = insult | learned | stem
    you = np.flatnonzero(member(words, hash_words(YOU)))
    near = np.zeros(len(words), dtype=bool)
    if len(you):
        at = np.arange(len(words))
        for side in (np.searchsorted(you, at), np.searchsorted(you, at) - 1):
            other = you[np.clip(side, 0, len(you) - 1)]
            near |= (np.abs(other - at) <= NEAR) & (tokens.rows[other] == tokens.rows)
    count = np.maximum(per_row(np.ones(len(words))), 1.0)
    size = np.maximum(np.diff(offsets), 1.0)
    upper = (data >= 65) & (data <= 90)
    uppers = np.concatenate([[0], np.cumsum(upper)])
    shouted = (uppers[tokens.last + 1] - uppers[tokens.first] >= 2) & (uppers[tokens.last + 1] - uppers[tokens.first] == tokens.last + 1 - tokens.first)
    same = np.zeros(len(data), dtype=bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & LETTER[data[2:]]
    hits, hidden = per_row(any_hit), per_row(any_hit & tokens.hidden)
    letters = np.maximum(sums(LETTER[data]), 1.0)
    return np.stack(
        [
            per_row(insult) / count,
            per_row(learned) / count,
            per_row(stem) / count,
            np.log1p(hits),
            per_row(any_hit & near) / count,
            per_row(any_hit & near) / np.maximum(hits, 1),
            hidden / count,
            hidden / np.maximum(hits, 1),
            sums(upper) / letters,
            per_row(shouted) / count,
            sums(PUNCTUATION[data]) / size,
            sums(data == 33) / size,
            per_row(tokens.hidden) / count,
            sums(same) / letters,
            np.log1p(per_row(np.ones(len(words)))),
        ],
        axis=1,
    )


def features(docs, lexicon):
    """(doc_id, features) of every document."""

    def describe(batches):
        for piece in arrays.pieces(batches):
            rows = dense(piece.column("text"), lexicon)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), flat], names=["doc_id", "features"])

    return docs.select("doc_id", "text").mapInArrow(describe, "doc_id bigint, features array<double>")


def score_documents(docs, labels, fit_rows=FIT_ROWS, modulus=4, held_out=2, threshold=THRESHOLD):
    """doc_id, held_out, score, predicted of every document; learned from rows whose remainder is not ``held_out``."""
    rows = labelled.sample(docs, labels, "toxic", fit_rows, modulus, held_out)
    learned = docs.select("doc_id", "text").join(F.broadcast(rows.filter("part < 4").select("doc_id", "label")), "doc_id")
    table = materialize(features(docs, learn_lexicon(learned)), "features")
    fit = table.join(F.broadcast(rows.filter("part >= 4")), "doc_id")
    fit = materialize(fit.select("label", "part", "features").coalesce(4), "fit")
    fit = fit.select(F.col("label").cast("double").alias("label"), "part", array_to_vector("features").alias("features"))
    trees, calibration = fit.filter("part < 8"), fit.filter("part >= 8")
    n, ones = fit.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    held = F.coalesce(labelled.remainder(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out")
    if min(x.select("label").distinct().count() for x in (trees, calibration)) < 2:
        score = F.lit(float(ones) / n if n else 0.0).alias("score")
        scored = table.select("doc_id", held, score)
    else:
        boosted = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, seed=7, maxMemoryInMB=64, cacheNodeIds=False).fit(trees)
        raw = vector_to_array("probability")[1].alias("raw")
        fitted = boosted.transform(calibration).select("label", raw)
        curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(fitted)
        inputs = table.select("doc_id", array_to_vector("features").alias("features"))
        scored = curve.transform(boosted.transform(inputs).select("doc_id", raw))
        scored = scored.select("doc_id", held, F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
