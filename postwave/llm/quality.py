"""Quality by naive Bayes support vectors: n-gram indicators scaled by class log-count ratios, then a linear hinge loss.

Tokens are words, runs of one sign, and line ends. Indicators are the 1- and 2-grams of the lower-cased tokens and the 1-
to 3-grams of their shapes (lower, capitalized or upper case, digits, the sign and its run length, "the same token as
before"), hashed to 2^18 places. With the share of documents that have an indicator in each class, smoothed by one, its
log-count ratio scales it; a document's vector has length 1. The support vector machine is fit by dual coordinate descent
(squared hinge loss, L2) on a bounded sample of the labelled rows without repeats (``labelled``): parts 0 to 7; parts 8 and
9 fit the sigmoid that turns margins to scores.

The model is 2^18 numbers whatever the input, so it goes to the tasks with the function. Null counts as empty; an empty text
has no indicator and gets the score of the bias; repeated rows are scored alike; an empty table gives an empty one; without
labels of both classes each score is the share of label 1 (0.5 without any). ``keep_good`` keeps all columns and does not
mind their names; the other functions ignore other columns.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from . import arrays, labelled

FIT_ROWS = 12_000
PLACES = 1 << 18
THRESHOLD = 0.5
EPOCHS = 12
PENALTY = 1.0  # C of the hinge loss

SIGN = ~arrays.WORD
SIGN[[9, 11, 12, 13, 32]] = False  # white space; a line end is a sign


def tokens(column):
    """(hash, shape, row offsets) of the tokens of a column of texts."""
    data, offsets = arrays.utf8(column)
    word_starts, word_ends = arrays.runs(arrays.WORD[data], offsets)
    # A run of one sign: cut where the byte changes.
    sign = SIGN[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    changes = np.ones(len(data), dtype=bool)
    changes[1:] = (data[1:] != data[:-1]) | ~sign[:-1]
    sign_starts = np.flatnonzero(sign & (changes | first[:-1]))
    stops = np.ones(len(data), dtype=bool)
    stops[:-1] = changes[1:] | first[1:-1]
    sign_ends = np.flatnonzero(sign & stops) + 1
    order = np.argsort(np.concatenate([word_starts, sign_starts]), kind="stable")
    starts = np.concatenate([word_starts, sign_starts])[order]
    ends = np.concatenate([word_ends, sign_ends])[order]
    keys = np.concatenate(
        [
            arrays.hashes(arrays.LOWER[data], word_starts, word_ends),
            arrays.mix(data[sign_starts].astype(np.uint64) * arrays.BASE + np.minimum(sign_ends - sign_starts, 4).astype(np.uint64)),
        ]
    )[order]
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    lower = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
    digit = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
    uppers, lowers, digits = (x[ends] - x[starts] for x in (upper, lower, digit))
    shape = np.select(
        [order >= len(word_starts), digits > 0, (uppers > 1) & (lowers == 0), (uppers == 1) & (lowers == 0), uppers > 0],
        [keys, np.where(lowers + uppers > 0, 1, 2), 3, 4, 5],
        6,
    ).astype(np.uint64)
    at = np.searchsorted(starts, offsets).astype(np.int64)
    again = np.zeros(len(keys), dtype=bool)
    again[1:] = keys[1:] == keys[:-1]
    again[at[:-1][at[:-1] < len(keys)]] = False
    return keys, np.where(again, np.uint64(7), shape), at


def indicators(column):
    """(place, row) of the different indicators of each text, by row and place."""
    keys, shapes, at = tokens(column)
    found = [arrays.grams(keys, at, n) for n in (1, 2)]
    found += [(arrays.mix(g + arrays.BASE), rows) for g, rows in (arrays.grams(arrays.mix(shapes), at, n) for n in (1, 2, 3))]
    place = np.concatenate([g for g, _ in found]) % np.uint64(PLACES)
    rows = np.concatenate([r for _, r in found])
    both = np.unique(rows.astype(np.int64) * PLACES + place.astype(np.int64))
    return both % PLACES, both // PLACES


class Model:
    """weights: one for each place, already scaled by the log-count ratio; norms: the squared ratio, for the length."""

    def __init__(self, ratio, weights, bias, slope, shift):
        self.squares, self.weights = (ratio**2).astype(np.float32), (weights * ratio).astype(np.float32)
        self.bias, self.slope, self.shift = bias, slope, shift

    def scores(self, column):
        place, row = indicators(column)
        n = len(column)
        length = np.sqrt(np.bincount(row, weights=self.squares[place], minlength=n))
        margin = np.bincount(row, weights=self.weights[place], minlength=n) / np.maximum(length, 1e-12) + self.bias
        return sigmoid(self.slope * margin + self.shift)


class Constant:
    def __init__(self, share):
        self.share = share

    def scores(self, column):
        return np.full(len(column), self.share)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def descend(rows, signs, penalty=PENALTY, epochs=EPOCHS, tolerance=0.01, seed=3):
    """(weights, bias) of the L2-regularized squared hinge loss, by dual coordinate descent.

    ``rows``: (places, values) of each document, values of length 1; the bias is a further value of 1. Each step solves
    one dual variable exactly; an epoch visits all in a random order, and epochs end when no step moves much.
    """
    weights, bias, alpha = np.zeros(PLACES), 0.0, np.zeros(len(rows))
    size = 2.0 + 0.5 / penalty  # squared length with the bias, and the diagonal of the squared hinge loss
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in random.permutation(len(rows)):
            place, value = rows[i]
            gradient = signs[i] * (weights[place] @ value + bias) - 1.0 + alpha[i] * 0.5 / penalty
            new = max(0.0, alpha[i] - gradient / size)
            step = (new - alpha[i]) * signs[i]
            if step:
                weights[place] += step * value
                bias += step
                largest = max(largest, abs(step))
                alpha[i] = new
        if largest < tolerance:
            break
    return weights, bias


def fit_sigmoid(margins, labels, rounds=50):
    """(slope, shift) of the logistic curve, by Newton's method on smoothed targets, as Platt proposed."""
    ones = labels.sum()
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x, beta = np.stack([margins, np.ones(len(margins))], axis=1), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = sigmoid(x @ beta)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit(docs, labels, fit_rows=FIT_ROWS, modulus=3, held_out=1):
    """A model from labelled rows whose remainder is not ``held_out``; at most ``fit_rows`` of them reach the driver."""
    rows = labelled.sample(docs, labels, "quality", fit_rows, modulus, held_out)

    def describe(batches):
        for piece in arrays.pieces(batches):
            place, row = indicators(piece.column("text"))
            found = np.split(place.astype("<i4"), np.searchsorted(row, np.arange(1, piece.num_rows)))
            columns = [piece.column(x) for x in ("doc_id", "label", "part")] + [pa.array([x.tobytes() for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "part", "places"])

    texts = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    texts = texts.mapInArrow(describe, "doc_id bigint, label int, part int, places binary").dropDuplicates(["doc_id"])
    found = sorted((r.doc_id, r.label, r.part, bytes(r.places)) for r in texts.toLocalIterator())
    labels_, parts = np.array([x[1] for x in found]), np.array([x[2] for x in found])
    places = [np.frombuffer(x[3], "<i4") for x in found]
    learned = parts < 8
    if min((len(set(labels_[mask])) for mask in (learned, ~learned)), default=0) < 2:
        return Constant(float(labels_.mean()) if len(labels_) else 0.5)
    shares = []
    for label in (1, 0):
        own = [p for p, mark in zip(places, learned & (labels_ == label)) if mark]
        shares.append((np.bincount(np.concatenate(own), minlength=PLACES) + 1.0) / (len(own) + 2.0))
    ratio = np.log(shares[0] / shares[1])

    def unit(place):
        value = ratio[place]
        return place, value / max(np.sqrt(value @ value), 1e-12)

    vectors = [unit(p) for p in places]
    chosen = np.flatnonzero(learned)
    weights, bias = descend([vectors[i] for i in chosen], np.where(labels_[chosen] > 0, 1.0, -1.0))
    margins = np.array([weights[p] @ v + bias for p, v in (vectors[i] for i in np.flatnonzero(~learned))])
    return Model(ratio, weights, bias, *fit_sigmoid(margins, labels_[~learned]))


def score_documents(docs, labels, fit_rows=FIT_ROWS, modulus=3, held_out=1, threshold=THRESHOLD):
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels, fit_rows, modulus, held_out)

    def score(batches):
        for piece in arrays.pieces(batches):
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(model.scores(piece.column("text")))], names=["doc_id", "score"])

    held = F.coalesce(labelled.remainder(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out")
    scored = docs.select("doc_id", "text").mapInArrow(score, "doc_id bigint, score double")
    return scored.select("doc_id", held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs, labels, fit_rows=FIT_ROWS, modulus=3, held_out=1, threshold=THRESHOLD):
    """The documents with a score of ``threshold`` or more, with all columns."""
    model = fit(docs, labels, fit_rows, modulus, held_out)

    def keep(batches):
        for piece in arrays.pieces(batches):
            yield piece.filter(pa.array(model.scores(piece.column("text")) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
