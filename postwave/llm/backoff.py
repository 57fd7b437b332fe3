"""Stupid-backoff scores of documents from n-gram counts over the whole corpus.

The score of a word after its history is count(n-gram) / count(history) if the n-gram occurs, else 0.4 times the score
after a history shorter by one word; a word by itself has count(word) / count(all words). A document's own n-grams are
taken off all counts first (leave one out): else each n-gram would occur, and nothing would ever back off. A word that no
other document has counts as one occurrence in the whole corpus, times 0.4.

The count tables are partitioned by hash and joined to the n-grams of slices of documents (``gram_counts``); the logs are
summed per document. Null, empty and wordless texts have 0 words, a sum of 0.0 and no mean; repeated rows are scored one by
one, each against the other; an empty table gives an empty one; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from . import arrays, gram_counts

ORDER = 3
DISCOUNT = 0.4


def gram_hashes(words, at, order):
    """For each n up to ``order``, the hash of the n-gram of each word that ends one, in the order of the words."""
    return [arrays.grams(words, at, n)[0] for n in range(1, order + 1)]


def count_grams(order):
    def count(table):
        words, at = arrays.word_hashes(gram_counts.unpack(table))
        keys, counts = np.unique(np.concatenate([*gram_hashes(words, at, order), [gram_counts.ALL]]), return_counts=True)
        counts[np.searchsorted(keys, gram_counts.ALL)] = len(words)
        return keys, counts

    return count


def log_scores(words, at, totals, everything, discount):
    """The natural log of each word's score. ``totals``: for each n, (hash, total) of the n-gram of each word that ends one."""
    rows = arrays.rows_of(at)
    place = np.arange(len(words)) - at[rows]
    elsewhere = []
    for n, (keys, total) in enumerate(totals, 1):
        count = np.zeros(len(words), dtype=np.int64)
        ends = np.flatnonzero(place >= n - 1)
        shared = np.flatnonzero(total > 1)
        own = arrays.mix(keys[shared] + rows[ends[shared]].astype(np.uint64) * arrays.BASE)
        _, inverse, times = np.unique(own, return_inverse=True, return_counts=True)
        count[ends[shared]] = total[shared] - times[inverse]
        elsewhere.append(count)
    others = everything - np.diff(at)[rows]
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(elsewhere[0] > 0, elsewhere[0] / others, discount / everything)
        for n in range(2, len(totals) + 1):
            ends = place >= n - 1
            history = np.concatenate([[0], elsewhere[n - 2][:-1]])
            longer = np.where(elsewhere[n - 1] > 0, elsewhere[n - 1] / history, discount * score)
            score = np.where(ends, longer, score)
    return np.log(score)


def score_documents(docs, order=ORDER, discount=DISCOUNT):
    """doc_id, n_words, log_score (sum of natural logs), mean_log_score (null without words) of each document."""
    docs = docs.select("doc_id", "text")
    n_slices, bits = gram_counts.sizes(docs, order)
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_slices)).cast("int").alias("slice")

    def pack(batches):
        for batch in batches:
            yield gram_counts.pack(batch)

    texts = docs.select("doc_id", number, "text").mapInArrow(pack, "doc_id bigint, slice int, packed binary, bytes bigint")
    texts = texts.repartition(n_slices, "slice")
    corpus = gram_counts.corpus_counts(texts, count_grams(order), bits)

    def score(table, back):
        words, at = arrays.word_hashes(gram_counts.unpack(table))
        parts = gram_hashes(words, at, order)
        keys, inverse = np.unique(np.concatenate([*parts, [gram_counts.ALL]]), return_inverse=True)
        found = gram_counts.totals_of(back)[inverse]
        totals = list(zip(parts, np.split(found[:-1], np.cumsum([len(x) for x in parts])[:-1])))
        logs = log_scores(words, at, totals, int(found[-1]), discount)
        n = np.diff(at)
        total = np.bincount(arrays.rows_of(at), weights=logs, minlength=len(n))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(n, pa.int64()),
                "log_score": pa.array(total),
                "mean_log_score": pa.array(total / np.maximum(n, 1), mask=n == 0),
            }
        )

    both = texts.groupBy("slice").cogroup(corpus.groupBy("slice"))
    return both.applyInArrow(score, "doc_id bigint, n_words bigint, log_score double, mean_log_score double")
