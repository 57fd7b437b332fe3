"""Unigrams and sentence-bound n-grams as array Columns.

Splitting follows the usual JVM rule: trailing empty parts are dropped, inner and leading ones stay, and an empty
string is one empty part. Characters are removed from a whole string, not per token, which is one regex pass and
gives the same tokens because separators are never touched.
"""

from pyspark.sql import functions as F

# What trimming a sentence removes: every character up to the space.
BLANKS = "".join(map(chr, range(0x21)))

NO_WORDS = "array<string>"
NO_SENTENCES = "array<array<string>>"


def drop_trailing(text, ch):
    return F.rtrim(text, F.lit(ch))


def split_words(text):
    """Split on one space, dropping trailing empty parts."""
    body = drop_trailing(text, " ")
    return F.when((body == "") & (text != ""), F.array().cast(NO_WORDS)).otherwise(F.split(body, " "))


def clean_words(body):
    return F.split(F.regexp_replace(body, r"[^\w ]+", ""), " ")


def unigrams(text):
    """Words with all but ASCII letters, digits and _ removed; words left empty stay as ''."""
    body = drop_trailing(text, " ")
    return F.when((body == "") & (text != ""), F.array().cast(NO_WORDS)).otherwise(clean_words(body))


def sentence_words(text):
    """One word list per '.'-separated sentence, each sentence trimmed before its words are cleaned."""
    body = drop_trailing(text, ".")
    words = F.transform(F.split(body, r"\."), lambda s: clean_words(F.trim(s, F.lit(BLANKS))))
    return F.when((body == "") & (text != ""), F.array().cast(NO_SENTENCES)).otherwise(words)


def ngrams_of(words, n):
    """n-grams of one word list; a list shorter than n gives one short gram, an empty one none."""
    grams = words
    for k in range(1, n):
        tail = F.slice(words, k + 1, F.greatest(F.size(words) - n + 1, F.lit(0)))
        head = F.slice(grams, 1, F.size(tail))
        grams = F.zip_with(head, tail, lambda a, b: F.concat(a, F.lit(" "), b))
    none = F.array().cast(NO_WORDS)
    short = F.array(F.array_join(words, " "))
    return F.when(F.size(words) == 0, none).when(F.size(words) < n, short).otherwise(grams)


def ngrams(text, n):
    return F.flatten(F.transform(sentence_words(text), lambda words: ngrams_of(words, n)))


def bigrams(text):
    return ngrams(text, 2)


def trigrams(text):
    return ngrams(text, 3)


def unigrams_and_bigrams(text):
    return F.concat(unigrams(text), bigrams(text))
