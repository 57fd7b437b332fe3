"""Porter stemming (M. F. Porter, 1980) of every space-separated word.

The stemmer is the one step with no built-in counterpart. Each Arrow batch is dictionary-encoded, so Python sees a
batch's distinct words only, the rest stays in Arrow kernels, and no shuffle is needed. A batch is split into words by parts of
bounded bytes, so the memory of a task is that of its batch and of one part.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The UDFs travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A task forgets the stems it knows beyond this many words; longer words than this are not kept.
KNOWN_WORDS = 1 << 18
KNOWN_LENGTH = 64
PART_BYTES = 4 << 20  # text that is split into words at once, one text at least

# The published suffix rules of steps 2, 3 and 4.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
          "iti", "ous", "ive", "ize")


class _Shapes(dict):
    """Translation table: vowels to '1', y left alone, all else to '0'."""

    def __missing__(self, code):
        return "0"


_SHAPES = _Shapes({ord(ch): "1" for ch in "aeiou"} | {ord("y"): "y"})


def _shape(word):
    """'1' per vowel, '0' per consonant; y is a vowel after a consonant."""
    shape = word.translate(_SHAPES)
    while "y" in shape:
        at = shape.index("y")
        shape = shape[:at] + ("1" if shape[at - 1:at] == "0" else "0") + shape[at + 1:]
    return shape


def _measure(stem):
    return _shape(stem).count("10")


def _doubled(word):
    return word[-1:] == word[-2:-1] != "" and _shape(word)[-1:] == "0"


def _short_end(word):
    return _shape(word)[-3:] == "010" and word[-1] not in "wxy"


def _suffix(word, suffixes):
    """The longest of the suffixes that ends the word, or None."""
    if word.endswith(tuple(suffixes)):
        return max((s for s in suffixes if word.endswith(s)), key=len)
    return None


def _plural(word):
    for end, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(end):
            return word[: -len(end)] + new
    return word


def _past(word):
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    end = _suffix(word, ("ed", "ing"))
    if not end or "1" not in _shape(word[: -len(end)]):
        return word
    word = word[: -len(end)]
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    if _doubled(word) and word[-1] not in "lsz":
        return word[:-1]
    return word + "e" if _measure(word) == 1 and _short_end(word) else word


def _swap(word, rules):
    end = _suffix(word, rules)
    if end and _measure(word[: -len(end)]) > 0:
        return word[: -len(end)] + rules[end]
    return word


def _cut(word):
    end = _suffix(word, STEP_4)
    if not end:
        return word
    stem = word[: -len(end)]
    return stem if _measure(stem) > 1 and (end != "ion" or stem.endswith(("s", "t"))) else word


def porter(word):
    if len(word) < 3:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and "1" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _cut(_swap(_swap(word, STEP_2), STEP_3))
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    return word[:-1] if word.endswith("ll") and _measure(word) > 1 else word


def _stem(word, known):
    stem = known.get(word)
    if stem is None:
        stem = porter(word)
        if len(word) <= KNOWN_LENGTH:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            known[word] = stem
    return stem


def _stem_array(words, known):
    """Stem an Arrow string array through its dictionary; ``known`` maps words to stems."""
    coded = pc.dictionary_encode(words)
    stems = pa.array([_stem(w, known) for w in coded.dictionary.to_pylist()], pa.string())
    return pc.take(stems, coded.indices)


def _parts(texts, part_bytes=PART_BYTES):
    """A string array in slices of so many bytes of text, or a little more."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = (np.cumsum(sizes) - sizes) // part_bytes
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(texts)]
    for start, end in zip(edges, edges[1:]):
        yield texts.slice(start, end - start)


def _stem_texts(texts, known):
    """Stem each space-separated word of an Arrow string array."""
    parts = pc.split_pattern(texts, " ")
    stems = _stem_array(parts.values, known)
    joined = pc.binary_join(type(parts).from_arrays(parts.offsets, stems), " ")
    return pc.if_else(pc.is_valid(texts), joined, None)


@F.arrow_udf(T.StringType())
def stem_word(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    known = {}
    for words in batches:
        yield _stem_array(words, known)


@F.arrow_udf(T.StringType())
def stem_words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    known = {}
    for texts in batches:
        for part in _parts(texts):
            yield _stem_texts(part, known)
        # What Arrow keeps for later adds up over the workers of an executor.
        pa.default_memory_pool().release_unused()


def stem_text(text):
    """Stem each word; trailing spaces are lost, as in a split and join."""
    return stem_words(F.rtrim(text))
