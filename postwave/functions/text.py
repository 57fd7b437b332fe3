"""Post text normalisation. Every function maps a string Column to a string Column."""

import re
import sys
from functools import reduce

from pyspark.sql import functions as F

# Emoticons and emoji, with the word that stands in for each.
SENTIMENT_WORDS = {
    ":)": "good",
    ":-)": "good",
    "&lt;3": "good",
    " ->d": "good",
    " ->dd": "good",
    "8)": "good",
    " ->-)": "good",
    " ->)": "good",
    ";)": "good",
    ";-)": "good",
    "(- ->": "good",
    "( ->": "good",
    "😃": "good",
    "😄": "good",
    "😊": "good",
    "😀": "good",
    "😗": "good",
    "😛": "good",
    "☺": "good",
    "✌": "good",
    "❤": "good",
    "⭐": "good",
    "👍": "good",
    "👌": "good",
    "👏": "good",
    "😂": "good",
    "😆": "good",
    "😋": "good",
    "😍": "good",
    "😟": "bad",
    "😦": "bad",
    "😧": "bad",
    "😕": "bad",
    "😞": "bad",
    "😠": "bad",
    "😢": "sad",
    "😡": "sad",
    " ->/": "bad",
    " ->&gt;": "sad",
    " ->')": "sad",
    " ->-(": "bad",
    " ->(": "bad",
    " ->S": "bad",
    " ->-S": "bad",
}

ARROW = " ->"
FIRST_SYMBOL = "\u2600"

# Short forms, matched as whole words.
SHORT_FORMS = {
    "you're": "you are",
    "u": "you",
    "haha": "ha",
    "hahaha": "ha",
    "don't": "do not",
    "doesn't": "does not",
    "didn't": "did not",
    "hasn't": "has not",
    "haven't": "have not",
    "hadn't": "had not",
    "won't": "will not",
    "wouldn't": "would not",
    "can't": "can not",
    "cannot": "can not",
}

# Noise patterns, in the order they apply.
NOISE_PATTERNS = {
    r"([a-z])\1\1+": "$1$1",
    r"@\S+": "username",
    r"http:\/\/\S+": "url",
    r"[-_]": " ",
}


def longest_first(pairs):
    """Longest key first, so that a key is never eaten by its own prefix; equal lengths keep their order."""
    return sorted(pairs, key=lambda kv: -len(kv[0]))


def one_of(literals):
    return "|".join(re.escape(x) for x in literals)


def replace_literal(text, key, word):
    return F.replace(text, F.lit(key), F.lit(word))


def rewrite(text, pairs, step):
    """Apply each (pattern, replacement) in turn."""
    return reduce(lambda c, kv: step(c, *kv), pairs, text)


def first_of(literals):
    """A look at one character that rules most positions out before the costlier part of a pattern is tried."""
    return f"(?=[{re.escape(''.join(dict.fromkeys(x[0] for x in literals)))}])"


def replace_emoticons(text):
    """Keys with an arrow can overlap each other and go one by one, longest first. The others overlap nothing that
    comes later, so their order is free: single symbols go one by one as well, the ASCII faces in one pass. A cheap
    look at the post skips the two chains when it has no arrow or no symbol.
    """
    arrows = longest_first((k, v) for k, v in SENTIMENT_WORDS.items() if ARROW in k)
    symbols = [(k, v) for k, v in SENTIMENT_WORDS.items() if k >= FIRST_SYMBOL]
    faces = [k for k in SENTIMENT_WORDS if ARROW not in k and k < FIRST_SYMBOL]
    text = F.when(text.contains(ARROW), rewrite(text, arrows, replace_literal)).otherwise(text)
    has_symbol = text.rlike(f"[{FIRST_SYMBOL}-{chr(sys.maxunicode)}]")
    text = F.when(has_symbol, rewrite(text, symbols, replace_literal)).otherwise(text)
    return F.regexp_replace(text, f"{first_of(faces)}(?:{one_of(faces)})", "good")


def short_form_patterns():
    """(first characters, pattern, replacement) of the short forms: one for all words in -n't that only lose it, one for
    those with the same long form. No key overlaps or makes another one, so their order is free and few passes do."""
    negated = [k.removesuffix("n't") for k, v in SHORT_FORMS.items() if k.endswith("n't") and v == k.removesuffix("n't") + " not"]
    alike = {}
    for key, word in SHORT_FORMS.items():
        if key.removesuffix("n't") not in negated:
            alike.setdefault(word, []).append(key)
    return [(negated, f"({one_of(negated)})n't", "$1 not")] + [(keys, f"(?:{one_of(keys)})", word) for word, keys in alike.items()]


def expand_short_forms(text):
    """One look decides whether a post needs the passes."""
    passes = [(rf"{first_of(keys)}\b{pattern}\b", word) for keys, pattern, word in short_form_patterns()]
    needed = text.rlike(rf"{first_of(SHORT_FORMS)}\b(?:{one_of(SHORT_FORMS)})\b")
    return F.when(needed, rewrite(text, passes, F.regexp_replace)).otherwise(text)


def remove_noise(text):
    return rewrite(text, NOISE_PATTERNS.items(), F.regexp_replace)


def normalize_sentiment(text):
    """Lower-case, then emoticons to words."""
    return replace_emoticons(F.lower(text))


def normalize_short_forms(text):
    """Lower-case, then short forms written out."""
    return expand_short_forms(F.lower(text))


def normalize_noise(text):
    """Lower-case, then elongations, mentions, links and hyphens."""
    return remove_noise(F.lower(text))


def normalize(text):
    """Sentiment words, then short forms, then noise; all of it keeps lower case, so one lower-casing does."""
    return remove_noise(expand_short_forms(normalize_sentiment(text)))
