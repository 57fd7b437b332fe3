"""Emoticon predicates and the distant label they give."""

import re
from functools import reduce
from operator import or_

from pyspark.sql import functions as F

# Emoticons that decide the label.
POSITIVE_EMOTICONS = (":)", ":-)", ";-)", ";)")
NEGATIVE_EMOTICONS = (":(", ":-(")

POSITIVE = 1.0
NEGATIVE = 0.0


def any_of(literals):
    """Pattern that matches one or more of the literals."""
    return "(" + "|".join(re.escape(x) for x in literals) + ")+"


def contains_any(text, literals):
    """Whether ``any_of`` finds something, at the cost of plain substring searches."""
    return reduce(or_, (text.contains(x) for x in literals))


def is_positive(text):
    return contains_any(text, POSITIVE_EMOTICONS)


def is_negative(text):
    return contains_any(text, NEGATIVE_EMOTICONS)


def is_neutral(text):
    return ~contains_any(text, POSITIVE_EMOTICONS + NEGATIVE_EMOTICONS)


def emoticon_label(text):
    """1.0 with a positive emoticon, else 0.0: mixed posts are positive, neutral ones negative."""
    return F.when(is_positive(text), F.lit(POSITIVE)).otherwise(F.lit(NEGATIVE))


def without_label_emoticons(text):
    """The text less the emoticons its label came from, for features that must not repeat the label."""
    return F.regexp_replace(text, any_of(POSITIVE_EMOTICONS + NEGATIVE_EMOTICONS), "")
