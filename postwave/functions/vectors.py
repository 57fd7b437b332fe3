"""Hashed sparse vectors as a struct of two parallel arrays, ``idx`` (ascending) and ``value``.

A vector never leaves its row, so term frequencies, weighting and dot products need no shuffle. Dense operands (IDF
weights, model weights) have a fixed width and enter the plan as one constant-folded array.
"""

from pyspark.sql import functions as F


def hash_index(token, width):
    """Bucket of a token: murmur3 with seed 42, non-negative modulo the width."""
    return F.pmod(F.hash(token), F.lit(width))


def constant_array(values):
    """A fixed-width list of doubles as one foldable expression (shortest round-trip text, exact)."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def weighted(vector, weights):
    """Each value times the weight of its bucket."""
    dense = constant_array(weights)
    value = F.zip_with(vector["idx"], vector["value"], lambda i, v: v * F.get(dense, i))
    return F.struct(vector["idx"].alias("idx"), value.alias("value"))


def dot(vector, weights):
    dense = constant_array(weights)
    terms = F.zip_with(vector["idx"], vector["value"], lambda i, v: v * F.get(dense, i))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def sigmoid(x):
    return 1.0 / (1.0 + F.exp(-x))
