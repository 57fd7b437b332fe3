"""Secrets in texts: three patterns, and sliding-window Shannon entropy over candidate strings.

Patterns (leftmost, not overlapping, each by itself): ``assign``, a password-like name with a value of 12 characters or
more; ``access``, AKIA and more, 18 characters or more; ``hex``, 16 hex digits or more. A span is the whole match.

Entropy: a candidate is a run of 20 or more letters, digits and ``+/_=-``. A window of 20 characters slides over it; the
counts of its characters change by one in and one out, and so does the sum of c log2 c from which its entropy follows. A
window is of the narrowest class that holds all its characters: digits, hex, letters, letters of both cases (``CASES`` of
each at least), letters and digits, base64. Each class has its own limit; digits alone and letters of one case have none, as
numbers and long words are no secrets. Windows over the limit that touch are one span. An allow list drops spans that are
known not to be secret: those whose every part of ``LEAST_PART`` characters or more, between ``/`` and ``=``, is listed or
made of words. A span within a pattern's span is left out, as it is reported already. The patterns' spans always stay.

Positions are code points. Null and empty texts have no span; repeated rows are scanned one by one; an empty table gives an
empty one; other columns are ignored. A text's memory is its own; candidates may be as long as the text.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from . import arrays

WINDOW = 20
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")

# Bits of entropy that a window of each class must exceed. 20 characters have 4.32 at most.
LIMITS = {"hex": 3.0, "mixed": 3.7, "alphanumeric": 3.7, "base64": 3.8}
CASES = 4  # letters of each case that make a window one of both cases

# What looks random and is not secret.
ALLOWED = tuple(
    re.compile(pattern)
    for pattern in (
        r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUID
        r"(?i).*(example|sample|dummy|placeholder|changeme|your[_-]?(api|key|token|secret)).*",
        r"(?i).*(0123456789|abcdefghij|qwertyuiop).*",  # rows of a keyboard or an alphabet
        r"[0-9+/_=-]*(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}[0-9T+/_=-]*",  # dates
    )
)

LEAST_PART = 8
PARTS, NAME, HUMP = re.compile("[/=]"), re.compile("([A-Za-z_+-]+)[0-9]{0,4}"), re.compile("[A-Z]?[a-z]+|[A-Z]+")

IS_HEX = np.zeros(256, dtype=bool)
IS_HEX[[*range(48, 58), *range(97, 103)]] = True
IS_CANDIDATE = np.zeros(256, dtype=bool)
IS_CANDIDATE[[*range(48, 58), *range(65, 91), *range(97, 123), *map(ord, "+/_=-")]] = True
IS_TELLING = np.zeros(256, dtype=bool)  # a candidate without a digit or a capital has no limit
IS_TELLING[[*range(48, 58), *range(65, 91)]] = True

HEX_DIGITS, DIGITS = frozenset("0123456789abcdefABCDEF"), frozenset("0123456789")
SIGNS, CAPITALS = frozenset("+/_=-"), frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
C_LOG_C = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def char_class(digits, hexes, signs, capitals):
    """The narrowest class of a window from its counts."""
    if digits == WINDOW:
        return "digits"
    if hexes == WINDOW and digits:
        return "hex"
    if digits:
        return "base64" if signs else "alphanumeric"
    return "mixed" if not signs and CASES <= capitals <= WINDOW - CASES else "letters"


def entropy_windows(candidate):
    """(start, entropy, class) of each window of a candidate, from counts that change by one character."""
    counts, total = {}, 0.0
    digits = hexes = signs = capitals = 0
    for i, char in enumerate(candidate):
        c = counts.get(char, 0)
        total += C_LOG_C[c + 1] - C_LOG_C[c]
        counts[char] = c + 1
        digits, hexes, signs = digits + (char in DIGITS), hexes + (char in HEX_DIGITS), signs + (char in SIGNS)
        capitals += char in CAPITALS
        if i >= WINDOW - 1:
            yield i - WINDOW + 1, math.log2(WINDOW) - total / WINDOW, char_class(digits, hexes, signs, capitals)
            old = candidate[i - WINDOW + 1]
            c = counts[old]
            total += C_LOG_C[c - 1] - C_LOG_C[c]
            counts[old] = c - 1
            digits, hexes, signs = digits - (old in DIGITS), hexes - (old in HEX_DIGITS), signs - (old in SIGNS)
            capitals -= old in CAPITALS


def entropy_spans(candidate, limits=LIMITS):
    """(start, end) of the touching windows over their limit, without those the allow list knows."""
    spans = []
    for start, entropy, kind in entropy_windows(candidate):
        if entropy > limits.get(kind, math.inf):
            if spans and start <= spans[-1][1]:
                spans[-1][1] = start + WINDOW
            else:
                spans.append([start, start + WINDOW])
    return [(a, b) for a, b in spans if not allowed(candidate, a, b)]


def of_words(part):
    """Whether a part is a name made of words: humps of letters, 3.5 long on average, and up to four digits."""
    found = NAME.fullmatch(part)
    humps = HUMP.findall(found[1]) if found else []
    return len(humps) > 0 and sum(map(len, humps)) >= 3.5 * len(humps)


def allowed(candidate, a, b):
    """Whether the parts of a candidate, between slashes and equals signs, that a span touches are known not to be secret."""
    start = max(candidate.rfind(sign, 0, a) for sign in "/=") + 1
    stop = min((i for i in (candidate.find(sign, b) for sign in "/=") if i >= 0), default=len(candidate))
    parts = [part for part in PARTS.split(candidate[start:stop]) if len(part) >= LEAST_PART]
    return len(parts) > 0 and all(of_words(part) or any(x.fullmatch(part) for x in ALLOWED) for part in parts)


def base_spans(text, has_hex=True):
    """(kind, start, end) of the patterns' matches, by start and kind."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    if has_hex:
        spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def all_spans(text, base, has_candidate=True):
    """The base spans and those of entropy that lie in none of them, by start and kind."""
    if not has_candidate:
        return base
    added = [
        ("entropy", m.start() + a, m.start() + b)
        for m in CANDIDATE.finditer(text)
        for a, b in entropy_spans(m[0])
        if not any(s <= m.start() + a and m.start() + b <= e for _, s, e in base)
    ]
    return sorted([*base, *added], key=lambda s: (s[1], KINDS.index(s[0])))


def long_runs(data, offsets, inside, least, other=None):
    """Which rows have a run of ``least`` bytes of a kind (that holds a byte of the other kind)."""
    starts, ends = arrays.runs(inside[data], offsets)
    long = ends - starts >= least
    if other is not None:
        seen = np.concatenate([[0], np.cumsum(other[data])])
        long &= seen[ends] > seen[starts]
    found = np.zeros(len(offsets) - 1, dtype=bool)
    found[np.searchsorted(offsets, starts[long], side="right") - 1] = True
    return found


SPAN = "struct<kind:string,start:bigint,end:bigint>"


def scan(docs):
    """doc_id, base and spans (arrays of kind, start, end) of each document."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches):
        for piece in arrays.pieces(batches):
            data, offsets = arrays.utf8(piece.column("text"))
            hexes = long_runs(data, offsets, IS_HEX, 16)
            candidates = long_runs(data, offsets, IS_CANDIDATE, WINDOW, IS_TELLING)
            base, spans = [], []
            for i, text in enumerate(piece.column("text").to_pylist()):
                base.append(base_spans(text or "", hexes[i]))
                spans.append(all_spans(text or "", base[-1], candidates[i]))
            named = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row] for row in x], kind) for x in (base, spans)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *named], names=["doc_id", "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id bigint, base array<{SPAN}>, spans array<{SPAN}>")


def secrets(docs):
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of each document."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    join = lambda name: F.array_join(F.transform(name, text), ",")
    digest = F.sha2(join("base").cast("binary"), 256).alias("base_sha256")
    return scan(docs).select("doc_id", *map(count, KINDS[:3]), digest, join("spans").alias("spans"))
