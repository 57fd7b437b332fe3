"""Token counts of a sentencepiece BPE model, by merges over a heap and a linked list; no identifiers are made.

The symbols of a text, at first its characters, are a doubly linked list. A heap holds the adjacent pairs that are a piece of
the vocabulary, by the piece's rank and then by place; the lowest is taken out and merged until none is left. The count is the
number of initial symbols less the merges; a character without a piece counts as its bytes, which the model falls back to.

Merges never reach over a place between two characters that no piece has side by side, so a text is cut at such places and
each part is merged alone. A space (``SPACE``) after another character is one of them in models that keep spaces at the start
of pieces; a worker keeps the counts of the short parts between them, which repeat. Memory is that of one text and its longest
part, beside counts of at most ``MOST_KEPT`` characters of parts.

Text is normalized as the model says (a space before it, spaces as ``SPACE``); strings of special tokens in a text are
ordinary text. Null counts as an empty text, which has no tokens; repeated rows are counted one by one; an empty table gives
an empty one; other columns are ignored. Models with pieces of the user or unused ones, or without byte fallback, are an error.
"""

import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from . import arrays

SPACE = "▁"
LIMIT = 4096
MOST_KEPT = 8 << 20  # characters of parts that a worker keeps the counts of
LONGEST_KEPT = 64
PLACE_BITS = 40
PLACES = (1 << PLACE_BITS) - 1
COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint"
_counters = {}


class Counter:
    """Counts tokens with the pieces of a model file."""

    def __init__(self, path):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        numbers = range(model.get_piece_size())
        plain = [i for i in numbers if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        if any(model.is_unused(i) for i in numbers) or not any(model.is_byte(i) for i in numbers):
            raise ValueError("the model has unused pieces or no byte fallback")
        scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
        # Pieces of the user score 0 and are no merges; learned pieces score below it.
        if any(score >= 0 and len(piece) > 1 for piece, score in scores.items()):
            raise ValueError("the model has pieces of the user")
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {piece: order[score] for piece, score in scores.items()}
        self.side_by_side = {piece[i : i + 2] for piece in scores for i in range(len(piece) - 1)}
        alone = all(pair[1] != SPACE or pair[0] == SPACE for pair in self.side_by_side)
        self.parts = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if alone else "(?s).+").findall
        self.kept, self.size = {}, 0

    def extra(self, symbol):
        """Tokens of a symbol beyond one: the bytes of a character without a piece."""
        return 0 if symbol in self.ranks else len(symbol.encode("utf-8")) - 1

    def merged(self, part):
        """Initial symbols of a part less its merges.

        A heap entry is rank and left symbol in one number. It is out of date if the pair that starts there now has another
        rank; if a later pair has the same one, its own entry is the same number, so the order stays right.
        """
        symbols, n, rank_of = list(part), len(part), self.ranks.get
        extra = {symbol: self.extra(symbol) for symbol in set(symbols) if symbol not in self.ranks}
        count = n + sum(extra.get(symbol, 0) for symbol in symbols) if extra else n
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = enumerate(map(rank_of, map(str.__add__, part, part[1:])))
        heap = [(rank << PLACE_BITS) + i for i, rank in ranks if rank is not None]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            left = entry & PLACES
            a, right = symbols[left], after[left]
            if a is None or right >= n:
                continue
            b = symbols[right]
            if rank_of(a + b) != entry >> PLACE_BITS:
                continue
            count -= 1 + extra.get(a, 0) + extra.get(b, 0) if extra else 1
            symbols[left] = both = a + b
            symbols[right] = None
            after[left] = follower = after[right]
            leader = before[left]
            if follower < n:
                before[follower] = left
                rank = rank_of(both + symbols[follower])
                if rank is not None:
                    heappush(heap, (rank << PLACE_BITS) + left)
            if leader >= 0:
                rank = rank_of(symbols[leader] + both)
                if rank is not None:
                    heappush(heap, (rank << PLACE_BITS) + leader)
        return count

    def keep(self, part, count):
        if len(part) <= LONGEST_KEPT:
            if self.size > MOST_KEPT:
                self.kept.clear()
                self.size = 0
            self.kept[part] = count
            self.size += len(part)
        return count

    def of_part(self, part):
        """The count of a part between spaces, cut further where no piece has two characters side by side."""
        pairs, kept, count, start = self.side_by_side, self.kept, 0, 0
        for i in range(1, len(part) + 1):
            if i == len(part) or part[i - 1 : i + 1] not in pairs:
                if i - start == 1:
                    count += 1 + self.extra(part[start])
                else:
                    inner = part[start:i]
                    n = kept.get(inner)
                    count += self.keep(inner, self.merged(inner)) if n is None else n
                start = i
        return count

    def count(self, text):
        """The number of tokens of a text."""
        kept, total = self.kept, 0
        for part in self.parts(self.model.normalize(text)):
            n = kept.get(part)
            total += self.keep(part, self.of_part(part)) if n is None else n
        return total


def counter(path):
    """The worker's counter for a model file, loaded once."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs, path, limit=LIMIT):
    """doc_id, n_bytes, n_tokens, over_limit of each document."""

    def count(batches):
        known = counter(path)
        for piece in arrays.pieces(batches):
            texts = piece.column("text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            tokens = pa.array([known.count(x.as_py() or "") for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), sizes, tokens], names=["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select("doc_id", "text").mapInArrow(count, COUNTS)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
