"""Fingerprints of documents as invertible Bloom lookup sketches of their paragraphs, in DataFrame operations only.

A paragraph is a line. A line of more than 200 characters is cut at content-defined places into pieces that count as
paragraphs: after each word (with its space; a CJK or Hangul character is a word) whose hash with the word before is 0 modulo
16. So a text without line ends has paragraphs too, and an edit changes only the pieces that it touches. A long run of other
characters without a space stays one paragraph.

An element is a different paragraph's 64-bit digest with the number of times the text has it. A sketch has three tables of m cells; an element falls into one cell of each, and a cell holds the number of its elements, the
xor of their keys and the xor of a check hash of the keys. The fingerprint of a text is its sketch with m = 4, written as
``cell:number:key:check`` (hex) of the cells in use, so equal texts have equal fingerprints.

To compare two versions, the cells of one are subtracted from the other's (numbers) and xored, which leaves the elements that
only one has. A cell with number 1 or -1 whose check fits its key holds one element alone: it is recovered and taken out of
its other cells. That goes table by table, in two rounds over all pairs: an element has one cell in a table, so none is found
twice at once. The tables of a pair start with about as many cells as it may differ in: all elements of a text and the next
one, a third of those of a text and its changed version. Pairs that are not empty after the rounds are sketched anew with m
four times as large, until each pair is recovered; so a pair costs as much as it has elements. With a and b elements and d
that differ, the likeness is (a + b - d) / (a + b + d): the shared elements' part of all.

The next document is found with one shuffle of the texts, by ranges of doc_id (null last, ties by text); the first document
of a range is put into the range before it as well, with its elements. Later steps move elements, not texts.

Null counts as an empty text, which is one empty paragraph; a single document is its own next one; repeated rows are
compared row by row; an empty table gives an empty one; other columns are ignored. If most ids of a sparse range lie
close together, few ranges hold them and their sort is larger, but spills.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import materialize

RANGE_BYTES = 8 << 20  # bytes of text that a range of doc_id has on average
TABLES = 3
PART_ELEMENTS = 1 << 17  # elements that a partition has on average
LONG_LINE = 200  # characters of a line that stays whole
PIECE_WORDS = 16  # words of a piece of a longer line, on average
WORD_END = "(?<=[ \\u2E80-\\uD7A3])"
MOST_BROADCAST = 100_000  # ranges, one narrow row each
OWN, CHANGED, NEXT = range(3)
KINDS = ((1, CHANGED, 3), (2, NEXT, 1))  # (kind, version beside the own one, elements for a first cell)
FIRST_CELLS = 4
GROWTH = 4
ROUNDS = 2


def by_range(docs, range_bytes=RANGE_BYTES):
    """((doc_id, text, elements, range), number of ranges) with ranges of doc_id in ascending order; null ids have the last."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("elements", elements("text"))
    size, low, high = rows.agg(F.sum(F.octet_length("text")), F.min("doc_id"), F.max("doc_id")).first()
    ranges = max(1, (size or 0) // range_bytes)
    width = max(1.0, ((high or 0) - (low or 0) + 1) / ranges)
    number = F.floor((F.col("doc_id").cast("double") - float(low or 0)) / width)
    return rows.withColumn("range", F.coalesce(number, F.lit(1 << 62))), ranges


def with_next(docs, range_bytes=RANGE_BYTES):
    """(doc_id, text, elements, next_text, next_elements) of each document; the last document's next one is the first."""
    rows, ranges = by_range(docs, range_bytes)
    heads = rows.groupBy("range").agg(F.min("doc_id").alias("head_id"))
    order = Window.orderBy("range")  # one narrow row for each range
    # The first row of a range also goes into the range before it; that of the first range, into the last.
    last = F.max("range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.withColumn("before", F.coalesce(F.lag("range").over(order), last))
    # Joined without a shuffle of the texts while the heads are few.
    heads = heads.withColumnRenamed("range", "head_range").hint("broadcast" if ranges <= MOST_BROADCAST else "merge")
    rows = rows.join(heads, (F.col("range") == F.col("head_range")) & F.col("doc_id").eqNullSafe(F.col("head_id")), "left")
    own = F.struct(F.col("range"), F.lit(False).alias("borrowed"))
    lent = F.struct(F.col("before").alias("range"), F.lit(True).alias("borrowed"))
    rows = rows.select("doc_id", "text", "elements", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, lent))).alias("at"))
    rows = rows.select("doc_id", "text", "elements", "at.*")
    within = Window.partitionBy("range").orderBy("borrowed", F.col("doc_id").asc_nulls_last(), "text")
    rows = rows.withColumns({f"next_{name}": F.lead(name).over(within) for name in ("text", "elements")})
    return rows.filter(~F.col("borrowed")).select("doc_id", "text", "elements", "next_text", "next_elements")


def edited(text, next_text):
    """The text with its last quarter replaced by the beginning of the next one."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(next_text, F.lit(1), quarter))


def once(value, function):
    """``function`` of a column that it names more than once, or in an inner function, but that is computed once."""
    return F.transform(F.array(value), function)[0]


def pieces(line):
    """The pieces of a long line."""
    ends = lambda words, word, i: F.pmod(F.xxhash64(F.get(words, i - 1), word), F.lit(PIECE_WORDS)) == 0
    mark = lambda words: F.transform(words, lambda w, i: F.when(ends(words, w, i), F.concat(w, F.lit("\n"))).otherwise(w))
    return F.split(F.array_join(once(F.split(line, WORD_END), mark), ""), "\n")


def digests(text):
    """The digests of the paragraphs of a text."""
    whole = lambda line: F.array(F.xxhash64(line))
    cut = lambda line: F.transform(pieces(line), lambda piece: F.xxhash64(piece))
    return F.flatten(F.transform(F.split(text, "\n"), lambda line: F.when(F.length(line) <= LONG_LINE, whole(line)).otherwise(cut(line))))


def elements(text):
    """The keys of the different paragraphs of a text, each with the number of times the text has it."""
    starts = lambda d: F.filter(F.sequence(F.lit(0), F.size(d) - 1), lambda i: (i == 0) | (F.get(d, i) != F.get(d, i - 1)))
    times = lambda d, at, i, j: (F.coalesce(F.get(at, j + 1), F.size(d)) - i).cast("bigint")
    keys = lambda d, at: F.transform(at, lambda i, j: F.xxhash64(F.get(d, i), times(d, at, i, j)))
    return once(F.sort_array(digests(text)), lambda d: once(starts(d), lambda at: keys(d, at)))


def versions(docs):
    """(row, doc_id, n_chars, edited_sha256, elements): the last are those of the own, the changed and the next text.

    They are one column, as the versions share most of their elements and such repeats compress away side by side.
    """
    rows = with_next(docs).withColumn("changed_text", edited(F.col("text"), F.col("next_text")))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("changed_text").cast("binary"), 256).alias("edited_sha256"),
        F.array("elements", elements("changed_text"), "next_elements").alias("elements"),
    )
    return materialize(rows, "versions")


def by_row(rows, *keep):
    """Rows of a table of versions in partitions by row, of bounded numbers of elements."""
    n = rows.agg(F.sum(F.size(F.flatten("elements")))).first()[0] or 0
    return rows.select("row", "elements", *keep).repartition(max(1, -(-n // PART_ELEMENTS)), "row")


def check_of(key):
    return F.xxhash64(key, F.lit("check"))


def cell_of(key, m, t):
    """The cell of a key in table t."""
    return (F.pmod(F.xxhash64(key, F.lit(t)), m) + t * m).cast("int")


def cells_of(key, m):
    """The three cells of a key."""
    return F.array(*[cell_of(key, m, t) for t in range(TABLES)])


def add_up(cells, *keys):
    """(keys, cell, number, key, check): cells with their parts added."""
    return cells.groupBy(*keys, "cell").agg(F.sum("number").alias("number"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))


def sketches(sides, *keys):
    """(keys, cell, number, key, check): the cells in use. ``sides`` has the keys, m, number (what an element counts) and elements."""
    alone = sides.select(*keys, "m", "number", F.explode("elements").alias("key"))
    placed = alone.select(*keys, "number", "key", check_of(F.col("key")).alias("check"), F.explode(cells_of(F.col("key"), F.col("m"))).alias("cell"))
    return add_up(placed, *keys)


def subtracted(rows):
    """(row, kind, m, cell, number, key, check): sketches of the own version minus the changed one (kind 1), the next one (kind 2).

    ``rows`` has row, elements and the cells of each kind, ``m1`` and ``m2``, null for a pair that is not asked for.
    """
    side = lambda kind, number, version: F.struct(
        F.lit(kind).alias("kind"), F.col(f"m{kind}").alias("m"), F.lit(number).alias("number"), F.col("elements")[version].alias("elements")
    )
    sides = F.array(*[side(kind, *x) for kind, other, _ in KINDS for x in ((1, OWN), (-1, other))])
    return sketches(rows.select("row", F.explode(sides).alias("side")).select("row", "side.*").filter("m is not null"), "row", "kind", "m")


def peel(cells, rounds=ROUNDS):
    """(row, kind, m, differing, left): elements recovered from subtracted cells, and cells that could not be emptied.

    A step turns each cell of one table that holds one element into what it takes out of its other cells, and a found element:
    cell -1 counts those of a pair.
    """
    field = {"cell": "int", "number": "bigint", "key": "bigint", "check": "bigint"}
    part = lambda *values: F.struct(*[v.cast(t).alias(n) for v, (n, t) in zip(values, field.items())])
    number, key, check, m = (F.col(x) for x in ("number", "key", "check", "m"))
    used = "cell < 0 or number <> 0 or key <> 0 or check <> 0"
    state = cells.filter(used)
    for t in list(range(TABLES)) * rounds:
        own_table = (F.col("cell") >= t * m) & (F.col("cell") < (t + 1) * m)
        alone = own_table & (F.abs("number") == 1) & (check == check_of(key))
        found = part(F.lit(-1), F.lit(1), F.lit(0), F.lit(0))
        outs = [part(cell_of(key, m, other), -number, key, check) for other in range(TABLES) if other != t]
        moves = F.when(alone, F.array(found, *outs)).otherwise(F.array(part(F.col("cell"), number, key, check)))
        state = add_up(state.select("row", "kind", "m", F.explode(moves).alias("p")).select("row", "kind", "m", "p.*"), "row", "kind", "m").filter(used)
    differing = F.coalesce(F.sum(F.when(F.col("cell") < 0, number)), F.lit(0))
    return state.groupBy("row", "kind", "m").agg(differing.alias("differing"), F.count(F.when(F.col("cell") >= 0, 1)).alias("left"))


def differences(table, first_cells=FIRST_CELLS, rounds=ROUNDS):
    """(row, kind, differing) of the pairs that differ; kind 1: own and changed, kind 2: own and next."""
    size = lambda version: F.size(F.col("elements")[version])
    cells = {f"m{kind}": F.floor((size(OWN) + size(other)) / share) + first_cells for kind, other, share in KINDS}
    done, open_ = None, table.withColumns(cells)
    while True:
        peeled = materialize(peel(subtracted(by_row(open_, *cells)), rounds), "peeled")
        good = peeled.filter("left = 0").select("row", "kind", "differing")
        done = good if done is None else done.unionAll(good)
        failed = peeled.filter("left > 0")
        if failed.isEmpty():
            return done
        larger = [F.max(F.when(F.col("kind") == kind, F.col("m") * GROWTH)).alias(f"m{kind}") for kind, *_ in KINDS]
        open_ = table.join(failed.groupBy("row").agg(*larger), "row")


def fingerprints(table, m=FIRST_CELLS):
    """(row, fingerprint, edited_fingerprint)."""
    side = lambda version: F.struct(F.lit(version).alias("version"), F.lit(m).alias("m"), F.lit(1).alias("number"), F.col("elements")[version].alias("elements"))
    sides = by_row(table).select("row", F.explode(F.array(side(OWN), side(CHANGED))).alias("side")).select("row", "side.*")
    text = F.concat_ws(":", F.lpad(F.hex("cell"), 4, "0"), F.hex("number"), F.hex("key"), F.hex("check"))
    each = sketches(sides, "row", "version").groupBy("row", "version").agg(F.array_join(F.array_sort(F.collect_list(text)), ",").alias("cells"))
    pick = lambda version: F.max(F.when(F.col("version") == version, F.col("cells")))
    return each.groupBy("row").agg(pick(OWN).alias("fingerprint"), pick(CHANGED).alias("edited_fingerprint"))


def compare_documents(docs):
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each document."""
    table = versions(docs)
    pairs = differences(table).groupBy("row").agg(
        F.max(F.when(F.col("kind") == 1, F.col("differing"))).alias("edits"), F.max(F.when(F.col("kind") == 2, F.col("differing"))).alias("next_edits")
    )
    sizes = [F.size(F.col("elements")[i]).alias(f"{n}_size") for i, n in enumerate(("own", "changed", "next"))]
    rows = fingerprints(table).join(pairs, "row", "left").join(table.select("row", "doc_id", "n_chars", "edited_sha256", *sizes), "row")

    def near(a, b, edits):
        total, d = F.col(a) + F.col(b), F.coalesce(edits, F.lit(0))
        return (total - d) / (total + d)

    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        near("own_size", "changed_size", "edits").alias("near_edited"),
        near("own_size", "next_size", "next_edits").alias("near_next"),
    )
