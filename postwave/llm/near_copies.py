"""Near copies by improved consistent weighted sampling over TF-IDF weights of word shingles.

A shingle is a run of five words (``arrays``), or all words of a text with one to four. Its weight in a text is its count
there times a damped idf, 1 + ln((N + 1) / (df + 1)) / (2 ln(N + 1)), which lies between 1 and 1.5; N and df count
different texts. Two texts are linked if the sum of their lesser weights is 0.8 of the sum of their greater weights, or
more. Classes are the connected components; equal texts are always one class, also empty ones.

1. Different texts go to slices by their hash; a batch drops its repeats first, so a text that is a third of all rows does
   not fill its slice. Document frequencies come from ``gram_counts``.
2. A text can only have a link if 0.8 of its weight lies in shingles of two texts or more; others are done. For each that
   is left, 30 consistent weighted samples give ten band keys of three samples: a pair at 0.8 shares a band in 99.9 % of
   cases, one at 0.9 in all but one of 100,000.
3. In a band, all texts are first compared by their exact weights with one leader, which n copies of a text need n
   comparisons for. A band that still has texts of several classes is then cut into blocks of bounded bytes, and each pair of
   blocks is one group of rows: its texts are compared with all others there that are not in their class yet, so any two
   texts of a band are compared or in one class. Only links leave a group. The rows of a band grow with its texts times its
   blocks; the comparisons of texts that share a band and have no link still grow with the square of their number.
4. Components of the links, then the least doc_id of each class.

Null counts as empty; ties and repeated rows fall in one class; an empty table gives an empty one; a class in which every
doc_id is null has a null class id; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import materialize
from . import arrays, gram_counts
from .graph import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 10
ROWS = 3
SLICE_BYTES = 4 << 20  # weighted shingles of the texts that a slice compares
BLOCK_BYTES = 4 << 20  # weighted shingles of the texts of a block
CANDIDATES = "fp string, common double, bands array<bigint>, hashes binary, weights binary"


def fingerprint(text):
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def shingles(column, n=SHINGLE):
    """(hash, row) of the shingles of the texts."""
    words, at = arrays.word_hashes(column)
    keys, rows = arrays.grams(words, at, n)
    short = np.flatnonzero((np.diff(at) > 0) & (np.diff(at) < n))
    if len(short):
        few = [arrays.grams(words[at[i] : at[i + 1]], np.array([0, at[i + 1] - at[i]]), int(at[i + 1] - at[i]))[0] for i in short]
        keys, rows = np.concatenate([keys, *few]), np.concatenate([rows, short])
    return keys, rows


def bags(column, n=SHINGLE):
    """(hash, row, count) of the different shingles of each text, by row and then by hash."""
    keys, rows = shingles(column, n)
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    return keys[first], rows[first], np.diff(np.append(first, len(keys)))


def different(table):
    """One row of each fp of an Arrow table."""
    _, first = np.unique(np.array(table.column("fp").to_pylist(), dtype="S32"), return_index=True)
    return table.take(pa.array(np.sort(first)))


def slices_of_texts(docs):
    """(packed texts with fp and slice; bits of a bucket's number) of the different texts, repeats of a batch left out."""
    n_slices, bits = gram_counts.sizes(docs, 1)
    number = F.pmod(F.xxhash64("fp"), F.lit(n_slices)).cast("int").alias("slice")

    def pack(batches):
        for batch in batches:
            yield gram_counts.pack(different(batch))

    texts = docs.select(fingerprint("text").alias("fp"), "text").select("fp", number, "text")
    return texts.mapInArrow(pack, "fp string, slice int, packed binary, bytes bigint").repartition(n_slices, "slice"), bits


def corpus_keys(keys, n_texts):
    """(sorted entries of a slice, counts, place of each key) for the different shingles of its texts."""
    found, inverse, counts = np.unique(np.append(keys, gram_counts.ALL), return_inverse=True, return_counts=True)
    counts[inverse[-1]] = n_texts
    return found, counts, inverse


def count_shingles(n):
    def count(table):
        table = different(table)
        found, counts, _ = corpus_keys(bags(gram_counts.unpack(table), n)[0], table.num_rows)
        return found, counts

    return count


def uniform(x):
    """Numbers strictly between 0 and 1 from 32 bits."""
    return (x.astype(np.float64) + 0.5) * 2.0**-32


def samples(keys, weights, firsts, draws):
    """A matrix of consistent weighted samples: a column of ``draws`` 64-bit values for each text.

    ``firsts``: where each text's shingles start. Per shingle and draw, r and c are Gamma(2, 1) and b uniform, all made
    from the shingle's hash; t = floor(ln w / r + b), and the shingle with the least ln c - r (t - b + 1) is the sample.
    """
    low, size = np.uint64(0xFFFFFFFF), np.diff(np.append(firsts, len(keys)))
    logs = np.log(weights)
    out = np.empty((draws, len(firsts)), dtype=np.uint64)
    for d in range(draws):
        x = arrays.mix(keys + np.uint64((2 * d + 1) * int(arrays.BASE) % 2**64))
        y, z = arrays.mix(x ^ arrays.BASE), arrays.mix(x + arrays.BASE)
        r = -np.log(uniform(x >> np.uint64(32)) * uniform(x & low))
        c = -np.log(uniform(y >> np.uint64(32)) * uniform(y & low))
        b = uniform(z & low)
        t = np.floor(logs / r + b)
        a = np.log(c) - r * (t - b + 1.0)
        least = np.minimum.reduceat(a, firsts)
        hit = np.flatnonzero(a == np.repeat(least, size))
        _, once = np.unique(np.searchsorted(firsts, hit, side="right"), return_index=True)
        hit = hit[once]
        out[d] = arrays.mix(keys[hit] + t[hit].astype(np.int64).view(np.uint64) * arrays.BASE)
    return out


def band_keys(drawn, rows):
    """A column of band keys for each text, from ``rows`` samples a band."""
    bands = np.zeros((len(drawn) // rows, drawn.shape[1]), dtype=np.uint64)
    for b in range(len(bands)):
        for k in range(rows):
            bands[b] = arrays.mix(bands[b] * arrays.BASE + drawn[b * rows + k] + np.uint64(b + 1))
    return bands


def candidates(texts, totals, similarity=SIMILARITY, bands=BANDS, rows=ROWS, n=SHINGLE):
    """``CANDIDATES`` rows: the texts that share enough weight to have a link, with band keys and weighted shingles.

    common: the mean log of the document frequency of the text's shingles, by weight.
    """

    def sign(table, back):
        table = different(table)
        keys, at, times = bags(gram_counts.unpack(table), n)
        _, _, place = corpus_keys(keys, table.num_rows)
        df = gram_counts.totals_of(back)[place]
        number, df = int(df[-1]), df[:-1]
        weights = times * (1 + np.log((number + 1) / (df + 1)) / (2 * np.log(number + 1)))
        total = np.bincount(at, weights=weights, minlength=table.num_rows)
        shared = np.bincount(at, weights=weights * (df > 1), minlength=table.num_rows)
        common = np.bincount(at, weights=weights * np.log(df), minlength=table.num_rows) / np.maximum(total, 1e-12)
        open_ = np.flatnonzero((total > 0) & (shared >= similarity * total - 1e-9))
        kept = np.isin(at, open_)
        keys, weights, at = keys[kept], weights[kept], at[kept]
        firsts = np.searchsorted(at, open_)
        cuts = list(zip(firsts.tolist(), np.append(firsts[1:], len(keys)).tolist()))
        drawn = samples(keys, weights, firsts, bands * rows) if len(open_) else np.zeros((bands * rows, 0), np.uint64)
        return pa.table(
            {
                "fp": table.column("fp").take(pa.array(open_)),
                "common": pa.array(common[open_]),
                "bands": pa.array(list(band_keys(drawn, rows).T.astype(np.int64)), pa.list_(pa.int64())),
                "hashes": pa.array([keys[i:j].tobytes() for i, j in cuts], pa.binary()),
                "weights": pa.array([weights[i:j].tobytes() for i, j in cuts], pa.binary()),
            }
        )

    both = texts.groupBy("slice").cogroup(totals.groupBy("slice"))
    return both.applyInArrow(sign, CANDIDATES)


def weighted_similarity(keys, weights, other_keys, other_weights):
    """Sum of lesser weights over sum of greater weights of two sorted bags."""
    _, i, j = np.intersect1d(keys, other_keys, assume_unique=True, return_indices=True)
    least = np.minimum(weights[i], other_weights[j]).sum()
    return least / (weights.sum() + other_weights.sum() - least)


def compare(pairs, vectors, similarity, n_slices):
    """(a, b, linked) for pairs of fps.

    Pairs go to slices by b. A slice gets each bag it needs once, so a hot a travels at most once a slice, whatever the
    number of its pairs, and b once, whatever the number of its bands.
    """
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(n_slices)).cast("int").alias("slice"))
    needed = dealt.select("slice", F.inline(F.array(F.struct(F.col("a").alias("fp")), F.struct(F.col("b").alias("fp"))))).distinct()
    bags_ = needed.join(vectors.select("fp", "hashes", "weights"), "fp").select(F.col("slice").alias("of_slice"), "fp", "hashes", "weights")

    def verify(pairs, table):
        place = {fp: i for i, fp in enumerate(table.column("fp").to_pylist())}
        columns = [(table.column(name), kind) for name, kind in (("hashes", "u8"), ("weights", "f8"))]
        bag = lambda fp: [np.frombuffer(column[place[fp]].as_buffer(), kind) for column, kind in columns]
        pairs = pairs.sort_by("a").select(["a", "b"])
        linked, last, own = [], None, None
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            if a != last:
                last, own = a, bag(a)
            linked.append(weighted_similarity(*own, *bag(b)) >= similarity - 1e-9)
        return pairs.append_column("linked", pa.array(linked, pa.bool_()))

    return dealt.groupBy("slice").cogroup(bags_.groupBy("of_slice")).applyInArrow(verify, "a string, b string, linked boolean")


def block_links(hashes, weights, roots, split, similarity):
    """(i, j) of linked texts, enough of them to join all classes that links join.

    ``roots``: the class of each text. Texts are compared with those after them; with ``split``, only across that place.
    """
    sizes = [len(x) for x in hashes]
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    codes = np.unique(np.concatenate(hashes), return_inverse=True)[1]
    values = np.concatenate(weights)
    totals = np.array([x.sum() for x in weights])
    _, group = np.unique(np.array(roots), return_inverse=True)
    mark, found = np.zeros(len(codes)), []
    for i in range(split or len(sizes) - 1):
        start = split or i + 1
        if (group[start:] == group[i]).all():
            continue
        own = slice(firsts[i], firsts[i + 1])
        mark[codes[own]] = values[own]
        rest = firsts[start]
        least = np.add.reduceat(np.minimum(mark[codes[rest:]], values[rest:]), firsts[start:-1] - rest)
        mark[codes[own]] = 0.0
        near = least >= (similarity - 1e-9) * (totals[i] + totals[start:] - least)
        others = start + np.flatnonzero(near & (group[start:] != group[i]))
        joined, once = np.unique(group[others], return_index=True)
        found += [(i, j) for j in others[once].tolist()]
        group[np.isin(group, joined)] = group[i]
    return found


def compare_blocks(open_, vectors, similarity, block_bytes=BLOCK_BYTES):
    """(a, b, a_root, b_root) of linked texts of different classes, from the bands in ``open_`` (fp, band, root).

    Pairs of blocks are dealt to slices; a slice gets each bag it needs once, whatever the number of its bands.
    """
    spark = vectors.sparkSession
    size = vectors.select("fp", (F.octet_length("hashes") + F.octet_length("weights")).alias("bytes"))
    sized = open_.join(size, "fp")
    blocks = sized.groupBy("band").agg(F.ceil(F.sum("bytes") / block_bytes).cast("int").alias("blocks"))
    sized = sized.join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    members = sized.select("fp", "band", "root", "bytes", "block", other)
    members = members.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    members = materialize(members.select("band", "low", "high", "block", "fp", "root", "bytes"), "members")
    total = members.agg(F.sum("bytes")).first()[0] or 0
    n_slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SLICE_BYTES))
    number = F.pmod(F.xxhash64("band", "low", "high"), F.lit(n_slices)).cast("int").alias("slice")
    dealt = members.select(number, "band", "low", "high", "block", "fp", "root")
    needed = dealt.select(F.col("slice").alias("of_slice"), F.col("fp").alias("bag")).distinct()
    bags_ = needed.join(vectors.select(F.col("fp").alias("bag"), "hashes", "weights"), "bag").select("of_slice", "bag", "hashes", "weights")

    def verify(members, table):
        place = {fp: i for i, fp in enumerate(table.column("bag").to_pylist())}
        columns = [(table.column(name).combine_chunks(), kind) for name, kind in (("hashes", "u8"), ("weights", "f8"))]
        bag = lambda fp, k: np.frombuffer(columns[k][0][place[fp]].as_buffer(), columns[k][1])
        members = members.sort_by([(name, "ascending") for name in ("band", "low", "high", "block", "fp")])
        keys = [members.column(name).to_numpy() for name in ("band", "low", "high")]
        new = np.ones(members.num_rows, dtype=bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in keys], axis=0)
        edges = np.append(np.flatnonzero(new), members.num_rows).tolist()
        fps, roots, block = (members.column(name).to_pylist() for name in ("fp", "root", "block"))
        found = []
        for start, end in zip(edges, edges[1:]):
            split = 0
            if keys[1][start] != keys[2][start]:
                split = block[start:end].count(int(keys[1][start]))
                if split in (0, end - start):
                    continue
            own = range(start, end)
            linked = block_links([bag(fps[i], 0) for i in own], [bag(fps[i], 1) for i in own], roots[start:end], split, similarity)
            found += [(fps[start + i], fps[start + j], roots[start + i], roots[start + j]) for i, j in linked]
        names = ("a", "b", "a_root", "b_root")
        return pa.table({name: pa.array([row[k] for row in found], pa.string()) for k, name in enumerate(names)})

    both = dealt.groupBy("slice").cogroup(bags_.groupBy("of_slice"))
    return both.applyInArrow(verify, "a string, b string, a_root string, b_root string")


def reroot(rooted, joined):
    """``rooted`` with the classes joined that the rows of (a, b) name."""
    moved = components(joined).select(F.col("node").alias("root"), F.col("root").alias("new_root"))
    rooted = rooted.join(moved, "root", "left").withColumn("root", F.coalesce("new_root", "root"))
    return materialize(rooted.select("fp", "common", "band", "root"), "rooted")


def join_bands(vectors, similarity=SIMILARITY, block_bytes=BLOCK_BYTES):
    """(compared pairs: all with a leader, of the others the linked ones; (fp, band, root)): the classes of the links of all bands.

    The leader of a band is the text whose shingles the most texts have. What it leaves apart is compared block by block.
    """
    bands = vectors.select("fp", "common", F.explode("bands").alias("band")).distinct()
    several = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("band")
    size = vectors.agg(F.sum(F.octet_length("hashes") + F.octet_length("weights"))).first()[0] or 0
    n_slices = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SLICE_BYTES))
    rooted = bands.join(several, "band").withColumn("root", F.col("fp"))
    rooted = materialize(rooted.select("fp", "common", "band", "root"), "rooted")
    leaders = rooted.groupBy("band").agg(F.max(F.struct("common", "fp")).alias("most")).select("band", F.col("most.fp").alias("a"))
    met = rooted.join(leaders, "band").filter("fp <> a").select("a", F.col("fp").alias("b"))
    # Two leaders meet from both sides; the plan runs more than once, so which side is kept must not depend on the run.
    either = [F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")]
    pairs = met.groupBy(*either).agg(F.min(F.struct("a", "b")).alias("side")).select("side.a", "side.b")
    tested = materialize(compare(pairs, vectors, similarity, n_slices), "links")
    linked = tested.filter("linked").select("a", "b")
    if not linked.isEmpty():
        rooted = reroot(rooted, linked)
    # Of two texts one has led.
    kinds = rooted.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("least"), F.max("root").alias("greatest"))
    open_ = rooted.join(kinds.filter("n > 2 and least <> greatest").select("band"), "band").select("fp", "band", "root")
    more = materialize(compare_blocks(open_, vectors, similarity, block_bytes), "links")
    if not more.isEmpty():
        rooted = reroot(rooted, more.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))
    return tested.unionAll(more.select("a", "b", F.lit(True).alias("linked"))), rooted


def links(vectors, similarity=SIMILARITY):
    """(a, b) for linked texts, enough of them that their components are those of all links between texts of a band."""
    return join_bands(vectors, similarity)[0].filter("linked").select("a", "b")


def fingerprint_roots(docs, similarity=SIMILARITY, bands=BANDS, rows=ROWS, n=SHINGLE):
    """(fp, root) of the texts that are linked to a lesser fp, the root of their class."""
    texts, bits = slices_of_texts(docs)
    totals = gram_counts.corpus_counts(texts, count_shingles(n), bits)
    vectors = materialize(candidates(texts, totals, similarity, bands, rows, n), "vectors")
    # A text that lies in two batches is signed in one slice only, so fps are unique here.
    return join_bands(vectors, similarity)[1].filter("fp <> root").select("fp", "root").distinct()


def classes(docs, similarity=SIMILARITY, bands=BANDS, rows=ROWS, n=SHINGLE):
    """doc_id, fp, class_id of each document; class_id is the least doc_id of its class."""
    roots = materialize(fingerprint_roots(docs, similarity, bands, rows, n), "roots")
    rooted = docs.select("doc_id", fingerprint("text").alias("fp")).join(roots, "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rooted.join(least, "root").select("doc_id", "fp", "class_id")


def drop_copies(docs, similarity=SIMILARITY, bands=BANDS, rows=ROWS, n=SHINGLE):
    """One document of each class, with all columns: that of the least doc_id, and of its rows the first by fp."""
    roots = materialize(fingerprint_roots(docs, similarity, bands, rows, n), "roots")
    rooted = docs.select("doc_id", fingerprint("text").alias("fp")).join(roots, "fp", "left")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("best")
    kept = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(best).select("best.doc_id", "best.fp")
    kept = kept.select(F.struct(F.col("doc_id"), F.col("fp")).alias("kept_row"))
    row = F.struct(docs["doc_id"].alias("doc_id"), fingerprint(docs["text"]).alias("fp")).alias("own_row")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("document"), row)
    same = rows.join(kept, F.col("own_row").eqNullSafe(F.col("kept_row")), "left_semi")
    return same.dropDuplicates(["own_row"]).select("document.*")
