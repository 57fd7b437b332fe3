"""Ranking, token counts, hard negatives, hashes and the mix against brute force, with odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from postwave.llm import arrays, hard_negatives, lexical_rank, mixing, secret_scan, suffix_search, token_blocks, token_counts

SCHEMA = "doc_id bigint, text string, item_id string, rank int, score double"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def documents(spark):
    draw, words = random.Random(1), "alpha beta gamma Delta épée x1 日本 omega".split()
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(1, 30))) + ".", None, 1, 2.0) for i in range(60)]
    rows += [(60, None, "a", 1, 1.0), (61, "", "a", 1, 1.0), (62, "...", None, None, None), (None, "alpha beta", "a", 1, 1.0)]
    rows += [(70, "alpha omega", "a", 1, 1.0)] * 3 + [(71, "Alpha, OMEGA!", "a", 1, 1.0), (72, "alpha " * 5000, "a", 1, 1.0)]
    return spark.createDataFrame(rows, SCHEMA)


def best_by_hand(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    out = []
    for item, text in items:
        found = []
        for doc, c in held:
            m, score = 100 - 90 + 90 * sum(c.values()) * n_docs // n_terms, 0
            for term in set(terms(text)):
                df = sum(term in other for _, other in held)
                if c[term]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * c[term] // (1000 * c[term] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank + 1, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [lexical_rank.BLOCK_BYTES, 12])
def test_ranking(spark, monkeypatch, block_bytes):
    """Any blocks of items, strips of terms and tiles of documents give the rows of the plain sums; ties go by doc_id."""
    docs = documents(spark).repartition(3)
    items = spark.createDataFrame([(1, "alpha BETA omega"), (2, "Épée épée 日本 none"), (3, None), (4, ""), (None, "x1 gamma"), (5, "none at all")],
                                  "item_id int, text string")
    rows = lexical_rank.best_documents(docs, items, block_bytes=block_bytes)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    want = best_by_hand([(r.doc_id, r.text) for r in docs.collect()], items.collect())
    assert sorted(map(tuple, rows.collect()), key=repr) == want and len(want) > 20


def test_ranking_without_rows(spark):
    docs = documents(spark)
    items = spark.createDataFrame([(1, "alpha")], "item_id int, text string")
    assert lexical_rank.best_documents(docs.filter("false"), items).count() == 0
    assert lexical_rank.best_documents(docs, items.filter("false")).count() == 0


def test_strips_are_exact():
    """The greatest weights and impacts give the sums of whole numbers."""
    weights = np.full(6000, 10**9)
    tile = lexical_rank.Tile([list(range(6000))], weights, 0)
    assert tile.strip * 10**9 * 10**6 < 2**53
    impact = np.full(6000, 999_999, dtype=np.int64)
    assert tile.scores(np.zeros(6000, np.int64), np.arange(6000), impact, 1)[0, 0] == 6000 * 10**9 * 999_999


def test_token_counts(spark):
    draw, counter = random.Random(2), token_counts.Counter(MODEL)
    letters = "abcdeéßth  ▁▁\n\t0123<s>/ü梦日本語😀 '.,-\x00"
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 80))) for _ in range(400)]
    texts += [None, "", " ", "<s> </s><unk>", "a" * 4000, " " * 500, "日本" * 2000, "no" + "\n" * 50, thue_morse(2000)]
    rows = [(i, t, None, 0, 0.0) for i, t in enumerate(texts)] + [(None, "one two", "a", 1, 1.0)] * 2
    got = token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA), MODEL, limit=400).collect()
    want = [(i, len((t or "").encode()), len(counter.model.encode(t or ""))) for i, t, *_ in rows]
    assert sorted([tuple(r)[:3] for r in got], key=repr) == sorted(want, key=repr)
    assert all(r.over_limit == (r.n_tokens > 400) for r in got) and any(r.over_limit for r in got)
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA), MODEL).count() == 0


def negatives_by_hand(rows):
    sound = [(v, (l + 1) % 10 if v % 7 == 0 else l, [math.floor(256 * x) for x in e]) for v, l, e in rows
             if v is not None and l is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out, seen = [], set()
    for v, label, e in sorted(sound):
        if v % 50 or v in seen:
            continue
        seen.add(v)
        scored = [(-dot(e, f), w, m == label) for w, m, f in sound if w != v]
        for p, w, _ in sorted(x for x in scored if x[2])[:5]:
            fits = sorted((n, u) for n, u, same in scored if not same and 50 * -p <= 100 * -n <= 95 * -p)[:3]
            out += [(v, w, i + 1, u, -p, -n) for i, (n, u) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("anchors, sample", [(2048, 2048), (3, 20), (3, 0)])
def test_hard_negatives(spark, monkeypatch, anchors, sample):
    """Blocks of anchors and thresholds from any sample give the rows of the plain search; ties, odd and repeated rows too."""
    draw = random.Random(3)
    rows = [(i, draw.randrange(4), [draw.gauss(0.3, 0.5) for _ in range(9)]) for i in range(400)]
    rows += [(i, 9, [1.0] * 9) for i in range(500, 520)] + [(i, 8, [0.7] * 9) for i in range(520, 560)]
    rows += [(600, None, [1.0] * 9), (650, 1, None), (700, 1, [1.0, None] + [0.0] * 7), (750, 1, [float("nan")] * 9), (800, 1, [float("inf")] * 9)]
    rows += [(850, 3, [0.0] * 9), (900, 5, [0.4] * 5), (950, 2, []), (None, 2, [1.0] * 9), (101, 2, rows[101][2])]
    table = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id bigint, label int, embedding array<float>, rank string, score double")
    monkeypatch.setattr(hard_negatives, "SAMPLE", sample)
    monkeypatch.setattr(hard_negatives, "CHUNK", 64)
    plain = [tuple(r)[:3] for r in table.collect()]
    got = sorted(map(tuple, hard_negatives.mine(table.repartition(3), anchors).collect()))
    assert got == negatives_by_hand(plain) and len(got) > 60
    assert hard_negatives.mine(table.filter("false")).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, i % 2, [1e6 + i, 3e5 * (i % 5), 7.0]) for i in range(101)]
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    assert sorted(map(tuple, hard_negatives.mine(table).collect())) == negatives_by_hand(rows)


def test_pruned_pairs_reach_no_threshold():
    draw = np.random.default_rng(4)
    rows, anchors = draw.integers(-50, 50, (300, 40)), draw.integers(-50, 50, (20, 40))
    rows[:100, 20:] = 0
    scores = anchors @ rows.T
    for least in (np.full(20, 9000), np.quantile(scores, 0.99, axis=1).astype(np.int64), np.full(20, -(2**63))):
        a, r, score = hard_negatives.Index(rows, anchors, least).pairs(np.ones(scores.shape, bool))
        assert set(zip(a.tolist(), r.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(scores >= least[:, None]))))
        assert (score == scores[a, r]).all()


def test_hashes_of_regular_texts():
    texts = [thue_morse(n, letters) for n in (1024, 2048, 4096) for letters in ("ab", "ba")] + ["a", "a\0", "", "\0", "\0" * 9]
    data, offsets = arrays.utf8(pa.array(texts))
    for seed in (0, 1):
        assert len(set(arrays.hashes(data, offsets[:-1], offsets[1:], seed).tolist())) == len(texts)


@pytest.mark.parametrize("weak", [False, True])
def test_ids_of_texts_that_share_hashes(monkeypatch, weak):
    """A memo hit counts only if the bytes are the same."""
    if weak:
        strong = arrays.hashes
        monkeypatch.setattr(arrays, "hashes", lambda d, s, e, seed=0: strong(d, s, e, seed) % np.uint64(40 if seed < 3 else 2**63))
    known = token_blocks.Known(public_tokenizers.path("byte_bpe_50k.json"), most_bytes=3000)
    texts = [thue_morse(1024), thue_morse(1024, "ba"), None, "", "one two  three\n", "é ü 日本 x", " a b a b c"] * 2
    want = [x.ids + [0] for x in known.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):
        ids, sizes = token_blocks.encode_texts(pa.array(texts), known)
        assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_a_full_memo_keeps_what_was_met_again():
    path = public_tokenizers.path("byte_bpe_50k.json")
    known, plain, learnt = token_blocks.Known(path, most=300), token_blocks.tokenizer(path), []
    known.encode = lambda texts: learnt.extend(texts) or plain.encode_batch_fast(texts, add_special_tokens=False)
    for i in range(40):
        text = "often met words " + " ".join(f"once{i}x{j}" for j in range(20))
        ids, _ = token_blocks.encode_texts(pa.array([text]), known)
        assert ids[:-1].tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(known.keys) <= 300
    assert sum(text.count(" met") for text in learnt) == 1



def test_words_that_share_a_hash_are_no_hit(spark, monkeypatch):
    docs = spark.createDataFrame([(1, thue_morse(1024)), (2, thue_morse(1024, "ba"))], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, thue_morse(1024))], "item_id bigint, text string")
    assert {r.doc_id: r.contaminated for r in suffix_search.contamination(docs, items).collect()} == {1: True, 2: False}
    # Words that only share their hash, with a hash that a fifth of all words share.
    items_ = [(1, np.array([7], np.uint64), np.array([3]), b"abc")]
    tests = suffix_search.Tests(items_)
    data = np.frombuffer(b"abcxyz", np.uint8)
    starts, ends = np.array([0, 3]), np.array([3, 6])
    assert tests.number(np.array([7, 7], np.uint64), data, starts, ends).tolist() == [1, 0]


def mix_by_hand(rows):
    """(doc_id, taken, first_slot) of rows (doc_id, source, size, spot)."""
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(r[2] for r in rows if r[1] == s) for s in names}
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= 2 * size[s]}
        for s in full or open_:
            target[s] = 2.0 * size[s] if full else left * weight[s] / total
        left -= sum(2 * size[s] for s in full)
        open_ = open_ - full if full else set()
    quota = {s: math.floor(target[s]) for s in names}
    blocks = {s: -(-quota[s] // mixing.BLOCK) for s in names}
    slots, all_quota = sum(blocks.values()), sum(quota.values())
    edges = np.cumsum([quota[s] for s in names])[:-1] / max(all_quota, 1)
    order, drawn = {s: [] for s in names}, Counter()
    for i in range(slots):
        point = (i + 1) * mixing.GOLDEN
        order[names[np.searchsorted(edges, point - math.floor(point), side="right")]].append(i)
    more = slots
    for s in names:
        while len(order[s]) < blocks[s]:
            order[s].append(more)
            more += 1
    out = []
    for s in names:
        place = 0
        for doc, _, n, spot in sorted((r for r in rows if r[1] == s), key=lambda r: (r[3] % 2**64, r[0])):
            taken, first = 0, None
            for start in (place, place + size[s]):
                stop = min(start + n, quota[s])
                for b in range(start // mixing.BLOCK, -(-stop // mixing.BLOCK)) if start < stop else ():
                    part = min(stop, (b + 1) * mixing.BLOCK) - max(start, b * mixing.BLOCK)
                    taken += part
                    first = min(order[s][b], first) if first is not None else order[s][b]
            out.append((doc, taken, first))
            place += n
    return sorted(out), target


@pytest.mark.parametrize("sources", [1, 4, 300])
def test_every_row_of_the_mix(spark, sources):
    draw = random.Random(sources)
    rows = [(i, "w " * draw.choice([0, 1, 40, 900]), "s%03d" % draw.randrange(sources) if i % 9 else None, 1, 0.0) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, taken int, slot double")
    sized = [(r.doc_id, r.source, r["size"], r.spot) for r in mixing.sizes(docs).collect()]
    want, target = mix_by_hand(sized)
    got = mixing.mixed_sizes(docs).collect()
    assert sorted((r.doc_id, r.taken, r.first_slot) for r in got) == want
    assert {r.doc_id: r.target for r in got} == {d: pytest.approx(target[s]) for d, s, *_ in sized}
    slots = mixing.slots(docs)
    words = {r.doc_id: r.n for r in slots.groupBy("doc_id").agg(F.sum("words").alias("n")).collect()}
    assert words == {d: n for d, n, _ in want if n}
    assert slots.groupBy("slot").agg(F.count_distinct("source", "block").alias("n"), F.sum("words").alias("words")).filter("n > 1 or words > 512").count() == 0


def test_sources_without_limit(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "'a b c' AS text", "concat('s', id) AS source")
    got = mixing.mixed_sizes(rows).agg(F.count(F.lit(1)), F.min("taken"), F.max("taken")).first()
    assert tuple(got)[0] == 20_000 and 0 < tuple(got)[2] <= 6


def spans_by_hand(text):
    """Entropy spans from the definition, window by window."""
    out = []
    for run in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        spans = []
        for i in range(len(run[0]) - 19):
            part = run[0][i : i + 20]
            entropy = -sum(c / 20 * math.log2(c / 20) for c in Counter(part).values())
            digits, capitals = len(re.findall("[0-9]", part)), len(re.findall("[A-Z]", part))
            if digits == 20:
                limit = math.inf
            elif digits and re.fullmatch("[0-9a-fA-F]*", part):
                limit = 3.0
            elif digits:
                limit = 3.8 if re.search("[+/_=-]", part) else 3.7
            else:
                limit = 3.7 if 4 <= capitals <= 16 and part.isalpha() else math.inf
            if entropy > limit:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + 20
                else:
                    spans.append([i, i + 20])
        out += [("entropy", run.start() + a, run.start() + b) for a, b in spans if not secret_scan.allowed(run[0], a, b)]
    return out


def test_entropy_spans(spark):
    draw = random.Random(6)
    signs = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
    texts = [" é ".join("".join(draw.choices(signs[: draw.choice([26, 52, 62, 67])], k=draw.randint(5, 60))) for _ in range(6)) for _ in range(80)]
    texts += ["zXqLmRtWvKpYsBdNcHgJfTrQwEyUi", "k=/home/sample/aZ9qLm2Rt7Wv4Kp8Ys1Bd6Xc3", "a" * 60000 + "1", "aB3" * 20000]
    rows = secret_scan.secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    for r in rows:
        base = secret_scan.base_spans(texts[r.doc_id])
        added = [s for s in spans_by_hand(texts[r.doc_id]) if not any(b[1] <= s[1] and s[2] <= b[2] for b in base)]
        assert [x for x in r.spans.split(",") if x.startswith("entropy")] == [f"{k}:{a}:{b}" for k, a, b in added]
    found = {r.doc_id for r in rows if "entropy" in r.spans}
    assert {80, 81} <= found and len(found) > 40


def test_names_and_numbers_are_no_secrets():
    for text in ("getElementsByClassNameAndOtherThings", "HTTPServerConnectionFactory12", "id=123e4567-e89b-12d3-a456-426614174000",
                 "this/is/a/long/path/of/words2024", "12345678901234567890123", "internationalizationlongword"):
        assert secret_scan.all_spans(text, []) == []
