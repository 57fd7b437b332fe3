"""Hand-derived cases for normalisation, tokens, sentiment and filters."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postwave.functions import sentiment, stem, text, tokens
from postwave.functions.stem import porter, stem_text
from postwave.operators import filters
from postwave.operators.trending import hashtag_words
from postwave.sources.posts import posts_from_rows


@pytest.mark.parametrize("given, expected", [
    ("Nice:)", "nicegood"),
    ("a ->dd b ->d c", "agood bgood c"),
    ("( ->)", "(good"),
    ("(- ->)", "good)"),
    ("x ->&gt;)", "xsad)"),
    ("&lt;3 8) ;-)", "good good good"),
    ("\U0001F603\U0001F61F\U0001F622☺", "goodbadsadgood"),
    ("8:))", "8good)"),
    (":( ->(", ":good("),
    (" ->S", " ->s"),
    ("plain", "plain"),
    ("", ""),
])
def test_sentiment_words(value, given, expected):
    assert value(text.normalize_sentiment, given) == expected


def test_sentiment_words_equal_one_by_one_replacement(spark):
    """The grouped form against literal replacement, longest first, over all pairs of keys."""
    from pyspark.sql import functions as F

    keys = list(text.SENTIMENT_WORDS)
    rows = [(a + glue + b,) for a in keys for b in keys for glue in ("", "x", ")", ";", " ", "(")]
    df = spark.createDataFrame(rows, "t string")
    got = df.select("t", text.normalize_sentiment(F.col("t")).alias("v")).collect()
    for row in got:
        want = row.t.lower()
        for k, v in text.longest_first(text.SENTIMENT_WORDS.items()):
            want = want.replace(k, v)
        assert row.v == want, row.t


@pytest.mark.parametrize("given, expected", [
    ("u can't", "you can not"),
    ("U U u", "you you you"),
    ("You're haha hahaha hahahaha", "you are ha ha hahahaha"),
    ("cannot wouldn't won't", "can not would not will not"),
    ("but under us", "but under us"),
    ("éu u", "éu you"),
])
def test_short_forms(value, given, expected):
    assert value(text.normalize_short_forms, given) == expected


@pytest.mark.parametrize("given, expected", [
    ("soooo goood", "soo good"),
    ("@bob http://x.y/z a-b_c", "username url a b c"),
    ("https://x.y", "https://x.y"),
    ("ééé 111", "ééé 111"),
])
def test_noise(value, given, expected):
    assert value(text.normalize_noise, given) == expected


@pytest.mark.parametrize("given, expected", [
    ("a b!  ", ["a", "b"]),
    ("", [""]),
    (" ", []),
    (" a  b", ["", "a", "", "b"]),
    ("café! - x", ["caf", "", "x"]),
    ("a !", ["a", ""]),
])
def test_unigrams(value, given, expected):
    assert value(tokens.unigrams, given) == expected


@pytest.mark.parametrize("n, given, expected", [
    (2, "a b c. d.", ["a b", "b c", "d"]),
    (3, "a b c d. e f", ["a b c", "b c d", "e f"]),
    (2, "", [""]),
    (2, "...", []),
    (2, "a..b", ["a", "", "b"]),
    (2, "a. .", ["a", ""]),
    (2, "\n a b \t. ! c", ["a b", " c"]),
    (2, "one", ["one"]),
])
def test_ngrams(value, n, given, expected):
    assert value(lambda c: tokens.ngrams(c, n), given) == expected


def test_tokens_follow_the_split_rules(spark):
    """Unigrams and n-grams against a direct rendering of the rules, on random short strings."""
    import random
    import re

    from pyspark.sql import functions as F

    def split(s, ch):
        if s == "":
            return [""]
        parts = s.split(ch)
        while parts and parts[-1] == "":
            parts.pop()
        return parts

    def unigrams(s):
        return [re.sub(r"\W+", "", w, flags=re.ASCII) for w in split(s, " ")]

    def ngrams(s, n):
        out = []
        for sentence in split(s, "."):
            u = unigrams(sentence.strip("".join(map(chr, range(0x21)))))
            out += [" ".join(u[i:i + n]) for i in range(max(len(u) - n + 1, 1))]
        return out

    rng = random.Random(7)
    rows = [("".join(rng.choice("ab..  \n\t!é_") for _ in range(rng.randrange(12))),) for _ in range(3000)]
    df = spark.createDataFrame(rows, "t string").distinct()
    for r in df.select("t", tokens.unigrams(F.col("t")).alias("u"), tokens.bigrams(F.col("t")).alias("b"),
                       tokens.trigrams(F.col("t")).alias("c")).collect():
        assert (r.u, r.b, r.c) == (unigrams(r.t), ngrams(r.t, 2), ngrams(r.t, 3)), repr(r.t)


PORTER = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss
fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration
valenci valenc digitizer digit conformabli conform radicalli radic differentli differ vileli vile
analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis
hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic
formative form formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv
allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit
replacement replac adjustment adjust dependent depend adoption adopt homologou homolog communism commun activate activ
angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas
controll control roll roll by by syzygy syzygi running. running.""".split()


def test_porter_examples():
    """The examples of the published algorithm."""
    pairs = dict(zip(PORTER[::2], PORTER[1::2]))
    assert {w: porter(w) for w in pairs} == pairs


@pytest.mark.parametrize("given, expected", [
    ("running dogs  ", "run dog"), (" flies", " fli"), ("running. dogs", "running. dog"), ("", ""), ("   ", ""),
])
def test_stem_text(value, given, expected):
    assert value(stem_text, given) == expected


def test_stem_null(value):
    assert value(stem_text, None) is None


@pytest.mark.parametrize("given, label, neutral", [
    ("hi :)", 1.0, False), ("hi :(", 0.0, False), ("hi", 0.0, True), (":( :)", 1.0, False), ("hi ;-)", 1.0, False),
    (":-(", 0.0, False), (": )", 0.0, True),
])
def test_labels(value, given, label, neutral):
    assert value(sentiment.emoticon_label, given) == label
    assert value(sentiment.is_neutral, given) is neutral


def test_predicates_equal_their_patterns(spark):
    from pyspark.sql import functions as F

    parts = [":", ";", "-", ")", "(", "x"]
    rows = [(a + b + c + d,) for a in parts for b in parts for c in parts for d in parts]
    t = F.col("t")
    wrong = [
        sentiment.is_positive(t) != t.rlike(sentiment.any_of(sentiment.POSITIVE_EMOTICONS)),
        sentiment.is_negative(t) != t.rlike(sentiment.any_of(sentiment.NEGATIVE_EMOTICONS)),
    ]
    assert spark.createDataFrame(rows, "t string").filter(wrong[0] | wrong[1]).count() == 0


def test_label_emoticons_can_be_dropped(value):
    assert value(sentiment.without_label_emoticons, "a :):) b ;-( c :-(") == "a  b ;-( c "


def post(i, text="x", lang="en", user_lang="en", retweet=False):
    from datetime import datetime

    return (i, datetime(2024, 1, 1), text, lang, user_lang, retweet)


def test_filters(spark):
    posts = posts_from_rows(spark, [
        post(1), post(2, lang="it"), post(3, lang="nl"), post(4, retweet=True), post(5, user_lang="de"),
    ])
    ids = lambda df: sorted(r.post_id for r in df.collect())
    assert ids(filters.in_languages(posts)) == [1, 3, 4, 5]
    assert ids(filters.originals(posts)) == [1, 2, 3, 5]
    assert ids(filters.english_originals(posts)) == [1, 2, 3]
    assert posts_from_rows(spark, []).columns == posts.columns


def test_hashtag_words(spark):
    posts = posts_from_rows(spark, [post(1, "#a #A, # a#b x"), post(2, "none")])
    assert sorted(r.hashtag for r in hashtag_words(posts).collect()) == ["#", "#A,", "#a"]


def test_stems_by_parts_of_bounded_bytes():
    rng = random.Random(5)
    texts = [None, "", " ", "running  dogs", "a" * 200 + "ing"] + [" ".join(rng.choice(["hopping", "flies", "relational", "x"]) for _ in range(rng.randrange(40))) for _ in range(200)]
    array = pa.array(texts, pa.string()).slice(1).slice(0, 203)
    known = {}
    parts = list(stem._parts(array, 500))
    assert len(parts) > 10 and pa.concat_arrays(parts).to_pylist() == array.to_pylist()
    longest = max(len(t) for t in texts if t)
    assert all(sum(len(t or "") for t in p.to_pylist()) <= 500 + longest for p in parts)
    got = [x for p in parts for x in stem._stem_texts(p, known).to_pylist()]
    assert got == [t if t is None else " ".join(stem.porter(w) for w in t.split(" ")) for t in array.to_pylist()]
    assert max(map(len, known)) <= stem.KNOWN_LENGTH
    for i in range(stem.KNOWN_WORDS + 10):
        stem._stem(f"w{i}", known)
    assert len(known) <= stem.KNOWN_WORDS


def test_short_forms_in_few_passes(spark):
    """Few passes give what replacing one short form after the other does."""
    assert len(text.short_form_patterns()) < len(text.SHORT_FORMS) / 2
    rng, parts = random.Random(5), [*text.SHORT_FORMS, *text.SHORT_FORMS.values(), "'", " ", " ", "-", "re", "t", "n't", "."]
    posts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(3000)]

    def one_by_one(post):
        for key, word in text.SHORT_FORMS.items():
            post = re.sub(rf"\b{key}\b", word, post)
        return post

    found = spark.createDataFrame([(p,) for p in posts], "text string").select("text", text.expand_short_forms(F.col("text")).alias("long"))
    assert [(r.text, r.long) for r in found.collect() if r.long != one_by_one(r.text)] == []
