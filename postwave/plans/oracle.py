"""The registered queries once more, as plain SQL over the sample tables.

These are checks, written the direct way: windows are spelled out end by end, literals replaced one at a time, words
looked at one by one, hashes computed with integer arithmetic.
"""

from ..functions.stem import STEP_2, STEP_3, STEP_4
from ..functions.text import SENTIMENT_WORDS, SHORT_FORMS, longest_first
from ..schema import FEATURE_WIDTH, SEARCH_SIZE, TRENDING_LANGS
from ..sources.tables import EPOCH, SECONDS_PER_POST
from .queries import KEYWORD, SAMPLE_CORPUS, SLIDE, TRAIN_STEPS
from .stream_queries import STEPS, STREAM_STEPS, TRAIN_BATCHES

POSTS = f"""posts AS (
  SELECT doc_id AS post_id, {EPOCH} + doc_id * {SECONDS_PER_POST} AS t,
    text || ' #' || source
      || CASE WHEN doc_id % 3 = 0 THEN ' #' || lang ELSE '' END
      || CASE WHEN doc_id % 5 IN (0, 1) THEN ' :)' WHEN doc_id % 5 = 2 THEN ' :(' ELSE '' END
      || CASE WHEN doc_id % 11 = 0 THEN ' don''t u' ELSE '' END
      || CASE WHEN doc_id % 13 = 0 THEN ' http://x.io/a_b soooo' ELSE '' END AS text,
    lang, lang AS user_lang, doc_id % 7 = 0 AS is_retweet
  FROM documents)"""

TAGGED_POSTS = f"""{POSTS}, tags AS (
  SELECT t, hashtag FROM (
    SELECT t, unnest(string_split(text, ' ')) AS hashtag FROM posts
    WHERE NOT is_retweet AND lang IN {TRENDING_LANGS}) WHERE starts_with(hashtag, '#'))"""

TAGGED_EVENTS = """tags AS (
  SELECT CAST(floor(epoch(ts)) AS BIGINT) AS t,
    '#' || event_type || '_' || CAST(user_id % 20 AS VARCHAR) AS hashtag FROM events)"""


def quoted(s):
    return "'" + s.replace("'", "''") + "'"


# Trending


def windows_sql(tags, slide, until=""):
    """Every window end, every hashtag in it, ranked."""
    width = 3600 // slide
    return f"""{tags}, buckets AS (
      SELECT hashtag, t // {slide} AS bucket, count(*) AS n FROM tags GROUP BY ALL),
    counts AS (
      SELECT hashtag, window_end, CAST(sum(n) AS BIGINT) AS count FROM (
        SELECT hashtag, n, unnest(range(bucket + 1, bucket + {width} + 1)) * {slide} AS window_end FROM buckets)
      {until} GROUP BY ALL),
    ranked AS (
      SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY count DESC, hashtag) AS INT) AS rank,
        hashtag, count FROM counts QUALIFY rank <= 10)"""


TOP_NOW = f"""{TAGGED_POSTS}, now AS (SELECT (max(t) // 5) * 5 + 5 AS e FROM posts),
  top AS (SELECT hashtag, count(*) AS count FROM tags, now WHERE t >= e - 3600 AND t < e
    GROUP BY hashtag ORDER BY count DESC, hashtag LIMIT 10)"""

PAYLOAD_ITEM = """'{"hashtag":"' || hashtag || '","count":' || count || '}'"""

DELTA = f"""WITH {TAGGED_EVENTS}, buckets AS (SELECT hashtag, t // 5 AS b, count(*) AS n FROM tags GROUP BY ALL),
  deltas AS (
    SELECT hashtag, b + 1 AS e, n FROM buckets UNION ALL SELECT hashtag, b + 721, -n FROM buckets),
  steps AS (SELECT hashtag, e, sum(n) AS d FROM deltas GROUP BY ALL)
  SELECT hashtag, e * 5 AS window_end, CAST(c AS BIGINT) AS count FROM (
    SELECT *, sum(d) OVER (PARTITION BY hashtag ORDER BY e) AS c FROM steps) WHERE d <> 0"""

# Text

POSITIVE = "(contains(text, ':)') OR contains(text, ':-)') OR contains(text, ';-)') OR contains(text, ';)'))"
NEGATIVE = "(contains(text, ':(') OR contains(text, ':-('))"


def sentiment_words(s):
    s = f"lower({s})"
    for key, word in longest_first(SENTIMENT_WORDS.items()):
        s = f"replace({s}, {quoted(key)}, '{word}')"
    return s


def short_forms(s):
    """Two passes, because neighbours share a boundary character."""
    s = f"lower({s})"
    edge = r"[^\p{L}\p{Nd}_]"
    for key, words in SHORT_FORMS.items():
        for _ in range(2):
            s = f"regexp_replace({s}, {quoted(f'(^|{edge}){key}({edge}|$)')}, '\\1{words}\\2', 'g')"
    return s


def noise(s):
    s = f"lower({s})"
    for c in "abcdefghijklmnopqrstuvwxyz":
        s = f"regexp_replace({s}, '{c}{c}{c}+', '{c}{c}', 'g')"
    s = rf"regexp_replace({s}, '@\S+', 'username', 'g')"
    s = rf"regexp_replace({s}, 'http://\S+', 'url', 'g')"
    return f"regexp_replace({s}, '[-_]', ' ', 'g')"


def normalized(s):
    return noise(short_forms(sentiment_words(s)))


def split_on(s, ch):
    """Split without trailing empty parts."""
    return (
        f"CASE WHEN {s} = '' THEN [''] WHEN rtrim({s}, '{ch}') = '' THEN CAST([] AS VARCHAR[]) "
        f"ELSE string_split(rtrim({s}, '{ch}'), '{ch}') END"
    )


def unigrams(s):
    return rf"list_transform({split_on(s, ' ')}, lambda w: regexp_replace(w, '\W+', '', 'g'))"


def ngrams(s, n):
    trimmed = r"regexp_replace(x, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
    sentences = f"list_transform({split_on(s, '.')}, lambda x: {trimmed})"
    words = f"list_transform({sentences}, lambda y: {unigrams('y')})"
    grams = (
        f"list_transform(range(1, greatest(len(u) - {n} + 1, 1) + 1), "
        f"lambda i: array_to_string(u[i:i + {n - 1}], ' '))"
    )
    return f"flatten(list_transform({words}, lambda u: {grams}))"


def both_grams(s):
    return f"list_concat({unigrams(s)}, {ngrams(s, 2)})"


def token_rows(clean, tokens):
    """One row per post about its tokens; ``clean`` defines the table clean(post_id, text)."""
    return f"""{clean}, tokens AS (SELECT post_id, {tokens} AS w FROM clean)
      SELECT post_id, CAST(len(w) AS BIGINT) AS tokens, CAST(len(list_distinct(w)) AS BIGINT) AS distinct_tokens,
        md5(array_to_string(w, '|')) AS digest FROM tokens"""


def raw_clean(name="posts"):
    return f"{POSTS}, clean AS (SELECT post_id, lang, text FROM {name})"


def normalized_clean():
    return f"{POSTS}, clean AS MATERIALIZED (SELECT post_id, lang, {normalized('text')} AS text FROM posts)"


# Stemming, one table per step


def shape(x):
    """'1' per vowel, '0' per consonant. The first y of a run is settled by what precedes it, then they alternate."""
    for pattern, new in (("(^|[aeiou])y", r"\1C"), ("yy", "VC"), ("y", "V"), ("[^aeiouV]", "0"), ("[^0]", "1")):
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    return x


def measure(x):
    return f"((length({shape(x)}) - length(replace({shape(x)}, '10', ''))) // 2)"


def has_vowel(x):
    return f"contains({shape(x)}, '1')"


def doubled(x):
    return f"(length({x}) > 1 AND right({x}, 1) = right(left({x}, -1), 1) AND ends_with({shape(x)}, '0'))"


def short_end(x):
    return f"(ends_with({shape(x)}, '010') AND right({x}, 1) NOT IN ('w', 'x', 'y'))"


def first_ending(rules):
    """CASE over suffixes, longest first: (suffix, condition on the rest, replacement)."""
    arms = ""
    for end, condition, new in sorted(rules, key=lambda r: -len(r[0])):
        rest = f"left(w, -{len(end)})"
        arms += f" WHEN ends_with(w, '{end}') THEN CASE WHEN {condition(rest)} THEN {rest} || '{new}' ELSE w END"
    return f"CASE{arms} ELSE w END"


def stems(words):
    """Tables that end in stems(word, stem) for the words of the table ``words``(word)."""
    positive = lambda r: f"{measure(r)} > 0"
    large = lambda r: f"{measure(r)} > 1"
    large_st = lambda r: f"{measure(r)} > 1 AND right({r}, 1) IN ('s', 't')"
    step_2 = first_ending([(k, positive, v) for k, v in STEP_2.items()])
    step_3 = first_ending([(k, positive, v) for k, v in STEP_3.items()])
    step_4 = first_ending([(k, large_st if k == "ion" else large, "") for k in STEP_4])
    return f"""s0 AS MATERIALIZED (SELECT DISTINCT word, word AS w FROM {words}),
    s1 AS (SELECT word, CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN left(w, -2)
        WHEN ends_with(w, 'ss') OR NOT ends_with(w, 's') THEN w ELSE left(w, -1) END AS w
      FROM s0 WHERE length(word) > 2),
    s2 AS (SELECT word, w, CASE WHEN ends_with(w, 'eed') THEN NULL
        WHEN ends_with(w, 'ed') AND {has_vowel('left(w, -2)')} THEN left(w, -2)
        WHEN ends_with(w, 'ing') AND {has_vowel('left(w, -3)')} THEN left(w, -3) END AS cut FROM s1),
    s3 AS (SELECT word, CASE
        WHEN ends_with(w, 'eed') THEN CASE WHEN {measure('left(w, -3)')} > 0 THEN left(w, -1) ELSE w END
        WHEN cut IS NULL THEN w
        WHEN right(cut, 2) IN ('at', 'bl', 'iz') THEN cut || 'e'
        WHEN {doubled('cut')} AND right(cut, 1) NOT IN ('l', 's', 'z') THEN left(cut, -1)
        WHEN {measure('cut')} = 1 AND {short_end('cut')} THEN cut || 'e' ELSE cut END AS w FROM s2),
    s4 AS (SELECT word, CASE WHEN ends_with(w, 'y') AND {has_vowel('left(w, -1)')}
        THEN left(w, -1) || 'i' ELSE w END AS w FROM s3),
    s5 AS (SELECT word, {step_2} AS w FROM s4),
    s6 AS (SELECT word, {step_3} AS w FROM s5),
    s7 AS (SELECT word, {step_4} AS w FROM s6),
    s8 AS (SELECT word, CASE WHEN ends_with(w, 'e') AND ({measure('left(w, -1)')} > 1
        OR ({measure('left(w, -1)')} = 1 AND NOT {short_end('left(w, -1)')})) THEN left(w, -1) ELSE w END AS w FROM s7),
    stems AS MATERIALIZED (
      SELECT word, CASE WHEN ends_with(w, 'll') AND {measure('w')} > 1 THEN left(w, -1) ELSE w END AS stem FROM s8
      UNION ALL SELECT word, word FROM s0 WHERE length(word) <= 2)"""


def stemmed_clean():
    """Normalised text with every word replaced by its stem."""
    return f"""{POSTS}, plain AS MATERIALIZED (
      SELECT post_id, lang, rtrim({normalized('text')}, ' ') AS text FROM posts),
    words AS MATERIALIZED (SELECT post_id, unnest(string_split(text, ' ')) AS word,
        generate_subscripts(string_split(text, ' '), 1) AS pos FROM plain),
    {stems('words')},
    clean AS MATERIALIZED (SELECT post_id, string_agg(stem, ' ' ORDER BY pos) AS text
      FROM words JOIN stems USING (word) GROUP BY post_id)"""


# Features and model

MASK = 4294967295


def times(x, c):
    return f"CAST(CAST({x} AS HUGEINT) * {c} % {MASK + 1} AS BIGINT)"


def rotated(x, r):
    return f"((({x} << {r}) | ({x} >> {32 - r})) & {MASK})"


def features():
    """Stemmed tokens hashed with 32-bit murmur3, seed 42: tf(post_id, idx, v). All tokens are ASCII."""
    code = "ascii(substr(token, CAST({} AS BIGINT), 1))"
    block = " + ".join(f"(CAST({code.format(f'4 * i + {j + 1}')} AS BIGINT) << {8 * j})" for j in range(4))
    mixed = "list_transform(k, lambda x: " + times("x", 3432918353) + ")"
    mixed = f"list_transform({mixed}, lambda x: {rotated('x', 15)})"
    mixed = f"list_transform({mixed}, lambda x: {times('x', 461845907)})"
    step = f"(({rotated('xor(h, x)', 13)} * 5 + 3864292196) & {MASK})"
    return f"""{stemmed_clean()}, grams AS MATERIALIZED (
      SELECT post_id, token, count(*) AS n FROM (
        SELECT post_id, unnest({both_grams('text')}) AS token FROM clean) GROUP BY ALL),
    m0 AS (SELECT token, length(token) AS bytes,
        list_transform(range(length(token) // 4), lambda i: {block})
        || list_transform(range(length(token) - length(token) % 4, length(token)),
            lambda i: CAST({code.format('i + 1')} AS BIGINT)) AS k
      FROM (SELECT DISTINCT token FROM grams)),
    m1 AS (SELECT token, bytes, {mixed} AS k FROM m0),
    m2 AS (SELECT token, xor(list_reduce(k, lambda h, x: {step}, CAST(42 AS BIGINT)), bytes) AS h FROM m1),
    m3 AS (SELECT token, {times('xor(h, h >> 16)', 2246822507)} AS h FROM m2),
    m4 AS (SELECT token, {times('xor(h, h >> 13)', 3266489909)} AS h FROM m3),
    m5 AS (SELECT token, xor(h, h >> 16) AS h FROM m4),
    hashed AS (SELECT token, CAST(((CASE WHEN h > 2147483647 THEN h - {MASK + 1} ELSE h END) % {FEATURE_WIDTH}
        + {FEATURE_WIDTH}) % {FEATURE_WIDTH} AS INT) AS idx FROM m5),
    tf AS MATERIALIZED (SELECT post_id, idx, CAST(sum(n) AS BIGINT) AS v
      FROM grams JOIN hashed USING (token) GROUP BY ALL)"""


def idf(name, members):
    """name(idx, df, weight) and name_m(m) over the posts of ``members``."""
    return f"""{name}_m AS (SELECT count(*) AS m FROM {members}),
    {name} AS MATERIALIZED (SELECT idx, df, ln((m + 1) / (df + 1)) AS weight FROM (
      SELECT idx, count(*) AS df FROM tf SEMI JOIN {members} USING (post_id) GROUP BY idx), {name}_m)"""


TRAINING = f"""training AS MATERIALIZED (
  SELECT post_id, text, CASE WHEN {POSITIVE} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y FROM posts
  WHERE ({POSITIVE} OR {NEGATIVE}) AND user_lang = 'en' AND NOT is_retweet)"""

QUALITY = """training AS MATERIALIZED (
  SELECT post_id, text, CAST(quality AS DOUBLE) AS y FROM posts JOIN labels ON post_id = doc_id
  WHERE user_lang = 'en' AND NOT is_retweet)"""


def descent(steps, training=TRAINING):
    """Tables w1 .. w<steps>(idx, weight), from zero weights."""
    sql = f"{training}, w0 AS (SELECT idx, 0.0::DOUBLE AS weight FROM range({FEATURE_WIDTH}) AS r(idx))"
    for i in range(1, steps + 1):
        sql += f""", e{i} AS MATERIALIZED (
          SELECT post_id, 1 / (1 + exp(-coalesce(margin, 0))) - y AS e FROM training LEFT JOIN (
            SELECT post_id, sum(v * weight) AS margin FROM tf JOIN w{i - 1} USING (idx) GROUP BY post_id)
          USING (post_id)),
        w{i} AS MATERIALIZED (SELECT idx, weight - coalesce(g, 0) / (SELECT count(*) FROM training) / sqrt({i}) AS weight
          FROM w{i - 1} LEFT JOIN (SELECT idx, sum(e * v) AS g FROM tf JOIN e{i} USING (post_id) GROUP BY idx)
          USING (idx))"""
    return sql


def scores(steps=1, training=TRAINING):
    """Table scored(post_id, p): predictions on TF-IDF features with the IDF of the training posts."""
    return f"""{features()}, {descent(steps, training)}, {idf('fit', 'training')},
    scored AS MATERIALIZED (SELECT post_id, CASE WHEN 1 / (1 + exp(-coalesce(margin, 0))) > 0.5
        THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p
      FROM posts LEFT JOIN (
        SELECT post_id, sum(v * coalesce(fit.weight, ln(m + 1)) * w.weight) AS margin
        FROM tf JOIN w{steps} AS w USING (idx) LEFT JOIN fit USING (idx), fit_m GROUP BY post_id) USING (post_id))"""


def metrics(steps=1, training=TRAINING):
    return f"""{scores(steps, training)}, stats AS (SELECT 'Online' AS trainer,
      'org.apache.spark.mllib.classification.LogisticRegressionModel: intercept = 0.0, '
        || 'numFeatures = {FEATURE_WIDTH}, numClasses = 2, threshold = 0.5' AS model,
      round((count(*) FILTER (p = 1 AND y = 1) / count(*) FILTER (y = 1)
        + count(*) FILTER (p = 0 AND y = 0) / count(*) FILTER (y = 0)) / 2, 6) AS "areaUnderRoc",
      round(count(*) FILTER (p = y) / count(*), 6) AS accuracy
    FROM scored JOIN training USING (post_id))"""


FOUND = f"""found AS (SELECT post_id, t, text FROM posts
  WHERE lang = 'en' AND NOT is_retweet AND contains(lower(text), '{KEYWORD}')
  ORDER BY t DESC, post_id LIMIT {SEARCH_SIZE})"""

CLASSIFIED = f"""{scores()}, {FOUND}, result AS (
  SELECT t, post_id, text AS tweet, CASE WHEN p = 1 THEN '1.0' ELSE '0.0' END AS sentiment FROM found JOIN scored USING (post_id))"""

# Corpus

def batches_sql(size):
    """The corpus collected from batches of ``size`` consecutive ids."""
    return f"""{POSTS}, {TRAINING}, sized AS (
  SELECT y AS sentiment, post_id // {size} AS batch, count(*) AS n FROM training GROUP BY ALL),
kept AS (SELECT sentiment, batch, n FROM (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY sentiment ORDER BY batch
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized) WHERE before < {SAMPLE_CORPUS // 2}),
corpus AS (SELECT post_id, y AS sentiment, post_id // {size} AS batch FROM training
  SEMI JOIN kept ON y = kept.sentiment AND post_id // {size} = kept.batch)"""


BATCHES = batches_sql(20)

PROGRESS = f"""WITH {BATCHES}, reached AS (
  SELECT b.batch, CAST(coalesce(sum(n) FILTER (sentiment = 1), 0) AS BIGINT) AS positive,
    CAST(coalesce(sum(n) FILTER (sentiment = 0), 0) AS BIGINT) AS negative
  FROM (SELECT DISTINCT batch FROM sized) b JOIN kept ON kept.batch <= b.batch GROUP BY b.batch)
SELECT batch, positive, negative, CAST({SAMPLE_CORPUS} AS BIGINT) AS total FROM reached
WHERE batch <= coalesce((SELECT min(batch) FROM reached
  WHERE positive >= {SAMPLE_CORPUS // 2} AND negative >= {SAMPLE_CORPUS // 2}), batch)"""


def normal_query(expression):
    return f"WITH {POSTS} SELECT post_id, {expression('text')} AS text FROM posts"


BATCH_SQL = {
    "trending_top10": f"WITH {TOP_NOW} SELECT * FROM top",
    "trending_windows_top10": f"WITH {windows_sql(TAGGED_POSTS, SLIDE)} SELECT * FROM ranked",
    "trending_windows_top10_events": f"WITH {windows_sql(TAGGED_EVENTS, SLIDE)} SELECT * FROM ranked",
    "trending_delta_5s": DELTA,
    "trending_time_in_top10_5s": f"""WITH {windows_sql(TAGGED_EVENTS, 5)}
      SELECT hashtag, count(*) AS windows, min(rank) AS best_rank, max(count) AS peak FROM ranked GROUP BY hashtag""",
    "trending_payload_ordered": f"""WITH {TOP_NOW}
      SELECT '[' || string_agg({PAYLOAD_ITEM}, ',' ORDER BY count DESC, hashtag) || ']' AS value FROM top""",
    "trending_payload_windows": f"""WITH {windows_sql(TAGGED_POSTS, SLIDE)}
      SELECT window_end, '[' || string_agg({PAYLOAD_ITEM}, ',' ORDER BY rank) || ']' AS value
      FROM ranked GROUP BY window_end""",
    "trending_payload_set": f"""WITH {TOP_NOW}
      SELECT '{{"collect_set(hashtag_and_count)":[' || string_agg({PAYLOAD_ITEM}, ',' ORDER BY hashtag) || ']}}' AS value
      FROM top""",
    "trending_languages": f"""WITH {POSTS} SELECT lang, count(*) AS posts FROM posts
      WHERE NOT is_retweet AND lang IN {TRENDING_LANGS} GROUP BY lang""",
    "english_originals": f"""WITH {POSTS} SELECT post_id, user_lang FROM posts
      WHERE user_lang = 'en' AND NOT is_retweet""",
    "tracked_posts": f"WITH {POSTS} SELECT post_id, text FROM posts WHERE {POSITIVE} OR {NEGATIVE}",
    "keyword_search": f"WITH {POSTS}, {FOUND} SELECT '{KEYWORD}' AS keyword, text FROM found",
    "emoticon_labels": f"""WITH {POSTS} SELECT post_id, {POSITIVE} AS positive, {NEGATIVE} AS negative,
      NOT ({POSITIVE} OR {NEGATIVE}) AS neutral,
      CASE WHEN {POSITIVE} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS sentiment FROM posts""",
    "sentiment_mix": f"""WITH {POSTS} SELECT lang, CASE WHEN {POSITIVE} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS sentiment,
      count(*) AS posts FROM posts GROUP BY ALL""",
    "labelled_union": f"""WITH {POSTS} SELECT CASE WHEN {POSITIVE} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS sentiment,
      count(*) AS count FROM posts GROUP BY ALL""",
    "normalize_emoticons": normal_query(sentiment_words),
    "normalize_shortforms": normal_query(short_forms),
    "normalize_noise": normal_query(noise),
    "normalize_all": normal_query(normalized),
    "unigrams": f"WITH {token_rows(raw_clean(), unigrams('text'))}",
    "bigrams": f"WITH {token_rows(raw_clean(), ngrams('text', 2))}",
    "trigrams": f"WITH {token_rows(raw_clean(), ngrams('text', 3))}",
    "token_pipeline": f"WITH {token_rows(normalized_clean(), both_grams('text'))}",
    "token_pipeline_stemmed": f"WITH {token_rows(stemmed_clean(), both_grams('text'))}",
    "term_frequency": f"""WITH {normalized_clean()}, terms AS (
        SELECT lang, term, count(*) AS count FROM (SELECT lang, unnest({both_grams('text')}) AS term FROM clean)
        GROUP BY ALL)
      SELECT lang, term, count, CAST(row_number() OVER (PARTITION BY lang ORDER BY count DESC, term) AS INT) AS rank
      FROM terms QUALIFY rank <= 20""",
    "stemmed_vocabulary": f"""WITH docs AS (SELECT lower(text) AS text FROM documents WHERE text IS NOT NULL),
      words AS (SELECT word, count(*) AS n FROM (SELECT unnest({split_on('text', ' ')}) AS word FROM docs) GROUP BY word),
      {stems('words')}
      SELECT stem, count(*) AS words, CAST(sum(n) AS BIGINT) AS occurrences
      FROM words JOIN stems USING (word) GROUP BY stem""",
    "balanced_corpus": f"WITH {BATCHES} SELECT * FROM corpus",
    "balanced_corpus_counts": f"WITH {BATCHES} SELECT sentiment, count(*) AS count FROM corpus GROUP BY sentiment",
    "corpus_progress": PROGRESS,
    "hashed_tf": f"""WITH {features()} SELECT post_id, count(*) AS buckets, CAST(sum(v) AS BIGINT) AS tokens,
      CAST(sum(idx * v) AS BIGINT) AS checksum FROM tf GROUP BY post_id""",
    "idf_weights": f"""WITH {features()}, {idf('fit', 'posts')}
      SELECT idx, df, round(weight, 6) AS weight FROM fit""",
    "tfidf": f"""WITH {features()}, {idf('fit', 'posts')}
      SELECT post_id, round(sum(v * weight), 6) AS total, round(max(v * weight), 6) AS largest
      FROM tf JOIN fit USING (idx) GROUP BY post_id""",
    "sgd_first_step": f"""WITH {features()}, {descent(1)}
      SELECT idx, round(weight, 6) AS weight FROM w1 WHERE weight <> 0""",
    "sgd_trained_weights": f"""WITH {features()}, {descent(TRAIN_STEPS)}
      SELECT idx, round(weight, 6) AS weight FROM w{TRAIN_STEPS} WHERE weight <> 0""",
    "sgd_trained_metrics": f"WITH {metrics(TRAIN_STEPS, QUALITY)} SELECT * FROM stats",
    "score_posts": f"WITH {scores()} SELECT post_id, CASE WHEN p = 1 THEN '1.0' ELSE '0.0' END AS sentiment FROM scored",
    "model_metrics": f"WITH {metrics()} SELECT * FROM stats",
    "model_metrics_json": f"""WITH {metrics()} SELECT '{{"trainer":"' || trainer || '","model":"' || model
      || '","areaUnderRoc":' || "areaUnderRoc" || ',"accuracy":' || accuracy || '}}' AS value FROM stats""",
    "length_auc": """WITH ranked AS (
        SELECT quality, rank() OVER (ORDER BY length(text)) + (count(*) OVER (PARTITION BY length(text)) - 1) / 2 AS r
        FROM documents JOIN labels USING (doc_id))
      SELECT round((sum(r) FILTER (quality = 1) - count(*) FILTER (quality = 1) * (count(*) FILTER (quality = 1) + 1) / 2)
        / (count(*) FILTER (quality = 1) * count(*) FILTER (quality = 0)), 6) AS auc FROM ranked""",
    "classify_keyword": f"WITH {CLASSIFIED} SELECT tweet, sentiment FROM result",
    "classification_payload": f"""WITH {CLASSIFIED} SELECT '{{"onlineModelResult":[' || string_agg(
      CAST(json_object('tweet', tweet, 'sentiment', sentiment) AS VARCHAR), ',' ORDER BY t DESC, post_id) || ']}}' AS value
      FROM result""",
}

def warm_descent(batches, steps):
    """Tables model<b>(idx, weight) after each of ``batches`` equal steps of time, each ``steps`` steps of descent on its posts."""
    sql = f"""{TRAINING}, edges AS (SELECT min(t) * 1000000 - 1 AS low, max(t) * 1000000 AS high FROM posts),
    parted AS MATERIALIZED (SELECT training.*, CAST(least(greatest(
        ceil((posts.t * 1000000 - low)::DOUBLE / ((high - low + {batches - 1}) // {batches})), 1), {batches}) AS INT) AS part
      FROM training JOIN posts USING (post_id), edges),
    model0 AS (SELECT idx, 0.0::DOUBLE AS weight FROM range({FEATURE_WIDTH}) AS r(idx))"""
    for b in range(1, batches + 1):
        for i in range(1, steps + 1):
            before, after = (f"model{b - 1}" if i == 1 else f"model{b}_{i - 1}"), (f"model{b}" if i == steps else f"model{b}_{i}")
            sql += f""", e{b}_{i} AS MATERIALIZED (
              SELECT post_id, 1 / (1 + exp(-coalesce(margin, 0))) - y AS e FROM parted LEFT JOIN (
                SELECT post_id, sum(v * weight) AS margin FROM tf JOIN {before} USING (idx) GROUP BY post_id)
              USING (post_id) WHERE part = {b}),
            {after} AS MATERIALIZED (SELECT idx,
                weight - coalesce(g, 0) / (SELECT count(*) FROM parted WHERE part = {b}) / sqrt({i}) AS weight
              FROM {before} LEFT JOIN (SELECT idx, sum(e * v) AS g FROM tf JOIN e{b}_{i} USING (post_id) GROUP BY idx)
              USING (idx))"""
    return sql


def stream_metrics(batches, steps):
    scored = " UNION ALL ".join(
        f"""SELECT {b}::BIGINT AS version, y, CASE WHEN 1 / (1 + exp(-coalesce(margin, 0))) > 0.5 THEN 1 ELSE 0 END AS p
          FROM training LEFT JOIN (SELECT post_id, sum(v * fit.weight * model{b}.weight) AS margin
            FROM tf JOIN fit USING (idx) JOIN model{b} USING (idx) GROUP BY post_id) USING (post_id)"""
        for b in range(1, batches + 1)
    )
    return f"""{features()}, {warm_descent(batches, steps)}, {idf('fit', 'training')}, scored AS ({scored}),
      c AS (SELECT version, count(*) FILTER (p = 1 AND y = 1) AS tp, count(*) FILTER (p = 0 AND y = 1) AS fn,
        count(*) FILTER (p = 1 AND y = 0) AS fp, count(*) FILTER (p = 0 AND y = 0) AS tn FROM scored GROUP BY version)
      SELECT version, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS "areaUnderRoc",
        round((tp + tn) / (tp + fn + fp + tn), 6) AS accuracy FROM c"""


# Where each batch of a replayed stream has got: the newest bucket that the watermark of the batch's posts has closed.
REACHED = f"""{TAGGED_EVENTS}, times AS (SELECT epoch_us(ts) AS us FROM events),
  edges AS (SELECT min(us) - 1 AS low, max(us) AS high FROM times),
  marks AS (SELECT (max(us) // 1000 - 600000) * 1000 AS mark
    FROM edges, range(1, {STEPS + 1}) AS s(i), times
    WHERE us <= least(low + i * ((high - low + {STEPS - 1}) // {STEPS}), high) GROUP BY i),
  ends AS (SELECT DISTINCT (max(t // {SLIDE}) + 1) * {SLIDE} AS e FROM marks JOIN tags
    ON (t // {SLIDE} + 1) * {SLIDE} * 1000000 <= mark GROUP BY mark)"""

STREAM_SQL = {
    "stream_trending": f"WITH {windows_sql(TAGGED_EVENTS, SLIDE)} SELECT * FROM ranked",
    "stream_payload": f"""WITH {windows_sql(TAGGED_EVENTS, SLIDE)}
      SELECT window_end, '[' || string_agg({PAYLOAD_ITEM}, ',' ORDER BY rank) || ']' AS value
      FROM ranked GROUP BY window_end""",
    "stream_time_in_top_5s": f"""WITH {windows_sql(TAGGED_EVENTS, 5)}
      SELECT hashtag, count(*) AS windows, min(rank) AS best_rank, max(count) AS peak FROM ranked GROUP BY hashtag""",
    "stream_live_top": f"""WITH {REACHED}, counts AS (SELECT e AS window_end, hashtag, count(*) AS count
        FROM ends JOIN tags ON t >= e - 3600 AND t < e GROUP BY ALL)
      SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY count DESC, hashtag) AS INT) AS rank,
        hashtag, count FROM counts QUALIFY rank <= 10""",
    "stream_tracked": f"""WITH {POSTS} SELECT lang, count(*) AS posts, CAST(sum(post_id) AS BIGINT) AS ids FROM posts
      WHERE {POSITIVE} OR {NEGATIVE} GROUP BY lang""",
    "stream_corpus": f"""WITH {POSTS}, {TRAINING} SELECT y AS sentiment, count(*) AS count FROM training GROUP BY y""",
    "stream_train": f"WITH {stream_metrics(TRAIN_BATCHES, STREAM_STEPS)}",
}
