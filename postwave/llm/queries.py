"""The registered query of each operator of this subpackage, over whole tables, and the SQL of those that SQL can express."""

import public_tokenizers
from pyspark.sql import functions as F

from . import (
    backoff,
    hard_negatives,
    lexical_rank,
    line_chunks,
    mixing,
    near_copies,
    paragraph_sketch,
    quality,
    secret_scan,
    suffix_search,
    token_blocks,
    token_counts,
    toxicity,
)


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_blocks(spark, folder):
    return token_blocks.token_table(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_backoff_scores(spark, folder):
    scores = backoff.score_documents(table(spark, folder, "documents"))
    return scores.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


def op3_near_copies(spark, folder):
    return near_copies.classes(table(spark, folder, "documents")).select("doc_id", "class_id")


def op4_suffix_decontamination(spark, folder):
    return suffix_search.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_toxicity(spark, folder):
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_secrets(spark, folder):
    return secret_scan.secrets(table(spark, folder, "documents"))


def op7_paragraph_sketch(spark, folder):
    return paragraph_sketch.compare_documents(table(spark, folder, "documents"))


def op8_quality(spark, folder):
    return quality.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_line_chunks(spark, folder):
    return line_chunks.passage_summary(table(spark, folder, "documents"))


def op10_source_mix(spark, folder):
    return mixing.mixed_sizes(table(spark, folder, "documents"))


def op11_lexical_top(spark, folder):
    return lexical_rank.best_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_token_counts(spark, folder):
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_hard_negatives(spark, folder):
    return hard_negatives.mine(table(spark, folder, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_blocks,
        op2_backoff_scores,
        op3_near_copies,
        op4_suffix_decontamination,
        op5_toxicity,
        op6_secrets,
        op7_paragraph_sketch,
        op8_quality,
        op9_line_chunks,
        op10_source_mix,
        op11_lexical_top,
        op12_token_counts,
        op13_hard_negatives,
    )
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_list(column):
    return rf"regexp_extract_all(translate(coalesce({column}, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


BACKOFF_SQL = f"""
WITH d AS (SELECT doc_id, {word_list("text")} AS ws FROM documents),
w AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, ws[i] AS g1,
        CASE WHEN i > 1 THEN ws[i - 1] || ' ' || ws[i] END AS g2,
        CASE WHEN i > 2 THEN ws[i - 2] || ' ' || ws[i - 1] || ' ' || ws[i] END AS g3 FROM w),
c AS (SELECT doc_id, i, g2, g3,
        count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY g1, doc_id) AS c1,
        count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY g2, doc_id) AS c2,
        count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY g3, doc_id) AS c3,
        count(*) OVER () AS n, count(*) OVER (PARTITION BY doc_id) AS own FROM g),
h AS (SELECT *, lag(c1) OVER (PARTITION BY doc_id ORDER BY i) AS h2, lag(c2) OVER (PARTITION BY doc_id ORDER BY i) AS h3 FROM c),
s1 AS (SELECT *, CASE WHEN c1 > 0 THEN c1::double / (n - own) ELSE 0.4::double / n END AS p1 FROM h),
s2 AS (SELECT *, CASE WHEN g2 IS NULL THEN p1 WHEN c2 > 0 THEN c2::double / h2 ELSE 0.4::double * p1 END AS p2 FROM s1),
s3 AS (SELECT doc_id, CASE WHEN g3 IS NULL THEN p2 WHEN c3 > 0 THEN c3::double / h3 ELSE 0.4::double * p2 END AS p3 FROM s2),
t AS (SELECT doc_id, sum(ln(p3)) AS total FROM s3 GROUP BY doc_id)
SELECT d.doc_id, len(ws)::bigint AS n_words, round(coalesce(total, 0.0), 4) AS log_score, round(total / len(ws), 6) AS mean_log_score
FROM d LEFT JOIN t USING (doc_id)
"""

DECONTAMINATION_SQL = f"""
WITH b AS (SELECT item_id::varchar AS item, {word_list("text")} AS ws FROM benchmark),
i AS (SELECT item, ws, least(10, len(ws)) AS k FROM b WHERE len(ws) > 0),
p AS (SELECT item, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM i),
win AS (SELECT DISTINCT item, k, array_to_string(ws[s : s + k - 1], ' ') AS text FROM p),
d AS (SELECT doc_id, {word_list("text")} AS ws FROM documents),
q AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM i) WHERE len(ws) >= k),
hit AS (SELECT doc_id, q.k, s, item FROM (SELECT doc_id, k, s, array_to_string(ws[s : s + k - 1], ' ') AS text FROM q) q
        JOIN win ON q.k = win.k AND q.text = win.text),
word AS (SELECT DISTINCT doc_id, unnest(range(s, s + k)) AS at FROM hit),
n AS (SELECT doc_id, count(*) AS n_hit FROM word GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(ws)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

LEXICAL_SQL = rf"""
WITH terms AS (SELECT doc_id, unnest({word_list("text")}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
d AS (SELECT doc_id, sum(tf)::bigint AS n FROM tf GROUP BY doc_id),
s AS (SELECT count(*)::bigint AS docs, sum(n)::bigint AS terms FROM d),
m AS (SELECT doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM d, s),
q AS (SELECT item_id, unnest(list_distinct({word_list("text")})) AS term FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint AS w
  FROM tf JOIN (SELECT DISTINCT term FROM q) USING (term), s GROUP BY term, docs),
hits AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::int AS rank FROM hits WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

NEGATIVES_SQL = """
WITH sound AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::double) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::bigint AS score
  FROM sound a JOIN sound b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::int AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

SQL = {
    "op2_backoff_scores": BACKOFF_SQL,
    "op4_suffix_decontamination": DECONTAMINATION_SQL,
    "op11_lexical_top": LEXICAL_SQL,
    "op13_hard_negatives": NEGATIVES_SQL,
}
