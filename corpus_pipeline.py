"""From raw documents to token files: each stage applies one operator to all that the stage before kept.

``STAGES`` holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

import public_tokenizers

from postwave.llm import mixing, near_copies, quality, suffix_search, token_blocks
from postwave.session import materialize


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def minhash_near_dedup(spark, docs, sf_dir):
    """One document of each class of near copies stays, that of the least doc_id."""
    return near_copies.drop_copies(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents with a verbatim benchmark passage go."""
    return suffix_search.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark, docs, sf_dir):
    """Each document stays as often as the mix takes it: not at all, once or twice."""
    return mixing.mix(docs)


def token_output(spark, docs, sf_dir):
    """Token files, described by doc_id, start, n_tokens and ids_crc32 as they are read back."""
    return token_blocks.token_table(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
    ("token_output", token_output),
]

# Hash-based samples, trained models and token files have no SQL form; tests run the stages against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
