"""Corpus pipeline: quality, near-duplicates, personal data, mixing and tokens, each stage on what the one before kept.

Each stage takes rows with a missing id or text, repeated rows and an empty table, as its operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lanewise.llm import bpe, mixing, personal_data, quality_model, simhash
from lanewise.llm.common import table
from lanewise.llm.queries import trusted
from lanewise.sources import stage

#: Characters of a block of documents in `quality`. Its tasks run beside what other stages left in the executors' memory, so blocks
#: are smaller than the operator's own; more entries of words and bigrams are shuffled, and the rows are the same.
QUALITY_BLOCK_CHARS = 2_000_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity classifier rejects go; so do empty ones, which it cannot judge."""
    return quality_model.keep_good(docs, trusted(spark, sf_dir), max_chars=QUALITY_BLOCK_CHARS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (fingerprints of three-word shingles, three bits) stays, the one with the
    smallest id. Texts without words are one group."""
    return simhash.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return personal_data.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources give what their weights ask for; a document stands as often as the mix passes through it."""
    return mixing.mixed_rows(docs)


#: Characters of a block of documents in `tokens`. Its tasks hold the ids too, beside what earlier stages left in memory, so blocks
#: are smaller than the operator's own; more entries of words are shuffled, and the rows are the same.
TOKEN_BLOCK_CHARS = 4_000_000


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the token ids, and the digests of ids and of the bytes they decode to."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, TOKEN_BLOCK_CHARS, with_ids=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("private", private), ("mix", mix), ("tokens", tokens)]
#: A language model, a hash and tokenizers: none of the stages can be said in SQL. tests/llm compares the tokens with the texts
#: they came from, and the other stages with their operators, which have tests of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name=name)
    name, step = STAGES[-1]
    return stage(step(spark, docs, sf_dir), name=name).drop("ids")
