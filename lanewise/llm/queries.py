"""One query per operator over its whole table, and the SQL for DuckDB where SQL can say it.

Not in SQL: op1 and op8 (tokenizers), op3 and op7 (a model over hashed counts), op4 (its hash), op5 and op9 (a trained field,
a compressor), op13 (wrong characters). Their tests compare them with brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.llm import bpe, conversations, embeddings, licenses, lm_scoring, merkle, mixing, personal_data, quality_model, quality_rules, secrets, simhash, token_files
from lanewise.llm.common import table
from lanewise.llm.sql import CONVERSATIONS, MERKLE, MIXING, NEAR_VECTORS, QUALITY_RULES


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents labelled good."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), trusted(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_tokens(written)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.taken(table(spark, sf_dir, "documents"))
    rows = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows are presented with their text in lower case; the proofs tell which of them differ from what was signed."""
    docs = table(spark, sf_dir, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = F.translate("text", upper, upper.lower()).alias("text")
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = merkle.leaf([lower if name == "text" else F.col(name) for name in merkle.COLUMNS])
    found = merkle.manifest(docs, claim=F.when(touched, tampered))
    columns = {"proof_sha256": merkle.proof_digest(F.col("proof")), "folded_root": merkle.folded(F.col("claim"), F.col("proof"))}
    found = found.select("doc_id", "leaf", "subroot", "root", *[column.alias(name) for name, column in columns.items()])
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.report(conversations.damage(rows), rows)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


QUERIES = {
    name: query
    for name, query in globals().copy().items()
    if name.startswith("op") and name[2].isdigit()
}

ORACLE = {"op2_quality_rules": QUALITY_RULES, "op6_near_vectors": NEAR_VECTORS, "op10_mixing": MIXING, "op11_merkle_manifest": MERKLE, "op12_conversation_repair": CONVERSATIONS}
