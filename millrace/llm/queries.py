"""Registered corpus queries: name -> (session, table folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import ann, bpe, chat, decontam, langid, quality, secretscan, simhash, suffix, tokenfile
from millrace.llm.common import Stage, read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(suffix.remove_repeats(read_table(spark, sf_dir, "documents")))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = "\\### Assistant: </turn> ok"
    extra = spark.sql("SELECT -7L AS conv_id, stack(2, 0L, 'user', 1L, 'assistant') AS (turn, role)").withColumn("text", F.lit(trap))
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_conversations(rows.unionByName(extra)))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select(F.col("id").alias("doc_id"), quality.held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def op8_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op9_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark, "tokens")
    manifest = tokenfile.write_shards(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), f"{stage.root}/shards", stage)
    return tokenfile.read_shards(manifest)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digest(secretscan.find_secrets(read_table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_suffix": op2_suffix,
    "op3_bpe": op3_bpe,
    "op4_chat": op4_chat,
    "op5_quality": op5_quality,
    "op6_decontam": op6_decontam,
    "op7_langid": op7_langid,
    "op8_hnsw": op8_hnsw,
    "op9_tokenfile": op9_tokenfile,
    "op10_secrets": op10_secrets,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op4_chat": chat.ORACLE,
}
