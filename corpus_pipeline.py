"""A training corpus from ``documents``: score, deduplicate, decontaminate, redact, tokenize.

Each stage is a function of (spark, docs, sf_dir); ``run`` writes the result of
each as Parquet in the shared folder and reads it back as the next one's docs.
All stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontam, quality, secretscan, simhash
from millrace.llm.common import Stage, read_table
from millrace.llm.queries import tokenizer_path

#: Documents that score less are rejected.
REJECT_BELOW = 0.5


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the compression classifier rejects.

    A null or empty text is scored as any other. Repeated rows and rows without
    an id are judged by their own texts; they teach nothing where labels do not
    name them. An empty table gives no rows.
    """
    score = _free(docs, "score")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model, out=score).where(F.col(score) >= REJECT_BELOW).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each SimHash group.

    Rows that repeat an id are one document, of which one whole row stays: the
    one with the smallest text, a null text last, and of equal texts the one
    whose other columns come first as JSON. Documents without an id are
    compared by their texts alone (null texts are equal), and one row of each
    text stays by the same order. An empty table gives no rows.
    """
    stage = Stage(spark, "kept")
    groups = stage.put(simhash.near_duplicates(docs))
    kept = stage.put(groups.where("doc_id = component_id").groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__rows")))
    chosen = lambda ids: docs.join(ids.select("__id").hint("shuffle_hash"), docs["doc_id"] == ids["__id"], "left_semi")
    order = F.struct(F.col("text").isNull(), "text", F.to_json(F.struct(*docs.columns)))
    one_of = lambda rows, *by: rows.groupBy(*by).agg(F.min_by(F.struct(*docs.columns), order).alias("__r")).select("__r.*")
    out = chosen(kept.where("__rows = 1"))
    if not kept.where("__rows > 1").isEmpty():
        out = out.unionByName(one_of(chosen(kept.where("__rows > 1")), "doc_id"))
    if not groups.where("doc_id IS NULL").isEmpty():
        out = out.unionByName(one_of(docs.where("doc_id IS NULL"), "text"))
    return out


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that overlap a benchmark item.

    Null and empty texts overlap nothing and stay, as do repeated rows without
    an overlap; ids play no part. Without items all rows stay.
    """
    return decontam.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; n_chars, where there is such a column, counts the new text.

    All rows stay. A null text stays null, with a null n_chars.
    """
    out = secretscan.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the texts that remain, one row for each row; a null text has no tokens."""
    return bpe.token_digests(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", classify_quality),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", redact_secrets),
    ("byte-pair encoding", tokenize),
]

#: No stage but the first part of the last is SQL: models, metric trees and digests of token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage staged goes once its result is written."""
    docs, stage = read_table(spark, sf_dir, "documents"), Stage(spark, "pipeline")
    for k, (_, step) in enumerate(STAGES):
        mark = Stage.mark()
        out = stage.put(step(spark, docs, sf_dir))
        Stage.clear(spark, mark)
        if k:
            stage.drop(docs)
        docs = out
    return docs
