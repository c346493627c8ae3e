"""Queries that run a stream to its end and return what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.common import shared_folder
from millrace.plans.registry import query
from millrace.session import table
from millrace.streaming import assembly, ingest


def _folder(spark: SparkSession) -> str:
    return f"{spark.sparkContext.getCheckpointDir() or shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def _arriving(spark: SparkSession, df: DataFrame, folder: str, parts: int = 3) -> DataFrame:
    """A stream over the table's rows as files, a few of them repeated."""
    df.repartition(parts).write.parquet(folder + "/in")
    df.limit(50).coalesce(1).write.mode("append").parquet(folder + "/in")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(folder + "/in")


@query("SELECT event_id, user_id, event_type FROM events")
def streaming_ingest_dedup(spark: SparkSession, sf: str) -> DataFrame:
    folder = _folder(spark)
    rows = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    ingest.ingest(_arriving(spark, rows, folder), folder + "/out", folder + "/checkpoint").awaitTermination()
    return ingest.durable(spark, folder + "/out", ["event_id"], "user_id").select("event_id", "user_id", "event_type")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_time_windows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.tumbling(rows, "ts", "1 day", "1 day", "event_type").select(F.col("start").cast("timestamp_ntz").alias("day"), "event_type", "n")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 6 HOURS THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT user_id, k AS session, n FROM (SELECT user_id, CAST(k AS BIGINT) AS k, count(*) AS n FROM s GROUP BY 1, 2)
""")
def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    from millrace.operators.common import ranked

    rows = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    found = ingest.sessions(rows, "user_id", "ts", "6 hours", "1 day")
    return found.select("user_id", (ranked(["user_id"], F.col("start")) - 1).cast("long").alias("session"), "n")


MEMBERS = """
WITH m AS (SELECT conv_id, 'c' || conv_id AS folder, count(*) FILTER (conv_id % 10 != 3 OR turn != 1) AS have, count(*) AS want, CAST(sum(CASE WHEN conv_id % 10 != 3 OR turn != 1 THEN strlen(text) ELSE 0 END) AS BIGINT) AS bytes FROM conversations GROUP BY conv_id)
SELECT folder, CASE WHEN conv_id % 10 = 5 THEN 'unparseable' WHEN have = want THEN 'complete' ELSE 'partial' END AS status, CAST(have AS BIGINT) AS members, bytes FROM m
"""


def _members(spark: SparkSession, sf: str) -> DataFrame:
    """A member per turn and a manifest per conversation; some lack a member or the manifest."""
    turns = table(spark, sf, "conversations")
    folder, name = F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.concat(F.lit("t"), F.col("turn").cast("string"))
    plain = turns.where("conv_id % 10 != 3 OR turn != 1").select(folder.alias("folder"), name.alias("name"), F.lit(None).cast("array<string>").alias("refs"), F.octet_length("text").cast("long").alias("bytes"))
    manifests = turns.where("conv_id % 10 != 5").groupBy("conv_id").agg(F.collect_list(name).alias("refs"))
    return plain.unionByName(manifests.select(folder.alias("folder"), F.lit("manifest").alias("name"), "refs", F.lit(0).cast("long").alias("bytes")))


@query(MEMBERS)
def batch_assembly(spark: SparkSession, sf: str) -> DataFrame:
    return assembly.assembled(_members(spark, sf))


@query("SELECT folder, status, members, bytes FROM (" + MEMBERS + ") WHERE status = 'complete'")
def streaming_assembly(spark: SparkSession, sf: str) -> DataFrame:
    folder = _folder(spark)
    members = _members(spark, sf)
    members.repartition(3).write.parquet(folder + "/in")
    stream = spark.readStream.schema(members.schema).option("maxFilesPerTrigger", 2).parquet(folder + "/in")
    ingest.ingest(assembly.assemble_stream(stream), folder + "/out", folder + "/checkpoint").awaitTermination()
    return spark.read.schema(assembly.OUTPUT).parquet(folder + "/out").select("folder", "status", "members", "bytes")
