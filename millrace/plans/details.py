"""Queries on smaller operators: pages, ids, spans, logs, descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import geometry as G
from millrace.functions import hashing as H
from millrace.functions import labels
from millrace.functions import text as T
from millrace.operators import evaluation as E
from millrace.operators import reports, selection, trajectory, validate
from millrace.operators.common import fixed_rows
from millrace.plans.conversations import STRIP, _turns
from millrace.plans.registry import query
from millrace.session import table
from millrace.streaming import ingest


@query("SELECT CAST(o_orderkey AS BIGINT) AS task, o_orderstatus AS status FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def unexpected_results(spark: SparkSession, sf: str) -> DataFrame:
    expected = table(spark, sf, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return E.unexpected(expected, table(spark, sf, "orders"), "o_custkey").select(F.col("o_orderkey").cast("long").alias("task"), F.col("o_orderstatus").alias("status"))


@query("SELECT * FROM (VALUES ('a', 'INVESTIGATE', true), ('b', 'WATCH', false), ('c', 'OK', false), ('d', 'HARD_STOP', true)) v(panel, overall, regression)")
def worst_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    told = {"a": ("OK", "INVESTIGATE", "WATCH"), "b": ("WATCH", "OK"), "c": ("OK",), "d": ("HARD_STOP", "OK")}
    parts = [E.worst(fixed_rows(spark, "verdict string", *[(v,) for v in vs])).select(F.lit(k).alias("panel"), "*") for k, vs in told.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(f"""
WITH t AS (SELECT conv_id, turn, role, {STRIP.format("coalesce(text, '')")} AS s, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
c AS (SELECT conv_id, max(CASE WHEN k = 1 THEN role END) AS first, count(*) FILTER (role = 'assistant') AS said, count(*) FILTER (role = 'assistant' AND s = '') AS mute, count(*) FILTER (s = '') AS blank FROM t GROUP BY conv_id)
SELECT conv_id, concat_ws(',', CASE WHEN first NOT IN ('system', 'user') OR said = 0 THEN 'invalid_roles' END, CASE WHEN mute > 0 THEN 'empty_assistant_target' END, CASE WHEN blank > 0 THEN 'empty_message_content' END) AS failures FROM c
""")
def message_failures(spark: SparkSession, sf: str) -> DataFrame:
    return _turns(spark, sf).select("conv_id", F.array_join(validate.all_failures(validate.message_checks(F.col("turns"))), ",").alias("failures"))


@query("SELECT p_brand, p_partkey, CAST((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 10 AS BIGINT) AS page FROM part")
def paged_listing(spark: SparkSession, sf: str) -> DataFrame:
    return reports.numbered_pages(table(spark, sf, "part").select("p_brand", "p_partkey"), "p_brand", "p_partkey", 10)


@query("""
WITH p AS (SELECT p_partkey, p_partkey * 7 % 1900 AS lo, p_partkey * 7 % 1900 + p_size AS hi FROM part),
s AS (SELECT *, CAST(round_even(lo * 799 / 1919.0, 0) AS BIGINT) AS a, CAST(round_even(hi * 799 / 1919.0, 0) AS BIGINT) AS b FROM p)
SELECT p_partkey, a AS low, CASE WHEN b <= a THEN least(a + 1, 799) ELSE b END AS high FROM s
""")
def scaled_spans(spark: SparkSession, sf: str) -> DataFrame:
    lo = F.col("p_partkey") * 7 % 1900
    low, high = G.scale_span(lo, lo + F.col("p_size"), F.lit(1920), F.lit(800))
    return table(spark, sf, "part").select("p_partkey", low.cast("long").alias("low"), high.cast("long").alias("high"))


@query("""
WITH p AS (SELECT p_partkey, p_partkey * 11 % 2560 AS x FROM part), m AS (SELECT *, round_even(x * (1600 / 2560.0), 0) AS seen FROM p)
SELECT p_partkey, CAST(least(greatest(round_even(seen / (1600 / 2560.0), 0), 0), 2559) AS BIGINT) AS back, abs(least(greatest(round_even(seen / (1600 / 2560.0), 0), 0), 2559) - x) <= 1 AS near FROM m
""")
def screen_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    x, w, h = F.col("p_partkey") * 11 % 2560, F.lit(2560), F.lit(1440)
    back = G.to_screen(F.rint(x * G.model_scale(w, h)), w, w, h)
    return table(spark, sf, "part").select("p_partkey", back.alias("back"), (F.abs(back - x) <= 1).alias("near"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'indicated control' WHEN p_partkey % 4 = 1 THEN lower(p_type) WHEN p_partkey % 4 = 2 THEN p_name ELSE p_name || ' (' || lower(p_type) || ')' END AS described FROM part
""")
def element_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    text, kind = F.when(F.col("p_partkey") % 4 >= 2, F.col("p_name")), F.when(F.col("p_partkey") % 2 == 1, F.col("p_type")).otherwise("  ")
    return table(spark, sf, "part").select("p_partkey", labels.describe_element(text, kind).alias("described"))


@query("SELECT event_type, round(coalesce(avg(nullif(CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 7 = 1 THEN NULL ELSE value END, 0)), 0), 6) AS mean FROM events GROUP BY event_type UNION ALL SELECT 'none', 0.0")
def truthy_means(spark: SparkSession, sf: str) -> DataFrame:
    value = F.when(F.col("event_id") % 3 == 0, 0.0).when(F.col("event_id") % 7 != 1, F.col("value"))
    rows = table(spark, sf, "events").select("event_type", value.alias("v")).unionByName(fixed_rows(spark, "event_type string, v double", ("none", None), ("none", 0.0)))
    return rows.groupBy("event_type").agg(F.round(reports.mean_of_truthy(F.col("v")), 6).alias("mean"))


@query("""
WITH t AS (SELECT lang, 'd' || doc_id AS id FROM documents) SELECT lang, sha256('["' || string_agg(id, '", "' ORDER BY id) || '"]') AS task_set_hash FROM t GROUP BY lang
""")
def task_set_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy("lang").agg(H.id_set_hash(F.concat(F.lit("d"), F.col("doc_id").cast("string"))).alias("task_set_hash"))


@query("SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'a9993e364706816a', 'the goal'), (2, 'da39a3ee5e6b4b0d', '')) v(id, content_id, description)")
def content_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "id long, t string, md string", (1, "abc", "# x\n**Description:**  the goal \nmore"), (2, "", "none"))
    return rows.select("id", H.content_id(F.col("t")).alias("content_id"), T.markdown_description(F.col("md")).alias("description"))


@query("""
WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 4 = 0 THEN 'finish' ELSE event_type END AS verb FROM events) SELECT event_id FROM e QUALIFY verb = 'finish' AND event_id < max(event_id) OVER (PARTITION BY user_id)
""")
def mid_trajectory_finishes(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", "user_id", F.when(F.col("event_id") % 4 == 0, "finish").otherwise(F.col("event_type")).alias("verb"))
    return trajectory.mid_finishes(rows, "user_id", "event_id", "verb").select("event_id")


@query("""
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'coding::' || lang || '::unknown' WHEN 1 THEN 'math::' || source END AS domain FROM documents
""")
def domain_keys(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("doc_id") % 3 == 0, "replay_coding").when(F.col("doc_id") % 3 == 1, "replay_math").otherwise("action")
    return table(spark, sf, "documents").select("doc_id", selection.domain_key(kind, F.col("lang"), F.lit(None).cast("string"), F.col("source")).alias("domain"))


@query("SELECT * FROM (VALUES (CAST(10 AS BIGINT), CAST(1.5 AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE)), (20, 2.5, NULL, NULL), (NULL, NULL, 'gpu0', 91.5), (NULL, NULL, 'gpu1', 7.0)) v(step, ts, device, peak)")
def training_log(spark: SparkSession, sf: str) -> DataFrame:
    lines = fixed_rows(spark, "value string", ("{'loss': 1.0, 'step': 10, 'ts': 1.5}",), ("{'loss': 0.9, 'global_step': 20, 'ts': 2.5}",), ("{'eval': 1, 'step': 30}",), ("{'loss': 1}",))
    memory = fixed_rows(spark, "device string, peak string", ("gpu0", "12"), ("gpu0", "91.5"), ("gpu1", "7"))
    steps = ingest.step_times(lines).select("step", "ts", F.lit(None).cast("string").alias("device"), F.lit(None).cast("double").alias("peak"))
    peaks = ingest.column_peaks(memory, "device", ["peak"]).select(F.lit(None).cast("long").alias("step"), F.lit(None).cast("double").alias("ts"), "device", "peak")
    return steps.unionByName(peaks)
