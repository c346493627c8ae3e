"""Queries on evaluation accounting and paired statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import evaluation as E
from millrace.operators import validate
from millrace.operators.common import fixed_rows
from millrace.plans.registry import query
from millrace.session import table

STATUS = "CASE WHEN quality = 1 AND toxic = 0 THEN 'success' WHEN toxic = 1 THEN 'environment_failure' WHEN doc_id % 5 = 0 THEN 'timeout' ELSE 'model_failure' END"


def _results(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(F.col("doc_id").alias("task_id"), F.expr(STATUS).alias("status"), F.lit(1).alias("seq"))


@query(f"""
WITH r AS (SELECT doc_id AS task_id, {STATUS} AS status FROM labels), t AS (SELECT d.lang, coalesce(r.status, 'missing') AS status FROM documents d LEFT JOIN r ON r.task_id = d.doc_id),
c AS (SELECT lang, count(*) AS expected, count(*) FILTER (status = 'success') AS successes, count(*) FILTER (status = 'missing') AS missing, count(*) FILTER (status = 'environment_failure') AS excluded FROM t GROUP BY lang)
SELECT lang, expected, CAST(expected - missing AS BIGINT) AS attempted, CAST(successes AS BIGINT) AS successes, CAST(missing AS BIGINT) AS missing, CAST(round(successes / expected, 6) AS DOUBLE) AS strict_rate,
  CAST(expected - excluded AS BIGINT) AS protocol_denominator, CAST(round(CASE WHEN expected > excluded THEN successes / (expected - excluded) END, 6) AS DOUBLE) AS protocol_rate FROM c
""")
def dual_denominator_scoring(spark: SparkSession, sf: str) -> DataFrame:
    expected = table(spark, sf, "documents").select(F.col("doc_id").alias("task_id"), "lang")
    tasks = E.outcomes(expected, _results(spark, sf), "task_id", "seq").join(expected, "task_id")
    return E.rates(tasks, E.fixed.PROTOCOL_EXCLUDES, "lang").withColumn("strict_rate", F.round("strict_rate", 6)).withColumn("protocol_rate", F.round("protocol_rate", 6))


@query(f"""
WITH s AS (SELECT unnest(['success', 'model_failure', 'parser_failure', 'timeout', 'environment_failure', 'harness_failure', 'invalid_task', 'aborted', 'missing']) AS status),
r AS (SELECT coalesce({STATUS}, 'missing') AS status FROM documents d LEFT JOIN labels l USING (doc_id)), q AS (SELECT CASE WHEN status IS NULL THEN 'missing' ELSE status END AS status FROM r),
c AS (SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE {STATUS.replace('doc_id', 'l.doc_id')} END AS status, count(*) AS n FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1)
SELECT status, CAST(coalesce(n, 0) AS BIGINT) AS n FROM s LEFT JOIN c USING (status)
""")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    expected = table(spark, sf, "documents").select(F.col("doc_id").alias("task_id"))
    return E.status_counts(E.outcomes(expected, _results(spark, sf), "task_id", "seq"))


@query(f"SELECT doc_id AS task_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE {STATUS} != 'timeout' OR true)")
def pending_tasks(spark: SparkSession, sf: str) -> DataFrame:
    return E.pending(table(spark, sf, "documents").select(F.col("doc_id").alias("task_id")), _results(spark, sf), "task_id")


def _arms(spark: SparkSession, sf: str):
    marks = table(spark, sf, "labels")
    return marks.select("doc_id", (F.col("quality") == 1).alias("ok")), marks.where("doc_id % 9 != 0").select("doc_id", (F.col("toxic") == 0).alias("ok"))


@query("""
WITH p AS (SELECT l.doc_id, quality = 1 AS b, CASE WHEN doc_id % 9 != 0 THEN toxic = 0 END AS o FROM labels l),
c AS (SELECT count(*) FILTER (o IS NOT NULL) AS shared, count(*) FILTER (o IS NULL) AS lost, count(*) FILTER (b AND NOT o) AS wb, count(*) FILTER (o AND NOT b) AS wo, count(*) FILTER (b = o) AS ties,
  count(*) FILTER (b AND o IS NOT NULL) AS nb, count(*) FILTER (o) AS no FROM p)
SELECT CAST(shared AS BIGINT) AS shared, CAST(0 AS BIGINT) AS missing_in_base, CAST(lost AS BIGINT) AS missing_in_other, CAST(wb AS BIGINT) AS wins_base, CAST(wo AS BIGINT) AS wins_other, CAST(ties AS BIGINT) AS ties,
  CAST(round(nb / shared, 6) AS DOUBLE) AS base_rate, CAST(round(no / shared, 6) AS DOUBLE) AS other_rate, CAST(round(100 * (no / shared - nb / shared), 6) AS DOUBLE) AS delta_pp FROM c
""")
def paired_summary(spark: SparkSession, sf: str) -> DataFrame:
    found = E.paired(*_arms(spark, sf), "doc_id")
    return found.drop("mcnemar_p").select("shared", "missing_in_base", "missing_in_other", "wins_base", "wins_other", "ties", *[F.round(c, 6).alias(c) for c in ("base_rate", "other_rate", "delta_pp")])


@query("""
WITH RECURSIVE n(b, c) AS (SELECT * FROM (VALUES (5, 5), (0, 0), (1, 9), (0, 8), (3, 7), (40, 61)) v(b, c)),
t(b, c, i, term, total) AS (SELECT b, c, 0, pow(0.5, b + c), pow(0.5, b + c) FROM n UNION ALL SELECT b, c, i + 1, term * (b + c - i) / (i + 1), total + term * (b + c - i) / (i + 1) FROM t WHERE i < least(b, c))
SELECT CAST(b AS BIGINT) AS b, CAST(c AS BIGINT) AS c, CAST(round(CASE WHEN b + c = 0 THEN 1 ELSE least(1.0, 2 * max(total)) END, 9) AS DOUBLE) AS p FROM t GROUP BY b, c
""")
def mcnemar_exact(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "b long, c long", (5, 5), (0, 0), (1, 9), (0, 8), (3, 7), (40, 61))
    return rows.select("b", "c", F.round(E.mcnemar(F.col("b"), F.col("c")), 9).alias("p"))


@query()
def bootstrap_ci(spark: SparkSession, sf: str) -> DataFrame:
    return E.bootstrap(*_arms(spark, sf), "doc_id")


FAILED = """
WITH r AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'harness_failure' WHEN 'view' THEN 'model_failure' WHEN 'click' THEN 'timeout' WHEN 'signup' THEN 'environment_failure' ELSE 'success' END AS status,
  value > 50 AS finished, CASE WHEN value > 75 THEN false END AS at_finish, CASE WHEN value < 25 THEN true END AS at_budget FROM events)
"""


def _failed(spark: SparkSession, sf: str) -> DataFrame:
    status = F.lit("success")
    for k, v in (("error", "harness_failure"), ("view", "model_failure"), ("click", "timeout"), ("signup", "environment_failure")):
        status = F.when(F.col("event_type") == k, v).otherwise(status)
    v = F.col("value")
    rows = table(spark, sf, "events").select("event_id", status.alias("status"), (v > 50).alias("finished"), F.when(v > 75, False).alias("at_finish"), F.when(v < 25, True).alias("at_budget"))
    category = E.auto_category(F.col("status"), F.col("finished"), F.col("at_finish"), F.col("at_budget"))
    return rows.withColumn("failure_category", category).withColumn("failure_annotation", F.when(category.isNull() & (F.col("status") != "success"), "pending").otherwise("none"))


@query(FAILED + """
, c AS (SELECT CASE WHEN status = 'harness_failure' THEN 'tool_harness_error' WHEN status = 'environment_failure' THEN 'environment_error' WHEN finished AND at_finish IS NOT DISTINCT FROM false THEN 'premature_finish'
  WHEN NOT finished AND at_budget IS NOT DISTINCT FROM true THEN 'failure_to_finish' ELSE 'needs_manual_annotation' END AS category FROM r WHERE status != 'success')
SELECT category, count(*) AS n, CAST(count(*) FILTER (category = 'needs_manual_annotation') AS BIGINT) AS pending,
  CASE category WHEN 'tool_harness_error' THEN 'harness_caused' WHEN 'environment_error' THEN 'environment_caused' WHEN 'needs_manual_annotation' THEN 'unattributed' ELSE 'model_caused' END AS attribution FROM c GROUP BY category
""")
def failure_taxonomy_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return E.failure_breakdown(_failed(spark, sf))


@query(FAILED + """
SELECT event_id, 'planning_error' AS failure_category, 'manual:planning_error' AS failure_annotation FROM r WHERE event_id % 100 = 0 AND status IN ('model_failure', 'timeout')
  AND NOT (finished AND at_finish IS NOT DISTINCT FROM false) AND NOT (NOT finished AND at_budget IS NOT DISTINCT FROM true)
""")
def manual_annotations(spark: SparkSession, sf: str) -> DataFrame:
    notes = table(spark, sf, "events").where("event_id % 100 = 0").select("event_id", F.lit("planning_error").alias("category"), F.lit(None).cast("boolean").alias("overwrite"))
    found = E.annotate(_failed(spark, sf), notes, "event_id")
    return found.where("failure_annotation LIKE 'manual:%'").select("event_id", "failure_category", "failure_annotation")


@query("""
WITH m AS (SELECT d.lang, avg(CAST(quality = 1 AS INT)) AS b, avg(CAST(toxic = 0 AS INT)) AS o, count(*) AS n FROM labels JOIN documents d USING (doc_id) GROUP BY d.lang)
SELECT lang, n, CAST(round(b, 6) AS DOUBLE) AS base_rate, CAST(round(o, 6) AS DOUBLE) AS other_rate,
  CASE WHEN -(100 * (o - b)) >= 5 THEN 'HARD_STOP' WHEN -(100 * (o - b)) >= 3 THEN 'INVESTIGATE' WHEN -(100 * (o - b)) >= 2 THEN 'WATCH' ELSE 'OK' END AS verdict FROM m
""")
def regression_verdict(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    found = E.panels(rows.select("lang", (F.col("quality") == 1).alias("ok")), rows.select("lang", (F.col("toxic") == 0).alias("ok")), "lang")
    return found.withColumn("base_rate", F.round("base_rate", 6)).withColumn("other_rate", F.round("other_rate", 6))


@query("SELECT * FROM (VALUES (CAST(0.8 AS DOUBLE), 'OK'), (0.785, 'OK'), (0.775, 'WATCH'), (0.76, 'INVESTIGATE'), (0.74, 'HARD_STOP'), (0.85, 'OK')) v(rate, verdict)")
def verdict_levels(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "rate double", (0.8,), (0.785,), (0.775,), (0.76,), (0.74,), (0.85,))
    return rows.select("rate", E.verdict(F.lit(0.80), F.col("rate")).alias("verdict"))


CLAIMS = (
    ("a", 0, "same_step_budget", True), ("a", 0, "supported_win", False), ("a", 1, "published_equivalence", True),
    ("b", 0, "same_step_budget", True), ("b", 1, "published_equivalence", False), ("b", 2, "protocol_pinned", False),
    ("c", 0, "same_step_budget", True), ("c", 1, "published_equivalence", True), ("c", 2, "protocol_pinned", False),
    ("d", 0, "same_step_budget", True), ("d", 1, "published_equivalence", True), ("d", 2, "protocol_pinned", True),
)


@query("""
SELECT * FROM (VALUES ('a', 'NOT_COMPARABLE', 'supported_win'), ('b', 'BEATS_LOCAL_BASELINE', 'published_equivalence'), ('c', 'COMPARABLE_TO_PUBLISHED_RESULT', 'protocol_pinned'), ('d', 'POTENTIAL_SOTA', '')) v(id, label, failed)
""")
def claim_ladder(spark: SparkSession, sf: str) -> DataFrame:
    return E.claim(fixed_rows(spark, "id string, tier int, condition string, met boolean", *CLAIMS), "id")


MANIFESTS = (
    '{"benchmark":{"name":"b","task_set_hash":"1"},"step_budget":50,"seed":1337,"model":{"revision":"r1"}}',
    '{"benchmark":{"name":"b","task_set_hash":"2"},"step_budget":50,"seed":1338,"tool_schema_hash":"t"}',
)


@query("SELECT * FROM (VALUES ('benchmark.task_set_hash', '1', '2'), ('seed', '1337', '1338'), ('model.revision', 'r1', '<ABSENT>'), ('tool_schema_hash', '<ABSENT>', 't')) v(field, base, other)")
def manifest_diff(spark: SparkSession, sf: str) -> DataFrame:
    flat = [validate.flattened(fixed_rows(spark, "m string", (m,)), "m", E.fixed.MANIFEST_FIELDS) for m in MANIFESTS]
    return validate.manifest_diff(*flat)


@query("""
WITH g AS (SELECT * FROM (VALUES (20.0), (40.0), (60.0), (80.0), (140.0)) v(gate)), c AS (SELECT o_orderkey, 100.0 * (o_orderkey % 1000) / 997 AS at FROM orders),
r AS (SELECT g.gate, c.o_orderkey, c.at FROM g JOIN c ON abs(c.at - g.gate) <= 2.5 QUALIFY row_number() OVER (PARTITION BY g.gate ORDER BY abs(c.at - g.gate), c.o_orderkey) = 1)
SELECT CAST(g.gate AS DOUBLE) AS gate, r.o_orderkey FROM g LEFT JOIN r USING (gate)
""")
def nearest_gate(spark: SparkSession, sf: str) -> DataFrame:
    gates = fixed_rows(spark, "gate double", *[(float(g),) for g in (20, 40, 60, 80, 140)])
    points = table(spark, sf, "orders").select("o_orderkey", (100.0 * (F.col("o_orderkey") % 1000) / 997).alias("at"))
    return validate.nearest(gates, points, "gate", "at", "o_orderkey", 2.5).select("gate", "o_orderkey")


@query("""
SELECT * FROM (VALUES (CAST(100003 AS BIGINT), CAST(3126 AS BIGINT), CAST(625 AS BIGINT)), (96000, 3000, 600), (1, 1, 0)) v(samples, steps, interval)
""")
def optimizer_steps(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "samples long", (100003,), (96000,), (1,)).withColumn("steps", E.optimizer_steps(F.col("samples")))
    return rows.select("samples", "steps", E.gate_steps(F.col("steps"))[0].alias("interval"))


@query("SELECT * FROM (VALUES (CAST(1 AS BIGINT), CAST(32 AS BIGINT)), (2, 32), (3, 33), (4, 32), (8, 32), (64, 64)) v(world, batch)")
def effective_batch(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "world long", *[(w,) for w in (1, 2, 3, 4, 8, 64)])
    return rows.select("world", E.effective_batch(F.col("world")).alias("batch"))
