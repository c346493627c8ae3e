"""Queries on aggregate reports and on integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import tokens
from millrace.operators import reports as R
from millrace.operators import selection, validate
from millrace.operators.common import fixed_rows
from millrace.plans.registry import query
from millrace.session import table


@query("""
WITH a AS (SELECT 'lang' AS axis, lang AS key, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source
  UNION ALL SELECT 'long', CAST(n_chars > 1000 AS VARCHAR), count(*) FROM documents GROUP BY 2)
SELECT axis, key, n, CAST(round(n / sum(n) OVER (PARTITION BY axis), 6) AS DOUBLE) AS share FROM a
""")
def mixture_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("lang", "source", (F.col("n_chars") > 1000).alias("long"))
    return R.mixture(rows, "lang", "source", "long").select("axis", "key", "n", F.round("share", 6).alias("share"))


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY GROUPING SETS ((source, lang), (source))")
def two_level_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.two_level(table(spark, sf, "documents").select("source", "lang"), "source", "lang")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 7")
def top_sources(spark: SparkSession, sf: str) -> DataFrame:
    return R.top(table(spark, sf, "documents"), "source", 7)


@query("""
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, CAST(round(sum(n * n) / (sum(n) * sum(n)), 6) AS DOUBLE) AS hhi, arg_max(lang, n) AS top_key, CAST(round(max(n) / sum(n), 6) AS DOUBLE) AS top_share FROM c
""")
def hhi_dominance(spark: SparkSession, sf: str) -> DataFrame:
    found = R.concentration(table(spark, sf, "documents"), "lang")
    return found.select("rows", "keys", F.round("hhi", 6).alias("hhi"), "top_key", F.round("top_share", 6).alias("top_share"))


@query("""
WITH c AS (SELECT event_type, user_id % 2 = 0 OR user_id % 5 < 4 AS k, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, CAST(sum(n) AS BIGINT) AS rows, arg_max(k, n) AS top_key, CAST(round(max(n) / sum(n), 6) AS DOUBLE) AS top_share FROM c GROUP BY event_type HAVING sum(n) > 100 AND max(n) / sum(n) > 0.6
""")
def dominated_groups(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_type", ((F.col("user_id") % 2 == 0) | (F.col("user_id") % 5 < 4)).alias("k"))
    return R.dominated(rows, "event_type", "k", least=100).select("event_type", "rows", "top_key", F.round("top_share", 6).alias("top_share"))


@query("""
WITH t AS (SELECT lang, CAST(ceil(length(text) / 4.0) AS BIGINT) AS v FROM documents WHERE length(text) > 0)
SELECT lang, count(*) AS n, CAST(round(avg(v), 4) AS DOUBLE) AS mean, quantile_disc(v, 0.5) AS p50, quantile_disc(v, 0.9) AS p90, quantile_disc(v, 0.95) AS p95, quantile_disc(v, 0.99) AS p99, max(v) AS max FROM t GROUP BY lang
""")
def token_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    found = R.percentiles(table(spark, sf, "documents"), tokens(F.col("text")), "lang")
    return found.select("lang", "n", F.round("mean", 4).alias("mean"), "p50", "p90", "p95", "p99", "max")


LOSS = """
WITH t AS (SELECT c.conv_id, coalesce(d.lang, '?') AS source, 'task' || c.conv_id % 3 AS task_type, c.role, CAST(ceil(length(c.text) / 4.0) AS BIGINT) AS tok FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id),
p AS (SELECT conv_id, source, task_type, coalesce(sum(tok) FILTER (role != 'assistant'), 0) AS i, coalesce(sum(tok) FILTER (role = 'assistant'), 0) AS l FROM t GROUP BY 1, 2, 3),
g AS (SELECT CASE WHEN grouping(source) = 0 THEN 'source' WHEN grouping(task_type) = 0 THEN 'task_type' ELSE 'total' END AS axis, coalesce(source, task_type, 'all') AS key, count(*) AS samples,
  CAST(sum(i) AS BIGINT) AS input_tokens, CAST(sum(l) AS BIGINT) AS loss_tokens FROM p GROUP BY GROUPING SETS ((source), (task_type), ())),
r AS (SELECT *, CAST(round(loss_tokens / greatest(1, max(loss_tokens) FILTER (axis = 'total') OVER ()), 6) AS DOUBLE) AS share FROM g)
"""


def _loss(spark: SparkSession, sf: str) -> DataFrame:
    langs = table(spark, sf, "documents").select(F.col("doc_id").alias("conv_id"), "lang")
    rows = table(spark, sf, "conversations").join(langs, "conv_id", "left").select(
        "conv_id", "role", "text", F.coalesce("lang", F.lit("?")).alias("source"), F.concat(F.lit("task"), (F.col("conv_id") % 3).cast("string")).alias("task_type")
    )
    return R.loss_tokens(rows, "role", "text", "conv_id", "source", "task_type")


@query(LOSS + "SELECT axis, key, samples, input_tokens, loss_tokens, share FROM r")
def loss_token_report(spark: SparkSession, sf: str) -> DataFrame:
    return _loss(spark, sf).select("axis", "key", "samples", "input_tokens", "loss_tokens", F.round("share", 6).alias("share"))


@query(LOSS + "SELECT key, share FROM r WHERE axis = 'task_type' AND key != 'task0' AND share > 0.3")
def aux_share_gate(spark: SparkSession, sf: str) -> DataFrame:
    return validate.share_violations(_loss(spark, sf), 0.3, ("task0",)).select("key", F.round("share", 6).alias("share"))


@query("""
WITH m AS (SELECT doc_id, unnest(list_filter([CASE WHEN doc_id % 11 = 0 THEN 'drag' END, CASE WHEN doc_id % 7 = 0 THEN 'hotkeys' END], lambda x: x IS NOT NULL)) AS motif FROM documents),
c AS (SELECT motif, count(*) AS selected FROM m GROUP BY motif), f AS (SELECT * FROM (VALUES ('drag', 0.2), ('hotkeys', 50.0), ('settings', 0.01)) v(motif, floor)),
r AS (SELECT motif, CAST(CASE WHEN floor < 1 THEN ceil(floor * (SELECT count(*) FROM documents)) ELSE floor END AS BIGINT) AS required, coalesce(selected, 0) AS selected FROM f LEFT JOIN c USING (motif))
SELECT motif, required, selected FROM r WHERE selected < required
""")
def motif_floors_unmet(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    kinds = F.array_compact(F.array(F.when(F.col("doc_id") % 11 == 0, F.lit("drag")), F.when(F.col("doc_id") % 7 == 0, F.lit("hotkeys"))))
    floors = fixed_rows(spark, "motif string, floor double", ("drag", 0.2), ("hotkeys", 50.0), ("settings", 0.01))
    wanted = selection.required(floors.crossJoin(docs.agg(F.count("*").alias("total"))), F.col("total"))  # one row of totals
    return validate.unmet_floors(R.coverage(docs.select("doc_id", kinds.alias("motifs")), "doc_id", "motifs"), wanted)


@query("""
SELECT source, count(*) AS selected, CAST(count(*) FILTER (doc_id % 10 != 0) AS BIGINT) AS train, CAST(count(*) FILTER (doc_id % 10 = 0) AS BIGINT) AS validation,
  (SELECT string_agg(lang || '=' || n, ',' ORDER BY lang) FROM (SELECT lang, count(*) AS n FROM documents i WHERE i.source = o.source GROUP BY lang)) AS task_types FROM documents o GROUP BY source
""")
def source_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("source", "lang", F.when(F.col("doc_id") % 10 == 0, "validation").otherwise("train").alias("split"))
    found = R.source_stats(rows, "source", "split", "lang")
    listed = F.array_join(F.transform(F.map_entries("task_types"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return found.select("source", "selected", "train", "validation", listed.alias("task_types"))


@query("""
WITH f AS (SELECT 'timeout after ' || user_id % 4 || 's token hf_abcdefghijklmnopqrstuvwxyz' AS error, 'u' || user_id % 3 AS source FROM events WHERE event_type = 'error'),
c AS (SELECT regexp_replace(substring(error, 1, 120), 'hf_[A-Za-z0-9]{20,}', '[REDACTED]', 'g') AS class, source, count(*) AS n FROM f GROUP BY 1, 2)
SELECT class, CAST(sum(n) AS BIGINT) AS n, string_agg(source || '=' || n, ',' ORDER BY source) AS sources FROM c GROUP BY class
""")
def failure_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").where("event_type = 'error'").select(
        F.concat(F.lit("timeout after "), (F.col("user_id") % 4).cast("string"), F.lit("s token hf_abcdefghijklmnopqrstuvwxyz")).alias("error"), F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")).alias("source")
    )
    listed = F.array_join(F.transform(F.map_entries("sources"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return R.failure_summary(rows, "error", "source").select("class", "n", listed.alias("sources"))


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def orphan_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    named = lambda c: F.concat(F.lit("images/p"), c.cast("string"), F.lit(".webp"))
    files = table(spark, sf, "part").select("p_partkey", named(F.col("p_partkey")).alias("path"))
    samples = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.array(named(F.col("l_partkey"))).alias("images"))
    return validate.orphans(files, samples).select("p_partkey")


@query("""
SELECT source, count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
  sha256(string_agg(lpad(CAST(doc_id AS VARCHAR), 12, '0') || chr(9) || strlen(text) || chr(9) || sha256(text) || chr(10), '' ORDER BY doc_id)) AS tree_sha256 FROM documents GROUP BY source
""")
def tree_hash(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("source", F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha"))
    return R.tree_hash(rows, "path", "bytes", "sha", "source")


@query("""
WITH t AS (SELECT doc_id, n_chars, text FROM documents), f AS (SELECT CASE WHEN doc_id % 50 = 0 THEN 'invalid_roles' WHEN doc_id % 31 = 0 THEN 'duplicate_sample_id' WHEN doc_id % 17 = 0 THEN 'not_listed' END AS reason FROM t),
c AS (SELECT reason, count(*) AS n FROM f WHERE reason IS NOT NULL GROUP BY reason), a AS (SELECT *, CASE WHEN reason = 'invalid_roles' THEN CAST(floor(0.05 * (SELECT count(*) FROM t)) AS BIGINT) ELSE 0 END AS allowed FROM c)
SELECT reason, n, CAST(allowed AS BIGINT) AS allowed, reason = 'invalid_roles' AND n <= allowed AS tolerated, reason IN ('invalid_roles', 'duplicate_sample_id') AND NOT (reason = 'invalid_roles' AND n <= allowed) AS fatal FROM a
""")
def fatal_reasons(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id")
    reason = validate.first_failure({"invalid_roles": F.col("doc_id") % 50 == 0, "duplicate_sample_id": F.col("doc_id") % 31 == 0, "not_listed": F.col("doc_id") % 17 == 0})
    counts = docs.select("doc_id", reason.alias("reason")).where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))
    total = docs.agg(F.count("*").alias("total"))
    return validate.fatal(counts.crossJoin(total), "reason", "n", F.col("total"), {"invalid_roles": 0.05}).select("reason", "n", "allowed", "tolerated", "fatal")  # one row of totals


@query("""
SELECT * FROM (VALUES ('config/b.json', 'environment_file'), ('data/x.zip', 'forbidden_suffix')) v(path, problem) WHERE path != 'config/b.json'
UNION ALL SELECT * FROM (VALUES ('.env.local', 'environment_file'), ('big.txt', 'too_large'), ('notes.md', 'secret')) v(path, problem)
""")
def repository_hygiene(spark: SparkSession, sf: str) -> DataFrame:
    from millrace.sources.files import hygiene

    rows = fixed_rows(
        spark, "path string, bytes long, text string", ("data/x.zip", 10, ""), (".env.local", 10, ""), ("big.txt", 6 << 20, ""), ("notes.md", 10, "key ghp_ABCDEFGHIJKLMNOPQRSTUVWX"), ("ok.md", 10, "fine"),
    )
    return hygiene(rows, F.col("text"), (".zip", ".pt"), (r"gh[pousr]_[A-Za-z0-9]{20,}",))


@query("SELECT * FROM (VALUES ('final/a.json'), ('images/b.webp'), ('manifests/c.json')) v(path)")
def publish_allow_list(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "path string", ("final/a.json",), ("state/p.json",), ("images/b.webp",), ("images/b.tmp",), ("final/skip.json",), ("manifests/c.json",))
    return validate.allow_list(rows, names=("skip.json",), suffixes=(".tmp",))
