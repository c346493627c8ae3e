"""Queries on the bookkeeping of builds and evaluation runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import actions as A
from millrace.functions import fixed
from millrace.operators import dedup, runs, selection, validate
from millrace.operators.common import fixed_rows, shared_folder
from millrace.plans.dedup import LEADERS, RADIUS, _signatures
from millrace.plans.registry import query
from millrace.plans.selection import RANKED
from millrace.session import table


@query("""
SELECT * FROM (VALUES ('a', 'x', '1'), ('a', 'y', '9'), ('a', 'z', '3'), ('b', NULL, 'plain'), ('c', 'k', 'v'), ('d', NULL, '5'), ('e', 'new', '1')) v(section, field, value)
""")
def config_layers(spark: SparkSession, sf: str) -> DataFrame:
    rows = lambda *r: fixed_rows(spark, "section string, field string, value string", *r)
    return runs.layered(rows(("a", "x", "1"), ("a", "y", "2"), ("b", "q", "0"), ("c", None, "0"), ("d", None, "5")), rows(("a", "y", "9"), ("a", "z", "3"), ("b", None, "plain"), ("c", "k", "v"), ("e", "new", "1")))


@query("""
SELECT * FROM (VALUES ('half', 'coding', CAST(800 AS BIGINT)), ('half', 'math', 2), ('half', 'tool', 1), ('whole', 'coding', 1600), ('whole', 'math', 5), ('whole', 'tool', 0), ('smoke', 'coding', 20), ('smoke', 'math', 20), ('smoke', 'tool', 20)) v(run, category, n)
""")
def replay_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "category string, standard long, given long", ("coding", 1600, None), ("math", 1500, 5), ("tool", 1300, 0))
    out = {"whole": runs.resolved_counts(rows), "half": runs.resolved_counts(rows, 3750), "smoke": runs.resolved_counts(rows, 100, smoke=True)}
    return out["whole"].select(F.lit("whole").alias("run"), "*").unionByName(out["half"].select(F.lit("half").alias("run"), "*")).unionByName(out["smoke"].select(F.lit("smoke").alias("run"), "*"))


@query("""
WITH c AS (SELECT source, count(*) * 20 AS n FROM documents GROUP BY source), s AS (SELECT CAST(coalesce(sum(n) FILTER (source IN (SELECT min(source) FROM documents)), sum(n)) AS BIGINT) AS rows, CAST(sum(n) AS BIGINT) AS every FROM c)
SELECT 'one' AS run, rows, rows >= 10000 AS production FROM s UNION ALL SELECT 'all', every, every >= 10000 FROM s UNION ALL SELECT 'smoke', every, false FROM s
""")
def production_build(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    counts = docs.groupBy("source").agg((F.count("*") * 20).alias("n"))
    first = docs.agg(F.min("source")).first()[0]
    parts = {"one": runs.production(counts, [first]), "all": runs.production(counts, []), "smoke": runs.production(counts, ["unknown"], smoke=True)}
    named = [df.select(F.lit(name).alias("run"), "*") for name, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("SELECT * FROM (VALUES ('done', CAST('' AS VARCHAR)), ('open', 'scorer,runner')) v(name, unresolved)")
def open_protocol_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "name string, m map<string,string>", ("done", {"scorer": "1", "runner": "2", "note": "OPEN"}), ("open", {"scorer": "OPEN", "runner": "OPEN", "note": "x"}))
    return rows.select("name", F.array_join(runs.unresolved_fields(F.col("m"), ["scorer", "runner", "missing"], "OPEN"), ",").alias("unresolved"))


FILES = """f AS (SELECT 'doc/' || doc_id || '.txt' AS path, text AS content FROM documents)"""


def _files(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.col("text").cast("binary").alias("content"))


@query(f"""
WITH {FILES}, w AS (SELECT DISTINCT 'doc/' || o_orderkey % 3000 || '.txt' AS path FROM orders)
SELECT w.path, sha256(content) AS sha256, CAST(strlen(content) AS BIGINT) AS bytes, content IS NULL AS missing FROM w LEFT JOIN f USING (path)
""")
def reference_manifest(spark: SparkSession, sf: str) -> DataFrame:
    wanted = table(spark, sf, "orders").select(F.concat(F.lit("doc/"), (F.col("o_orderkey") % 3000).cast("string"), F.lit(".txt")).alias("path"))
    return runs.reference_manifest(wanted, _files(spark, sf))


@query(f"""
WITH {FILES} SELECT path, 'changed' AS problem FROM f WHERE CAST(split_part(split_part(path, '/', 2), '.', 1) AS BIGINT) % 4 = 1 UNION ALL SELECT 'doc/none.txt', 'missing'
""")
def evidence_drift(spark: SparkSession, sf: str) -> DataFrame:
    files = _files(spark, sf)
    number = F.regexp_extract("path", r"(\d+)", 1).cast("long")
    told = files.select("path", F.sha2(F.when(number % 4 == 1, F.lit(b"")).otherwise(F.concat(F.col("content"), F.lit(b""))), 256).alias("sha256"))
    told = told.withColumn("sha256", F.when(number % 4 == 1, F.lit("0" * 64)).otherwise(F.col("sha256")))
    return runs.drifted(told.unionByName(fixed_rows(spark, "path string, sha256 string", ("doc/none.txt", "x"))), files)


@query(f"""
WITH {FILES}, a AS (SELECT CAST(length(t) AS BIGINT) AS bytes, md5(substring(t, 1, 4096)) AS head_md5 FROM (SELECT regexp_replace(content, '[^ -~]', '', 'g') AS t FROM f))
SELECT bytes, head_md5, count(*) AS copies FROM a GROUP BY 1, 2 HAVING count(*) > 1
""")
def image_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    ascii_only = F.regexp_replace(F.col("content").cast("string"), "[^ -~]", "").cast("binary")
    return runs.image_duplicates(_files(spark, sf).withColumn("content", ascii_only))


@query("""
WITH e AS (SELECT event_type AS source, CASE event_id % 3 WHEN 0 THEN 'sample' WHEN 1 THEN 'reject' ELSE 'note' END AS kind, 'r' || event_id % 4 AS reason, event_id % 5 AS n FROM events),
r AS (SELECT source, string_agg(reason || '=' || n, ',' ORDER BY reason) AS rejected FROM (SELECT source, reason, sum(n)::BIGINT AS n FROM e WHERE kind = 'reject' GROUP BY 1, 2) GROUP BY 1),
t AS (SELECT source, coalesce(sum(n) FILTER (kind = 'sample'), 0) AS taken FROM e GROUP BY 1), q AS (SELECT DISTINCT event_type AS source, 700 AS quota FROM events UNION ALL SELECT 'none', 5)
SELECT source, CAST(quota AS BIGINT) AS quota, CAST(coalesce(taken, 0) AS BIGINT) AS taken, CAST(greatest(0, quota - coalesce(taken, 0)) AS BIGINT) AS remaining, rejected FROM q LEFT JOIN t USING (source) LEFT JOIN r USING (source)
""")
def quota_ledger(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    kind = F.when(F.col("event_id") % 3 == 0, "sample").when(F.col("event_id") % 3 == 1, "reject").otherwise("note")
    entries = events.select(F.col("event_type").alias("source"), kind.alias("kind"), F.concat(F.lit("r"), (F.col("event_id") % 4).cast("string")).alias("reason"), (F.col("event_id") % 5).alias("n"))
    quotas = events.select(F.col("event_type").alias("source")).distinct().withColumn("quota", F.lit(700).cast("long")).unionByName(fixed_rows(spark, "source string, quota long", ("none", 5)))
    rows = runs.ledger(quotas, entries)
    told = F.array_join(F.transform(F.map_entries("rejected"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return rows.select("source", "quota", "taken", "remaining", told.alias("rejected"))


@query("""
SELECT source, count(*) AS rows, round(avg(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END), 6) AS long_text, round(avg(CASE WHEN regexp_matches(text, '[0-9]') THEN 1 ELSE 0 END), 6) AS has_digit FROM documents GROUP BY source
""")
def source_probes(spark: SparkSession, sf: str) -> DataFrame:
    rows = runs.rates(table(spark, sf, "documents"), "source", {"long_text": F.col("n_chars") > 1000, "has_digit": F.col("text").rlike("[0-9]")})
    return rows.select("source", "rows", F.round("long_text", 6).alias("long_text"), F.round("has_digit", 6).alias("has_digit"))


@query("""
WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 2 = 0 THEN 'wait' ELSE event_type END AS verb FROM events)
SELECT event_id, verb FROM e QUALIFY NOT (verb = 'wait' AND coalesce(lag(verb) OVER (PARTITION BY user_id ORDER BY ts, event_id) = 'wait', false))
""")
def single_waits(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("verb", F.when(F.col("event_id") % 2 == 0, "wait").otherwise(F.col("event_type")))
    return runs.single_waits(rows, "user_id", ["ts", "event_id"], "verb").select("event_id", "verb")


@query(LEADERS + "SELECT DISTINCT l.leader, CAST(h.s AS HUGEINT) % 1000003 AS h FROM lead l JOIN h USING (vec_id)".replace("CAST(h.s AS HUGEINT) % 1000003", "CAST(CAST(h.s AS HUGEINT) % 1000003 AS BIGINT)"))
def dedup_state(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters written as JSON and read back."""
    found = dedup.clusters(_signatures(spark, sf), "vec_id", "h", RADIUS)
    unsigned = F.when(F.col("h") >= 0, F.col("h").cast("decimal(20,0)")).otherwise(F.col("h").cast("decimal(20,0)") + F.lit("18446744073709551616").cast("decimal(20,0)"))
    return runs.state_rows(runs.state_json(found)).select("leader", (unsigned % 1000003).cast("long").alias("h")).distinct()


@query(f"""
WITH e AS (SELECT event_id, CAST(user_id AS VARCHAR) AS t, CAST(event_id AS VARCHAR) AS s, CASE event_id % 5 WHEN 0 THEN 'recovery' WHEN 1 THEN 'verification' WHEN 2 THEN 'planning' WHEN 3 THEN 'wait' END AS c FROM events),
d AS (SELECT *, CAST('0x' || md5(t || ':' || s || ':' || c)[1:8] AS BIGINT) % 3 + 1 AS k FROM e)
SELECT event_id, CASE c {' '.join("WHEN '{}' THEN [{}][k]".format(c, ', '.join("'" + x + "'" for x in texts)) for c, texts in fixed.PLAN_TEMPLATES.items())} END AS plan FROM d
""")
def plan_templates(spark: SparkSession, sf: str) -> DataFrame:
    names = list(fixed.PLAN_TEMPLATES)
    category = F.get(F.array(*map(F.lit, names)), (F.col("event_id") % 5).cast("int"))
    return table(spark, sf, "events").select("event_id", runs.plan_text(category, F.col("user_id").cast("string"), F.col("event_id").cast("string")).alias("plan"))


@query()
def plan_gate(spark: SparkSession, sf: str) -> DataFrame:
    names = [*fixed.PLAN_TEMPLATES, "none", "none"]
    rows = table(spark, sf, "events").select("event_id", F.get(F.array(*map(F.lit, names)), F.pmod(F.xxhash64("event_id"), F.lit(len(names))).cast("int")).alias("category"), (F.pmod(F.xxhash64(F.col("event_id") + 7), F.lit(1000)) / 1000.0).alias("u"))
    return runs.plan_gate(rows, "event_id", "category", "u", 0.12).select("event_id", "category")


MODULES = ("model.layers.0.mlp.gate_proj", "model.layers.11.mlp.gate_proj", "model.layers.3.self_attn.q_proj", "visual.blocks.0.attn", "visual.merger.mlp", "lm_head", "model.embed_tokens", "vision_tower.x", "multi_modal_projector.linear")


@query(r"""
SELECT * FROM (VALUES ('lm_head', 'lm_head'), ('model.embed_tokens', 'embedding'), ('model.layers.0.mlp.gate_proj', 'text'), ('model.layers.11.mlp.gate_proj', 'text'), ('model.layers.3.self_attn.q_proj', 'text'),
  ('multi_modal_projector.linear', 'aligner'), ('vision_tower.x', 'vision'), ('visual.blocks.0.attn', 'vision'), ('visual.merger.mlp', 'aligner'), ('(?:model\.layers\.\d+\.mlp\.gate_proj|model\.layers\.\d+\.self_attn\.q_proj)', '3')) v(path, kind)
""")
def module_targets(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "path string", *[(m,) for m in MODULES])
    return rows.select("path", runs.module_kind(F.col("path")).alias("kind")).unionByName(runs.target_pattern(rows, "path").select(F.col("pattern").alias("path"), F.col("modules").cast("string").alias("kind")))


@query("SELECT * FROM (VALUES ('task2', 'data/events/task2.jsonl', 'data/events/task2.md'), ('task10', 'data/events/task10.jsonl', NULL)) v(task, events, notes)")
def archived_tasks(spark: SparkSession, sf: str) -> DataFrame:
    names = [f"data/events/{n}" for n in ("task10.jsonl", "task2.md", "task2.jsonl", "task3.md", "taskx.jsonl", "task4.json")] + ["x/data/events/task5.jsonl"]
    return runs.archived_tasks(fixed_rows(spark, "name string", *[(n,) for n in names]), "name")


@query("""
WITH e AS (SELECT user_id, 'shots/' || event_id % 50 || '.png' AS path FROM events WHERE event_id % 4 != 0) SELECT DISTINCT user_id, path FROM e
""")
def screenshot_refs(spark: SparkSession, sf: str) -> DataFrame:
    shot = F.when(F.col("event_id") % 4 != 0, F.concat(F.when(F.col("event_id") % 2 == 0, "./").otherwise(""), F.lit("shots/"), (F.col("event_id") % 50).cast("string"), F.lit(".png")))
    step = F.struct(F.array(F.struct(shot.alias("screenshot"), F.col("event_type").alias("verb"))).alias("actions"))
    rows = table(spark, sf, "events").groupBy("user_id").agg(F.to_json(F.struct(F.collect_list(step).alias("steps"))).alias("j"))
    return runs.screenshots(rows, "user_id", "j")


@query("""
SELECT s_suppkey, row_number() OVER (ORDER BY CASE WHEN contains(lower(s_name), '1') OR contains(lower(s_name), '77') THEN 0 ELSE 1 END, s_acctbal, s_name) AS place FROM supplier
""")
def app_priority(spark: SparkSession, sf: str) -> DataFrame:
    return runs.app_order(table(spark, sf, "supplier"), "s_name", "s_acctbal", priority=("1", "77")).select("s_suppkey", "place")


@query("""
SELECT * FROM (VALUES ('r/checkpoint-5', CAST(5 AS BIGINT), CAST(0.5 AS DOUBLE), true, false), ('r/checkpoint-100', 120, 12.0, true, true), ('r/gates/early', 200, 21.0, true, true), ('r/checkpoint-400', 400, 40.0, false, false)) v(path, step, percent, has_adapter, verified)
""")
def checkpoint_discovery(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "path string, state string, has_adapter boolean", ("r/checkpoint-100", '{"global_step": 120}', True), ("r/checkpoint-100", '{"global_step": 120}', True), ("r/gates/early", '{"global_step": 200, "epoch": 0.21}', True),
        ("r/checkpoint-400", None, False), ("r/gates/final", None, True), ("r/checkpoint-5", "{oops", True),
    )
    return runs.checkpoints(rows, 1000).select("path", "step", "percent", "has_adapter", "verified")


@query("SELECT * FROM (VALUES (CAST(20.0 AS DOUBLE), 'a'), (40.0, 'b')) v(gate, name)")
def required_gates(spark: SparkSession, sf: str) -> DataFrame:
    points = fixed_rows(spark, "name string, percent double", ("a", 21.0), ("b", 39.0), ("c", 42.0))
    found = validate.nearest(fixed_rows(spark, "gate double", (20.0,), (40.0,)), points, "gate", "percent", "name", 2.5)
    return validate.require(found, F.col("name").isNotNull(), "a gate has no checkpoint").select("gate", "name")


@query("SELECT CAST(n_nationkey AS BIGINT) AS task, n_name AS status, n_nationkey % 2 = 0 AS success FROM nation")
def results_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/results-{uuid.uuid4().hex}"
    rows = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("task"), F.col("n_name").alias("status"), (F.col("n_nationkey") % 2 == 0).alias("success"))
    runs.write_results(rows, folder, "task")
    runs.write_results(rows.where("task < 3"), folder, "task")
    return runs.read_results(spark, folder, "task long, status string, success boolean")


@query("""
WITH e AS (SELECT event_id, user_id, event_type, CASE WHEN event_id % 9 = 0 THEN 'key ghp_' || repeat('a', 24) || ' end' ELSE event_type END AS said FROM events)
SELECT user_id, event_id AS place, 'step' AS record, '{"record":"step","user_id":' || user_id || ',"event_id":' || event_id || ',"said":"' || regexp_replace(said, 'gh[pousr]_[A-Za-z0-9]{20,}', '[REDACTED]', 'g') || '"}' AS line FROM e
UNION ALL SELECT DISTINCT user_id, -1, 'header', '{"record":"header","user_id":' || user_id || ',"arm":"base"}' FROM e
UNION ALL SELECT user_id, 9223372036854775807, 'summary', '{"record":"summary","user_id":' || user_id || ',"steps":' || count(*) || '}' FROM e GROUP BY user_id
""")
def trajectory_log(spark: SparkSession, sf: str) -> DataFrame:
    said = F.when(F.col("event_id") % 9 == 0, "key ghp_" + "a" * 24 + " end").otherwise(F.col("event_type"))
    steps = table(spark, sf, "events").select("user_id", "event_id", said.alias("said"))
    heads = steps.groupBy("user_id").agg(F.count("*").alias("end_steps")).withColumn("arm", F.lit("base"))
    return runs.trajectory_records(heads, steps, "user_id", "event_id", ["said"])


@query(f"""
WITH t AS (SELECT 't' || doc_id AS id, lang FROM documents), c AS (SELECT id, lang FROM t QUALIFY row_number() OVER (ORDER BY {RANKED.format('cut', 'id')}, id) <= 40)
SELECT CAST(count(*) AS BIGINT) AS size, (SELECT string_agg(lang || '=' || n, ',' ORDER BY lang) FROM (SELECT lang, count(*) AS n FROM c GROUP BY lang)) AS domains, sha256('["' || string_agg(id, '", "' ORDER BY id) || '"]') AS subset_sha256 FROM c
""")
def subset_envelope(spark: SparkSession, sf: str) -> DataFrame:
    tasks = table(spark, sf, "documents").select(F.concat(F.lit("t"), F.col("doc_id").cast("string")).alias("id"), "lang")
    chosen = tasks.orderBy(F.sha2(F.concat(F.lit("cut:"), F.col("id")), 256), "id").limit(40)
    told = F.array_join(F.transform("domain_counts", lambda d: F.concat(d["domain"], F.lit("="), d["n"].cast("string"))), ",")
    return runs.subset_envelope(tasks, chosen, "id", "lang").select("size", told.alias("domains"), "subset_sha256")


@query("SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'write'), (2, 'keep'), (3, 'refuse'), (4, 'replace'), (5, 'refuse')) v(id, verdict)")
def subset_regeneration(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "id long, old string, new string, same boolean, force boolean", (1, None, "a", False, False), (2, "a", "a", True, False), (3, "a", "b", True, False), (4, "a", "b", False, True), (5, "a", "a", False, False))
    return rows.select("id", runs.regeneration(F.col("old"), F.col("new"), F.col("same"), F.col("force")).alias("verdict"))


@query("""
WITH t AS (SELECT DISTINCT user_id, user_id * 37 % 1500 AS tx, user_id * 53 % 900 AS ty, user_id % 10 = 9 AS bad FROM events),
a AS (SELECT user_id, CASE event_id % 6 WHEN 0 THEN 'finish' WHEN 1 THEN 'click' WHEN 2 THEN 'double_click' ELSE 'wait' END AS verb, user_id * 37 % 1500 + event_id % 97 - 20 AS x, user_id * 53 % 900 + event_id % 89 - 20 AS y FROM events WHERE event_id % 40 < 7)
SELECT user_id, NOT bad AS valid, coalesce(bool_or(verb IN ('click', 'double_click') AND (x - tx) * (x - tx) + (y - ty) * (y - ty) <= 1600 AND NOT bad), false) AS clicked, coalesce(bool_or(verb = 'finish'), false) AS finished,
  coalesce(bool_or(verb IN ('click', 'double_click') AND (x - tx) * (x - tx) + (y - ty) * (y - ty) <= 1600 AND NOT bad), false) AND coalesce(bool_or(verb = 'finish'), false) AS success FROM t LEFT JOIN a USING (user_id) GROUP BY user_id, bad
""")
def target_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    x, y = F.col("user_id") * 37 % 1500, F.col("user_id") * 53 % 900
    said = F.when(F.col("user_id") % 10 == 9, "Broken task [invalid]").otherwise(F.concat(F.lit("Click the target square at ("), x.cast("string"), F.lit(", "), y.cast("string"), F.lit(") on a 1920x1080 screen, then finish.")))
    tasks = events.select("user_id").distinct().withColumn("instruction", said)
    verb = F.when(F.col("event_id") % 6 == 0, "finish").when(F.col("event_id") % 6 == 1, "click").when(F.col("event_id") % 6 == 2, "double_click").otherwise("wait")
    acts = events.where("event_id % 40 < 7").select("user_id", verb.alias("verb"), (x + F.col("event_id") % 97 - 20).alias("x"), (y + F.col("event_id") % 89 - 20).alias("y"))
    return runs.target_outcomes(tasks, acts, "user_id")


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey % 1000 AS a, l_suppkey % 1000 AS b, l_orderkey % 2 = 0 AS norm, l_linenumber % 5 AS d FROM lineitem),
e AS (SELECT *, CASE WHEN norm THEN a / 1000.0 * 1600 ELSE a * 1600 / 1000.0 END AS ex, CASE WHEN norm THEN b / 1000.0 * 900 ELSE b * 900 / 1000.0 END AS ey FROM r)
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber = 7 THEN 0 WHEN abs(round_even(ex, 0) + d - ex) > 2 OR abs(round_even(ey, 0) - ey) > 2 THEN 1 ELSE 0 END AS BIGINT) AS errors FROM e
""")
def conversion_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 1000).alias("a"), (F.col("l_suppkey") % 1000).alias("b"))
    said = F.when(F.col("l_linenumber") == 7, F.lit("click")).otherwise(F.concat(F.lit("click("), F.col("a").cast("string"), F.lit(", "), F.col("b").cast("string"), F.lit(")")))
    point = F.struct((F.rint(F.col("a") / 1000.0 * 1600) + F.col("l_linenumber") % 5).alias("x"), F.rint(F.col("b") / 1000.0 * 900).alias("y"))
    space = F.when(F.col("l_orderkey") % 2 == 0, "norm_0_1000").otherwise("pixel")
    return rows.select("l_orderkey", "l_linenumber", runs.conversion_errors(said, F.array(point), space, F.lit(1600), F.lit(900), F.lit(1000), F.lit(1000)).alias("errors"))


@query("""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), '<a>click(x=500, y=1000)</a>'), (2, 'click(x=50, y=99)'), (3, 'drag(x1=0, y1=0, x2=1000, y2=505, button="left")'), (4, 'press(key="enter")'), (5, 'scroll(clicks=-2, x=253, y=253)')) v(id, target)
""")
def contract_targets(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "id long, text string, w long, h long, norm boolean, template string", (1, "click(x=50, y=99)", 101, 100, True, "<a>{action}</a>"), (2, "click(x=50, y=99)", 101, 100, False, "{action}"),
        (3, 'drag(x1=0, y1=0, x2=99, y2=50, button="left")', 100, 100, True, "{action}"), (4, 'press(key="enter")', 100, 100, True, "{action}"), (5, "scroll(clicks=-2, x=25, y=25)", 100, 100, True, "{action}"),
    ).withColumn("a", A.parse_action(F.col("text")))
    return rows.select("id", runs.contract_target(F.col("a.rendered"), F.col("a.verb"), F.col("a.points"), F.col("w"), F.col("h"), F.col("norm"), F.col("template")).alias("target"))


@query("""
SELECT * FROM (VALUES ('empty_output', CAST(1 AS BIGINT)), ('out_of_bounds:[(900, 20)]', 2), ('missing_action', 1)) v(problem, n)
""")
def action_problems(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "task_type string, text string", ("action", "Plan: a\nAction: click(x=1, y=2)"), ("action", " "), ("action", "click(x=900, y=20)"), ("grounding", "click(x=900, y=20)"), ("replay_math", "nothing"), ("screen_understanding", "[]"), ("action", "Plan: only"),
    ).withColumn("parsed", A.model_output(F.col("text"))).withColumn("w", F.lit(800)).withColumn("h", F.lit(600))
    return runs.action_problems(rows, "parsed", "w", "h", "task_type")


@query("""
WITH d AS (SELECT CASE WHEN lang = 'en' THEN NULL ELSE source END AS reason, doc_id FROM documents)
SELECT reason, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) FILTER (k <= 3) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY doc_id) AS k FROM d WHERE reason IS NOT NULL) GROUP BY reason
""")
def failure_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", F.when(F.col("lang") != "en", F.col("source")).alias("reason"))
    return validate.failure_counts(rows, "reason", "doc_id").select("reason", "n", F.array_join(F.transform("examples", lambda x: x.cast("string")), ",").alias("examples"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'g' || doc_id % 10 WHEN doc_id % 3 = 1 THEN lang ELSE 'unknown' END AS grp FROM documents")
def group_keys(spark: SparkSession, sf: str) -> DataFrame:
    a = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("g"), (F.col("doc_id") % 10).cast("string"))).otherwise("")
    b = F.when(F.col("doc_id") % 3 == 1, F.col("lang"))
    return table(spark, sf, "documents").select("doc_id", selection.group_key(a, b).alias("grp"))
