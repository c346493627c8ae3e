"""Queries on conversation sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import labels
from millrace.functions import validators as V
from millrace.functions.geometry import conversion_space, to_pixel
from millrace.operators import conversations as C
from millrace.operators import reports, runs
from millrace.operators.common import fixed_rows
from millrace.plans.registry import query
from millrace.session import table

STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    """(conv_id, turns array<(turn, role, content)>) in order."""
    rows = table(spark, sf, "conversations").select("conv_id", F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("content")).alias("t"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


@query("""
SELECT conv_id, role, coalesce(text, '') AS content FROM conversations WHERE conv_id % 5 NOT IN (1, 2)
UNION ALL SELECT DISTINCT conv_id, NULL, NULL FROM conversations WHERE conv_id % 5 = 1
""")
def unfold_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Folded conversations; a fifth have no list and pass, a fifth hold a malformed one and go."""
    text = F.to_json(F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))))
    folded = F.when(F.col("conv_id") % 5 == 1, F.lit("")).when(F.col("conv_id") % 5 == 2, F.concat(F.lit("[{broken"), text)).otherwise(text)
    rows = C.unfolded(_turns(spark, sf).select("conv_id", folded.alias("f")), "f").withColumn("m", F.from_json("member", "role string, content string"))
    return rows.select("conv_id", "m.role", "m.content")


@query("SELECT * FROM (VALUES (CAST(1 AS BIGINT), CAST(2 AS BIGINT), 'b', '1'), (2, 0, NULL, NULL), (3, 0, NULL, NULL), (4, 1, NULL, '{\"a\":1}')) v(id, messages, second, k)")
def json_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "id long, m string, meta string", (1, '[{"role":"user","content":"a"},{"role":"x","content":"b"}]', '{"k":1}'), (2, "[{", "{"), (3, None, None), (4, '[{"role":"user"}]', '{"k":{"a":1}}')
    )
    found = C.json_list(F.col("m"))
    return rows.select("id", F.size(found).cast("long").alias("messages"), F.get(found, 1)["content"].alias("second"), F.element_at(C.json_map(F.col("meta")), "k").alias("k"))


@query(f"""
WITH t AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN CASE WHEN turn % 4 = 2 THEN 'TOOL' ELSE 'human' END WHEN 'system' THEN 'gizmo' ELSE 'gpt' END AS speaker, {STRIP.format("coalesce(text, '')")} AS v FROM conversations),
m AS (SELECT conv_id, turn, CASE speaker WHEN 'gizmo' THEN 'system' WHEN 'gpt' THEN 'assistant' ELSE 'user' END AS role, CASE WHEN speaker = 'TOOL' THEN 'Tool response: ' ELSE '' END || v AS content FROM t WHERE v != ''),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, max(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS said FROM m),
o AS (SELECT conv_id, k, role, CASE WHEN k = 1 AND role = 'system' THEN content || chr(10) || 'NOTE' ELSE content END AS content FROM f WHERE said = 1
  UNION ALL SELECT conv_id, 0, 'system', 'NOTE' FROM f WHERE said = 1 AND k = 1 AND role != 'system')
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k) - 1 AS place, role, content FROM o
""")
def role_remap(spark: SparkSession, sf: str) -> DataFrame:
    speaker = lambda t: F.when(t["role"] == "user", F.when(t["turn"] % 4 == 2, "TOOL").otherwise("human")).when(t["role"] == "system", "gizmo").otherwise("gpt")
    turns = F.transform("turns", lambda t: F.struct(speaker(t).alias("speaker"), t["content"].alias("value")))
    rows = _turns(spark, sf).select("conv_id", C.remapped(turns, F.lit("NOTE")).alias("m"))
    return rows.select("conv_id", F.posexplode("m").alias("place", "x")).select("conv_id", F.col("place").cast("long").alias("place"), "x.role", "x.content")


@query(f"""
WITH m AS (SELECT conv_id, turn, coalesce(CASE WHEN turn % 7 = 3 THEN NULL WHEN turn % 7 = 5 THEN 'critic' ELSE role END, 'user') AS role, coalesce(text, '') AS content FROM conversations),
k AS (SELECT * FROM m WHERE role IN ('system', 'user', 'assistant') AND {STRIP.format('content')} != '')
SELECT conv_id, count(k.turn) AS messages, sha256(coalesce(string_agg(k.role || ':' || k.content, chr(10) ORDER BY k.turn), '')) AS digest FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN k USING (conv_id) GROUP BY conv_id
""")
def message_filter(spark: SparkSession, sf: str) -> DataFrame:
    role = lambda t: F.when(t["turn"] % 7 == 3, F.lit(None).cast("string")).when(t["turn"] % 7 == 5, "critic").otherwise(t["role"])
    rows = _turns(spark, sf).select("conv_id", C.converted(F.transform("turns", lambda t: F.struct(role(t).alias("role"), t["content"].alias("content")))).alias("m"))
    told = F.array_join(F.transform("m", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return rows.select("conv_id", F.size("m").cast("long").alias("messages"), F.sha2(told, 256).alias("digest"))


@query(f"""
WITH p AS (SELECT conv_id, turn // 2 AS i, max(CASE WHEN turn % 2 = 0 THEN {STRIP.format("coalesce(text, '')")} END) AS q, max(CASE WHEN turn % 2 = 1 THEN {STRIP.format("coalesce(text, '')")} END) AS a FROM conversations GROUP BY 1, 2),
k AS (SELECT conv_id, i, CASE WHEN row_number() OVER (PARTITION BY conv_id ORDER BY i) = 1 AND conv_id % 3 = 0 THEN '<image>' || chr(10) ELSE '' END || q AS q, a, coalesce(q, '') != '' AND coalesce(a, '') != '' AS ok FROM p)
SELECT conv_id, CAST(2 * count(*) AS BIGINT) AS messages, sha256(string_agg(q || '|' || a, '|' ORDER BY i)) AS digest FROM k WHERE ok GROUP BY conv_id
""")
def question_turns(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "conversations").groupBy("conv_id", F.floor(F.col("turn") / 2).alias("i")).agg(
        F.max(F.when(F.col("turn") % 2 == 0, F.coalesce("text", F.lit("")))).alias("question"), F.max(F.when(F.col("turn") % 2 == 1, F.coalesce("text", F.lit("")))).alias("answer")
    )
    rows = pairs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("i", "question", "answer"))).alias("p"))
    found = rows.select("conv_id", C.question_messages(F.col("p"), F.col("conv_id") % 3 == 0).alias("m")).where(F.size("m") > 0)
    return found.select("conv_id", F.size("m").cast("long").alias("messages"), F.sha2(F.array_join(F.transform("m", lambda x: x["content"]), "|"), 256).alias("digest"))


@query("""
WITH t AS (SELECT conv_id, turn, role, regexp_replace(coalesce(text, ''), '[^ -~]', '', 'g') AS c FROM conversations),
j AS (SELECT conv_id, '[' || string_agg('{"content": ' || CAST(to_json(c) AS VARCHAR) || ', "role": "' || role || '"}', ', ' ORDER BY turn) || ']' AS j FROM t GROUP BY conv_id)
SELECT conv_id, CASE conv_id % 3 WHEN 0 THEN 'given-' || conv_id WHEN 1 THEN 'other-' || conv_id ELSE left(sha256(j), 16) END AS id FROM j
""")
def message_ids(spark: SparkSession, sf: str) -> DataFrame:
    said = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), F.regexp_replace(t["content"], "[^ -~]", "").alias("content")))
    told = lambda k, name: F.when(F.col("conv_id") % 3 == k, F.concat(F.lit(name), F.col("conv_id").cast("string"))).otherwise("")
    return _turns(spark, sf).select("conv_id", C.sample_id(told(0, "given-"), told(1, "other-"), said).alias("id"))


@query("""
SELECT doc_id, 'replay::' || lang || '::' || source || '::' || CAST(doc_id AS VARCHAR) AS id, sha256(encode('L:4x' || CAST(doc_id % 7 AS VARCHAR) || chr(0) || text)) AS digest FROM documents
""")
def replay_digests(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", C.replay_id(F.col("lang"), F.col("source"), F.col("doc_id")).alias("id"), C.pixel_digest(F.lit("L"), F.lit(4), F.col("doc_id") % 7, F.col("text").cast("binary")).alias("digest"))


@query(f"""
WITH d AS (SELECT doc_id, text AS r, 'please ' || source || ' write about ' || lang AS q FROM documents),
l AS (SELECT *, {STRIP.format('r')} AS s, list_filter(list_transform(regexp_split_to_array(r, '\\r\\n|\\r|\\n'), lambda x: {STRIP.format('x')}), lambda x: x != '') AS lines FROM d)
SELECT doc_id, CASE WHEN length({STRIP.format('q')}) < 20 OR length(s) < 40 THEN 'too_short' WHEN lower(s) IN ('n/a', 'none', 'todo', 'placeholder', 'cannot answer') OR contains(lower(s), 'lorem ipsum') THEN 'placeholder'
  WHEN (len(string_split(r, '```')) - 1) % 2 = 1 THEN 'open_fence' WHEN len(lines) >= 8 AND len(list_distinct(lines)) <= greatest(2, len(lines) // 4) THEN 'repetitive' END AS reason FROM l
UNION ALL SELECT * FROM (VALUES (-1, 'placeholder'), (-2, 'open_fence'), (-3, NULL), (-4, 'invalid_syntax'), (-5, 'too_short')) v(doc_id, reason)
""")
def coding_audit(spark: SparkSession, sf: str) -> DataFrame:
    ask = "write a function that adds numbers"
    cases = fixed_rows(
        spark, "doc_id long, r string, q string", (-1, "# your code here\n" + "x = 1\n" * 10, ask), (-2, "```python\nx = 1\n" + "and a long explanation of it all", ask),
        (-3, "```python\ndef add(a, b):\n    return a + b\n```\nThis adds two numbers.", ask), (-4, "```python\ndef add(a, b)\n    return a + b\n```\nThis adds two numbers.", ask), (-5, "short", ask),
    ).withColumn("syntax", V.code_syntax(F.col("r")))
    words = F.concat(F.lit("please "), F.col("source"), F.lit(" write about "), F.col("lang"))
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("r"), words.alias("q"), F.lit("partial_or_unchecked").alias("syntax"))
    return docs.unionByName(cases).select("doc_id", C.coding_verdict(F.col("q"), F.col("r"), F.col("syntax"))["reason"].alias("reason"))


@query("SELECT * FROM (VALUES (CAST(1 AS BIGINT), true), (2, false), (3, false), (4, true), (5, false)) v(id, ok)")
def math_answers(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "id long, q string, a string", (1, "What is 2 + 3 * 4?", "The answer is 14"), (2, "What is 2 + 3 * 4?", "The answer is 15"), (3, "What is 2?", "2"), (4, "How many apples does she have left over?", "She has 3 apples."), (5, "How many apples does she have?", "N/A "))
    return rows.select("id", V.math_quality(F.col("q"), F.col("a")).alias("ok"))


@query("SELECT * FROM (VALUES (CAST(1 AS BIGINT), true), (2, false), (3, true), (4, false), (5, NULL), (6, true)) v(id, ok)")
def schema_matches(spark: SparkSession, sf: str) -> DataFrame:
    told = '{"type":"object","required":["a"],"properties":{"a":{"type":["integer","null"],"minimum":1},"b":{"type":"string","maxLength":2}},"additionalProperties":false}'
    rows = fixed_rows(
        spark, "id long, v string, s string", (1, '{"a":1,"b":"xy"}', told), (2, '{"a":0}', told), (3, '{"a":null}', told), (4, '{"a":2,"c":1}', told), (5, "{", told), (6, "3", '{"anyOf":[{"type":"string"},{"enum":[3]}]}'),
    )
    return rows.select("id", V.json_schema_ok(F.col("v"), F.col("s")).alias("ok"))


@query()
def exact_loss_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Learned and other tokens by an exact tokenizer, and the gate on task types."""
    try:
        import public_tokenizers
    except ImportError:
        counted = lambda c: F.length(c).cast("bigint")  # noqa: E731  no vocabulary here: characters
    else:
        counted = lambda c: C.exact_tokens(c, public_tokenizers.path("byte_bpe_50k.json"))
    rows = table(spark, sf, "conversations").withColumn("n", counted(F.col("text"))).withColumn("task", F.concat(F.lit("t"), (F.col("conv_id") % 4).cast("string"))).withColumn("source", F.lit("replay"))
    report = reports.loss_tokens(rows, "role", "text", "conv_id", "source", "task", count="n")
    return report.crossJoin(F.broadcast(C.loss_gate(report))).select("axis", "key", "samples", "input_tokens", "loss_tokens", F.round("share", 6).alias("share"), "passed")


@query("""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), NULL), (2, 'unparseable_grounding_row'), (3, 'unparseable_grounding_row'), (4, 'coordinate_space_ambiguous'), (5, 'ambiguous_grounding_referent'), (6, 'coordinate_out_of_bounds'), (7, NULL)) v(id, reason)
""")
def grounding_cohort(spark: SparkSession, sf: str) -> DataFrame:
    ask = 'Click on "Save" button'
    rows = fixed_rows(
        spark, "id long, asked string, x double, y double, w long, h long, rw long, rh long", (1, ask, 500.0, 500.0, 1040, 736, 1040, 736), (2, "", 1.0, 1.0, 1040, 736, 1040, 736), (3, ask, None, None, 1040, 736, 1040, 736),
        (4, ask, 5.0, 5.0, 1040, 736, 800, 800), (5, "do it now", 5.0, 5.0, 1040, 736, 1040, 736), (6, ask, 5000.0, 5.0, 1040, 736, 1040, 736), (7, "select cell B12", 5.0, 5.0, 1040, 736, 2080, 1472),
    )
    point = F.when(F.col("x").isNotNull(), F.struct("x", "y"))
    pixel = F.struct(to_pixel(F.col("x"), F.col("rw"), "thousand").alias("x"), to_pixel(F.col("y"), F.col("rh"), "thousand").alias("y"))
    space = conversion_space(F.col("w"), F.col("h"), F.col("rw"), F.col("rh"))
    return rows.select("id", runs.grounding_reasons(F.col("asked"), point, space, labels.referent(F.col("asked")), pixel, F.col("rw"), F.col("rh")).alias("reason"))
