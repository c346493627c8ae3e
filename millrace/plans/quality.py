"""Queries on quality scores, geometry and conversation rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import geometry as G
from millrace.functions import scores as Q
from millrace.functions.labels import difficulty_signals, suspicions, verification_basis
from millrace.functions.text import tokens
from millrace.operators import reports, validate
from millrace.operators import trajectory as J
from millrace.operators.common import fixed_rows
from millrace.operators.selection import best_element
from millrace.plans.registry import query
from millrace.plans.trajectory import STEPS, steps
from millrace.session import table

SCORED = STEPS + """
, a AS (SELECT *, count(*) OVER (PARTITION BY event_type) / count(*) OVER () AS share,
  verb = lag(verb) OVER (PARTITION BY user_id ORDER BY idx) AS again, CASE WHEN value > 90 THEN 1 ELSE 0 END AS recovered, CASE WHEN value BETWEEN 60 AND 90 THEN 1 ELSE 0 END AS checked FROM c),
p AS (SELECT event_id, verb, coalesce(again, false) AS again, recovered,
  2.2 * recovered + 1.8 * checked + CASE verb WHEN 'drag' THEN 1.0 WHEN 'scroll' THEN 0.4 ELSE 0.15 END
  + 0.8 * greatest(0.3, 1.0 - 3 * share) + 0.8 * CASE WHEN changed THEN 0.6 ELSE 0.3 END + 0.6 * 0.3
  - 0.7 * CASE WHEN verb = 'click' THEN greatest(0.0, least(1.0, (value / 100 - 0.35) / 0.45)) ELSE 0.0 END
  - 1.8 * CASE WHEN verb = 'click' AND value * 10 > 300 THEN 0.8 WHEN idx = 0 AND verb = 'click' AND recovered + checked = 0 THEN 0.5 ELSE 0.0 END
  - 1.2 * CASE WHEN again THEN 1.0 ELSE 0.0 END AS raw,
  CASE WHEN verb = 'click' AND value * 10 > 300 THEN 0.8 WHEN idx = 0 AND verb = 'click' AND recovered + checked = 0 THEN 0.5 ELSE 0.0 END AS trivial FROM a),
s2 AS (SELECT *, greatest(0.0, least(10.0, 10.0 * (2 + raw) / 8.0)) AS score FROM p)
"""


@query(SCORED + """
SELECT event_id, CAST(round(score, 6) AS DOUBLE) AS score,
  CASE WHEN verb = 'move' THEN 'Reject' WHEN again AND recovered = 0 THEN 'Reject' WHEN score >= 7 THEN 'A' WHEN score >= 5 THEN 'B' WHEN score >= 3 THEN 'C'
    WHEN trivial > 0 AND NOT again AND verb = 'click' THEN 'C' ELSE 'Reject' END AS bucket,
  CASE WHEN verb = 'move' THEN 'anchor_ineligible_verb:move' WHEN again AND recovered = 0 THEN 'repeated_identical_no_recovery' WHEN score >= 3 THEN NULL
    WHEN trivial > 0 AND NOT again AND verb = 'click' THEN NULL ELSE 'low_quality' END AS reason FROM s2
""")
def action_quality_score(spark: SparkSession, sf: str) -> DataFrame:
    rows = steps(spark, sf).withColumn("again", J.repeated("user_id", "idx", "verb"))
    counts = rows.groupBy("event_type").agg(F.count("*").alias("n"))
    total = F.sum("n").over(J.Window.partitionBy(F.lit(1)))
    rows = rows.join(F.broadcast(counts.select("event_type", (F.col("n") / total).alias("share"))), "event_type")  # one row per event type
    signals = F.array_compact(F.array(F.when(F.col("value") > 90, F.lit("recovery_evidenced")), F.when(F.col("value").between(60, 90), F.lit("verification"))))
    verb = F.col("verb")
    parts = Q.action_components(
        verb, signals, F.col("event_type"), F.col("share"), F.col("idx") == 0, F.col("again"), F.coalesce("changed", F.lit(False)),
        width=F.col("value") * 10, offset=F.col("value") / 100,
    )
    score = Q.action_score(parts)
    found = rows.select("event_id", score.alias("score"), Q.action_verdict(score, verb, parts).alias("v"))
    return found.select("event_id", F.round("score", 6).alias("score"), "v.bucket", "v.reason")


@query("""
WITH e AS (SELECT p_partkey, p_size * 6 AS w, CAST(floor(p_retailprice / 20) AS BIGINT) AS h, p_name, p_brand, p_type FROM part),
n AS (SELECT *, len(list_filter(regexp_split_to_array(p_name, '\\W+'), lambda x: x != '')) AS words, sqrt(CAST(greatest(w, 1) * greatest(h, 1) AS DOUBLE)) AS extent FROM e),
r AS (SELECT *, 1.2 + 2.5 * greatest(0.0, least(1.0, 40.0 / greatest(1.0, extent) - 0.3)) + CASE WHEN words > 1 THEN least(1.0, 0.25 * (words - 1)) ELSE 0.0 END
  + 0.8 * 0.7 + 0.7 * 0.5 AS raw FROM n)
SELECT p_partkey, CAST(round(greatest(0.0, least(10.0, 10.0 * raw / 5.5)), 6) AS DOUBLE) AS score,
  CASE WHEN least(w, h) < 16 THEN 'tiny' WHEN least(w, h) < 32 THEN 'small' WHEN least(w, h) < 64 THEN 'medium' ELSE 'large' END AS size_bucket FROM r
""")
def grounding_score(spark: SparkSession, sf: str) -> DataFrame:
    w, h = F.col("p_size") * 6, F.floor(F.col("p_retailprice") / 20)
    score = Q.grounding_score(w, h, F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.lit(0.1))
    return table(spark, sf, "part").select("p_partkey", F.round(score, 6).alias("score"), G.size_bucket(w, h).alias("size_bucket"))


@query("""
SELECT p_size AS screen, p_partkey, CAST(round(p_retailprice, 2) AS DOUBLE) AS score FROM part WHERE p_retailprice > 0
QUALIFY row_number() OVER (PARTITION BY p_size ORDER BY p_retailprice DESC, p_partkey) = 1
""")
def best_element_per_screen(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").where("p_retailprice > 0").select(F.col("p_size").alias("screen"), "p_partkey", F.round("p_retailprice", 2).alias("score"))
    return best_element(rows, "screen", "score", "p_partkey").select("screen", "p_partkey", "score")


@query("""
WITH n AS (SELECT l_orderkey, l_linenumber, l_quantity * 20 AS x, l_partkey % 1000 AS y, 1920 AS w, 1080 AS h FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(round_even(l_linenumber / 7.0 * 1919, 0) AS BIGINT) AS unit_x, CAST(round_even(y / 1000 * 1079, 0) AS BIGINT) AS thousand_y,
  CAST(round_even(x * 1599 / 1919, 0) AS BIGINT) AS scaled_x, CAST(least(1000, greatest(0, round_even(x * 1000.0 / 1919, 0))) AS BIGINT) AS norm_x,
  x >= 0 AND x < 960 AND y >= 0 AND y < 540 AS inside, CAST(round_even(x * (1600 / 1920.0::DOUBLE), 0) AS BIGINT) AS model_x FROM n
""")
def geometry_suite(spark: SparkSession, sf: str) -> DataFrame:
    x, y, w, h = F.col("l_quantity") * 20, F.col("l_partkey") % 1000, F.lit(1920), F.lit(1080)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", G.to_pixel(F.col("l_linenumber") / 7.0, w, "unit").alias("unit_x"), G.to_pixel(y, h, "thousand").alias("thousand_y"),
        G.scale(x, w, F.lit(1600)).alias("scaled_x"), G.to_thousand(x, w).alias("norm_x"), G.inside(x, y, F.lit(960), F.lit(540)).alias("inside"), G.to_model(x, w, h).alias("model_x"),
    )


@query("""
WITH s AS (SELECT p_partkey, p_size * 90 AS w, p_size * 50 AS h, p_size AS t FROM part),
l AS (SELECT *, CASE WHEN greatest(w, h) <= 1600 OR t * 1600 / greatest(w, h) >= 11 THEN 1600 ELSE least(greatest(1600, ceil(11 * greatest(w, h) / t)), least(1920, greatest(w, h))) END AS long_side FROM s)
SELECT p_partkey, CAST(long_side AS BIGINT) AS long_side, CAST(CASE WHEN w > long_side THEN greatest(1, round_even(w * (long_side / CAST(w AS DOUBLE)), 0)) ELSE w END AS BIGINT) AS width,
  CAST(CASE WHEN w > long_side THEN greatest(1, round_even(h * (long_side / CAST(w AS DOUBLE)), 0)) ELSE h END AS BIGINT) AS height FROM l
""")
def resize_plan(spark: SparkSession, sf: str) -> DataFrame:
    w, h = F.col("p_size") * 90, F.col("p_size") * 50
    rows = table(spark, sf, "part").select("p_partkey", w.alias("w"), h.alias("h"), G.long_side(w, h, F.col("p_size")).alias("long_side"))
    width, height = G.resize(F.col("w"), F.col("h"), F.col("long_side"))
    return rows.select("p_partkey", "long_side", width.alias("width"), height.alias("height"))


@query("""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'ok'), (2, 'mismatch_used_actual'), (3, 'ambiguous')) v(id, status)
""")
def conversion_status(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "id long, mw int, mh int, aw int, ah int", (1, 1040, 736, 1040, 736), (2, 1040, 736, 2080, 1472), (3, 1040, 736, 1920, 1080))
    return rows.select("id", G.conversion_space(*[F.col(c) for c in ("mw", "mh", "aw", "ah")]).alias("status"))


@query("""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'structured_tool_arguments'), (2, 'grounding_target_with_known_point'), (3, NULL), (4, 'verified_finish_outcome'), (5, 'click_inside_trusted_box')) v(id, basis)
""")
def frontier_evidence(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "id long, task_type string, box boolean, finish string, math boolean", (1, "replay_tool", None, None, None), (2, "grounding", None, None, None),
        (3, "action", None, "no", None), (4, "action", False, "yes", None), (5, "action", True, "yes", None),
    )
    return rows.select("id", verification_basis(F.col("task_type"), F.col("box"), F.col("finish"), F.col("math")).alias("basis"))


@query(STEPS + """
, g AS (SELECT event_id, unnest(list_filter([CASE WHEN verb = 'finish' THEN 'finish' END, CASE WHEN verb = 'wait' THEN 'wait' END, CASE WHEN value > 90 THEN 'recovery' END,
  CASE WHEN value < 16 THEN 'tiny_target' END, CASE WHEN idx >= 7 THEN 'long_window' END], lambda x: x IS NOT NULL)) AS category FROM s)
SELECT category, count(*) AS n FROM g GROUP BY category
""")
def suspicious_categories(spark: SparkSession, sf: str) -> DataFrame:
    signals = F.array_compact(F.array(F.when(F.col("value") > 90, F.lit("recovery_evidenced"))))
    found = steps(spark, sf).select(F.explode(suspicions(F.col("verb"), signals, F.col("value"), F.col("idx") + 1, F.lit(None).cast("string"))).alias("category"))
    return found.groupBy("category").agg(F.count("*").alias("n"))


BROKEN = (
    (-1, 0, "assistant", "hello"), (-2, 0, "user", "hi"), (-2, 1, "assistant", "  "), (-3, 0, "user", " "), (-3, 1, "assistant", "fine"),
    (-4, 0, "user", "only a question"), (-5, 0, "user", "ask"), (-5, 1, "assistant", "a first answer that is long enough"), (-5, 2, "assistant", "a second one"),
)
TURNS = "SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES " + ", ".join(str(r) for r in BROKEN) + ") v(conv_id, turn, role, text)"


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(fixed_rows(spark, "conv_id long, turn long, role string, text string", *BROKEN))


@query(f"""
WITH t AS ({TURNS}),
c AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, arg_min(role, turn) AS first, count(*) FILTER (role = 'assistant') AS said,
  bool_or(role = 'assistant' AND trim(text, ' ' || chr(10) || chr(9)) = '') AS blank_target, bool_or(trim(text, ' ' || chr(10) || chr(9)) = '') AS blank FROM t GROUP BY conv_id)
SELECT conv_id, CASE WHEN first NOT IN ('system', 'user') OR said = 0 THEN 'invalid_roles' WHEN blank_target THEN 'empty_assistant_target' WHEN blank THEN 'empty_message_content' END AS reason FROM c
""")
def conversation_validate(spark: SparkSession, sf: str) -> DataFrame:
    rows = validate.role_checks(_turns(spark, sf), "conv_id", "turn", "role", "text")
    return rows.select("conv_id", validate.first_failure(validate.message_checks(F.col("messages"))).alias("reason"))


@query(f"""
WITH t AS ({TURNS}),
n AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM t),
c AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, arg_min(role, turn) AS first, bool_or(role = 'user') AS asked, bool_or(role = 'assistant') AS said, bool_or(coalesce(role = 'assistant' AND before = 'assistant', false)) AS twice,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, chr(10) ORDER BY turn), '') AS answer FROM n GROUP BY conv_id)
SELECT conv_id, first != 'assistant' AND asked AND said AND NOT twice AND length(trim(answer, ' ' || chr(10) || chr(9))) >= 30 AS ok FROM c
""")
def instruction_quality(spark: SparkSession, sf: str) -> DataFrame:
    rows = validate.role_checks(_turns(spark, sf), "conv_id", "turn", "role", "text")
    return rows.select("conv_id", validate.instruction_ok(F.col("roles"), F.col("assistant")).alias("ok"))


@query("""
WITH t AS (SELECT conv_id, turn, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tok, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations),
b AS (SELECT conv_id, sum(tok) FILTER (turn IN (0, last)) + 32 AS base FROM t GROUP BY conv_id),
h AS (SELECT t.conv_id, b.base, t.tok, sum(t.tok) OVER (PARTITION BY t.conv_id ORDER BY t.turn DESC) AS newest FROM t JOIN b USING (conv_id) WHERE t.turn NOT IN (0, t.last)),
k AS (SELECT conv_id, count(*) AS steps, count(*) FILTER (base <= 900 AND base + newest <= 900) AS kept, coalesce(max(newest) FILTER (base <= 900 AND base + newest <= 900), 0) AS sum FROM h GROUP BY conv_id)
SELECT conv_id, CAST(base AS BIGINT) AS base, base <= 900 AS fits, CAST(coalesce(steps, 0) AS BIGINT) AS history_steps, CAST(coalesce(kept, 0) AS BIGINT) AS kept_steps, CAST(base + coalesce(sum, 0) AS BIGINT) AS estimated_tokens
FROM b LEFT JOIN k USING (conv_id)
""")
def history_fit_to_budget(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").withColumn("last", F.max("turn").over(J.Window.partitionBy("conv_id")))
    ends = (F.col("turn") == 0) | (F.col("turn") == F.col("last"))
    base = F.sum(F.when(ends, tokens(F.col("text"))).otherwise(0)).over(J.Window.partitionBy("conv_id")) + 32
    items = rows.withColumn("base", base).select("conv_id", "base", F.when(~ends, F.col("turn")).alias("step"), "text")
    return reports.fit_history(items, "conv_id", "step", "text", "base", 900)


@query(f"""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), '{','.join(sorted(["difficulty:sorting"]))}'), (2, 'difficulty:exact_quantity,difficulty:ranking'), (3, '')) v(id, found)
""")
def difficulty_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "id long, text string", (1, "Arrange the icons"), (2, "Take the top 3 of all 12"), (3, "Open the page"))
    return rows.select("id", F.array_join(F.transform(difficulty_signals(F.col("text")), lambda x: F.concat(F.lit("difficulty:"), x)), ",").alias("found"))


@query("""
WITH a AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
SELECT event_type, CAST(round(greatest(0.3, 1.0 - 3 * n / sum(n) OVER ()), 6) AS DOUBLE) AS rarity FROM a
""")
def app_rarity(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(J.Window.partitionBy(F.lit(1)))
    return counts.select("event_type", F.round(Q.app_rarity(F.col("event_type"), share), 6).alias("rarity"))


@query()
def size_bucket_quota(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select("p_partkey", G.size_bucket(F.col("p_size") * 2, F.floor(F.col("p_retailprice") / 20)).alias("bucket"))
    return J.bucket_quota(rows, "bucket", "p_partkey", {k: v[2] for k, v in fixed.SIZE_BUCKETS.items()})
