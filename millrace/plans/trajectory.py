"""Queries on trajectories: the steps are the events of a user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import choice, uniform
from millrace.operators import reports, selection
from millrace.operators import trajectory as J
from millrace.operators.common import fixed_rows
from millrace.plans.registry import query
from millrace.session import table

GAP = 6 * 3600.0
#: Event types as verbs of a trajectory.
VERB = {"click": "click", "view": "scroll", "purchase": "drag", "signup": "wait", "error": "move"}
SQL_VERB = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in VERB.items()) + " END"
STEPS = f"""
WITH e AS (SELECT event_id, user_id, ts, event_type, value, {SQL_VERB} AS verb, row_number() OVER u - 1 AS idx, count(*) OVER (PARTITION BY user_id) AS n,
    lag(ts) OVER u AS before, CAST(concat('0x', substring(md5(event_type), 1, 15)) AS UBIGINT) AS state FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, CAST(sum(CASE WHEN (epoch_us(ts) - epoch_us(before)) / 1e6 >= {GAP} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM e),
c AS (SELECT *, bit_count(xor(state, lag(state) OVER (PARTITION BY user_id, segment ORDER BY idx))) > 6 AS changed FROM s)
"""


def steps(spark: SparkSession, sf: str) -> DataFrame:
    """Events numbered along each user, in segments parted by gaps of six hours."""
    verb = F.lit(None).cast("string")
    for k, v in VERB.items():
        verb = F.when(F.col("event_type") == k, v).otherwise(verb)
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value", verb.alias("verb"))
    w = J.Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = rows.withColumn("idx", (F.row_number().over(w) - 1).cast("long")).withColumn("seconds", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    state = F.conv(F.substring(F.md5("event_type"), 1, 15), 16, 10).cast("long")
    rows = J.continuity(rows, "user_id", "idx", J.time_gap("user_id", "idx", F.col("seconds"), GAP)).withColumn("state", state)
    return J.state_change(rows, "user_id", "segment", "idx", "state")


@query(STEPS + "SELECT event_id, user_id, segment FROM s")
def continuity_segments(spark: SparkSession, sf: str) -> DataFrame:
    return steps(spark, sf).select("event_id", "user_id", "segment")


@query(STEPS + """
SELECT event_id, coalesce(array_to_string(list(verb) OVER (PARTITION BY user_id, segment ORDER BY idx ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), ' '), '') AS history FROM s
""")
def history_window(spark: SparkSession, sf: str) -> DataFrame:
    return J.history(steps(spark, sf), "user_id", "segment", "idx", "verb").select("event_id", F.array_join("history", " ").alias("history"))


@query(STEPS + "SELECT event_id, changed FROM c")
def state_change(spark: SparkSession, sf: str) -> DataFrame:
    return steps(spark, sf).select("event_id", "changed")


def _frames(least: int, most: int, rule: str) -> str:
    return STEPS + f"""
, f AS (SELECT user_id, idx, count(*) OVER w AS steps, sum(CASE WHEN coalesce(changed, true) THEN 1 ELSE 0 END) OVER w AS changes,
  len(list_distinct(list(verb) OVER w)) AS actions, min(segment) OVER w = max(segment) OVER w AS whole, sum(CASE WHEN verb = 'wait' THEN 1 ELSE 0 END) OVER w AS waits
  FROM c WINDOW w AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND {most - 1} FOLLOWING))
SELECT user_id, CAST(idx AS BIGINT) AS idx, CAST(steps AS BIGINT) AS steps, CAST(changes AS BIGINT) AS changes, CAST(actions AS BIGINT) AS actions, whole AND {rule} AS informative FROM f WHERE steps >= {least}
"""


@query(_frames(4, 4, "changes >= 2 AND actions >= 2"))
def window_informative(spark: SparkSession, sf: str) -> DataFrame:
    return J.windows(steps(spark, sf), "user_id", "segment", "idx", "verb", "changed").select("user_id", "idx", "steps", "changes", "actions", "informative")


@query(_frames(8, 12, "changes >= 0.5 * steps AND actions >= 4 AND waits <= 0.3 * steps"))
def chunk_informative(spark: SparkSession, sf: str) -> DataFrame:
    return J.windows(steps(spark, sf), "user_id", "segment", "idx", "verb", "changed", least=8, most=12, chunk=True).select("user_id", "idx", "steps", "changes", "actions", "informative")


WEIGHED = STEPS + """
, w AS (SELECT event_id, user_id, idx, CASE WHEN n <= 1 THEN 2 ELSE least(4, 5 * idx // n) END AS bucket,
  CASE WHEN verb = 'move' THEN 0.0 ELSE CASE WHEN verb IN ('drag', 'wait') OR value > 80 THEN 2.0 ELSE 1.0 END * CASE WHEN verb = 'scroll' THEN 0.5 ELSE 1.0 END END AS weight FROM s)
"""


def _weighed(spark: SparkSession, sf: str) -> DataFrame:
    signals = F.array_compact(F.array(F.when(F.col("value") > 80, F.lit("verification")), F.when(F.col("verb") == "scroll", F.lit("ordinary_navigation"))))
    return J.scored_steps(steps(spark, sf).withColumn("signals", signals), "user_id", "idx", "verb", "signals")


@query(WEIGHED + "SELECT event_id, CAST(bucket AS BIGINT) AS bucket, CAST(weight AS DOUBLE) AS weight FROM w")
def step_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _weighed(spark, sf).select("event_id", "bucket", "weight")


@query(WEIGHED + """
, t AS (SELECT *, row_number() OVER (PARTITION BY user_id, bucket ORDER BY weight DESC, idx) AS turn FROM w WHERE weight > 0)
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY turn, list_position([2, 1, 3, 0, 4], bucket)) AS pick FROM t QUALIFY pick <= 4
""")
def step_sample_round_robin(spark: SparkSession, sf: str) -> DataFrame:
    return J.round_robin(_weighed(spark, sf), "user_id").select("event_id", "user_id", "pick")


UNIFORM = "CAST(concat('0x', substring(md5({}), 1, {})) AS UBIGINT) / CAST({} AS DOUBLE)"


def _u(key: str, digits: int = 8) -> str:
    return UNIFORM.format(key, digits, 16**digits - 1)


@query(f"""
WITH u AS (SELECT DISTINCT user_id, {_u("'repr:' || user_id")} AS u FROM events)
SELECT user_id, CASE WHEN u < 0.16 THEN 'single' WHEN u < 0.76 THEN 'window' WHEN u < 1.0 THEN 'chunk' ELSE 'single' END AS form FROM u
""")
def representation_draw(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("user_id").distinct().select("user_id", J.representation(F.col("user_id")).alias("form"))


@query(STEPS + WEIGHED.removeprefix(STEPS) + f"""
, t AS (SELECT *, row_number() OVER (PARTITION BY user_id, bucket ORDER BY weight DESC, idx) AS turn FROM w WHERE weight > 0),
p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY turn, list_position([2, 1, 3, 0, 4], bucket)) AS pick FROM t QUALIFY pick <= 4),
picks AS (SELECT user_id, list(CAST(idx AS BIGINT) ORDER BY idx) AS picks FROM p GROUP BY user_id),
sized AS (SELECT user_id, count(*) AS n FROM s GROUP BY user_id)
SELECT user_id, n, CAST(len(picks) AS BIGINT) AS picks, least(n - 4, CAST(floor({_u("'win:' || user_id || ':0'")} * (n - 3)) AS BIGINT)) AS first_window FROM sized JOIN picks USING (user_id)
""")
def window_start_draw(spark: SparkSession, sf: str) -> DataFrame:
    rows = _weighed(spark, sf)
    sized = rows.groupBy("user_id").agg(F.count("*").alias("n"))
    picks = J.round_robin(rows, "user_id").groupBy("user_id").agg(F.count("*").alias("picks"))
    return sized.join(picks, "user_id").select("user_id", "n", "picks", F.get(J.window_starts(F.col("user_id"), F.col("n"), 4), 0).alias("first_window"))


@query()
def representation_emission(spark: SparkSession, sf: str) -> DataFrame:
    rows = _weighed(spark, sf)
    good3 = J.windows(rows, "user_id", "segment", "idx", "verb", "changed").where("informative").groupBy("user_id").agg(F.collect_list("idx").alias("good3"))
    good8 = J.windows(rows, "user_id", "segment", "idx", "verb", "changed", least=8, most=12, chunk=True).where("informative").groupBy("user_id").agg(F.collect_list("idx").alias("good8"))
    picks = J.round_robin(rows, "user_id").groupBy("user_id").agg(F.sort_array(F.collect_list("idx")).alias("picks"), F.first("n").alias("n"))
    none = F.array().cast("array<bigint>")
    units = picks.join(good3, "user_id", "left").join(good8, "user_id", "left").select("user_id", "n", "picks", F.coalesce("good3", none).alias("good3"), F.coalesce("good8", none).alias("good8"))
    return J.emitted(units, "user_id")


@query("""
WITH units AS (SELECT event_type, user_id, min(event_id) AS seq, count(*) AS got FROM events GROUP BY 1, 2),
r AS (SELECT *, coalesce(sum(got) OVER (PARTITION BY event_type ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM units)
SELECT event_type, user_id, got, CAST(before AS BIGINT) AS before FROM r WHERE before < 500
""")
def app_cap(spark: SparkSession, sf: str) -> DataFrame:
    units = table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.min("event_id").alias("seq"), F.count("*").alias("got"))
    return J.app_cap(units, "event_type", "seq", "got", 500).select("event_type", "user_id", "got", F.col("before").cast("long").alias("before"))


@query(f"""
WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id),
p AS (SELECT *, CASE WHEN n < 4 THEN 0.5 WHEN n BETWEEN 6 AND 40 THEN 1.0 WHEN n < 6 THEN 0.8 ELSE 0.9 END AS priority FROM n)
SELECT user_id, n, CAST(priority AS DOUBLE) AS priority, priority >= 1 OR {_u("'keep:' || user_id")} < priority AS kept FROM p
""")
def trajectory_priority_keep(spark: SparkSession, sf: str) -> DataFrame:
    return J.kept_trajectories(table(spark, sf, "events"), "user_id")


@query(STEPS + "SELECT event_id FROM s QUALIFY verb = lag(verb) OVER (PARTITION BY user_id ORDER BY idx) AND value <= 80")
def repeated_action_reject(spark: SparkSession, sf: str) -> DataFrame:
    return steps(spark, sf).withColumn("again", J.repeated("user_id", "idx", "verb", F.col("value") > 80)).where("again").select("event_id")


@query(STEPS + """
, w AS (SELECT user_id, verb = 'wait' AND lag(verb) OVER (PARTITION BY user_id ORDER BY idx) = 'wait' AS pair FROM s)
SELECT user_id, CAST(count(*) FILTER (pair) AS BIGINT) AS wait_pairs FROM w GROUP BY user_id
""")
def wait_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = steps(spark, sf).withColumn("again", J.repeated("user_id", "idx", "verb") & (F.col("verb") == "wait"))
    return rows.groupBy("user_id").agg(F.count_if("again").alias("wait_pairs"))


@query(f"""
WITH d AS (SELECT doc_id, {_u("'replay:' || source || ':' || lang || ':' || doc_id")} AS u FROM documents)
SELECT doc_id, CAST(round(u, 9) AS DOUBLE) AS u FROM d WHERE u < 0.12
""")
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    u = uniform(F.concat(F.lit("replay:"), F.concat_ws(":", "source", "lang", F.col("doc_id").cast("string"))))
    return table(spark, sf, "documents").select("doc_id", u.alias("u")).where("u < 0.12").select("doc_id", F.round("u", 9).alias("u"))


@query(f"""
SELECT doc_id, source || ':' || doc_id % 40 AS split_group, CASE WHEN {_u("source || ':' || doc_id % 40", 12)} < 0.1 THEN 'validation' ELSE 'train' END AS split FROM documents
""")
def group_split(spark: SparkSession, sf: str) -> DataFrame:
    group = F.concat_ws(":", "source", (F.col("doc_id") % 40).cast("string"))
    return selection.split(table(spark, sf, "documents").select("doc_id", "source"), group, 10.0).select("doc_id", "split_group", "split")


@query(f"""
WITH s AS (SELECT lang || ':' || doc_id % 50 AS g, CASE WHEN {_u("doc_id::VARCHAR", 12)} < 0.3 THEN 'validation' ELSE 'train' END AS split FROM documents)
SELECT g AS family FROM s GROUP BY g HAVING count(DISTINCT split) = 2
""")
def split_overlap(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", F.concat_ws(":", "lang", (F.col("doc_id") % 50).cast("string")).alias("family"))
    return selection.overlap(selection.split(rows, F.col("doc_id"), 30.0), "family")


@query(f"""
WITH s AS (SELECT lang, CASE WHEN {_u("source || ':' || doc_id % 40", 12)} < 0.1 THEN 'validation' ELSE 'train' END AS split FROM documents)
SELECT lang, CAST(count(*) FILTER (split = 'train') AS BIGINT) AS train, CAST(count(*) FILTER (split = 'validation') AS BIGINT) AS validation FROM s GROUP BY lang
""")
def split_balance(spark: SparkSession, sf: str) -> DataFrame:
    group = F.concat_ws(":", "source", (F.col("doc_id") % 40).cast("string"))
    rows = selection.split(table(spark, sf, "documents").select("doc_id", "lang", "source"), group, 10.0)
    return rows.groupBy("lang").agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "validation").alias("validation"))


@query(STEPS + """
, t AS (SELECT user_id, idx, epoch_us(ts) / 1e6 AS t FROM s),
d AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY idx) AS d FROM t),
g AS (SELECT user_id, max(t) FILTER (idx = 5) - min(t) AS w, max(t) FILTER (idx = 45) - max(t) FILTER (idx = 5) AS m, list(d ORDER BY d) FILTER (idx > 5 AND idx <= 45) AS d FROM d GROUP BY user_id HAVING count(*) > 45)
SELECT user_id, round(w, 3) AS warmup_seconds, round(m, 3) AS measured_seconds, round(m / 40, 3) AS mean, round((d[20] + d[21]) / 2, 3) AS median, round(d[CAST(round_even(0.9 * 39, 0) AS INT) + 1], 3) AS p90 FROM g
""")
def throughput_stats(spark: SparkSession, sf: str) -> DataFrame:
    found = reports.throughput(steps(spark, sf), "user_id", "idx", "seconds", 5, 40)
    return found.select("user_id", *[F.round(c, 3).alias(c) for c in ("warmup_seconds", "measured_seconds", "mean", "median", "p90")])


@query("""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), CAST(2 AS BIGINT), 'CLICK', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)), (1, 4, 'DRAG_TO', 10.0, 10.0), (2, 1, 'MOVE_TO', NULL, NULL), (2, 2, 'CLICK', NULL, NULL)) v(task, idx, kind, start_x, start_y)
""")
def micro_actions(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "task long, idx long, kind string, x double, y double, t double",
        (1, 1, "MOVE_TO", 11.0, 12.0, 0.0), (1, 2, "CLICK", 10.0, 10.0, 0.0), (1, 3, "MOUSE_DOWN", None, None, 1.0), (1, 4, "DRAG_TO", 50.0, 60.0, 2.0), (1, 5, "MOUSE_UP", None, None, 3.0),
        (2, 1, "MOVE_TO", 500.0, 500.0, 0.0), (2, 2, "CLICK", 10.0, 10.0, 0.0),
    )
    return J.micro_actions(rows, "task", "idx", "kind", "x", "y", "t").select("task", "idx", "kind", "start_x", "start_y")


@query(f"""
WITH s AS (SELECT DISTINCT source FROM documents) SELECT source, CASE WHEN {_u('source')} < 0.5 THEN 'a' WHEN {_u('source')} < 1.0 THEN 'b' ELSE 'a' END AS half FROM s
""")
def seeded_shards(spark: SparkSession, sf: str) -> DataFrame:
    return J.seeded_order(table(spark, sf, "documents").select("source").distinct(), "source", "7").select("source", choice(F.col("source"), {"a": 0.5, "b": 0.5}).alias("half"))
