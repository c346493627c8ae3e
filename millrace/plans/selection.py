"""Queries on quotas and constrained selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import hashing as H
from millrace.functions import scores as Q
from millrace.functions.text import tokens
from millrace.operators import selection as L
from millrace.operators.common import fixed_rows
from millrace.plans.registry import query
from millrace.session import table


def _langs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"))


@query("""
SELECT lang, n, CAST(greatest(n, ceil(n * CASE lang WHEN 'en' THEN 1.5 WHEN 'fr' THEN 1.25 ELSE 1.0 END)) AS BIGINT) AS candidates FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
""")
def candidate_targets(spark: SparkSession, sf: str) -> DataFrame:
    factor = F.when(F.col("lang") == "en", 1.5).when(F.col("lang") == "fr", 1.25).otherwise(F.lit(None).cast("double"))
    return L.candidate_targets(_langs(spark, sf).withColumn("factor", factor), count="n").select("lang", "n", "candidates")


def _seats(tie: str) -> str:
    return f"""
WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
e AS (SELECT *, 73.0::DOUBLE * n / sum(n) OVER () AS exact FROM c), f AS (SELECT *, floor(exact) AS base FROM e)
SELECT source, CAST(base + CASE WHEN row_number() OVER (ORDER BY exact - base DESC, source {tie}) <= 73 - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS seats FROM f
"""


def _weights(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"))


@query(_seats("DESC"))
def largest_remainder_last(spark: SparkSession, sf: str) -> DataFrame:
    return L.largest_remainder(_weights(spark, sf), "source", "n", 73).select("source", "seats")


@query(_seats("ASC"))
def largest_remainder_first(spark: SparkSession, sf: str) -> DataFrame:
    return L.largest_remainder(_weights(spark, sf), "source", "n", 73, last_first=False).select("source", "seats")


POOL = """
WITH d AS (SELECT doc_id, lang, source, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tok, quality FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)),
f AS (SELECT *, count(*) OVER (PARTITION BY source) AS ng, count(*) OVER (PARTITION BY lang) AS na,
  CASE WHEN quality IS NULL OR quality = 0 THEN 5.0 ELSE quality * 7.0 END AS q, coalesce(quality, 0) * 7.0 / greatest(1.0, tok / 1000) AS eff FROM d),
s AS (SELECT *, round(q + 0.9 * least(1.5, ln(1 + eff) / 2) + 0.45 / sqrt(ng) + 0.30 / sqrt(na), 5) AS score,
  sha256(concat_ws('|', lang, source, CAST(doc_id AS VARCHAR))) AS tie FROM f)
"""


def pool(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a selection score; rounded, so that equal sums on other engines tie alike."""
    marks = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = table(spark, sf, "documents").select("doc_id", "lang", "source", tokens(F.col("text")).alias("tok")).join(marks, "doc_id", "left")
    rows = L.frequency_columns(rows, {"ng": "source", "na": "lang"}).withColumn("q", F.col("quality") * 7.0)
    eff = Q.token_efficiency(F.coalesce("q", F.lit(0.0)), F.col("tok"))
    score = Q.selection_score(F.col("q"), eff, {"group": F.col("ng"), "app": F.col("na")})
    return rows.select("doc_id", "lang", "source", F.round(score, 5).alias("score"), H.stable_tie(F.col("lang"), F.col("source"), F.col("doc_id")).alias("tie"))


@query(POOL + "SELECT doc_id, CAST(score AS DOUBLE) AS score FROM s")
def selection_score(spark: SparkSession, sf: str) -> DataFrame:
    return pool(spark, sf).select("doc_id", "score")


TARGETS = (("de", "all", 40), ("en", "all", 90), ("es", "all", 25), ("fr", "all", 500))


def _chosen(spark: SparkSession, sf: str) -> DataFrame:
    wanted = fixed_rows(spark, "lang string, cohort string, want long", *TARGETS)
    return L.best_valid(pool(spark, sf).withColumn("cohort", F.lit("all")), wanted, "lang", "cohort", "source", "score", "tie")


@query(POOL + f"""
, w AS (SELECT * FROM (VALUES {', '.join(str(t) for t in TARGETS)}) v(lang, cohort, want)),
g AS (SELECT lang, count(DISTINCT source) AS groups FROM s GROUP BY lang),
r AS (SELECT s.*, w.want, greatest(2, ceil(greatest(1, w.want) / g.groups * 2.5)) AS cap, row_number() OVER (PARTITION BY s.lang, s.source ORDER BY s.score DESC, s.tie) AS k FROM s JOIN w USING (lang) JOIN g USING (lang)),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY k > cap, score DESC, tie) AS rank FROM r)
SELECT doc_id, lang, rank FROM o WHERE rank <= want
""")
def best_valid_select(spark: SparkSession, sf: str) -> DataFrame:
    return _chosen(spark, sf).select("doc_id", "lang", "rank")


@query()
def motif_floor_swap(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.array_compact(F.array(*[F.when(F.col("doc_id") % m == 0, F.lit(name)) for name, m in (("drag", 11), ("hotkeys", 7), ("settings", 5))]))
    rows = pool(spark, sf).withColumn("cohort", F.lit("all")).withColumn("motifs", kinds)
    chosen = _chosen(spark, sf).select("doc_id")
    swaps = L.motif_swaps(rows, chosen, {"drag": 0.1, "hotkeys": 45}, "doc_id", "lang", "cohort", "score", "tie", "motifs", counted=300)
    return fixed_rows(spark, "motif string, in long, out long", *[(s["motif"], s["in"], s["out"]) for s in swaps])


@query("""
WITH t AS (SELECT lang, count(*) AS selected FROM documents GROUP BY lang), g AS (SELECT * FROM (VALUES ('en', 300), ('fr', 2000000), ('de', 0), ('xx', 5)) v(lang, target))
SELECT lang, CAST(target AS BIGINT) AS target, CAST(coalesce(selected, 0) AS BIGINT) AS selected, CAST(round(CASE WHEN target = 0 THEN 100.0 ELSE 100.0 * coalesce(selected, 0) / target END, 4) AS DOUBLE) AS realization_pct,
  lang = 'de' AS source_error, (target = 0 OR coalesce(selected, 0) >= target * CASE lang WHEN 'fr' THEN 0.9 ELSE 0.99 END) AND lang != 'de' AS accepted FROM g LEFT JOIN t USING (lang)
""")
def quota_acceptance(spark: SparkSession, sf: str) -> DataFrame:
    selected = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("selected"))
    wanted = fixed_rows(spark, "lang string, target long", ("en", 300), ("fr", 2000000), ("de", 0), ("xx", 5))
    rows = L.quota_acceptance(selected, wanted, "lang", {"fr": 0.9}, fixed_rows(spark, "lang string", ("de",)))
    return rows.select("lang", "target", "selected", F.round("realization_pct", 4).alias("realization_pct"), "source_error", "accepted")


RANKED = "sha256('{}:' || {})"


@query(f"""
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), e AS (SELECT *, 50.0::DOUBLE * n / sum(n) OVER () AS exact FROM c), f AS (SELECT *, floor(exact) AS base FROM e),
s AS (SELECT lang, base + CASE WHEN row_number() OVER (ORDER BY exact - base DESC, lang) <= 50 - sum(base) OVER () THEN 1 ELSE 0 END AS seats FROM f)
SELECT doc_id, lang FROM documents JOIN s USING (lang) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {RANKED.format('frozen', 'doc_id')}, doc_id) <= max(seats) OVER (PARTITION BY lang)
""")
def frozen_subset(spark: SparkSession, sf: str) -> DataFrame:
    return L.stratified(table(spark, sf, "documents").select("doc_id", "lang"), "lang", 50, "frozen", "doc_id")


@query(f"""
WITH d AS (SELECT doc_id, source, CASE WHEN doc_id % 13 = 0 THEN 'a_rare' WHEN doc_id % 7 = 0 THEN 'b_often' END AS category FROM documents),
f AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY source ORDER BY {RANKED.format('pack', 'doc_id')}, doc_id) <= 3),
r AS (SELECT * FROM d WHERE category IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM f) QUALIFY row_number() OVER (PARTITION BY category ORDER BY {RANKED.format('pack', 'doc_id')}, doc_id) <= 10)
SELECT doc_id, 'source:' || source AS tag FROM f UNION ALL SELECT doc_id, 'suspicious:' || category FROM r
""")
def review_pack(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.array_compact(F.array(F.when(F.col("doc_id") % 13 == 0, F.lit("a_rare")), F.when(F.col("doc_id") % 7 == 0, F.lit("b_often"))))
    rows = table(spark, sf, "documents").select("doc_id", "source", kinds.alias("kinds"))
    return L.review_pack(rows, "doc_id", "source", "kinds", 3, 10, "pack")


@query("""
WITH n AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS k FROM (SELECT DISTINCT source FROM documents))
SELECT source FROM n WHERE k IN (SELECT CAST(round_even(i * 19 / 6, 0) AS BIGINT) FROM range(0, 7) t(i))
""")
def systematic_sample(spark: SparkSession, sf: str) -> DataFrame:
    return L.systematic(table(spark, sf, "documents"), "source", 7)


@query("SELECT sample_id, frontier_score FROM (VALUES ('a', CAST(0.9 AS DOUBLE)), ('c', 1.0)) v(sample_id, frontier_score)")
def frontier_scores(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "line long, sample_id string, verifiable boolean, frontier_score double", (1, "a", True, 0.2), (2, "a", True, 0.9), (3, "b", False, 1.0), (4, "c", True, 7.0), (5, "", True, 0.5), (6, "d", True, None))
    return L.frontier(rows, "line")


@query("SELECT * FROM (VALUES ('coding', CAST(213 AS BIGINT)), ('math', 200), ('instruction', 227), ('vqa', 187), ('tool', 173)) v(category, n)")
def replay_subtargets(spark: SparkSession, sf: str) -> DataFrame:
    return fixed_rows(spark, "category string, n long", *L.replay_targets(1000).items())
