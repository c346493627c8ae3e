"""Queries on benchmark contamination by n-gram overlap, line by line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import similarity as S
from millrace.plans.registry import query
from millrace.session import table

KEY = ["doc_id", "line_no"]
WORDS = "regexp_extract_all(lower({}), '[a-z0-9]+')"
GRAMS = """CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 8 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) END"""
BASE = f"""
WITH split AS (SELECT doc_id, source, string_split(text, chr(10)) AS a FROM documents),
lines AS (SELECT doc_id, source, unnest(range(0, len(a))) AS line_no, unnest(a) AS line FROM split),
cut AS (SELECT doc_id, source, line_no, {WORDS.format('line')} AS w FROM lines),
l AS (SELECT *, array_to_string(w, ' ') AS norm, {GRAMS} AS g, list_distinct(w) AS u FROM cut),
rcut AS (SELECT item_id AS ref_id, {WORDS.format('text')} AS w FROM benchmark WHERE text != ''),
r AS (SELECT ref_id, array_to_string(w, ' ') AS rnorm, {GRAMS} AS rg, list_distinct(w) AS ru FROM rcut),
pairs AS (SELECT doc_id, line_no, ref_id, norm = rnorm AS same, len(list_intersect(g, rg)) AS i, len(g) AS ng, len(rg) AS nr,
  CASE WHEN len(u) < 8 THEN len(list_intersect(u, ru)) / greatest(1, len(u)) ELSE len(list_intersect(g, rg)) / len(g) END AS c,
  array_to_string(list_sort(list_intersect(g, rg))[1:5], '|') AS fragments FROM l, r WHERE len(w) > 0),
scored AS (SELECT *, i / (ng + nr - i) AS j, greatest(i / (ng + nr - i), c) AS s FROM pairs),
hits AS (SELECT doc_id, line_no, ref_id, CASE WHEN same THEN 'exact' WHEN j >= c THEN 'near_jaccard' ELSE 'containment' END AS kind,
  CASE WHEN same THEN 2.0 ELSE s END AS rank, CASE WHEN same THEN 1.0 ELSE round(s, 4) END AS score, CASE WHEN same THEN '' ELSE fragments END AS fragments
  FROM scored WHERE same OR s >= 0.5),
best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY doc_id, line_no ORDER BY rank DESC, ref_id) = 1)
"""


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return S.lines(table(spark, sf, "documents"), keep=("source",))


def _refs(spark: SparkSession, sf: str) -> DataFrame:
    return S.references(table(spark, sf, "benchmark"), "item_id", "text")


def _best(spark: SparkSession, sf: str) -> DataFrame:
    return S.contaminated(_lines(spark, sf), _refs(spark, sf), KEY, "line")


@query(BASE + "SELECT doc_id, line_no, kind, ref_id, CAST(round(score, 4) AS DOUBLE) AS score, fragments FROM best")
def contamination_flag(spark: SparkSession, sf: str) -> DataFrame:
    return _best(spark, sf).select("doc_id", "line_no", "kind", "ref_id", "score", F.array_join("fragments", "|").alias("fragments"))


#: With every benchmark item, partly in capitals, as a line of a document of its own.
PLANTED = BASE.replace("FROM documents),\nlines", "FROM documents UNION ALL SELECT -1 - item_id, 'planted', [translate(replace(text, chr(10), ' '), 'abcdefghijklm', 'ABCDEFGHIJKLM') || '!'] FROM benchmark),\nlines")


@query(PLANTED + "SELECT doc_id, line_no, ref_id FROM best WHERE kind = 'exact'")
def contamination_exact(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark").select((-1 - F.col("item_id")).alias("doc_id"), F.concat(F.translate(F.replace("text", F.lit("\n"), F.lit(" ")), "abcdefghijklm", "ABCDEFGHIJKLM"), F.lit("!")).alias("text"), F.lit("planted").alias("source"))
    docs = table(spark, sf, "documents").select("doc_id", "text", "source").unionByName(items)
    found = S.contaminated(S.lines(docs), _refs(spark, sf), KEY, "line")
    return found.where("kind = 'exact'").select("doc_id", "line_no", "ref_id")


@query(BASE + "SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM best WHERE score >= 0.5 AND kind != 'containment')")
def contamination_anti(spark: SparkSession, sf: str) -> DataFrame:
    flagged = _best(spark, sf).where("kind != 'containment'")
    return S.remove_contaminated(table(spark, sf, "documents").select("doc_id", "source", "n_chars"), flagged, ["doc_id"])


@query(BASE + """
SELECT l.source, count(*) AS scanned, CAST(count(*) FILTER (kind = 'exact') AS BIGINT) AS exact, CAST(count(*) FILTER (kind != 'exact') AS BIGINT) AS similar,
  CAST(count(kind) AS BIGINT) AS removed FROM l LEFT JOIN best USING (doc_id, line_no) GROUP BY GROUPING SETS ((l.source), ())
""")
def contamination_report(spark: SparkSession, sf: str) -> DataFrame:
    return S.contamination_report(_lines(spark, sf), _best(spark, sf), KEY, "source")


@query(BASE + "SELECT CAST(least(9, floor(round(score, 3) * 10)) / 10 AS DOUBLE) AS bin, count(*) AS n FROM best GROUP BY 1")
def similarity_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return S.similarity_histogram(_best(spark, sf))


@query(BASE + f"""
, d AS (SELECT doc_id, {GRAMS} AS g FROM (SELECT doc_id, {WORDS.format('text')} AS w FROM documents))
SELECT doc_id, ref_id, CAST(round(len(list_intersect(g, rg)) / len(rg), 6) AS DOUBLE) AS share FROM d, r WHERE len(rg) > 0 AND len(list_intersect(g, rg)) / len(rg) >= 0.5
""")
def reference_containment(spark: SparkSession, sf: str) -> DataFrame:
    found = S.reference_containment(table(spark, sf, "documents"), _refs(spark, sf), "doc_id", "text")
    return found.select("doc_id", "ref_id", F.round("share", 6).alias("share"))
