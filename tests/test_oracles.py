"""Every registered query against its SQL, or at least run, on the smallest tables."""

import re
import shutil
from pathlib import Path

import pytest
from oracle import difference

from millrace.plans import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    if name in ORACLE_SQL:
        assert difference(spark, sf, QUERIES[name], ORACLE_SQL[name]) == ""
    else:
        first, again = (sorted(map(str, QUERIES[name](spark, sf).collect())) for _ in range(2))
        assert first == again and first


def test_every_query_has_a_name_of_its_own():
    assert set(ORACLE_SQL) <= set(QUERIES) and not any(re.match(r"op\d|pipeline$", n) for n in QUERIES)


def test_app_from_page_ends_words_at_accented_letters(spark, sf, tmp_path):
    for path in Path(sf).iterdir():
        shutil.copy(path, tmp_path)
    titles = ["äthe x", "theö", "über dieä", "éder", "die", "the_", "2der", "xthe", "Die the", ""]
    spark.createDataFrame([(i, "https://a.b/c", f"<title>{t}</title>") for i, t in enumerate(titles)], "page_id long, url string, html string").toPandas().to_parquet(tmp_path / "pages.parquet")
    assert difference(spark, str(tmp_path), QUERIES["app_from_page"], ORACLE_SQL["app_from_page"]) == ""
