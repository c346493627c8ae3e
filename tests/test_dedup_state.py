"""Clusters written as JSON and read back: whole, in rows of bounded size, as the SQL has them."""

import json
import shutil
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import difference

from millrace.operators import dedup, runs
from millrace.plans import ORACLE_SQL, QUERIES


def test_a_state_is_read_back_whole_from_rows_of_bounded_size(spark):
    """A cluster was one list of one row however many hashes it had, and a hash that is null was lost."""
    want = {(7, h) for h in range(-50, 50)} | {(k, k * 3) for k in range(100, 140)} | {(-1, None), (7, None)}
    df = spark.createDataFrame([*want, *want], "leader long, h long")
    states = runs.state_json(df, 16)
    told = [[(c["leader"], h) for c in json.loads(r["state"]) for h in c["hashes"]] for r in states.collect()]
    order = lambda pair: (pair[0], pair[1] is not None, pair[1] or 0)
    assert all(len(row) <= 16 and row == sorted(row, key=order) for row in told)
    assert sorted((p for row in told for p in row), key=order) == sorted(want, key=order)
    assert sorted(map(tuple, runs.state_rows(states).collect()), key=order) == sorted(want, key=order)


def test_clusters_are_the_leaders_of_the_hashes(spark):
    df = spark.createDataFrame([(1, 0), (2, 63), (3, 127), (4, 0), (5, None), (6, None), (7, -1), (8, 127)], "id long, h long")
    led = df.join(dedup.leaders(df, "id", "h").withColumnRenamed("seq", "id"), "id").select("leader", "h")
    assert sorted(map(str, led.distinct().collect())) == sorted(map(str, dedup.clusters(df, "id", "h").collect()))


@pytest.mark.parametrize("name", ["dedup_state", "leader_clusters", "context_aware_near_dup", "hamming_pairs"])
def test_vectors_without_components_are_those_of_the_sql(spark, sf, tmp_path, name):
    """A null vector lost its clusters in the state and shared no signature with its variants; a short one failed the query."""
    for path in Path(sf).iterdir():
        shutil.copyfile(path, tmp_path / path.name)
    rows = pq.read_table(tmp_path / "embeddings.parquet").slice(0, 60)
    vectors, at = rows["embedding"].to_pylist(), rows.schema.get_field_index("embedding")
    vectors[3], vectors[11], vectors[12], vectors[13], vectors[14] = None, [], vectors[12][:20], [None, *vectors[13][1:]], [*vectors[14][:63], float("nan")]
    pq.write_table(rows.set_column(at, "embedding", pa.array(vectors, rows.schema.field(at).type)), tmp_path / "embeddings.parquet")
    assert difference(spark, str(tmp_path), QUERIES[name], ORACLE_SQL[name]) == ""
