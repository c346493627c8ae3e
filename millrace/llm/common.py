"""Helpers shared by the corpus operators: staging tables, sizes, components."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Where a local session names none (as in tests) a temporary folder is made
    once per application; on a cluster that is an error, since executors could
    not read each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return _FALLBACK[app]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stage:
    """Intermediate Parquet tables of one operator call, in the shared folder.

    A staged table cuts lineage and outlives the executors that wrote it, so a
    lost executor costs only its running tasks. An operator's result reads its
    tables, so they stay until the caller is done: ``clear`` deletes what was
    staged since a ``mark``.
    """

    _roots: list[str] = []

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self._roots.append(self.root)
        self._n = 0

    @classmethod
    def mark(cls) -> int:
        return len(cls._roots)

    @classmethod
    def clear(cls, spark: SparkSession, mark: int = 0) -> None:
        """Delete all tables of the operators called since ``mark``; nothing may read them any more."""
        for root in cls._roots[mark:]:
            _delete(spark, root)
        del cls._roots[mark:]

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self._n}"
        self._n += 1
        df.write.parquet(path)
        release(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a table that ``put`` returned and nothing reads any more."""
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/" + self.root.rpartition("/")[2] + "/" in path:
                _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans no longer referenced."""
    gc.collect()
    spark._jvm.System.gc()


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (file bytes for a plain scan)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def text_bytes(df: DataFrame, column: str) -> int:
    """About how many bytes of text a table has: Catalyst's estimate, measured where that is large or unknown."""
    told = plan_bytes(df)
    return told if told < 1 << 40 else df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def star_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over edges a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label = jump
        if np.array_equal(label[a], label[b]):
            break
    return label


def connected_components(stage: Stage, edges: DataFrame) -> DataFrame:
    """Components of an edge table (a long, b long) as (node, component).

    Alternates large-star and small-star rounds until the edges stop changing;
    what remains is one star per component round its smallest node. Every
    step is an aggregation with map-side combine or an equi-join, so a node
    with many neighbours is neither gathered nor expanded into pairs.
    Nodes without edges do not appear; self-loops and null ends are ignored.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    links = stage.put(links.distinct())
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = stage.put(
            both.join(low, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stage.put(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        stage.drop(links)
        stage.drop(large)
        links = after
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if seen == mark:
            break
        mark = seen
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def batches_of(rows: pa.RecordBatch, nbytes: int, column: int = 1):
    """Slices of a batch whose given binary/string column holds about nbytes."""
    done = 0
    sizes = np.diff(np.frombuffer(rows.column(column).buffers()[1], dtype=np.int32, count=len(rows) + 1 + rows.column(column).offset)[rows.column(column).offset :]) if len(rows) else np.zeros(0, int)
    held = 0
    for i, size in enumerate(sizes):
        held += int(size)
        if held >= nbytes:
            yield rows.slice(done, i + 1 - done)
            done, held = i + 1, 0
    if done < len(rows):
        yield rows.slice(done)
