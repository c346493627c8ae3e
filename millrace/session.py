"""Session factory and table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(app: str = "millrace", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC, adaptive execution and Arrow.

    On a cluster leave ``master`` and ``shuffle_partitions`` to the submitter;
    adaptive execution coalesces and splits shuffle partitions at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return builder.config(map=settings).getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
