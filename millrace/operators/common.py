"""Plan shapes that several operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows and bytes of a side that may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast, but only of a table measured to be small in rows and in bytes.

    Both are counted over the first rows up to the bound, so it is cheap however
    large the table is. A row's bytes are those of its JSON.
    """
    told = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(F.length(F.to_json(F.struct(*df.columns)))), F.lit(0))).first()
    return F.broadcast(df) if told[0] <= rows and told[1] <= size else df


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder where a local session names none, an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (named or tempfile.mkdtemp(prefix="millrace-")).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the folder the session names."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def first_rows(df: DataFrame, keys: Sequence[str], *order: str, count: str | None = None) -> DataFrame:
    """The first row of each key by ``order``; optionally how many rows the key has.

    An aggregation with partial results, so a key with very many rows is not
    gathered anywhere.
    """
    rest = [c for c in df.columns if c not in keys]
    totals = [] if count is None else [F.count("*").alias(count)]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"), *totals)
    return best.select(*keys, *[F.col("__first")[c].alias(c) for c in rest], *([] if count is None else [count]))


def ranked(keys: Sequence[str], *order: Column) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def best_ranked(df: DataFrame, keys: Sequence[str], most: str, *order: Column, out: str = "rank", salts: int = 64) -> DataFrame:
    """Adds the rank of each row within its key, for the first ``most`` rows (a column) of each.

    Ranks are taken among the rows of a hash of the row first and only the best
    of those again, so that a task meets at most ``salts`` times ``most`` rows of
    a key that holds much of the table. ``order`` should tell all rows apart.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    some = salted.withColumn("__own", ranked([*keys, "__salt"], *order)).where(F.col("__own") <= F.col(most)).drop("__own", "__salt")
    return some.withColumn(out, ranked(keys, *order).cast("long")).where(F.col(out) <= F.col(most))


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the same key, itself left out.

    Rows are dealt by range of key and order, so a key of any size spreads over
    many tasks: each task sums its own rows, and what lies before a task comes
    from one total per key and task.
    """
    dealt = cut(df.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()))
    totals = dealt.groupBy(*keys, "__part").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    own = Window.partitionBy(*keys, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = dealt.withColumn(out, F.coalesce(F.sum(value).over(own), F.lit(0))).alias("l").join(
        offsets.alias("r"), [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, "__part")]
    )
    return same.select(*[F.col(f"l.{c}") for c in df.columns], (F.col(f"l.{out}") + F.col("r.__offset")).alias(out))


def fixed_rows(spark: SparkSession, schema: str, *rows: tuple) -> DataFrame:
    """A literal table."""
    return spark.createDataFrame(list(rows), schema)
