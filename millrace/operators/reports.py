"""Aggregate reports: mixture, concentration, tokens, coverage, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import redact, tokens
from millrace.operators.common import ranked


def mixture(df: DataFrame, *axes: str) -> DataFrame:
    """(axis, key, n, share) of every axis, from one scan with grouping sets."""
    sets = df.select(*[F.coalesce(F.col(a).cast("string"), F.lit("?")).alias(a) for a in axes]).groupingSets([[a] for a in axes], *axes)
    counted = sets.agg(F.count("*").alias("n"), F.grouping_id(*axes).alias("g"))
    full = (1 << len(axes)) - 1
    axis, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, a in enumerate(axes):
        here = F.col("g") == full - (1 << (len(axes) - 1 - i))
        axis, key = F.when(here, a).otherwise(axis), F.when(here, F.col(a)).otherwise(key)
    rows = counted.select(axis.alias("axis"), key.alias("key"), "n")
    return rows.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("axis")))


def two_level(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Counts by two keys, with totals of the outer one where the inner is null."""
    return df.groupingSets([[outer, inner], [outer]], outer, inner).agg(F.count("*").alias("n"))


def top(df: DataFrame, key: str, n: int) -> DataFrame:
    """The most frequent keys; equal counts in the order of the key."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(n)


def concentration(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, Herfindahl index, the top key and its share."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    sums = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("keys"), F.sum(F.col("n").cast("double") * F.col("n")).alias("q"), F.max_by(key, F.struct("n", key)).alias("top"), F.max("n").alias("m"))
    return sums.select("rows", "keys", (F.col("q") / F.col("rows") / F.col("rows")).alias("hhi"), F.col("top").alias("top_key"), (F.col("m") / F.col("rows")).alias("top_share"))


def dominated(df: DataFrame, group: str, key: str, share: float = 0.60, least: int = 200) -> DataFrame:
    """Groups of more than ``least`` rows in which one key has more than ``share``."""
    counts = df.groupBy(group, key).agg(F.count("*").alias("n"))
    by = counts.groupBy(group).agg(F.sum("n").alias("rows"), F.max("n").alias("m"), F.max_by(key, F.struct("n", key)).alias("top_key"))
    return by.withColumn("top_share", F.col("m") / F.col("rows")).where((F.col("rows") > least) & (F.col("top_share") > share)).drop("m")


def percentiles(df: DataFrame, value: Column, *by: str, points: tuple[int, ...] = (50, 90, 95, 99)) -> DataFrame:
    """n, mean, nearest-rank percentiles and maximum of the values that are not null or 0.

    Computed from counts of distinct values, so equal values of a large group
    meet as one row.
    """
    counted = df.select(*by, value.alias("v")).where("v IS NOT NULL AND v != 0").groupBy(*by, "v").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*by).orderBy("v"))
    n = F.sum("c").over(Window.partitionBy(*by))
    placed = counted.withColumn("upto", upto).withColumn("n", n)
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.lit(p) / 100 * F.col("n")), F.col("v"))).alias(f"p{p}") for p in points]
    return placed.groupBy(*by).agg(F.max("n").alias("n"), (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean"), *at, F.max("v").alias("max"))


def mean_of_truthy(value: Column) -> Column:
    """Mean over values that are neither null nor 0; 0 without any."""
    return F.coalesce(F.avg(F.nullif(value, F.lit(0))), F.lit(0.0))


def loss_tokens(df: DataFrame, role: str, text: str, sample: str, source: str, task_type: str, loss: str | None = None, images: str | None = None, count: str | None = None) -> DataFrame:
    """(axis, key, samples, input_tokens, image_tokens, loss_tokens, share) by source, by task type and in all.

    Tokens are estimated from the text, or those of the column ``count``.
    """
    learned = F.col(role) == "assistant"
    if loss is not None:
        learned = learned & F.coalesce(F.col(loss), F.lit(True))
    n = tokens(F.col(text)) if count is None else F.col(count)
    per = df.groupBy(sample, source, task_type).agg(
        F.sum(F.when(learned, 0).otherwise(n)).alias("i"), F.sum(F.when(learned, n).otherwise(0)).alias("l"), (F.lit(0) if images is None else F.max(images)).alias("m")
    )
    sets = per.groupingSets([[source], [task_type], []], source, task_type).agg(
        F.count("*").alias("samples"), F.sum("i").cast("long").alias("input_tokens"), F.sum("m").cast("long").alias("image_tokens"),
        F.sum("l").cast("long").alias("loss_tokens"), F.grouping(source).alias("gs"), F.grouping(task_type).alias("gt"),
    )
    whole = F.max(F.when((F.col("gs") == 1) & (F.col("gt") == 1), F.col("loss_tokens"))).over(Window.partitionBy(F.lit(1)))
    axis = F.when((F.col("gs") == 1) & (F.col("gt") == 1), "total").when(F.col("gs") == 0, "source").otherwise("task_type")
    key = F.when(F.col("gs") == 0, F.col(source)).when(F.col("gt") == 0, F.col(task_type)).otherwise("all")
    return sets.select(axis.alias("axis"), key.alias("key"), "samples", "input_tokens", "image_tokens", "loss_tokens", (F.col("loss_tokens") / F.greatest(F.lit(1), whole)).alias("share"))


def fit_history(df: DataFrame, sample: str, order: str, text: str, base: str, budget: int) -> DataFrame:
    """(sample, base, fits, history_steps, kept_steps, estimated_tokens).

    ``df`` has a row per history item and ``base``, what the rest of the
    sample takes. Items go from the oldest on until the sum fits; a base over
    the budget fits nothing and is never shortened.
    """
    newest = Window.partitionBy(sample).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col(order).isNotNull(), tokens(F.col(text))).otherwise(0)
    rows = df.withColumn("__sum", F.sum(own).over(newest))
    real = F.col(order).isNotNull()
    kept = real & (F.col(base) <= budget) & (F.col(base) + F.col("__sum") <= budget)
    out = rows.groupBy(sample).agg(F.first(base).alias("base"), F.count_if(real).alias("history_steps"), F.count_if(kept).alias("kept_steps"), F.coalesce(F.max(F.when(kept, F.col("__sum"))), F.lit(0)).alias("h"))
    return out.select(sample, "base", (F.col("base") <= budget).alias("fits"), "history_steps", "kept_steps", (F.col("base") + F.col("h")).cast("long").alias("estimated_tokens"))


def coverage(df: DataFrame, sample: str, motifs: str) -> DataFrame:
    """How many samples show each motif."""
    return df.select(F.explode(F.array_distinct(motifs)).alias("motif")).groupBy("motif").agg(F.count("*").alias("selected"))


def source_stats(df: DataFrame, source: str, split: str, task_type: str) -> DataFrame:
    """Counts by source, with a map of its task types."""
    by = df.groupBy(source, task_type).agg(F.count("*").alias("n"), F.count_if(F.col(split) == "train").alias("t"), F.count_if(F.col(split) == "validation").alias("v"))
    return by.groupBy(source).agg(F.sum("n").alias("selected"), F.sum("t").alias("train"), F.sum("v").alias("validation"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(task_type, "n")))).alias("task_types"))


def failure_summary(df: DataFrame, error: str, source: str, limit: int = 120) -> DataFrame:
    """(class, n, sources): failures by the head of their redacted message, with a count per source."""
    told = df.select(redact(F.substring(F.coalesce(F.col(error), F.lit("unknown")), 1, limit)).alias("class"), F.coalesce(F.col(source), F.lit("?")).alias("source"))
    by = told.groupBy("class", "source").agg(F.count("*").alias("n"))
    return by.groupBy("class").agg(F.sum("n").cast("long").alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("sources"))


def repeated_texts(df: DataFrame, text: Column, over: int = 4, longer: int = 40, limit: int = 120) -> DataFrame:
    """Heads of texts that occur more than ``over`` times."""
    head = df.select(F.substring(text, 1, limit).alias("head")).where(F.length("head") > longer)
    return head.groupBy("head").agg(F.count("*").alias("n")).where(F.col("n") > over)


def longest(df: DataFrame, key: str, text: str, n: int = 5) -> DataFrame:
    return df.select(key, F.length(text).cast("long").alias("length")).orderBy(F.desc("length"), key).limit(n)


def tree_hash(df: DataFrame, path: str, size: str, digest: str, *by: str) -> DataFrame:
    """(by, files, bytes, tree_sha256): a digest over path, size and digest of every file, by path.

    The digest of a tree reads one line per file, not the files.
    """
    line = F.concat_ws("\t", F.col(path), F.col(size).cast("string"), F.col(digest))
    rows = df.select(*by, F.struct(F.col(path).alias("p"), line.alias("line")).alias("x"), F.col(size).alias("s"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: F.concat(x["line"], F.lit("\n"))), "")
    return rows.groupBy(*by).agg(F.count("*").alias("files"), F.sum("s").cast("long").alias("bytes"), F.sha2(joined, 256).alias("tree_sha256"))


def throughput(df: DataFrame, run: str, step: str, seconds: str, warmup: int, measure: int) -> DataFrame:
    """Step times of each run in the ``measure`` steps after ``warmup``; runs too short are left out.

    Of several times of one step the first counts. The ninetieth percentile is
    the value at place round(0.9 (n - 1)), half to even.
    """
    steps = df.groupBy(run, step).agg(F.min(seconds).alias("t"))
    w = Window.partitionBy(run).orderBy(step)
    paired = steps.withColumn("__d", F.when(F.col(step) - F.lag(step).over(w) == 1, F.col("t") - F.lag("t").over(w)))
    inside = (F.col(step) > warmup) & (F.col(step) <= warmup + measure)
    at = lambda s: F.max(F.when(F.col(step) == s, F.col("t")))
    by = paired.groupBy(run).agg(
        at(warmup).alias("a"), at(warmup + measure).alias("b"), F.min_by("t", step).alias("o"), F.sort_array(F.collect_list(F.when(inside, F.col("__d")))).alias("d"),
    ).where("a IS NOT NULL AND b IS NOT NULL AND size(d) > 0")
    n = F.size("d")
    median = (F.element_at("d", F.floor((n - 1) / 2).cast("int") + 1) + F.element_at("d", F.floor(n / 2).cast("int") + 1)) / 2
    return by.select(
        run, (F.col("a") - F.col("o")).alias("warmup_seconds"), (F.col("b") - F.col("a")).alias("measured_seconds"),
        ((F.col("b") - F.col("a")) / measure).alias("mean"), median.alias("median"), F.element_at("d", F.rint((n - 1) * 0.9).cast("int") + 1).alias("p90"),
    )


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("l")).select(key, "l.*")


def numbered_pages(df: DataFrame, platform: str, name: str, page: int) -> DataFrame:
    """Names in pages of each platform, platforms in turn."""
    place = ranked([platform], F.asc(name)) - 1
    return df.withColumn("page", F.floor(place / page).cast("long")).orderBy("page", platform, name)
