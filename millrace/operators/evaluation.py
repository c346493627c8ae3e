"""Evaluation accounting: strict denominators, attribution, paired statistics, verdicts."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.labels import lookup
from millrace.operators.reports import latest

VERDICTS = ("OK", "WATCH", "INVESTIGATE", "HARD_STOP")
LABELS = ("NOT_COMPARABLE", "BEATS_LOCAL_BASELINE", "COMPARABLE_TO_PUBLISHED_RESULT", "POTENTIAL_SOTA")


def outcomes(expected: DataFrame, results: DataFrame, task: str, order: str) -> DataFrame:
    """Every expected task with its last status, ``missing`` without one."""
    last = latest(results.select(task, order, "status"), task, order).select(task, "status")
    return expected.select(task).join(last, task, "left").withColumn("status", F.coalesce("status", F.lit("missing")))


def status_counts(tasks: DataFrame) -> DataFrame:
    """(status, n) for every status, 0 included."""
    known = tasks.sparkSession.createDataFrame([(s,) for s in fixed.STATUSES], "status string")
    return known.join(tasks.groupBy("status").agg(F.count("*").alias("n")), "status", "left").select("status", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def unexpected(expected: DataFrame, results: DataFrame, task: str) -> DataFrame:
    """Result rows of tasks that were not expected, repeats included."""
    return results.join(expected.select(task), task, "left_anti")


def rates(tasks: DataFrame, excludes: tuple[str, ...] = fixed.PROTOCOL_EXCLUDES, *by: str) -> DataFrame:
    """Success over all expected tasks, and over those the protocol counts (null without any)."""
    won, out = F.count_if(F.col("status") == "success"), F.count_if(F.col("status").isin(*excludes))
    rows = tasks.groupBy(*by).agg(F.count("*").alias("expected"), won.alias("successes"), F.count_if(F.col("status") == "missing").alias("missing"), out.alias("excluded"))
    base = F.col("expected") - F.col("excluded")
    return rows.select(
        *by, "expected", (F.col("expected") - F.col("missing")).alias("attempted"), "successes", "missing",
        F.coalesce(F.col("successes") / F.nullif("expected", F.lit(0)), F.lit(0.0)).alias("strict_rate"),
        base.alias("protocol_denominator"), F.when(base > 0, F.col("successes") / base).alias("protocol_rate"),
    )


def pending(tasks: DataFrame, results: DataFrame, task: str) -> DataFrame:
    """Tasks that a resumed run still has to do."""
    done = results.where(F.col("status").isin(*fixed.TERMINAL)).select(task).distinct()
    return tasks.join(done, task, "left_anti")


def auto_category(status: Column, finished: Column, success_at_finish: Column, success_at_budget: Column) -> Column:
    """A category that the outcome itself proves; null when a person has to look."""
    failed = status.isin("model_failure", "timeout")
    done = F.coalesce(finished, F.lit(False))
    return (
        F.when(status.isin("parser_failure", "harness_failure"), "tool_harness_error")
        .when(status == "environment_failure", "environment_error")
        .when(failed & done & success_at_finish.eqNullSafe(F.lit(False)), "premature_finish")
        .when(failed & ~done & success_at_budget.eqNullSafe(F.lit(True)), "failure_to_finish")
    )


def caused_by(category: Column) -> Column:
    return F.coalesce(lookup(fixed.CAUSED_BY, category), F.lit("unattributed"))


def annotate(results: DataFrame, notes: DataFrame, task: str) -> DataFrame:
    """Results with manual categories: (task, category, overwrite); only pending ones unless overwritten.

    An unknown category is an error.
    """
    ok = F.col("__c").isNull() | F.col("__c").isin("tool_harness_error", "environment_error", "premature_finish", "failure_to_finish", *fixed.MANUAL_CATEGORIES)
    rows = results.join(notes.select(task, F.col("category").alias("__c"), F.coalesce("overwrite", F.lit(False)).alias("__o")), task, "left")
    rows = rows.where(F.assert_true(ok, F.concat(F.lit("unknown failure category: "), F.coalesce("__c", F.lit("")))).isNull())
    use = F.col("__c").isNotNull() & ((F.col("failure_annotation") == "pending") | F.col("__o"))
    return rows.withColumn("failure_category", F.when(use, F.col("__c")).otherwise(F.col("failure_category"))).withColumn(
        "failure_annotation", F.when(use, F.concat(F.lit("manual:"), F.col("__c"))).otherwise(F.col("failure_annotation"))
    ).drop("__c", "__o")


def failure_breakdown(results: DataFrame) -> DataFrame:
    """(category, attribution, n, pending) of the results that did not succeed."""
    category = F.coalesce("failure_category", F.lit("needs_manual_annotation"))
    rows = results.where("status != 'success'").withColumn("category", category)
    waits = (F.col("category") == "needs_manual_annotation") & F.coalesce(F.col("failure_annotation") == "pending", F.lit(False))
    return rows.groupBy("category").agg(F.count("*").alias("n"), F.count_if(waits).alias("pending")).withColumn("attribution", caused_by(F.col("category")))


def mcnemar(b: Column, c: Column) -> Column:
    """Exact two-sided p of discordant counts: min(1, 2 P(X <= min(b, c))) with X binomial(b + c, 1/2).

    Terms are summed from their logarithms' ratios upward from 2^-n; counts
    whose 2^-n underflows use the terms' relative sizes from the largest down.
    """
    n, k = (b + c).cast("double"), F.least(b, c).cast("long")
    zero = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))

    def step(a, i):
        # downward from i = k: C(n, i - 1) = C(n, i) i / (n - i + 1), relative to C(n, k)
        return F.struct((a["t"] * i / (n - i + 1)).alias("t"), (a["s"] + a["t"]).alias("s"))

    relative = F.aggregate(F.sequence(k, F.lit(0).cast("long"), F.lit(-1).cast("long")), zero, step)["s"]
    logs = F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
        F.lit(0.0), lambda a, i: a + F.log((n - k + i) / i),
    )
    tail = relative * F.exp(logs - n * F.lit(0.6931471805599453))
    return F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), 2.0 * tail))


def paired(base: DataFrame, other: DataFrame, task: str, *by: str) -> DataFrame:
    """Shared tasks, wins, ties, rates, delta in points and McNemar's p; tasks of one side are counted apart."""
    both = base.select(task, *by, F.col("ok").alias("b")).join(other.select(task, F.col("ok").alias("o")), task, "full_outer")
    shared = F.col("b").isNotNull() & F.col("o").isNotNull()
    one = lambda c: F.count_if(shared & c)
    rows = both.groupBy(*by).agg(
        F.count_if(shared).alias("shared"), F.count_if(F.col("b").isNull()).alias("missing_in_base"), F.count_if(F.col("o").isNull()).alias("missing_in_other"),
        one(F.col("b") & ~F.col("o")).alias("wins_base"), one(F.col("o") & ~F.col("b")).alias("wins_other"), one(F.col("b") == F.col("o")).alias("ties"), one(F.col("b")).alias("nb"), one(F.col("o")).alias("no"),
    )
    rate = lambda c: F.coalesce(F.col(c) / F.nullif("shared", F.lit(0)), F.lit(0.0))
    return rows.select(
        *by, "shared", "missing_in_base", "missing_in_other", "wins_base", "wins_other", "ties", rate("nb").alias("base_rate"), rate("no").alias("other_rate"),
        (100.0 * (rate("no") - rate("nb"))).alias("delta_pp"), mcnemar(F.col("wins_base"), F.col("wins_other")).alias("mcnemar_p"),
    )


def _draws(n: int, seed: int, size: int = 1 << 18):
    """Blocks of the draws that random.Random(seed).randrange(n) makes one by one, for n below 2**32."""
    state = random.Random(seed).getstate()[1]
    source = np.random.MT19937()
    source.state = {"bit_generator": "MT19937", "state": {"key": np.array(state[:-1], np.uint32), "pos": state[-1]}}
    while True:
        drawn = (source.random_raw(size) >> np.uint64(32 - n.bit_length())).astype(np.int64)
        yield drawn[drawn < n]


def bootstrap(base: DataFrame, other: DataFrame, task: str, resamples: int = 10_000, seed: int = 1337, alpha: float = 0.05) -> DataFrame:
    """(n, low, high): percentile interval of the delta in points, resampled with a seeded generator.

    The draws depend on one another through the generator, so one task makes
    them, from the shared tasks' differences in the order of their ids.
    """
    pairs = base.select(task, F.col("ok").alias("b")).join(other.select(task, F.col("ok").alias("o")), task)

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by(task)
        delta = np.array([int(o) - int(b) for b, o in zip(rows["b"].to_pylist(), rows["o"].to_pylist())], np.int64)
        n, left, draws = len(delta), np.zeros(0, np.int64), _draws(len(delta), seed)
        found = []
        for _ in range(resamples):
            while len(left) < n:
                left = np.concatenate([left, next(draws)])
            found.append(100.0 * int(delta[left[:n]].sum()) / n)
            left = left[n:]
        found.sort()
        low, high = max(0, int(alpha / 2 * resamples) - 1), min(resamples - 1, int((1 - alpha / 2) * resamples))
        return pa.table({"n": [n], "low": [found[low]], "high": [found[high]]})

    return pairs.withColumn("__all", F.lit(1)).groupBy("__all").applyInArrow(run, "n long, low double, high double")


def meaningful(low: Column, high: Column, p: Column) -> Column:
    return ((low > 0) | (high < 0)) & (p < 0.05)


def verdict(base_rate: Column, other_rate: Column, watch: float = 2.0, investigate: float = 3.0, stop: float = 5.0) -> Column:
    """How bad a drop in points is."""
    drop = -(100.0 * (other_rate - base_rate))
    return F.when(drop >= stop, "HARD_STOP").when(drop >= investigate, "INVESTIGATE").when(drop >= watch, "WATCH").otherwise("OK")


def panels(base: DataFrame, other: DataFrame, panel: str) -> DataFrame:
    """(panel, n, base_rate, other_rate, verdict); panels of unequal size are an error."""
    count = lambda df, p: df.groupBy(panel).agg(F.count("*").alias(p + "_n"), F.avg(F.col("ok").cast("int")).alias(p + "_rate"))
    rows = count(base, "base").join(count(other, "other"), panel, "left")
    rows = rows.where(F.assert_true(F.col("base_n").eqNullSafe(F.col("other_n")), "unequal panels").isNull())
    return rows.select(panel, F.col("base_n").alias("n"), "base_rate", "other_rate", verdict(F.col("base_rate"), F.col("other_rate")).alias("verdict"))


def worst(df: DataFrame, verdict_col: str = "verdict") -> DataFrame:
    place = F.array_position(F.array(*map(F.lit, VERDICTS)), F.col(verdict_col))
    return df.agg(F.max_by(verdict_col, place).alias("overall")).withColumn("regression", F.col("overall").isin("INVESTIGATE", "HARD_STOP"))


def claim(conditions: DataFrame, claim_id: str) -> DataFrame:
    """(claim, label, failed): how much a comparison supports, from rows (claim, tier, condition, met).

    Tier 0 has what any comparison needs, tier 1 what equals a published
    number's set-up, tier 2 a fully pinned protocol; a tier counts once those
    below hold.
    """
    held = lambda t: F.coalesce(F.bool_and(F.when(F.col("tier") == t, F.col("met"))), F.lit(True))
    failed = F.array_sort(F.collect_list(F.when(~F.col("met"), F.struct("tier", "condition"))))
    rows = conditions.groupBy(claim_id).agg(held(0).alias("a"), held(1).alias("b"), held(2).alias("c"), failed.alias("f"))
    label = F.when(~F.col("a"), LABELS[0]).when(~F.col("b"), LABELS[1]).when(~F.col("c"), LABELS[2]).otherwise(LABELS[3])
    lowest = F.filter("f", lambda x: x["tier"] == F.get(F.col("f"), 0)["tier"])
    return rows.select(claim_id, label.alias("label"), F.array_join(F.transform(lowest, lambda x: x["condition"]), ",").alias("failed"))


def optimizer_steps(samples: Column, batch: int = 32) -> Column:
    return F.ceil(samples / batch).cast("long")


def gate_steps(total: Column, gates: int = 5) -> list[Column]:
    """(interval, gate nearest to 55 %, total) of a run saved ``gates`` times."""
    interval = F.floor(total / gates)
    middle = F.rint(total * 0.55 / interval) * interval
    return [interval.cast("long"), middle.cast("long"), total.cast("long")]


def effective_batch(world: Column, target: int = 32, per_device: int = 1) -> Column:
    """The batch nearest to ``target`` that a number of devices can make."""
    one = world * per_device
    low = F.floor(target / one) * one
    high = low + one
    near = F.when(target - low <= high - target, low).otherwise(high)
    return F.when(one >= target, one).when(F.lit(target) % one == 0, target).otherwise(near).cast("long")
