"""Trajectories: continuity, history, state changes, windows and step sampling.

One row is one step. Windows run over the steps of a trajectory, in ROWS
frames, in the order of the step index; all of them share one partitioning, so
a chain of these operators shuffles once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.geometry import hamming
from millrace.functions.hashing import choice, keep, uniform
from millrace.functions.labels import step_signals
from millrace.functions.scores import trajectory_priority
from millrace.operators.common import running_total

CHANGED_BITS = 6


def along(*keys: str, order: str) -> "Window":
    return Window.partitionBy(*keys).orderBy(order)


def continuity(df: DataFrame, key: str, order: str, gap: Column, out: str = "segment") -> DataFrame:
    """Numbers the stretches between gaps; ``gap`` is true on the first step after one."""
    steps = along(key, order=order)
    marked = df.withColumn("__gap", F.coalesce(gap, F.lit(False)).cast("int"))
    return marked.withColumn(out, F.sum("__gap").over(steps.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("__gap")


def time_gap(key: str, order: str, time: Column, seconds: float) -> Column:
    """True when at least ``seconds`` passed since the step before."""
    return time - F.lag(time).over(along(key, order=order)) >= seconds


def history(df: DataFrame, key: str, segment: str, order: str, action: str, steps: int = 5, out: str = "history") -> DataFrame:
    """Array of the last ``steps`` actions of the same segment."""
    frame = along(key, segment, order=order).rowsBetween(-steps, -1)
    return df.withColumn(out, F.collect_list(F.when(F.col(action) != "", F.col(action))).over(frame))


def state_change(df: DataFrame, key: str, segment: str, order: str, state: str, bits: int = CHANGED_BITS, out: str = "changed") -> DataFrame:
    """True when a state's hash differs from the step before in more than ``bits`` bits; null at a segment's start."""
    before = F.lag(state).over(along(key, segment, order=order))
    return df.withColumn(out, hamming(F.col(state), before) > bits)


def windows(df: DataFrame, key: str, segment: str, order: str, action: str, changed: str, verb: str | None = None, least: int = 4, most: int = 4, chunk: bool = False) -> DataFrame:
    """One row per start where ``least`` steps follow, with ``informative``.

    A window has up to ``most`` steps. It informs when it lies in one segment,
    has two distinct actions and two state changes; a chunk when half its steps
    change the state, it has four distinct actions and at most three tenths
    wait. An unknown change counts as one.
    """
    ahead = along(key, order=order).rowsBetween(0, most - 1)
    told = F.coalesce(F.col(changed), F.lit(True)).cast("int")
    rows = df.select(
        key, order, F.count("*").over(ahead).cast("long").alias("steps"), F.sum(told).over(ahead).cast("long").alias("changes"),
        F.size(F.collect_set(action).over(ahead)).cast("long").alias("actions"),
        (F.min(segment).over(ahead) == F.max(segment).over(ahead)).alias("whole"),
        F.sum((F.col(verb or action) == "wait").cast("int")).over(ahead).cast("long").alias("waits"),
    ).where(F.col("steps") >= least)
    enough = (F.col("changes") >= 0.5 * F.col("steps")) & (F.col("actions") >= 4) & (F.col("waits") <= 0.3 * F.col("steps")) if chunk else (F.col("changes") >= 2) & (F.col("actions") >= 2)
    return rows.withColumn("informative", F.col("whole") & enough)


def window_starts(trajectory: Column, n: Column, length: int, count: int = 1) -> Column:
    """Array of hash-drawn starts of windows in a trajectory of n steps; empty when too short."""
    one = lambda k: F.least(n - length, F.floor(uniform(F.concat(F.lit("win:"), trajectory.cast("string"), F.lit(f":{k}"))) * (n - length + 1)))
    return F.when(n >= length, F.array(*[one(k).cast("long") for k in range(count)])).otherwise(F.array().cast("array<bigint>"))


def spaced(starts: Column, length: int, most: int) -> Column:
    """The first ``most`` of an array of starts that are ``length`` apart from those before."""
    empty = F.array().cast("array<bigint>")
    return F.aggregate(starts, empty, lambda a, s: F.when((F.size(a) < most) & ~F.exists(a, lambda t: F.abs(t - s) < length), F.concat(a, F.array(s))).otherwise(a))


def position_bucket(index: Column, n: Column) -> Column:
    """Fifth of the trajectory that a step, counted from 0, lies in."""
    return F.when(n <= 1, 2).otherwise(F.least(F.lit(4), F.floor(5 * index / n))).cast("long")


def step_weight(signals: Column, verb: Column) -> Column:
    """1, doubled by a positive signal, halved by a negative one; 0 for what cannot anchor."""
    has = lambda names: F.arrays_overlap(signals, F.array(*map(F.lit, names)))
    weight = F.when(has(fixed.POSITIVE_SIGNALS), 2.0).otherwise(1.0) * F.when(has(fixed.NEGATIVE_SIGNALS), 0.5).otherwise(1.0)
    return F.when(verb.isin(*fixed.ANCHOR_VERBS), weight).otherwise(0.0)


def scored_steps(df: DataFrame, key: str, order: str, verb: str, signals: str, task_signals: Column | None = None) -> DataFrame:
    """Adds idx, n, bucket, weight to steps; signals are the step's own, the verb's and the task's."""
    all_of = Window.partitionBy(key)
    told = step_signals(F.col(signals), F.col(verb))
    told = told if task_signals is None else F.array_union(told, task_signals)
    rows = df.withColumn("idx", (F.row_number().over(along(key, order=order)) - 1).cast("long")).withColumn("n", F.count("*").over(all_of))
    return rows.withColumn("bucket", position_bucket(F.col("idx"), F.col("n"))).withColumn("weight", step_weight(told, F.col(verb)))


def round_robin(df: DataFrame, key: str, cap: int = 4) -> DataFrame:
    """Up to ``cap`` steps of each trajectory, one of each bucket in turn, from the middle outward.

    Takes rows as from ``scored_steps``; within a bucket heavier and then earlier steps go first.
    """
    turn = F.row_number().over(Window.partitionBy(key, "bucket").orderBy(F.desc("weight"), "idx"))
    place = F.array_position(F.array(*map(F.lit, (2, 1, 3, 0, 4))), F.col("bucket").cast("int"))
    rows = df.where("weight > 0").withColumn("__turn", turn).withColumn("__place", place)
    pick = F.row_number().over(Window.partitionBy(key).orderBy("__turn", "__place"))
    return rows.withColumn("pick", pick.cast("long")).where(F.col("pick") <= cap).drop("__turn", "__place")


def representation(trajectory: Column, shares: dict[str, float] | None = None) -> Column:
    return choice(F.concat(F.lit("repr:"), trajectory.cast("string")), shares or fixed.REPRESENTATIONS)


def emitted(df: DataFrame, key: str, cap: int = 4, shares: dict[str, float] | None = None) -> DataFrame:
    """(key, form, rank, start, steps): the samples that each trajectory gives.

    ``df`` has one row per trajectory: key, n, picks (indices chosen by
    ``round_robin``, ascending), good3 and good8 (arrays of starts whose window
    of four or chunk informs). A single trajectory gives its picks; a window
    one up to three spaced windows and one pick, or two picks when no window
    informs; a chunk one its chunk, else up to two windows, and one pick.
    """
    n, picks = F.col("n"), F.col("picks")
    length = F.least(F.lit(4), n)
    form = representation(F.col(key), shares)
    piece = lambda name, s, size: F.struct(F.lit(name).alias("form"), s.cast("long").alias("start"), size.cast("long").alias("steps"))
    singles = lambda a: F.transform(a, lambda i: piece("single", i, F.lit(1)))

    def found(count):
        drawn = F.filter(window_starts(F.col(key), n, 4, count + 2), lambda s: F.array_contains("good3", s))
        return F.transform(spaced(drawn, 4, count), lambda s: piece("window", s, length))

    chunk = F.when((n >= 8) & F.array_contains("good8", F.get(window_starts(F.col(key), n, 8, 1), 0)), F.array(piece("chunk", F.get(window_starts(F.col(key), n, 8, 1), 0), F.least(F.lit(12), n - F.get(window_starts(F.col(key), n, 8, 1), 0)))))
    some = found(3)
    out = (
        F.when(form == "single", singles(picks))
        .when(form == "window", F.when(F.size(some) > 0, F.concat(some, singles(F.slice(picks, 1, 1)))).otherwise(singles(F.slice(picks, 1, 2))))
        .otherwise(F.concat(F.coalesce(chunk, found(2)), singles(F.slice(picks, 1, 1))))
    )
    rows = df.where(F.size(picks) > 0).select(key, F.posexplode(F.slice(out, 1, cap)).alias("rank", "s"))
    return rows.select(key, F.col("rank").cast("long").alias("rank"), "s.form", "s.start", "s.steps")


def app_cap(df: DataFrame, app: str, order: str, got: str, cap: int) -> DataFrame:
    """Units admitted while their application has given fewer than ``cap`` before them.

    The check comes before and the count after a unit, so the last one may
    overshoot. An application of any size is summed in many tasks.
    """
    units = df.withColumn("__app", F.lower(F.coalesce(F.when(F.col(app) != "", F.col(app)), F.lit("unknown"))))
    return running_total(units, ["__app"], [order], got, "before").where(F.col("before") < max(1, cap)).drop("__app")


def bucket_quota(df: DataFrame, bucket: str, order: str, shares: dict[str, float] | None = None) -> DataFrame:
    """Rows admitted by a quota that looks at what was admitted before, in order.

    Each admission depends on all earlier ones, so this runs in one task, over
    (order, bucket) alone; use it on one screen's or one source's candidates.
    """
    parts = shares or {k: v[2] for k, v in fixed.SIZE_BUCKETS.items()}

    def run(batches):
        counts = dict.fromkeys(parts, 0)
        for rows in batches:
            taken = []
            for b in rows[bucket]:
                total = sum(counts.values())
                ok = total == 0 or counts.get(b, 0) < parts.get(b, 0.0) * total * 1.25 + 2
                counts[b] = counts.get(b, 0) + ok
                taken.append(ok)
            yield rows[taken]

    admitted = df.select(order, bucket).coalesce(1).sortWithinPartitions(order).mapInPandas(run, df.select(order, bucket).schema)
    return df.join(admitted.select(order), order, "left_semi")


def kept_trajectories(df: DataFrame, key: str, seed: str = "keep") -> DataFrame:
    """Trajectories with n and priority, kept with that probability by hash."""
    sized = df.groupBy(key).agg(F.count("*").alias("n")).withColumn("priority", trajectory_priority(F.col("n")))
    drawn = (F.col("priority") >= 1.0) | keep(F.concat(F.lit(seed + ":"), F.col(key).cast("string")), F.col("priority"))
    return sized.withColumn("kept", drawn)


def repeated(key: str, order: str, action: str, excused: Column | None = None) -> Column:
    """True when a step repeats the action before it, unless excused."""
    same = F.coalesce(F.col(action) == F.lag(action).over(along(key, order=order)), F.lit(False))
    return same if excused is None else same & ~excused


def mid_finishes(df: DataFrame, key: str, order: str, verb: str) -> DataFrame:
    """Finishing steps that are not their trajectory's last."""
    last = F.max(order).over(Window.partitionBy(key))
    return df.withColumn("__last", last).where((F.col(verb) == "finish") & (F.col(order) < F.col("__last"))).drop("__last")


def micro_actions(df: DataFrame, key: str, order: str, kind: str, x: str, y: str, time: str, reach: float = 64.0) -> DataFrame:
    """Pointer micro-actions in canonical form: adds start_x, start_y to drags.

    A drag starts where the pointer was when the button went down; button
    events go, and so does a move right before a click at the same time nearby.
    """
    steps = along(key, order=order)
    before = steps.rowsBetween(Window.unboundedPreceding, -1)
    k = F.upper(kind)
    pressing = k.isin("MOUSE_DOWN", "MOUSE_UP")
    at = F.when(~pressing & F.col(x).isNotNull() & F.col(y).isNotNull(), F.struct(F.col(x).alias("x"), F.col(y).alias("y")))
    rows = df.withColumn("__at", F.last(at, ignorenulls=True).over(before))
    held = F.when(k == "MOUSE_DOWN", F.struct(F.lit(True).alias("down"), F.col("__at").alias("at"))).when(k == "MOUSE_UP", F.struct(F.lit(False).alias("down"), F.lit(None).cast(rows.schema["__at"].dataType).alias("at")))
    rows = rows.withColumn("__held", F.last(held, ignorenulls=True).over(before))
    start = F.when((k == "DRAG_TO") & F.col("__held")["down"], F.col("__held")["at"])
    rows = rows.withColumn("start_x", start["x"]).withColumn("start_y", start["y"]).where(~pressing)
    nxt = lambda c: F.lead(c).over(steps)
    close = F.coalesce((F.abs(F.col(x) - nxt(x)) <= reach) & (F.abs(F.col(y) - nxt(y)) <= reach), F.lit(True))
    idle = (k == "MOVE_TO") & F.upper(nxt(kind)).isin("CLICK", "DOUBLE_CLICK", "RIGHT_CLICK") & (F.abs(F.col(time) - nxt(time)) <= 1e-6) & close
    return rows.withColumn("__idle", F.coalesce(idle, F.lit(False))).where("NOT __idle").drop("__idle", "__held", "__at")


def seeded_order(df: DataFrame, unit: str, seed: str) -> DataFrame:
    """Units by their hash under a seed."""
    return df.withColumn("__rank", F.sha2(F.concat(F.lit(seed + ":"), F.col(unit).cast("string")), 256)).orderBy("__rank", unit).drop("__rank")

