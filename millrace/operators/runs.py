"""Bookkeeping of builds and evaluation runs: configuration, ledgers, checkpoints, results, logs."""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.text import redact
from millrace.operators.common import cut

PRODUCTION_ROWS = 10_000
#: Hashes in one row of a deduplication state.
STATE_HASHES = 4096


# --- configuration ---


def merged_config(defaults: dict, overrides: dict) -> dict:
    """Overrides over defaults; sections that are mappings on both sides are merged one level deep."""
    both = lambda k: isinstance(defaults.get(k), dict) and isinstance(overrides.get(k), dict)
    return {k: defaults[k] | overrides[k] if both(k) else overrides.get(k, defaults.get(k)) for k in [*defaults, *(k for k in overrides if k not in defaults)]}


def layered(defaults: DataFrame, overrides: DataFrame) -> DataFrame:
    """``merged_config`` over rows (section, field, value): a field is null where a section is a plain value.

    An overriding plain value replaces its whole section, and a field replaces a plain value.
    """
    shape = overrides.groupBy("section").agg(F.bool_or(F.col("field").isNull()).alias("__plain"))
    kept = defaults.join(shape, "section", "left").where("__plain IS NULL OR (NOT __plain AND field IS NOT NULL)").drop("__plain")
    same = [kept["section"] == overrides["section"], kept["field"].eqNullSafe(overrides["field"])]
    return kept.join(overrides, same, "left_anti").unionByName(overrides)


def config_hash(config: dict) -> str:
    import hashlib

    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def resolved_counts(defaults: DataFrame, total: int | None = None, smoke: bool = False) -> DataFrame:
    """(category, n): counts given, else the defaults, scaled to ``total``; a smoke run takes a fifth of the total each.

    ``defaults`` has (category, standard, given). Halves round to even, and no category falls below one.
    """
    whole = sum(fixed.SUBTARGETS.values())
    n = F.coalesce("given", "standard")
    if total is not None and total != whole:
        n = F.greatest(F.lit(1), F.rint(n * (total / whole)).cast("long"))
    if smoke:
        n = F.lit(max(1, (whole if total is None else total) // 5))
    return defaults.select("category", n.cast("long").alias("n"))


def production(counts: DataFrame, requested: list[str], smoke: bool = False) -> DataFrame:
    """One row: the rows of the requested sources (of all, where none is known) and whether the build is in earnest."""
    asked = F.col("source").isin(*requested) if requested else F.lit(False)
    totals = counts.agg(F.sum(F.when(asked, F.col("n"))).alias("some"), F.sum("n").alias("every"))
    n = F.coalesce("some", "every", F.lit(0)).cast("long")
    return totals.select(n.alias("rows"), (n >= PRODUCTION_ROWS).alias("large")).select("rows", (F.col("large") & F.lit(not smoke)).alias("production"))


def unresolved_fields(values: Column, fields: list[str], open_: str) -> Column:
    """Of the named fields of a map those that still hold the marker ``open_``."""
    return F.filter(F.array(*map(F.lit, fields)), lambda f: F.coalesce(F.element_at(values, f) == open_, F.lit(False)))


def reference_manifest(paths: DataFrame, files: DataFrame) -> DataFrame:
    """(path, sha256, bytes, missing) of wanted files; ``files`` as Spark reads binary files."""
    found = files.select("path", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("bytes"))
    return paths.select("path").distinct().join(found, "path", "left").withColumn("missing", F.col("sha256").isNull())


def drifted(evidence: DataFrame, files: DataFrame) -> DataFrame:
    """(path, problem) of evidence (path, sha256) that is missing or no longer has its digest."""
    now = files.select("path", F.sha2("content", 256).alias("__now"))
    problem = F.when(F.col("__now").isNull(), "missing").when(F.col("__now") != F.col("sha256"), "changed")
    return evidence.join(now, "path", "left").select("path", problem.alias("problem")).where("problem IS NOT NULL")


# --- ledgers ---


def ledger(quotas: DataFrame, entries: DataFrame) -> DataFrame:
    """(source, quota, taken, remaining, rejected, noted) from entries (source, kind, reason, n).

    Kinds are sample, reject and note; rejections and notes are maps from reason to count.
    """
    by = entries.groupBy("source", "kind", "reason").agg(F.sum("n").cast("long").alias("n"))
    told = lambda kind: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("reason", "n")))))
    sums = by.groupBy("source").agg(F.coalesce(F.sum(F.when(F.col("kind") == "sample", F.col("n"))), F.lit(0)).alias("taken"), told("reject").alias("rejected"), told("note").alias("noted"))
    rows = quotas.join(sums, "source", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return rows.select("source", "quota", "taken", F.greatest(F.lit(0), F.col("quota") - F.col("taken")).cast("long").alias("remaining"), "rejected", "noted")


def rates(df: DataFrame, source: str, probes: dict[str, Column]) -> DataFrame:
    """(source, rows, a share for each probe): how many rows of a source pass; null counts as not passing."""
    return df.groupBy(source).agg(F.count("*").alias("rows"), *[F.avg(F.coalesce(p, F.lit(False)).cast("int")).alias(name) for name, p in probes.items()])


def single_waits(df: DataFrame, key: str, order: list[str], verb: str) -> DataFrame:
    """Without waits that follow a wait: of a run of waits the first is kept, so what precedes a step in the input decides."""
    before = F.lag(verb).over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("__before", before).where(~((F.col(verb) == "wait") & F.coalesce(F.col("__before") == "wait", F.lit(False)))).drop("__before")


def image_duplicates(files: DataFrame, head: int = 4096) -> DataFrame:
    """(bytes, head_md5, copies) of files that agree in size and in their first bytes."""
    sign = files.select(F.length("content").cast("long").alias("bytes"), F.md5(F.substring("content", 1, head)).alias("head_md5"))
    return sign.groupBy("bytes", "head_md5").agg(F.count("*").alias("copies")).where("copies > 1")


def state_json(leaders: DataFrame, most: int = STATE_HASHES) -> DataFrame:
    """(bucket, state): clusters (leader, h) as JSON lists with sorted members, in the order of leaders.

    A row holds at most ``most`` distinct hashes however large the input is; a
    cluster goes on in the next row where it does not fit. A null hash is a null
    in its leader's list.
    """
    each = leaders.select("leader", "h").distinct().repartitionByRange("leader", "h").sortWithinPartitions("leader", "h")
    filed = each.withColumn("bucket", F.expr(f"monotonically_increasing_id() div {most}")).repartition("bucket")
    lists = filed.groupBy("bucket", "leader").agg(F.sort_array(F.collect_list(F.struct("h")))["h"].alias("hashes"))
    return lists.groupBy("bucket").agg(F.to_json(F.sort_array(F.collect_list(F.struct("leader", "hashes")))).alias("state"))


def state_rows(states: DataFrame) -> DataFrame:
    """(leader, h) of what ``state_json`` wrote."""
    rows = states.select(F.explode(F.from_json("state", "array<struct<leader:bigint,hashes:array<bigint>>>")).alias("c"))
    return rows.select("c.leader", F.explode("c.hashes").alias("h"))


# --- plans ---


def plan_text(category: Column, trajectory: Column, step: Column) -> Column:
    """The template of a category that a hash of trajectory and step chooses; null without a category."""
    draw = F.conv(F.substring(F.md5(F.concat(trajectory, F.lit(":"), step, F.lit(":"), category)), 1, 8), 16, 10).cast("long")
    out = F.lit(None).cast("string")
    for name, texts in fixed.PLAN_TEMPLATES.items():
        out = F.when(category == name, F.element_at(F.array(*map(F.lit, texts)), (draw % len(texts) + 1).cast("int"))).otherwise(out)
    return out


def plan_gate(df: DataFrame, order: str, category: str, draw: str, rate: float) -> DataFrame:
    """Rows that get a plan, in order, so that their share follows ``rate`` and categories their shares.

    ``draw`` is a uniform number. Every row counts as emitted before the next.
    Each decision depends on all earlier ones, so one task decides, but it reads
    a byte for a row: the rows are sorted by range in many tasks, numbered, and
    packed into runs of codes. A rate of 0, the default of builds, admits nothing.
    """
    parts = fixed.PLAN_SHARES
    names = list(parts)
    code = F.coalesce(F.array_position(F.array(*map(F.lit, names)), F.col(category)), F.lit(0)) * 2 + F.coalesce((F.col(draw) > 0.5) & ~F.isnan(draw), F.lit(False)).cast("int")
    sorted_ = cut(df.select(order, category, draw).repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("__at", F.monotonically_increasing_id()).withColumn("__code", code.cast("byte")))

    def pack(batches):
        for rows in batches:
            if len(rows):
                yield pd.DataFrame({"at": rows["__at"].iloc[:1], "codes": [rows["__code"].to_numpy(np.uint8).tobytes()]})

    def run(batches):
        seen, given, total, emitted = set(), dict.fromkeys(names, 0), 0, 0
        for rows in batches:
            for start, codes in zip(rows["at"], rows["codes"]):
                taken = []
                for k, x in enumerate(codes):
                    if rate > 0 and x > 1:
                        c = names[(x >> 1) - 1]
                        seen.add(c)
                        now = total / max(1, emitted)
                        fair = total == 0 or given[c] <= parts[c] / sum(parts[s] for s in seen) * total + 2.0
                        if fair and not (now > rate or (now > 0.8 * rate and x & 1)):
                            given[c] += 1
                            total += 1
                            taken.append(start + k)
                    emitted += 1
                yield pd.DataFrame({"__at": np.array(taken, np.int64)})

    # numbers of one partition follow one another, so those of a run do
    runs = sorted_.select("__at", "__code").mapInPandas(pack, "at long, codes binary")
    admitted = cut(runs.coalesce(1).sortWithinPartitions("at").mapInPandas(run, "__at long"))
    return df.join(sorted_.join(admitted, "__at", "left_semi").select(order), order, "left_semi")


# --- models and archives ---


def module_kind(path: Column) -> Column:
    """aligner, vision, lm_head, embedding or text, by the segments of a module's path."""
    segments = F.split(F.lower(path), r"\.")
    some = lambda test: F.exists(segments, test)
    starts = lambda s, heads: F.greatest(*[s.startswith(h) for h in heads])
    return (
        F.when(some(lambda s: F.greatest(*[s.contains(w) for w in fixed.ALIGNER_WORDS])), "aligner")
        .when(some(lambda s: s.isin(*fixed.VISION_SEGMENTS) | starts(s, fixed.VISION_HEADS)), "vision")
        .when(F.element_at(segments, -1) == "lm_head", "lm_head").when(some(lambda s: s.startswith("embed")), "embedding").otherwise("text")
    )


def module_pattern(path: Column) -> Column:
    """A regular expression for a module in any layer."""
    each = F.transform(F.split(path, r"\."), lambda s: F.when(s.rlike("^[0-9]+$"), r"\d+").otherwise(F.regexp_replace(s, r"([^A-Za-z0-9_])", r"\\$1")))
    return F.array_join(each, r"\.")


def target_pattern(modules: DataFrame, path: str) -> DataFrame:
    """One row: the expression that matches the text modules and nothing else, and how many there are."""
    chosen = modules.where(module_kind(F.col(path)) == "text").select(module_pattern(F.col(path)).alias("p"))
    return chosen.groupBy("p").count().agg(F.concat(F.lit("(?:"), F.array_join(F.array_sort(F.collect_list("p")), "|"), F.lit(")")).alias("pattern"), F.sum("count").alias("modules"))


def archived_tasks(names: DataFrame, name: str) -> DataFrame:
    """(task, events, notes) of an archive's member names: tasks with events, in the order of their numbers."""
    part = lambda k: F.regexp_extract(name, r"^data/events/(task(\d+))\.(jsonl|md)$", k)
    rows = names.select(F.col(name).alias("n"), part(1).alias("task"), part(3).alias("kind")).where("task != ''")
    by = rows.groupBy("task").agg(F.max(F.when(F.col("kind") == "jsonl", F.col("n"))).alias("events"), F.max(F.when(F.col("kind") == "md", F.col("n"))).alias("notes"))
    return by.where("events IS NOT NULL").orderBy(F.substring("task", 5, 20).cast("long"), "task")


def screenshots(df: DataFrame, key: str, trajectory: str) -> DataFrame:
    """(key, path): distinct screenshots that a trajectory's JSON names."""
    steps = F.from_json(trajectory, "struct<steps:array<struct<actions:array<struct<screenshot:string>>>>>")["steps"]
    shots = df.select(key, F.explode(steps).alias("s")).select(key, F.explode("s.actions").alias("a")).where("a.screenshot != ''")
    return shots.select(key, F.regexp_replace("a.screenshot", r"^[./]+", "").alias("path")).distinct()


def app_order(apps: DataFrame, path: str, size: str, smoke: bool = False, priority: tuple[str, ...] = fixed.PRIORITY_APPS) -> DataFrame:
    """Adds the place of each application: wanted ones first, then the smallest; a smoke run only looks at size."""
    low = F.lower(path)
    wanted = F.lit(0) if smoke else F.when(F.greatest(*[low.contains(p) for p in priority]), 0).otherwise(1)
    return apps.withColumn("place", F.row_number().over(Window.orderBy(wanted, size, path)).cast("long"))


# --- checkpoints and results ---


def checkpoints(folders: DataFrame, total_steps: int | None = None) -> DataFrame:
    """(path, name, step, percent, has_adapter, verified) of checkpoint folders (path, state, has_adapter).

    The step is what the trainer's state says; a name's number stands in for a
    missing or malformed state, unverified, and a folder with neither is none.
    Percent of the training is from the state's epoch, else from the steps, else -1.
    """
    state = F.from_json("state", "global_step bigint, epoch double")
    name = F.substring_index("path", "/", -1)
    rows = folders.dropDuplicates(["path"]).select("path", name.alias("name"), state["global_step"].alias("told"), state["epoch"].alias("epoch"), "has_adapter")
    rows = rows.withColumn("step", F.coalesce("told", F.expr("try_cast(substring_index(name, '-', -1) AS bigint)"))).where("step IS NOT NULL")
    by_steps = F.lit(-1.0) if not total_steps else 100.0 * F.col("step") / float(total_steps)
    percent = F.when(F.col("epoch").isNotNull(), 100.0 * F.col("epoch")).otherwise(by_steps)
    return rows.select("path", "name", "step", F.round(percent, 2).alias("percent"), "has_adapter", F.col("told").isNotNull().alias("verified")).orderBy("step", "path")


def write_results(df: DataFrame, folder: str, key: str) -> None:
    """One JSON file per task, each complete under its name or absent; a later result replaces an earlier.

    For results of tasks, thousands of small files at most.
    """
    from pyarrow import fs

    names = df.columns

    def run(batches):
        target, at = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + os.path.abspath(re.sub("^file:", "", folder)))
        target.create_dir(f"{at}/tasks", recursive=True)
        for rows in batches:
            for row in rows.to_pylist():
                path = f"{at}/tasks/{re.sub(r'[^0-9A-Za-z._-]', '_', str(row[key]))}.json"
                with target.open_output_stream(f"{path}.{os.getpid()}.tmp") as out:
                    out.write(json.dumps({c: row[c] for c in names}, indent=1, sort_keys=True, default=str).encode())
                target.move(f"{path}.{os.getpid()}.tmp", path)
        yield from ()

    df.mapInArrow(run, "done int").collect()


def read_results(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of all results, in the order of their files' names."""
    rows = spark.read.schema(schema).option("multiLine", "true").option("pathGlobFilter", "*.json").json(f"{folder}/tasks")
    return rows.orderBy(F.col("_metadata.file_name"))


def trajectory_records(heads: DataFrame, steps: DataFrame, key: str, order: str, secret: list[str]) -> DataFrame:
    """(key, place, record, line): the log of each task as JSON lines: header, steps, summary.

    ``heads`` has one row per task: columns named ``end_...`` go into the
    summary, the others into the header. The named columns are redacted. A log
    only shows once Spark has committed it, so it is never partial.
    """
    told = lambda c: redact(F.col(c)).alias(c) if c in secret else F.col(c)
    line = lambda kind, cols: F.to_json(F.struct(F.lit(kind).alias("record"), *cols), {"ignoreNullFields": "false"})
    head = [told(c) for c in heads.columns if not c.startswith("end_")]
    tail = [F.col(key), *[told(c).alias(c[4:]) for c in heads.columns if c.startswith("end_")]]
    rows = heads.select(key, F.lit(-1).cast("long").alias("place"), F.lit("header").alias("record"), line("header", head).alias("line"))
    rows = rows.unionByName(steps.select(key, F.col(order).cast("long").alias("place"), F.lit("step").alias("record"), line("step", [told(c) for c in steps.columns]).alias("line")))
    return rows.unionByName(heads.select(key, F.lit((1 << 63) - 1).alias("place"), F.lit("summary").alias("record"), line("summary", tail).alias("line")))


def subset_envelope(tasks: DataFrame, chosen: DataFrame, key: str, domain: str) -> DataFrame:
    """One row: size, domain counts, ids and their hash, of tasks that were chosen."""
    rows = tasks.join(chosen.select(key), key, "left_semi")
    by = rows.groupBy(domain).agg(F.count("*").alias("n"), F.collect_list(key).alias("ids"))
    whole = by.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("size"), F.array_sort(F.collect_list(F.struct(F.col(domain).alias("domain"), "n"))).alias("domain_counts"), F.array_sort(F.flatten(F.collect_list("ids"))).alias("task_ids"))
    text = F.concat(F.lit('["'), F.array_join("task_ids", '", "'), F.lit('"]'))
    return whole.withColumn("subset_sha256", F.sha2(F.when(F.col("size") == 0, "[]").otherwise(text), 256))


def regeneration(existing: Column, wanted: Column, same_request: Column, force: Column) -> Column:
    """What may happen to a subset file: write, keep, replace or refuse; the first two are ids' hashes, null without a file."""
    return F.when(existing.isNull(), "write").when(same_request & (existing == wanted), "keep").when(force, "replace").otherwise("refuse")


def target_outcomes(tasks: DataFrame, actions: DataFrame, key: str, radius: int = 40) -> DataFrame:
    """(key, valid, clicked, finished, success) of tasks that ask for a click on a square at (x, y), then a finish.

    ``actions`` has (key, verb, x, y) in screen pixels.
    """
    spot = lambda k: F.expr(f"try_cast(regexp_extract(instruction, r'target square at \\((\\d+),\\s*(\\d+)\\)', {k}) AS bigint)")
    asked = tasks.select(key, spot(1).alias("tx"), spot(2).alias("ty"), F.contains("instruction", F.lit("[invalid]")).alias("bad"))
    near = F.col("verb").isin("click", "double_click", "right_click", "middle_click") & (F.pow(F.col("x") - F.col("tx"), F.lit(2)) + F.pow(F.col("y") - F.col("ty"), F.lit(2)) <= radius * radius)
    seen = actions.join(asked, key).groupBy(key).agg(F.bool_or(near).alias("clicked"), F.bool_or(F.col("verb") == "finish").alias("finished"))
    no = lambda c: F.coalesce(c, F.lit(False))
    valid = F.col("tx").isNotNull() & ~F.col("bad")
    return asked.join(seen, key, "left").select(key, valid.alias("valid"), no(F.col("clicked")).alias("clicked"), no(F.col("finished")).alias("finished"), (no(F.col("clicked")) & no(F.col("finished"))).alias("success"))


def conversion_errors(original: Column, points: Column, space: Column, width: Column, height: Column, real_width: Column, real_height: Column, tolerance: float = 2.0) -> Column:
    """How many points array<(x, y)> are off by more than ``tolerance`` pixels from the pairs of numbers in a source text.

    Pairs are thousandths (space ``norm_0_1000``) or pixels of the original
    size; 0 where the text has fewer pairs than there are points.
    """
    pair = r"(-?\d+(?:\.\d+)?)\s*[, ]\s*(-?\d+(?:\.\d+)?)"
    xs, ys = (F.transform(F.regexp_extract_all(F.coalesce(original, F.lit("")), F.lit(pair), F.lit(k)), lambda v: v.cast("double")) for k in (1, 2))
    scale = lambda v, full, real: F.when(space == "norm_0_1000", v / 1000.0 * full).otherwise(v * full / real)
    want = F.arrays_zip(xs.alias("x"), ys.alias("y"), points.alias("p"))
    off = F.filter(want, lambda z: z["p"].isNotNull() & ((F.abs(z["p"]["x"] - scale(z["x"], width, real_width)) > tolerance) | (F.abs(z["p"]["y"] - scale(z["y"], height, real_height)) > tolerance)))
    return F.when(F.size(xs) < F.size(points), 0).otherwise(F.size(off)).cast("long")


def contract_target(rendered: Column, verb: Column, points: Column, width: Column, height: Column, thousandths: Column, template: Column) -> Column:
    """An action in a model's own notation: pixels or thousandths, in the place of ``{action}`` in a template."""
    share = lambda v, size: F.when(size <= 1, 0).otherwise(F.least(F.lit(1000), F.greatest(F.lit(0), F.rint(v * 1000.0 / (size - 1))))).cast("int")
    p = lambda i: (share(F.get(points, i)["x"], width).cast("string"), share(F.get(points, i)["y"], height).cast("string"))
    one, two = p(0), p(1)
    put = lambda text, name, value: F.regexp_replace(text, F.lit(rf"\b{name}=-?\d+"), F.concat(F.lit(f"{name}="), value))
    moved = F.when(verb == "drag", put(put(put(put(rendered, "x1", one[0]), "y1", one[1]), "x2", two[0]), "y2", two[1])).when(F.size(points) == 1, put(put(rendered, "x", one[0]), "y", one[1])).otherwise(rendered)
    return F.replace(template, F.lit("{action}"), F.when(thousandths, moved).otherwise(rendered))


def action_problems(samples: DataFrame, parsed: str, width: str, height: str, task_type: str) -> DataFrame:
    """(problem, n) over samples with a parsed model output (see ``actions.model_output``); replayed and understanding samples are not looked at."""
    error, action = F.col(parsed)["error"], F.col(parsed)["action"]
    outside = F.exists(action["points"], lambda p: (p["x"] < 0) | (p["y"] < 0) | (p["x"] >= F.col(width)) | (p["y"] >= F.col(height)))
    told = F.array_join(F.transform(action["points"], lambda p: F.concat(F.lit("("), p["x"].cast("string"), F.lit(", "), p["y"].cast("string"), F.lit(")"))), ", ")
    found = F.when(error.isNotNull(), F.array(error)).otherwise(F.array_compact(F.array(
        F.when(~action["verb"].isin(*fixed.VERBS), F.concat(F.lit("bad_verb:"), action["verb"])), F.when(F.coalesce(outside, F.lit(False)), F.concat(F.lit("out_of_bounds:["), told, F.lit("]")))
    )))
    rows = samples.where(~F.col(task_type).startswith("replay") & (F.col(task_type) != "screen_understanding"))
    return rows.select(F.explode(found).alias("problem")).groupBy("problem").agg(F.count("*").alias("n"))


def grounding_reasons(asked: Column, point: Column, dimension: Column, referent: Column, pixel: Column, width: Column, height: Column) -> Column:
    """Why a grounding row is rejected, by the first rule that holds; null when it may be used."""
    inside = (pixel["x"] >= 0) & (pixel["x"] < width) & (pixel["y"] >= 0) & (pixel["y"] < height)
    return (
        F.when((F.coalesce(asked, F.lit("")) == "") | point.isNull(), "unparseable_grounding_row").when(dimension == "ambiguous", "coordinate_space_ambiguous")
        .when(referent.isNull(), "ambiguous_grounding_referent").when(~F.coalesce(inside, F.lit(False)), "coordinate_out_of_bounds")
    )
