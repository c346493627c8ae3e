"""Row validation with first-failure reasons, and the gates of a release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.text import strip
from millrace.operators.common import ranked, small


def first_failure(checks: dict[str, Column]) -> Column:
    """Name of the first check that is true, in the order given; null when none is."""
    return F.coalesce(*[F.when(c, F.lit(name)) for name, c in checks.items()])


def all_failures(checks: dict[str, Column]) -> Column:
    """Names of all checks that are true, in the order given."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]))


def blank(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit(""))) == ""


def message_checks(messages: Column) -> dict[str, Column]:
    """Checks of messages array<(role, content)> that hold for every kind of sample."""
    said = F.filter(messages, lambda m: m["role"] == "assistant")
    return {
        "invalid_messages": messages.isNull() | (F.size(messages) == 0),
        "invalid_roles": ~F.get(messages, 0)["role"].isin("system", "user") | (F.size(said) == 0),
        "empty_assistant_target": F.exists(said, lambda m: blank(m["content"])),
        "empty_message_content": F.exists(messages, lambda m: blank(m["content"])),
    }


def sample_checks(sources: tuple[str, ...], files: bool = False) -> dict[str, Column]:
    """The ordered checks of a final sample with the columns of ``schema.SAMPLE``.

    ``action`` is the parsed action (``actions.parse_action``) of the target
    and ``controls`` the parsed target of a screen description. With ``files``
    the columns missing_image and undecodable tell of its image files.
    """
    m, meta, images, kind = F.col("messages"), F.col("metadata"), F.col("images"), F.col("task_type")
    said = F.filter(m, lambda x: x["role"] == "assistant")
    learned = F.filter(said, lambda x: F.coalesce(x["loss"], F.lit(True)))
    acts, screen = kind.isin("action", "grounding"), kind == "screen_understanding"
    size = F.coalesce(meta["final_image_size"], meta["image_size"])
    native = F.coalesce(meta["native_interface"], F.lit(False))
    visual = native & F.coalesce(meta["interface_history_mode"] == "visual_recent_rounds", F.lit(False))
    action, controls = F.col("action"), F.col("controls")
    mark = F.coalesce(F.when(meta["interface_image_placeholder"] != "", meta["interface_image_placeholder"]), F.lit("<image>"))
    marks = F.aggregate(m, F.lit(0), lambda a, x: a + F.size(F.split(x["content"], F.concat(F.lit("\\Q"), mark, F.lit("\\E")), -1)) - 1)
    outside = F.exists(action["points"], lambda p: (p["x"] < 0) | (p["y"] < 0) | (p["x"] >= F.get(size, 0)) | (p["y"] >= F.get(size, 1)))
    digest = meta["assistant_target_sha256"]
    box = lambda c, i: F.get(c["control_rect"], i)
    place = lambda c: F.array(*[F.round(box(c, i), 6) for i in (1, 0, 3, 2)])
    lost = {"missing_image": F.coalesce(F.col("missing_image"), F.lit(False)), "image_undecodable": F.coalesce(F.col("undecodable"), F.lit(False))} if files else {}
    return message_checks(m) | {
        "unknown_source": ~F.coalesce(F.col("source"), F.lit("")).isin(*sources),
        "missing_trajectory_id": F.coalesce(F.col("trajectory_id"), F.lit("")) == "",
        "invalid_images": images.isNull(),
        "image_placeholder_mismatch": marks != F.size(images),
        "non_portable_path": F.exists(images, lambda p: p.contains("\\") | p.startswith("/") | p.contains("..")),
    } | lost | {
        "multi_assistant_action_without_state_alignment": acts & ~visual & (F.size(said) != 1),
        "action_requires_exactly_one_supervised_assistant": acts & (F.size(learned) != 1),
        "native_target_hash_missing": acts & native & (F.length(F.coalesce(digest, F.lit(""))) != 64),
        "native_target_hash_mismatch": acts & native & (F.sha2(F.get(learned, 0)["content"], 256) != digest),
        "action_requires_visual_state": acts & visual & (F.size(images) < 1),
        "native_history_supervised_assistant_not_last": acts & visual & ~F.coalesce(F.try_element_at(said, F.lit(-1))["loss"], F.lit(True)),
        "action_requires_exactly_one_image": acts & ~visual & (F.size(images) != 1),
        "invalid_action_syntax": acts & action.isNull(),
        "missing_final_image_size": acts & (size.isNull() | (F.size(size) < 2)),
        "coordinate_out_of_bounds": acts & F.coalesce(outside, F.lit(False)),
        "grounding_without_point": (kind == "grounding") & (F.size(action["points"]) == 0),
        "finish_without_evidence": acts & (action["verb"] == "finish") & ~F.coalesce(meta["finish_evidence"] == "yes", F.lit(False)),
        "invalid_understanding_turn_structure": screen & ((F.size(said) != 1) | (F.size(images) != 1)),
        "malformed_understanding_json": screen & (controls.isNull() | (F.size(controls) == 0) | (F.size(controls) > 24)),
        "malformed_understanding_control": screen & F.exists(controls, lambda c: blank(c["control_text"]) | c["control_rect"].isNull() | (F.size(c["control_rect"]) != 4)),
        "understanding_rect_out_of_bounds": screen & F.exists(controls, lambda c: F.exists(c["control_rect"], lambda v: (v < 0) | (v > 1000)) | (box(c, 2) < box(c, 0)) | (box(c, 3) < box(c, 1))),
        "understanding_not_spatially_sorted": screen & F.exists(F.zip_with(F.slice(controls, 1, F.greatest(F.size(controls) - 1, F.lit(0))), F.slice(controls, 2, F.size(controls)), lambda a, b: place(b) < place(a)), lambda x: x),
    }


def with_image_facts(samples: DataFrame, files: DataFrame, key: list[str]) -> DataFrame:
    """Adds missing_image: some image of the sample is not among ``files`` (path)."""
    asked = samples.select(*key, F.explode("images").alias("path"))
    lost = asked.join(files.select("path").distinct(), "path", "left_anti").select(*key, F.lit(True).alias("missing_image")).distinct()
    return samples.join(lost, key, "left").withColumn("undecodable", F.lit(False))


def role_checks(df: DataFrame, key: str, order: str, role: str, text: str) -> DataFrame:
    """(key, roles, assistant text): conversations for rules on the order of roles."""
    turns = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("content")))).alias("messages"))
    said = F.array_join(F.transform(F.filter("messages", lambda m: m["role"] == "assistant"), lambda m: m["content"]), "\n")
    return turns.select(key, "messages", F.transform("messages", lambda m: m["role"]).alias("roles"), said.alias("assistant"))


def instruction_ok(roles: Column, assistant: Column, quality: Column | None = None, category: Column | None = None) -> Column:
    """General instruction data: rated well or not at all, roles in order, an answer of some length."""
    ok = (F.size(roles) > 0) & (F.get(roles, 0) != "assistant") & F.array_contains(roles, "user") & F.array_contains(roles, "assistant")
    twice = F.exists(F.zip_with(F.slice(roles, 1, F.greatest(F.size(roles) - 1, F.lit(0))), F.slice(roles, 2, F.size(roles)), lambda a, b: (a == "assistant") & (b == "assistant")), lambda x: x)
    ok = ok & ~twice & (F.length(strip(assistant)) >= 30)
    if quality is not None:
        ok = ok & F.lower(strip(F.coalesce(quality, F.lit("")))).isin("", "good", "excellent")
    return ok if category is None else ok & ~F.lower(strip(F.coalesce(category, F.lit("")))).isin("coding", "math")


def failure_counts(df: DataFrame, reason: str, example: str, examples: int = 3) -> DataFrame:
    """(reason, n, examples): the smallest few ids of each reason, found without gathering the rest."""
    some = df.where(F.col(reason).isNotNull())
    counts = some.groupBy(reason).agg(F.count("*").alias("n"))
    first = some.select(reason, example).distinct().withColumn("__at", ranked([reason], F.asc(example))).where(F.col("__at") <= examples)
    return counts.join(first.groupBy(reason).agg(F.array_sort(F.collect_list(example)).alias("examples")), reason, "left")


def fatal(df: DataFrame, reason: str, n: str, total: Column, tolerances: dict[str, float] | None = None) -> DataFrame:
    """Adds allowed, tolerated and fatal to counted reasons; only schema reasons can be tolerated."""
    share = F.lit(0.0)
    for name, value in (tolerances or {}).items():
        share = F.when(F.col(reason) == name, value).otherwise(share)
    rows = df.withColumn("allowed", F.floor(share * F.greatest(F.lit(1), total)).cast("long"))
    rows = rows.withColumn("tolerated", F.col(reason).isin(*fixed.SCHEMA_REASONS) & (F.col(n) <= F.col("allowed")))
    return rows.withColumn("fatal", F.col(reason).isin(*fixed.FATAL_CONDITIONS, *fixed.SCHEMA_REASONS, *fixed.RELEASE_REASONS) & ~F.col("tolerated"))


def share_violations(report: DataFrame, most: float, exempt: tuple[str, ...] = ("action", "grounding")) -> DataFrame:
    """Task types whose share of learned tokens exceeds ``most``."""
    return report.where((F.col("axis") == "task_type") & ~F.col("key").isin(*exempt) & (F.col("share") > most)).select("key", "share")


def unmet_floors(coverage: DataFrame, floors: DataFrame) -> DataFrame:
    """(motif, required, selected) where fewer samples show a motif than its floor asks for."""
    rows = floors.join(coverage, "motif", "left").withColumn("selected", F.coalesce("selected", F.lit(0)).cast("long"))
    return rows.where("selected < required").select("motif", "required", "selected")


def orphans(files: DataFrame, samples: DataFrame, path: str = "path", images: str = "images", suffix: str = ".webp") -> DataFrame:
    """Generated files that no sample names."""
    named = samples.select(F.explode(images).alias("__p")).select(F.replace("__p", F.lit("\\"), F.lit("/")).alias(path)).distinct()
    return files.where(F.lower(path).endswith(suffix)).join(named, path, "left_anti")


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """The rows, or an error where one breaks the condition."""
    return df.where(F.assert_true(condition, message).isNull())


def allow_list(files: DataFrame, path: str = "path", under: tuple[str, ...] = ("final/", "images/", "manifests/"), names: tuple[str, ...] = (), suffixes: tuple[str, ...] = ()) -> DataFrame:
    """Files that may be published, in the order of their paths."""
    p = F.col(path)
    ok = F.lit(False)
    for head in under:
        ok = ok | p.startswith(head)
    for suffix in suffixes:
        ok = ok & ~F.lower(p).endswith(suffix)
    return files.where(ok & ~F.substring_index(p, "/", -1).isin(*names)).orderBy(path)


def manifest_diff(base: DataFrame, other: DataFrame, fields: tuple[str, ...] = fixed.MANIFEST_FIELDS) -> DataFrame:
    """(field, base, other) of compared fields that differ; a missing field is ``<ABSENT>``.

    Manifests come as rows (field, value).
    """
    both = base.select("field", F.col("value").alias("base"), F.lit(1).alias("b")).join(other.select("field", F.col("value").alias("other"), F.lit(1).alias("o")), "field", "full_outer")
    told = both.where(F.col("field").isin(*fields)).select(
        "field", F.when(F.col("b") == 1, F.col("base")).otherwise("<ABSENT>").alias("base"), F.when(F.col("o") == 1, F.col("other")).otherwise("<ABSENT>").alias("other")
    )
    return told.where(~F.col("base").eqNullSafe(F.col("other")))


def flattened(df: DataFrame, json_col: str, paths: tuple[str, ...]) -> DataFrame:
    """Rows (field, value) of dotted paths present in a JSON column."""
    pairs = F.array(*[F.struct(F.lit(p).alias("field"), F.get_json_object(json_col, "$." + p).alias("value")) for p in paths])
    return df.select(F.explode(pairs).alias("p")).select("p.field", "p.value").where("value IS NOT NULL")


def nearest(gates: DataFrame, points: DataFrame, gate: str, at: str, order: str, tolerance: float) -> DataFrame:
    """The point nearest to each gate within ``tolerance``; of equal ones the first by ``order``.

    Gates are few, so every point looks them up and one partial aggregation
    per gate keeps the best.
    """
    away = F.abs(F.col(at) - F.col(gate))
    met = points.join(small(gates.select(gate), 10_000), away <= tolerance)
    best = met.groupBy(gate).agg(F.min_by(F.struct(*points.columns), F.struct(away, F.col(order))).alias("b"))
    return gates.join(best.select(gate, "b.*"), gate, "left")
