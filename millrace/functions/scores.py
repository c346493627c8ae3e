"""Rule-based quality scores of steps and of grounding targets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.labels import lookup

POINTING = ("click", "double_click", "right_click", "middle_click")


def app_rarity(app: Column, share: Column) -> Column:
    """Rarer applications score higher; share is the application's part of the rows."""
    return (
        F.when(app.isNull() | (app == "") | share.isNull(), 0.3)
        .when(F.lower(app).isin(*fixed.COMMON_APPS), F.greatest(F.lit(0.0), 0.5 - share))
        .otherwise(F.greatest(F.lit(0.3), 1.0 - 3 * share))
    )


def bucket(score: Column) -> Column:
    return F.when(score >= 7, "A").when(score >= 5, "B").when(score >= 3, "C").otherwise("Reject")


def action_components(
    verb: Column, signals: Column, app: Column, share: Column, first: Column, repeated: Column, changed: Column,
    width: Column | None = None, offset: Column | None = None, form: Column | None = None, ineffective: Column | None = None,
) -> dict[str, Column]:
    """The parts of an action's score, by name; ``grounding_difficulty`` is told but carries no weight."""
    width, offset = (F.lit(None).cast("double") if c is None else c for c in (width, offset))
    has = lambda *names: F.arrays_overlap(signals, F.array(*map(F.lit, names)))
    unit = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    recovered = has("recovery_evidenced") if ineffective is None else has("recovery_evidenced") | F.coalesce(ineffective, F.lit(False))
    opening = F.when(first & verb.isin("click", "double_click") & (F.size(signals) == 0), 0.5).otherwise(0.0)
    giant = (verb == "click") & F.coalesce(width > 300, F.lit(False))
    return {
        "difficulty": F.least(F.lit(1.0), 0.15 * F.size(F.array_intersect(signals, F.array(*map(F.lit, fixed.HARD_SIGNALS))))),
        "recovery": F.when(recovered, 1.0).otherwise(0.0),
        "verification": F.when((verb == "finish") | has("verification"), 1.0).when(has("save_export"), 0.4).otherwise(0.0),
        "action_rarity": lookup(fixed.RARE_VERBS, verb, 0.15),
        "app_rarity": app_rarity(app, share),
        "dialog": F.when(has("dialog", "modal_dialog"), 1.0).otherwise(0.0),
        "save_export": F.when(has("save_export", "export"), 1.0).otherwise(0.0),
        "state_value": F.when(changed, 0.6).otherwise(0.3),
        "grounding_difficulty": F.when(verb.isin("click", "double_click", "right_click", "drag") & width.isNotNull(), unit(48.0 / F.greatest(F.lit(6.0), width) - 0.4)).otherwise(0.0),
        "offcenter_click": F.when(verb.isin(*POINTING) & offset.isNotNull(), unit((offset - 0.35) / 0.45)).otherwise(0.0),
        "sequence_value": F.lit(0.3) if form is None else lookup(fixed.SEQUENCE_VALUE, form, 0.3),
        "triviality": F.when(giant, F.greatest(opening, F.lit(0.8))).otherwise(opening),
        "redundancy": F.when(repeated, 1.0).otherwise(0.0),
    }


def action_score(parts: dict[str, Column]) -> Column:
    """0 to 10 from weighted parts."""
    raw = F.lit(2.0)
    for name, weight in fixed.ACTION_WEIGHTS.items():
        raw = raw + weight * parts[name]
    return F.greatest(F.lit(0.0), F.least(F.lit(10.0), 10.0 * raw / 8.0))


def action_verdict(score: Column, verb: Column, parts: dict[str, Column]) -> Column:
    """(bucket, reason): hard rejections first, then thresholds with a floor for routine clicks."""
    give = lambda b, r: F.struct(b.alias("bucket"), r.cast("string").alias("reason"))
    none = F.lit(None)
    routine = (parts["triviality"] > 0) & (parts["redundancy"] == 0) & (verb == "click")
    return (
        F.when(~verb.isin(*fixed.ANCHOR_VERBS), give(F.lit("Reject"), F.concat(F.lit("anchor_ineligible_verb:"), verb)))
        .when((parts["redundancy"] > 0) & (parts["recovery"] == 0), give(F.lit("Reject"), F.lit("repeated_identical_no_recovery")))
        .when(score >= 3, give(bucket(score), none))
        .when(routine, give(F.lit("C"), none))
        .otherwise(give(F.lit("Reject"), F.lit("low_quality")))
    )


def grounding_score(width: Column, height: Column, text: Column, category: Column, app: Column, share: Column) -> Column:
    """0 to 10: small, well-named targets of rare applications score high."""
    extent = F.greatest(F.lit(1.0), F.sqrt((F.greatest(width, F.lit(1)) * F.greatest(height, F.lit(1))).cast("double")))
    hard = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 40.0 / extent - 0.3))
    n = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\W+"), lambda x: x != ""))
    named = F.when(n > 1, F.least(F.lit(1.0), 0.25 * (n - 1))).otherwise(0.0)
    kind = F.when(category.isin(*fixed.VALUED_CATEGORIES), 1.0).otherwise(0.5)
    raw = 1.2 + 2.5 * hard + 1.0 * named + 0.8 * app_rarity(app, share) + 0.7 * kind
    return F.greatest(F.lit(0.0), F.least(F.lit(10.0), 10.0 * raw / 5.5))


def token_efficiency(score: Column, tokens: Column) -> Column:
    return score / F.greatest(F.lit(1.0), tokens / 1000)


def selection_score(quality: Column, efficiency: Column, counts: dict[str, Column], motif_counts: Column | None = None, frontier: Column | None = None) -> Column:
    """Quality, saturating efficiency, rarity by frequency columns, verified frontier score.

    A quality that is null or 0 counts as 5. ``counts`` holds how often the
    row's group, app, verb and domain occur; a null count adds nothing.
    """
    base = F.when(quality.isNull() | (quality == 0), 5.0).otherwise(quality)
    gain = F.least(F.lit(1.5), F.log1p(F.greatest(F.lit(0.0), F.coalesce(efficiency, F.lit(0.0)))) / 2.0)
    out = base + 0.9 * gain
    for name, weight in (("group", 0.45), ("app", 0.30), ("verb", 0.20), ("domain", 0.25)):
        if name in counts:
            out = out + F.coalesce(weight / F.sqrt(F.greatest(F.lit(1), counts[name]).cast("double")), F.lit(0.0))
    if motif_counts is not None:
        out = out + F.aggregate(motif_counts, F.lit(0.0), lambda a, n: a + 0.10 / F.sqrt(F.greatest(F.lit(1), n).cast("double")))
    return out if frontier is None else out + 1.6 * F.coalesce(frontier, F.lit(0.0))


def trajectory_priority(n: Column) -> Column:
    """Weight of a trajectory by its number of steps."""
    return F.when(n < 4, 0.5).when((n >= 6) & (n <= 40), 1.0).when(n < 6, 0.8).otherwise(0.9)
