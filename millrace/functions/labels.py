"""Labels by rule: signals, motifs, applications, referents, categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.text import strip


def lookup(values: dict, key: Column, default=None) -> Column:
    out = F.lit(default)
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def labels(rules: dict[str, str], *texts: Column) -> Column:
    """Sorted names of the rules whose pattern occurs in one of the texts."""
    hit = lambda p: F.coalesce(*[F.when(t.rlike("(?i)" + p), True) for t in texts], F.lit(False))
    return F.array_sort(F.array_compact(F.array(*[F.when(hit(p), F.lit(name)) for name, p in rules.items()])))


def task_signals(*texts: Column) -> Column:
    return labels(fixed.TASK_PATTERNS, *texts)


def difficulty_signals(*texts: Column) -> Column:
    return labels(fixed.DIFFICULTY_PATTERNS, *texts)


def step_signals(signals: Column, verb: Column) -> Column:
    return F.array_union(signals, F.array_compact(F.array(lookup(fixed.VERB_SIGNAL, verb))))


def motifs(text: Column, signals: Column | None = None, action: Column | None = None, **flags: Column) -> Column:
    """Sorted motifs of a conversation's text, its signals, its last action and its flags.

    Flags name the motif they prove, such as ``finish_verification``.
    """
    found = [F.when(text.rlike("(?i)" + p), F.lit(m)) for m, p in fixed.MOTIF_PATTERNS.items()]
    if signals is not None:
        found += [F.when(F.array_contains(signals, s), F.lit(m)) for s, m in fixed.SIGNAL_MOTIF.items()]
    if action is not None:
        low = F.lower(action)
        found += [F.when(low.contains("drag("), F.lit("drag")), F.when(low.contains("hotkey(") | low.contains("press("), F.lit("hotkeys")), F.when(low.contains("scroll("), F.lit("scroll_read"))]
    found += [F.when(flag, F.lit(m)) for m, flag in flags.items()]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))


def app_of(goal: Column, given: Column | None = None, rules: dict[str, str] | None = None, default: str = "desktop") -> Column:
    """A given application, else the first rule that occurs in the goal."""
    found = F.lit(default)
    for app, pattern in reversed((rules or fixed.APP_PATTERNS).items()):
        found = F.when(goal.rlike("(?i)" + pattern), F.lit(app)).otherwise(found)
    return found if given is None else F.coalesce(F.when(given != "", F.substring(F.lower(given), 1, 40)), found)


def app_from_id(row_id: Column, default: str = "office") -> Column:
    head = F.regexp_extract(row_id, "^[A-Za-z]+", 0)
    return F.lower(F.when(head != "", head).otherwise(default))


def referent(text: Column) -> Column:
    """The visible target a text names: a quoted control or a cell; null without one."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    label = strip(F.regexp_extract(t, "(?i)" + fixed.REFERENT_QUOTED, 1))
    kind = F.lower(F.regexp_extract(t, "(?i)" + fixed.REFERENT_QUOTED, 2))
    cell = F.regexp_extract(t, "(?i)" + fixed.REFERENT_CELL, 1)
    quoted = t.rlike("(?i)" + fixed.REFERENT_QUOTED)
    return F.when(quoted, F.when(label != "", F.trim(F.concat(label, F.lit(" "), kind)))).when(cell != "", F.concat(F.lit("cell "), F.upper(cell)))


def control_kind(given: Column, text: Column) -> Column:
    raw = F.lower(strip(F.coalesce(given, F.lit(""))))
    found = F.lit("unknown")
    for word in reversed(fixed.CONTROL_KINDS):
        found = F.when(F.lower(text).contains(word), word).otherwise(found)
    return F.when(raw != "", F.substring(raw, 1, 48)).otherwise(found)


def describe_element(text: Column, category: Column, default: str = "indicated control") -> Column:
    t, c = strip(F.coalesce(text, F.lit(""))), F.lower(strip(F.coalesce(category, F.lit(""))))
    return F.when((t != "") & (c != ""), F.concat(t, F.lit(" ("), c, F.lit(")"))).when(t != "", t).when(c != "", c).otherwise(default)


def usable_element(box: Column, text: Column) -> Column:
    """A box array<double> of four with a fair size whose text says something."""
    w, h = F.get(box, 2) - F.get(box, 0), F.get(box, 3) - F.get(box, 1)
    told = ~F.lower(strip(F.coalesce(text, F.lit("")))).isin(*fixed.LOW_INFORMATION)
    return F.coalesce((F.size(box) == 4) & (w >= 4) & (h >= 4) & (w <= 300) & told, F.lit(False))


def plan_category(signals: Column) -> Column:
    """Category of the first signal, in the order given, that may carry a plan."""
    known = F.filter(signals, lambda s: s.isin(*fixed.PLAN_CATEGORY))
    return lookup(fixed.PLAN_CATEGORY, F.try_element_at(known, F.lit(1)))


def finish_evidence(*flags: Column) -> Column:
    out = F.lit(False)
    for flag in flags:
        out = out | F.coalesce(flag, F.lit(False))
    return out


def verification_basis(task_type: Column, clicked_box: Column, finish: Column, math_ok: Column) -> Column:
    """What verifies a sample, by the first rule that holds; null when nothing does."""
    return (
        F.when(task_type == "grounding", "grounding_target_with_known_point")
        .when((task_type == "action") & F.coalesce(clicked_box, F.lit(False)), "click_inside_trusted_box")
        .when(task_type == "replay_tool", "structured_tool_arguments")
        .when(finish == "yes", "verified_finish_outcome")
        .when(math_ok, "verified_math_reference")
    )


def suspicions(verb: Column, signals: Column, width: Column, length: Column, plan: Column) -> Column:
    """Review categories of a sample, in a fixed order."""
    has = lambda *names: F.arrays_overlap(signals, F.array(*map(F.lit, names)))
    rules = {
        "finish": verb == "finish", "wait": verb == "wait", "recovery": has("recovery_evidenced"), "no_state_change": has("no_state_change"),
        "save_export": has("save", "export"), "dialog": F.exists(signals, lambda s: s.contains("dialog")), "multi_app": has("multi_app"),
        "sorting_ranking": has("sorting", "ranking"), "exact_quantity": has("exact_quantity"), "multi_target": has("multi_target"),
        "tiny_target": F.coalesce(width, F.lit(999)) < 16, "long_window": F.coalesce(length, F.lit(1)) >= 8, "reasoning": F.coalesce(plan, F.lit("")) != "",
    }
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
