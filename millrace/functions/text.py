"""Text expressions: normal forms, shingles, token estimates, redaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import fixed


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def words(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits; accented letters part words."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def normalize(text: Column) -> Column:
    return F.array_join(words(text), " ")


def shingles(w: Column, n: int = 8) -> Column:
    """Distinct n-grams of a word array; fewer words make one shingle, none make none."""
    grams = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
    return (
        F.when(F.size(w) == 0, F.array().cast("array<string>"))
        .when(F.size(w) < n, F.array(F.array_join(w, " ")))
        .otherwise(F.array_distinct(grams))
    )


def shingle_hashes(words: Column, n: int = 8) -> Column:
    """64-bit hashes of the distinct shingles of an array of words; a short text is one shingle."""
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - n + 1)), lambda i: F.xxhash64(F.slice(words, i, n)))
    return F.when(F.size(words) > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))


def jaccard(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def containment(a: Column, b: Column) -> Column:
    """Share of the set a that is in b."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def normalized_hash(text: Column) -> Column:
    return F.sha2(normalize(text), 256)


def text_hash(text: Column) -> Column:
    return F.sha2(F.lower(strip(text)), 256)


def template(text: Column, limit: int = 1200) -> Column:
    """A text with addresses, numbers and long hex ids replaced by marks, in that order.

    Lower case stands in for case folding, with sharp s written as ss.
    """
    t = F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))
    t = F.regexp_replace(t, r"(?U)https?://\S+", "<url>")
    t = F.regexp_replace(t, r"(?U)\b\d+(?:\.\d+)?\b", "<n>")
    t = F.regexp_replace(t, r"[A-Fa-f0-9]{16,}", "<id>")
    return F.substring(F.trim(F.regexp_replace(t, r"(?U)\s+", " ")), 1, limit)


def sanitize(text: Column, limit: int = 96) -> Column:
    """A text as part of a file name; an empty one becomes x."""
    clean = F.substring(F.regexp_replace(strip(F.when(text != "", text).otherwise("x")), "[^A-Za-z0-9._-]+", "_"), 1, limit)
    return F.when(clean == "", "x").otherwise(clean)


def right_trimmed_lines(text: Column) -> Column:
    return F.array_join(F.transform(F.split(strip(text), r"\r\n|\r|\n"), lambda x: F.regexp_replace(x, r"\s+$", "")), "\n")


def tokens(text: Column) -> Column:
    """Estimated tokens: a quarter of the code points, rounded up."""
    return F.ceil(F.length(F.coalesce(text, F.lit(""))) / 4).cast("long")


def image_tokens(width: Column, height: Column, patch: int = 28, extra: int = 8) -> Column:
    return (F.ceil(width / patch) * F.ceil(height / patch) + extra).cast("long")


def sequence_tokens(history: Column, *texts: Column, images: Column | None = None) -> Column:
    """Estimate of a whole sequence: an array of history texts, further texts, image tokens."""
    total = 4 * (3 + F.size(history)) + F.aggregate(history, F.lit(0).cast("long"), lambda a, x: a + tokens(x))
    for t in texts:
        total = total + tokens(t)
    return (total if images is None else total + images).cast("long")


def redact(text: Column, mask: str = "[REDACTED]", patterns: tuple[str, ...] = fixed.SECRET_PATTERNS) -> Column:
    out = F.coalesce(text, F.lit(""))
    for pattern in patterns:
        out = F.regexp_replace(out, pattern, mask)
    return out


def has_secret(text: Column, patterns: tuple[str, ...] = fixed.SECRET_PATTERNS) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | F.coalesce(text, F.lit("")).rlike(pattern)
    return found


def action_line(content: Column) -> Column:
    """The last ``Action:`` line, else the last line that is not blank, else the empty string."""
    marked = F.regexp_extract_all(content, F.lit(r"(?m)^Action:\s*(.+)$"), F.lit(1))
    lines = F.filter(F.split(content, r"\r\n|\r|\n"), lambda x: strip(x) != "")
    return F.coalesce(strip(F.try_element_at(marked, F.lit(-1))), strip(F.try_element_at(lines, F.lit(-1))), F.lit(""))


def task_line(content: Column) -> Column:
    """What follows ``Task:`` on the first line that starts so; null without one."""
    lines = F.filter(F.split(content, "\n"), lambda x: x.startswith("Task:"))
    return strip(F.substring(F.try_element_at(lines, F.lit(1)), 6, 1 << 30))


def markdown_description(text: Column) -> Column:
    return strip(F.regexp_extract(text, fixed.MARKDOWN_DESCRIPTION, 1))


def compose_target(action: Column, plan: Column) -> Column:
    """A plan and an action as one target; without a plan the action alone."""
    bare = strip(plan)
    bare = F.when(bare.startswith("Plan:"), strip(F.substring(bare, 6, 1 << 30))).otherwise(bare)
    return F.when(F.coalesce(plan, F.lit("")) == "", action).otherwise(F.concat(F.lit("Plan: "), bare, F.lit("\nAction: "), action))


def prompt(task: Column, history: Column, keep: int | None = None, placeholder: str = "<image>") -> Column:
    """A user turn: placeholder, task, and the last ``keep`` previous actions as bullets."""
    last = history if keep is None else F.slice(history, F.greatest(F.size(history) - keep, F.lit(0)) + 1, keep)
    bullets = F.array_join(F.transform(last, lambda x: F.concat(F.lit("- "), x)), "\n")
    return F.concat_ws(
        "\n", F.lit(placeholder), F.when(task != "", F.concat(F.lit("Task: "), task)),
        F.when(F.size(last) > 0, F.concat(F.lit("Previous actions:\n"), bullets)),
    )


def repetitive(text: Column, least: int = 8) -> Column:
    """True when a text of many lines has few distinct ones."""
    lines = F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), strip), lambda x: x != "")
    return (F.size(lines) >= least) & (F.size(F.array_distinct(lines)) <= F.greatest(F.lit(2), F.floor(F.size(lines) / 4)))


def code_language(instruction: Column, response: Column) -> Column:
    """Tag of the first fenced block, else the first keyword that occurs."""
    tag = F.lower(strip(F.regexp_extract(response, r"(?s)```\s*([A-Za-z0-9_+.-]*)\s*\n.*?```", 1)))
    found = F.lit("unknown")
    text = F.lower(F.concat(instruction, F.lit("\n"), F.substring(response, 1, 500)))
    for word, language in reversed(fixed.CODE_KEYWORDS.items()):
        found = F.when(text.contains(word), language).otherwise(found)
    named = tag
    for alias, language in fixed.CODE_ALIASES.items():
        named = F.when(tag == alias, language).otherwise(named)
    return F.when(tag != "", named).otherwise(found)


def problem_type(instruction: Column) -> Column:
    return F.when(instruction.rlike("(?i)" + fixed.DEBUGGING), "debugging").when(instruction.rlike("(?i)" + fixed.ALGORITHM), "algorithm").otherwise("general")


def math_points(question: Column) -> Column:
    """Counts of numbers, terms and relations, each at most 3, and two points for length."""
    q = F.lower(question)
    count = lambda pattern: F.regexp_count(q, F.lit(pattern))
    return (
        F.least(F.lit(3), F.floor(count(fixed.MATH_NUMBER) / 3)) + F.least(F.lit(3), count(fixed.MATH_TERM)) + F.least(F.lit(3), count(fixed.MATH_RELATION))
        + F.when(F.length(q) > 180, 1).otherwise(0) + F.when(F.length(q) > 320, 1).otherwise(0)
    ).cast("long")


def math_difficulty(question: Column) -> Column:
    points = math_points(question)
    return F.when(points <= 1, "easy").when(points <= 4, "medium").otherwise("medium_hard")
