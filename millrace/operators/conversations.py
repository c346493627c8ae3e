"""Conversation sources: folded rows, JSON columns, roles, messages, ids, token reports."""

from __future__ import annotations

import hashlib
import json
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.actions import arrow_function
from millrace.functions.text import code_language, problem_type, repetitive, strip

MESSAGE = "struct<role:string,content:string>"


def unfolded(df: DataFrame, folded: str, out: str = "member") -> DataFrame:
    """One row for each member of a JSON list of objects, as JSON text in ``out``.

    A row without a list stays, with a null member; a malformed list gives no rows.
    """
    members = F.coalesce(F.from_json(folded, "array<string>"), F.array().cast("array<string>"))
    told = F.coalesce(F.col(folded), F.lit("")) != ""
    return df.withColumn(out, F.explode(F.when(told, members).otherwise(F.array(F.lit(None).cast("string")))))


def json_list(text: Column, element: str = MESSAGE) -> Column:
    """The elements of a JSON list; malformed or missing text has none."""
    return F.coalesce(F.from_json(text, f"array<{element}>"), F.array().cast(f"array<{element}>"))


def json_map(text: Column) -> Column:
    """The members of a JSON object as text; malformed or missing text has none."""
    return F.coalesce(F.from_json(text, "map<string,string>"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def _message(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def remapped(turns: Column, note: Column) -> Column:
    """Messages of turns array<(speaker, value)>, with a note for the system; null without an assistant.

    Tools speak as the user, marked as responses; blank turns go. The note ends
    the first system message, or becomes one.
    """
    def message(t: Column) -> Column:
        speaker, said = F.lower(F.coalesce(t["speaker"], F.lit(""))), strip(F.coalesce(t["value"], F.lit("")))
        role = F.lit("assistant")
        for name, speakers in fixed.SPEAKERS.items():
            role = F.when(speaker.isin(*speakers), name).otherwise(role)
        return _message(role, F.when(said != "", F.concat(F.when(speaker.isin(*fixed.TOOL_SPEAKERS), fixed.TOOL_RESPONSE).otherwise(""), said)))

    all_ = F.filter(F.transform(turns, message), lambda m: m["content"].isNotNull())
    first = F.get(all_, 0)
    opened = F.when(first["role"] == "system", F.concat(F.array(_message(F.lit("system"), F.concat(first["content"], F.lit("\n"), note))), F.slice(all_, 2, F.greatest(F.size(all_), F.lit(1)))))
    return F.when(F.exists(all_, lambda m: m["role"] == "assistant"), opened.otherwise(F.concat(F.array(_message(F.lit("system"), note)), all_)))


def converted(messages: Column) -> Column:
    """Messages of known roles that say something; a missing role is the user's."""
    plain = F.transform(messages, lambda m: _message(F.coalesce(m["role"], F.lit("user")), F.coalesce(m["content"], F.lit(""))))
    return F.filter(plain, lambda m: m["role"].isin("system", "user", "assistant") & (strip(m["content"]) != ""))


def question_messages(pairs: Column, pictured: Column) -> Column:
    """Messages of array<(question, answer)>: pairs that lack one go, and the first pair carries the picture."""
    def turn(p: Column, i: Column) -> Column:
        q, a = strip(F.coalesce(p["question"], F.lit(""))), strip(F.coalesce(p["answer"], F.lit("")))
        asked = F.concat(F.when((i == 0) & pictured, "<image>\n").otherwise(""), q)
        return F.when((q != "") & (a != ""), F.array(_message(F.lit("user"), asked), _message(F.lit("assistant"), a)))

    return F.flatten(F.filter(F.transform(pairs, turn), lambda x: x.isNotNull()))


def sample_id(given: Column, other: Column, messages: Column) -> Column:
    """An id that is given, else the head of the SHA-256 of the messages' JSON with sorted keys and spaced separators."""
    def digest(found):
        plain = [{"role": m["role"], "content": m["content"]} for m in found or []]
        return hashlib.sha256(json.dumps(plain, sort_keys=True).encode()).hexdigest()[:16]

    real = lambda c: F.when(c != "", c)
    return F.coalesce(real(given), real(other), arrow_function("string", digest, messages))


def replay_id(dataset: Column, source: Column, index: Column) -> Column:
    return F.concat_ws("::", F.lit("replay"), dataset, source, index.cast("string"))


def pixel_digest(mode: Column, width: Column, height: Column, pixels: Column) -> Column:
    """SHA-256 of mode, size and pixel bytes, whatever the file was called."""
    head = F.concat(mode, F.lit(":"), width.cast("string"), F.lit("x"), height.cast("string"), F.lit("\0"))
    return F.sha2(F.concat(head.cast("binary"), pixels), 256)


def coding_verdict(instruction: Column, response: Column, syntax: Column) -> Column:
    """(reason, language, problem) of a coding answer: the first reason to reject it, null when it passes.

    ``syntax`` is the result of ``validators.code_syntax``; a null one fails Python answers.
    """
    low = F.lower(strip(response))
    fences = F.size(F.split(response, "```")) - 1
    rules = {
        "too_short": (F.length(strip(instruction)) < 20) | (F.length(strip(response)) < 40),
        "placeholder": low.isin(*fixed.PLACEHOLDER_ANSWERS) | F.exists(F.array(*map(F.lit, fixed.PLACEHOLDER_PARTS)), lambda p: F.contains(low, p)),
        "open_fence": fences % 2 == 1, "repetitive": repetitive(response),
        "invalid_syntax": (code_language(instruction, response) == "python") & syntax.isNull(),
    }
    reason = F.coalesce(*[F.when(rule, name) for name, rule in rules.items()])
    return F.struct(reason.alias("reason"), code_language(instruction, response).alias("language"), problem_type(instruction).alias("problem"))


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def exact_tokens(text: Column, tokenizer: str) -> Column:
    """Tokens of a text by a tokenizers JSON file, without special tokens; a null text has none."""
    return arrow_function("bigint", lambda t: len(_tokenizer(tokenizer).encode(t or "", add_special_tokens=False).ids), text)


def loss_gate(report: DataFrame, most: float = 0.20, exempt: tuple[str, ...] = ("action", "grounding")) -> DataFrame:
    """One row: the task types whose share of learned tokens exceeds ``most``, and whether there are none."""
    over = (F.col("axis") == "task_type") & ~F.col("key").isin(*exempt) & (F.round("share", 6) > most)
    found = report.agg(F.array_sort(F.collect_set(F.when(over, F.col("key")))).alias("violations"))
    return found.select("violations", (F.size("violations") == 0).alias("passed"))
