"""Deterministic choices: uniforms, tie-breaks and ids from hashes of strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import right_trimmed_lines, sanitize


def uniform(key: Column, digits: int = 8) -> Column:
    """A double in [0, 1] from the first hex digits of md5(key); 1.0 is possible."""
    return F.conv(F.substring(F.md5(key), 1, digits), 16, 10).cast("double") / F.lit(float(16**digits - 1))


def keep(key: Column, share: Column | float) -> Column:
    """Bernoulli draw by hash: true when the key's uniform is below ``share``."""
    return uniform(key) < share


def choice(key: Column, shares: dict[str, float]) -> Column:
    """One of the names, drawn by the key's uniform against cumulative shares."""
    u, out, total, cuts = uniform(key), F.lit(next(iter(shares))), 0.0, []
    for name, share in shares.items():
        total += share
        cuts.append((total, name))
    for cut, name in reversed(cuts):
        out = F.when(u < cut, name).otherwise(out)
    return out


def stable_tie(*parts: Column) -> Column:
    """sha256 of the parts joined by ``|``; a null part is the empty string."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def sample_key(*parts: Column) -> Column:
    return F.concat_ws("::", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def content_id(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 16)


def canonical_json(value: Column) -> Column:
    """Compact JSON of a flat map with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(value))))


def conversation_id(prefix: str, messages: Column, extra: Column | None = None) -> Column:
    """Prefix and digest of the canonical JSON of messages array<(role, content)>.

    Contents count without trailing white space on lines; ``extra`` is JSON text.
    """
    body = F.to_json(F.transform(messages, lambda m: F.struct(right_trimmed_lines(F.coalesce(m["content"], F.lit(""))).alias("content"), F.coalesce(m["role"], F.lit("")).alias("role"))))
    whole = F.concat(F.lit('{"extra":'), F.lit("{}") if extra is None else extra, F.lit(',"images":[],"messages":'), body, F.lit("}"))
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(whole, 256), 1, 24))


def artifact_name(trajectory: Column, steps: Column, suffix: str = ".webp") -> Column:
    """A readable prefix and a digest of the full ids: trajectory and array of steps."""
    whole = F.concat(F.lit("["), F.regexp_extract(F.to_json(F.array(trajectory)), r"(?s)^\[(.*)\]$", 1), F.lit(","), F.to_json(steps), F.lit("]"))
    return F.concat(sanitize(trajectory, 56), F.lit("__"), F.substring(F.sha2(whole, 256), 1, 20), F.lit(suffix))


def id_set_hash(ids: Column) -> Column:
    """sha256 of the JSON list of sorted ids (an aggregate expression)."""
    return F.sha2(F.concat(F.lit('["'), F.array_join(F.array_sort(F.collect_list(ids)), '", "'), F.lit('"]')), 256)


def split_of(group: Column, percent: float = 3.0) -> Column:
    return F.when(uniform(group, 12) < percent / 100.0, "validation").otherwise("train")


def lcg(state: Column) -> Column:
    """The next state of the linear congruential generator 1103515245 x + 12345 mod 2^31."""
    return F.pmod(state.cast("long") * 1103515245 + 12345, F.lit(1 << 31))
