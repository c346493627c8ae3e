"""Secret scanning through a trigram inverted index.

Each rule's regular expression is parsed into a Boolean query over the
trigrams that every match must hold. Per block of texts, an inverted index
maps the queried trigrams to the texts that hold them; postings are
intersected and united by the query, and only candidates are verified with
the expression itself. A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

import hashlib
import re
import re._constants as sre
import re._parser as parser
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    ignore_case: bool = False

    def spans(self, text: str):
        for m in _compiled(self).finditer(text):
            if m.end(self.group) - m.start(self.group) >= self.least:
                yield m.start(), m.end()


@cache
def _compiled(rule: Rule) -> re.Pattern:
    return re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.ignore_case else 0))


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{20,}"),
    Rule("chatapp", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("webtoken", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + EXTRA

#: Query forms: True, a trigram, ("and", *queries) or ("or", *queries).
Query = object


def trigram_query(pattern: str) -> Query:
    """Boolean trigram query, in lower case, that any text with a match satisfies."""
    return _of(parser.parse(pattern))


def _grams(words: set[str]) -> Query:
    if not words or min(map(len, words)) < 3:
        return True
    return _join("or", [_join("and", [w[i : i + 3] for i in range(len(w) - 2)]) for w in sorted(words)])


def _join(kind: str, parts: list) -> Query:
    parts = list(dict.fromkeys(parts))
    if kind == "and":
        parts = [p for p in parts if p is not True]
        return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _exact(item) -> set[str] | None:
    """The few strings that a parsed item can match, or None."""
    op, arg = item
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN:
        if all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
            return {chr(a).lower() for _, a in arg}
        return None
    if op is sre.SUBPATTERN:
        return _product(arg[3])
    if op is sre.BRANCH:
        parts = [_product(x) for x in arg[1]]
        return set().union(*parts) if all(p is not None for p in parts) else None
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[:2] == (0, 1):
        part = _product(arg[2])
        return part | {""} if part is not None else None
    return None


def _product(items) -> set[str] | None:
    found = {""}
    for item in items:
        part = _exact(item)
        if part is None or len(found) * len(part) > 64:
            return None
        found = {a + b for a in found for b in part}
    return found


def _of(items) -> Query:
    parts, run = [], {""}
    for item in items:
        part = _exact(item)
        if part is not None and len(run) * len(part) <= 64:
            run = {a + b for a in run for b in part}
            continue
        parts.append(_grams(run))
        run = {""}
        op, arg = item
        if op is sre.SUBPATTERN:
            parts.append(_of(arg[3]))
        elif op is sre.BRANCH:
            parts.append(_join("or", [_of(x) for x in arg[1]]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
            parts.append(_of(list(arg[2]) * min(arg[0], 3)))
    return _join("and", parts + [_grams(run)])


def _terms(query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(_terms, query[1:]))


@cache
def _plan(rules: tuple[Rule, ...]):
    queries = [trigram_query(r.pattern) for r in rules]
    terms = sorted(t for t in set().union(*map(_terms, queries)) if t.isascii())
    table = np.zeros(1 << 24, np.uint8)
    for i, t in enumerate(terms):
        a, b, c = t.encode()
        table[a << 16 | b << 8 | c] = i + 1
    assert len(terms) < 255
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return queries, terms, table, lower


def _postings(data: np.ndarray, bounds: np.ndarray, rules: tuple[Rule, ...]) -> dict[str, np.ndarray]:
    """term -> mask of the texts of a block that hold it."""
    _, terms, table, lower = _plan(rules)
    n = len(bounds) - 1
    post = {t: np.zeros(n, bool) for t in terms}
    for at in range(0, max(0, len(data) - 2), 1 << 20):
        low = lower[data[at : at + (1 << 20) + 2]].astype(np.uint32)
        term = table[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
        hit = np.flatnonzero(term)
        doc = np.searchsorted(bounds, hit + at, "right") - 1
        inside = hit + at + 3 <= bounds[doc + 1]
        for k in np.unique(pairs := (term[hit[inside]].astype(np.int64) - 1) * n + doc[inside]) if len(hit) else ():
            post[terms[k // n]][k % n] = True
    return post


def _evaluate(query, post: dict[str, np.ndarray], n: int) -> np.ndarray:
    if query is True:
        return np.ones(n, bool)
    if isinstance(query, str):
        return post.get(query, np.ones(n, bool))
    parts = [_evaluate(q, post, n) for q in query[1:]]
    return (np.logical_and if query[0] == "and" else np.logical_or).reduce(parts)


_HEX = np.zeros(256, bool)
_HEX[[*b"0123456789abcdef"]] = True


def _hex_texts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Texts that may hold 24 hex digits in a row: 24 cover two neighbouring multiples of 12."""
    found = np.zeros(len(bounds) - 1, bool)
    at = np.arange(0, max(0, len(data) - 12), 12)
    for k in (0, 12, 6, 3, 9, 1, 2, 4, 5, 7, 8, 10, 11):
        at = at[_HEX[data[at + k]]]
    found[np.searchsorted(bounds, at, "right") - 1] = True
    return found


def scan_block(data: np.ndarray, bounds: np.ndarray, rules: tuple[Rule, ...] = RULES) -> dict[int, list[tuple[int, int, int]]]:
    """text number -> sorted (start, rule number, end) in code points."""
    n = len(bounds) - 1
    post = _postings(data, bounds, rules)
    found: dict[int, list[tuple[int, int, int]]] = {}
    texts: dict[int, str] = {}
    for k, (rule, query) in enumerate(zip(rules, _plan(rules)[0])):
        if query is True and rule.pattern == r"[0-9a-f]+" and rule.least >= 24:
            mask = _hex_texts(data, bounds)  # a full scan of the bytes, in columns
        else:
            mask = _evaluate(query, post, n)
        for i in np.flatnonzero(mask).tolist():
            if i not in texts:
                texts[i] = data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace")
            spans = [(s, k, e) for s, e in rule.spans(texts[i])]
            if spans:
                found.setdefault(i, []).extend(spans)
    return {i: sorted(x) for i, x in found.items()}


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Joined bytes and bounds of a binary column; a null is empty."""
    column = column.fill_null(b"")
    raw = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[raw[0] : raw[-1]], raw - raw[0]


def _blocks(rows: pa.RecordBatch, column: int, nbytes: int = 2 << 20):
    """Slices of a batch with about nbytes of text each, one text at least."""
    if not len(rows):
        return
    size = np.cumsum(np.diff(column_bytes(rows.column(column))[1]))
    cut = np.unique(np.searchsorted(size, np.arange(nbytes, size[-1], nbytes)) + 1).tolist()
    for a, b in zip([0, *cut], [*cut, len(rows)]):
        if b > a:
            yield rows.slice(a, b - a)


def find_secrets(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) per row, sorted by start, then rule order.

    Offsets are code points, end exclusive. A null or empty text has no spans;
    repeated rows and null ids are kept as they come; other columns are
    ignored; texts of any length are scanned whole.
    """

    kind_of = np.array([r.kind for r in rules])

    def run(batches):
        for big in batches:
            for rows in _blocks(big, 1):
                data, bounds = column_bytes(rows.column(1))
                found = scan_block(data, bounds, rules)
                spans = [[{"kind": str(kind_of[k]), "start": s, "end": e} for s, k, e in found.get(i, ())] for i in range(len(rows))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], names=["id", "spans"]
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact(df: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The rows with every found span replaced by ``mask``; overlapping spans merge.

    All columns are kept; a null text stays null, and a text without spans is
    unchanged. Row order within a partition is kept.
    """
    at = df.columns.index(text_col)

    def run(batches):
        for big in batches:
            for rows in _blocks(big.set_column(at, text_col, big.column(at).cast(pa.binary())), at):
                data, bounds = column_bytes(rows.column(at))
                found = scan_block(data, bounds, rules)
                text = rows.column(at).cast(pa.string())
                if found:
                    new = text.to_pylist()
                    for i, spans in found.items():
                        out, end, old = [], 0, new[i]
                        for s, _, e in spans:
                            if s >= end:
                                out += [old[end:s], mask]
                            end = max(end, e)
                        new[i] = "".join(out) + old[end:]
                    text = pa.array(new, pa.string())
                yield rows.set_column(at, text_col, text)

    return df.mapInArrow(run, df.schema)


def digest(found: DataFrame) -> DataFrame:
    """The figures of ``op10`` from ``find_secrets`` rows."""
    show = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = [r.kind for r in BASE]
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("id").alias("doc_id"), *map(count, base),
        F.sha2(F.array_join(F.transform(F.filter("spans", lambda x: x["kind"].isin(base)), show), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", show), ",").alias("spans"),
    )


def digest_text(spans: list[tuple[str, int, int]]) -> str:
    """SHA-256 of kind:start:end joined by commas (the form of base_sha256)."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
