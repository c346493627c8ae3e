"""Benchmark decontamination with spaced seeds.

Texts become sequences of lower-cased words. A spaced seed is a fixed mask
over consecutive words that ignores some of them, so its hash survives a
substitution there. Seed hashes of the texts are joined with those of the
benchmark items, and round each hit the two sequences are aligned word by word:
an overlap counts when at least ``similarity`` of its words agree and it spans
``least`` words, or the whole item when that is shorter.

Of an overlap that the default thresholds admit, one of the two masks below finds
an untouched seed, wherever the substitutions fall: the tests try all of them for
13 to 25 words, and a longer overlap holds one of such a length that counts too.
Items of 8 to 12 words use runs of 3 words, and shorter items must occur whole;
items of fewer than ``shortest`` words (5) are no evidence and never match.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.secretscan import _blocks, column_bytes

MASK = (0, 1, 3, 6, 7)
#: The first meets every 13 words with 2 substitutions; the second what it misses with more.
MASKS = (MASK, (0, 2, 8, 10, 11))
RUN = (0, 1, 2)
LEAST, SIMILARITY = 13, 0.8
#: Words of an item below which it is no evidence.
SHORTEST = 5
#: Benchmark text broadcast together, in bytes; more items are scanned in further blocks.
BLOCK = 4 << 20
#: Text searched together, in bytes; a longer text is searched alone, whole.
TOGETHER = 1 << 20
#: Meetings of a text's seed with an item's that are held at once, about.
SEEDS = 1 << 20

_WORD = np.zeros(256, bool)
_WORD[[*b"abcdefghijklmnopqrstuvwxyz0123456789"]] = True
_WORD[128:] = True
_POWER = np.multiply.accumulate(np.full(1024, 0x9E3779B97F4A7C15, np.uint64))


def lowered(column: pa.Array) -> pa.Array:
    """Lower case, character by character, of texts and items alike; what is no UTF-8 becomes U+FFFD first."""
    try:
        text = column.cast(pa.string())
    except pa.ArrowInvalid:
        text = pa.array([None if t is None else t.decode("utf-8", "replace") for t in column.cast(pa.binary()).to_pylist()], pa.string())
    return pc.utf8_lower(text).cast(pa.binary())


def words(data: np.ndarray, bounds: np.ndarray):
    """(hash, text number) of the words of joined lower-cased texts."""
    w = _WORD[data]
    before = np.concatenate([[False], w[:-1]])
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    start = np.flatnonzero(w & ~before)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(w)
    first = np.flatnonzero((w & ~before)[at])  # of each word, among word bytes
    size = np.diff(np.append(first, len(at)))
    inside = np.arange(len(at)) - np.repeat(first, size)
    h = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * _POWER[inside & 1023], first)
    h ^= size.astype(np.uint64) << np.uint64(56)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(29), np.searchsorted(bounds, start, "right") - 1


def seeds(h: np.ndarray, mask) -> np.ndarray:
    """Hash of the masked words from every position that has room."""
    n = len(h) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(mask), np.uint64)
    for k in mask:
        out = (out ^ h[k : k + n]) * np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(32)
    return out


def overlap(a: np.ndarray, b: np.ndarray, similarity: float) -> tuple[int, int]:
    """(length, matches) of the longest stretch with enough equal places."""
    equal = a == b
    p = np.concatenate([[0.0], np.cumsum(np.where(equal, 1 - similarity, -similarity))])
    low = np.minimum.accumulate(p)  # falling: the first i with p[i] <= p[j]
    i = np.searchsorted(-low, -(p + 1e-9))
    j = int(np.argmax(np.arange(len(p)) - i))
    return j - int(i[j]), int(equal[i[j] : j].sum())


@dataclass
class Index:
    """Seeds of one block of benchmark items."""

    ids: list
    item: list[np.ndarray]
    masks: tuple
    keys: list[np.ndarray]  # per mask, sorted
    where: list[np.ndarray]  # per mask: (item, position) rows of the keys
    quick: list[np.ndarray]

    @staticmethod
    def build(rows: list[tuple[int, bytes]], least: int = LEAST, shortest: int = SHORTEST) -> "Index":
        ids = [i for i, _ in rows]
        item = [words(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for _, t in rows]
        by: dict[tuple, list[tuple[np.ndarray, int]]] = {}
        for k, h in enumerate(item):
            if len(h) >= max(1, shortest):
                for mask in MASKS if len(h) >= least else (RUN if len(h) >= 8 else tuple(range(len(h))),):
                    by.setdefault(mask, []).append((seeds(h, mask), k))
        keys, where, quick = [], [], []
        for found in by.values():
            key = np.concatenate([s for s, _ in found])
            at = np.concatenate([np.column_stack([np.full(len(s), k), np.arange(len(s))]) for s, k in found])
            order = np.argsort(key, kind="stable")
            keys.append(key[order])
            where.append(at[order])
            table = np.zeros(1 << 22, bool)
            table[(key >> np.uint64(42)).astype(np.int64)] = True
            quick.append(table)
        return Index(ids, item, tuple(by), keys, where, quick)

    def search(self, data: np.ndarray, bounds: np.ndarray, least: int, similarity: float):
        """(text number, item number, length, matches): the longest overlap of each pair."""
        h, doc = words(data, bounds)
        if not len(h) or not self.masks:
            return []
        first = np.searchsorted(doc, np.arange(len(bounds) - 1))
        last = np.searchsorted(doc, np.arange(len(bounds) - 1), "right")
        seen = []
        for mask, keys, where, quick in zip(self.masks, self.keys, self.where, self.quick):
            s = seeds(h, mask)
            at = np.flatnonzero(quick[(s >> np.uint64(42)).astype(np.int64)])
            lo, hi = np.searchsorted(keys, s[at]), np.searchsorted(keys, s[at], "right")
            at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            edge = np.cumsum(n)
            cut = np.unique(np.append(np.searchsorted(edge, np.arange(SEEDS, edge[-1], SEEDS)), len(n))) if len(n) else []
            for a, b in zip([0, *cut[:-1]], cut):  # seeds met together, about SEEDS at a time
                many = n[a:b]
                row = np.repeat(at[a:b], many)
                k = np.repeat(lo[a:b] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                seen.append(np.unique(np.column_stack([doc[row], where[k, 0], row - where[k, 1]]), axis=0))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for d, k, shift in np.unique(np.concatenate([np.zeros((0, 3), np.int64), *seen]), axis=0).tolist():
            item = self.item[k]
            lo, hi = max(shift, int(first[d])), min(shift + len(item), int(last[d]))
            if hi - lo < min(least, len(item)):
                continue
            found = overlap(h[lo:hi], item[lo - shift : hi - shift], similarity if len(item) >= 8 else 1.0)
            if found[0] >= min(least, len(item)) and found > best.get((d, k), (0, 0)):
                best[d, k] = found
        return [(d, k, *v) for (d, k), v in sorted(best.items())]


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block: int | None = None, least: int = LEAST, shortest: int = SHORTEST):
    """Indexes over the benchmark, each of about ``block`` (else ``BLOCK``) bytes of text."""
    rows: list[tuple[int, bytes]] = []
    held = 0
    for r in benchmark.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t")).toLocalIterator():
        rows.append((r.i, lowered(pa.array([bytes(r.t)], pa.binary()))[0].as_py()))
        held += len(r.t)
        if held >= (block or BLOCK):
            yield Index.build(rows, least, shortest)
            rows, held = [], 0
    if rows:
        yield Index.build(rows, least, shortest)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, similarity: float = SIMILARITY, shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, item_id, overlap_words, matched_words) per leaked pair.

    One row for each text and item that overlap, with their longest overlap.
    Null and empty texts match nothing; repeated rows and null ids are reported
    as they come; texts of any length are searched whole; other columns are
    ignored. Without items, or without texts, the result is empty.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, overlap_words int, matched_words int"
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    out = None
    for index in benchmark_blocks(benchmark, least=least, shortest=shortest):

        def run(batches, index=index):
            for big in batches:
                for rows in _blocks(big.set_column(1, "t", big.column(1).cast(pa.binary())), 1, TOGETHER):
                    found = index.search(*column_bytes(lowered(rows.column(1))), least, similarity)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0).take(pa.array([x[0] for x in found], pa.int64())), pa.array([index.ids[x[1]] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int32()), pa.array([x[3] for x in found], pa.int32())],
                        names=["doc_id", "item_id", "overlap_words", "matched_words"],
                    )

        part = texts.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", least: int = LEAST, similarity: float = SIMILARITY, shortest: int = SHORTEST) -> DataFrame:
    """The rows whose text overlaps no benchmark item, all columns kept."""
    at = docs.columns.index(text_col)
    for index in benchmark_blocks(benchmark, least=least, shortest=shortest):

        def run(batches, index=index):
            for big in batches:
                for rows in _blocks(big.set_column(at, text_col, big.column(at).cast(pa.binary())), at, TOGETHER):
                    found = index.search(*column_bytes(lowered(rows.column(at))), least, similarity)
                    keep = np.ones(len(rows), bool)
                    keep[[x[0] for x in found]] = False
                    yield rows.filter(pa.array(keep)).set_column(at, text_col, rows.column(at).filter(pa.array(keep)).cast(pa.string()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
