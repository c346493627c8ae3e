"""Language identification with error-correcting output codes.

Every language gets a codeword; one binary classifier per bit, naive Bayes over
hashed byte trigrams, predicts whether a text belongs to the languages with
that bit set. Loss-weighted decoding chooses the codeword with the least sum of
bit losses, each weighted by how reliable its classifier is.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.quality import held_out

BUCKETS = 1 << 14
#: Texts per language that the classifiers are fitted on, about.
SAMPLE = 2000
#: Bits of the code for more languages than the exhaustive code serves.
BITS = 48
#: A letter is a character of Unicode category L.
_LETTER = regex.compile(r"\p{L}")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32


def trigrams(text: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams, lower-cased in ASCII, spaces at the ends."""
    b = _LOWER[np.frombuffer(b" " + text + b" ", np.uint8)].astype(np.uint32)
    h = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
    return np.bincount(h >> np.uint32(18), minlength=BUCKETS)


def codewords(k: int) -> np.ndarray:
    """k codewords of -1 and +1: all splits for few languages, spread ones for many."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 6:
        rows = [(1, *bits) for bits in itertools.product((-1, 1), repeat=k - 1) if -1 in bits]
        return np.array(rows, float).T
    best, rng = None, np.random.default_rng(7)
    for _ in range(200):
        m = np.where(rng.random((k, BITS)) < 0.5, -1.0, 1.0)
        if (np.abs(m.sum(0)) == k).any():
            continue
        apart = ((BITS - m @ m.T) / 2 + BITS * np.eye(k)).min()
        if best is None or apart > best[0]:
            best = apart, m
    return best[1]


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weight: np.ndarray  # BUCKETS x bits, log-odds
    scale: np.ndarray  # per bit, of the mean log-odds
    trust: np.ndarray  # per bit

    def margins(self, text: bytes) -> np.ndarray:
        n = trigrams(text)
        at = np.flatnonzero(n)
        return n[at] @ self.weight[at] / n.sum() / self.scale

    def decode(self, margins: np.ndarray) -> tuple[int, float, bool]:
        """(language, score, ambiguous): least weighted logistic loss."""
        loss = np.logaddexp(0, -4 * self.code * margins) @ self.trust
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        best = int(np.argmin(loss))
        rest = np.delete(loss, best)
        return best, float(p[best]), bool(len(rest) and rest.min() - loss[best] < 0.5)


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on about ``sample`` texts of each language that are not held out.

    Rows are drawn by a hash of their id, at a rate set by the language's count;
    the driver receives one row of trigram counts per language. Null texts,
    languages and ids are left out.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("t")).where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("t").isNotNull() & ~held_out(F.col("id")))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.ones((0, 1)), np.zeros((BUCKETS, 1)), np.ones(1), np.ones(1))
    rate = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, sample / counts[lang]))])
    drawn = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20) < F.element_at(rate, F.col("lang")))

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, t in zip(batch.column("lang").to_pylist(), batch.column("t").to_pylist()):
                total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                total[lang] += trigrams(t)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["lang", "n"])

    def add(key, table):
        return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "n": pa.array([sum(np.frombuffer(x.as_py(), np.int64) for x in table["n"]).tobytes()], pa.binary())})

    total = {r.lang: np.frombuffer(bytes(r.n), np.int64) for r in drawn.mapInArrow(count, "lang string, n binary").groupBy("lang").applyInArrow(add, "lang string, n binary").collect()}
    langs = sorted(total)
    p = np.array([(total[lang] + 0.5) / (total[lang].sum() + 0.5 * BUCKETS) for lang in langs])
    code = codewords(len(langs))
    weight = np.zeros((BUCKETS, code.shape[1]))
    for j in range(code.shape[1]):
        one, none = p[code[:, j] > 0], p[code[:, j] < 0]
        if len(one) and len(none):
            weight[:, j] = np.log(one.mean(0)) - np.log(none.mean(0))
    expected = p @ weight  # mean log-odds of each language's own text
    scale = np.maximum(np.abs(expected).mean(0), 1e-9)
    trust = np.clip((code * expected / scale).min(0), 0.05, 1.0)
    return Model(langs, code, weight, scale, trust / trust.sum() * min(8, code.shape[1]))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, ambiguous) for every row, from the whole text alone.

    A text that is null or has no letter (Unicode category L) is ``und`` with score 0, as is every
    text when nothing could be learned. Ids null or repeated are kept as they
    come; other columns are ignored.
    """

    def run(batches):
        for rows in batches:
            out = []
            for t in rows.column(1).to_pylist():
                if t is None or not model.langs or not _LETTER.search(t.decode("utf-8", "replace")):
                    out.append(("und", 0.0, True))
                else:
                    best, p, doubt = model.decode(model.margins(t))
                    out.append((model.langs[best], p, doubt))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.bool_())], names=["id", "lang_pred", "score", "ambiguous"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"id {kind}, lang_pred string, score double, ambiguous boolean")

