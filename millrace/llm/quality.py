"""Quality scores by compression with two trained zstandard dictionaries.

One dictionary is built from text labelled good, one from text labelled bad.
A text is compressed piece by piece with both; the difference of the sizes,
normalised by the text's length, says which kind it resembles, and a logistic
calibration turns that one number into a probability.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows per class that the model is fitted on, at most.
SAMPLE = 3000
#: Pieces of a sampled text that go into a dictionary, at most (a long text's are drawn by hash over all of it).
PIECES = 16
PIECE = 512
DICTIONARY = 112 << 10
LEVEL = 3
#: Difference in bytes per byte beyond which more of it counts less.
BEND = 0.03


def held_out(id_col: Column) -> Column:
    """True for ids whose crc32 (as text) leaves 2 modulo 4; false for null."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    good: bytes
    bad: bytes
    center: np.ndarray
    scale: np.ndarray
    weight: np.ndarray

    def compressors(self):
        kind = {"level": LEVEL, "write_content_size": False, "write_dict_id": False, "write_checksum": False}
        return [zstandard.ZstdCompressor(**kind, dict_data=zstandard.ZstdCompressionDict(d)) if d else zstandard.ZstdCompressor(**kind) for d in (self.good, self.bad)]

    def score(self, difference: np.ndarray) -> np.ndarray:
        z = (design(difference) - self.center) / self.scale @ self.weight
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def difference(text: bytes, good, bad) -> float:
    """Compressed sizes of all pieces under good less under bad, per byte of text; 0 for an empty one."""
    if not text:
        return 0.0
    pieces = [text[i : i + PIECE] for i in range(0, len(text), PIECE)]
    return sum(len(good.compress(p)) - len(bad.compress(p)) for p in pieces) / len(text)


def design(d: np.ndarray) -> np.ndarray:
    """The difference on a scale that is linear up to ``BEND`` and logarithmic beyond, so that extreme texts do not rule the fit."""
    return np.column_stack([np.ones(len(d)), np.arcsinh(d / BEND)])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4):
    """(center, scale, coefficients) of a weighted ridge logistic regression.

    Newton steps, halved until the loss falls.
    """
    center, scale = x.mean(0), x.std(0)
    center[0], scale[0] = 0, 1
    scale[scale == 0] = 1
    z, share = (x - center) / scale, weight / weight.sum()

    def loss(w):
        return share @ np.logaddexp(0, np.where(y > 0, -1, 1) * (z @ w)) + ridge / 2 * w @ w

    w, now = np.zeros(z.shape[1]), np.log(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) * share)[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ ((p - y) * share) + ridge * w)
        rate = 1.0
        while rate > 1e-6 and loss(w - rate * step) > now:
            rate /= 2
        w = w - rate * step
        if (after := loss(w)) > now - 1e-12:
            break
        now = after
    return center, scale, w


def _dictionary(pieces: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:  # too few pieces to train on: they serve as they are
        return b"".join(pieces)[-DICTIONARY:]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", pieces: int = PIECES) -> Model:
    """Fit on at most ``sample`` labelled rows of each class that are not held out.

    Rows are drawn by a hash of their id: two thirds build the dictionaries, one
    third calibrates, weighted by how often each class occurs among all labels.
    Of a text at most ``pieces`` pieces go into a dictionary. Ids labelled twice
    with different values, null labels and null ids are left out. Without both
    classes the score is the share of label 1 (one half without any label).
    """
    known = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").select("id", "y")
    )
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    drawn = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample) for y in (0, 1)]
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))  # at most 2 x sample pairs of numbers
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t")).join(chosen, "id")

    calibrates = lambda i: zlib.crc32(b"x%d" % i) % 3 == 0

    def cut(batches):
        for rows in batches:
            out = []
            for i, y, t in zip(*(rows.column(c).to_pylist() for c in ("id", "y", "t"))):
                if calibrates(i):
                    continue
                starts = range(0, max(1, len(t)), PIECE)
                if len(starts) > pieces:
                    starts = sorted(sorted(starts, key=lambda s: zlib.crc32(f"{i}:{s}".encode()))[:pieces])
                out += [(i, y, t[s : s + PIECE]) for s in starts if t[s : s + PIECE]]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.binary()))], names=["id", "y", "p"])

    drawn = sorted((zlib.crc32(bytes(r.p)), r.y, bytes(r.p)) for r in texts.mapInArrow(cut, "id long, y int, p binary").collect())
    by = {y: [p for _, z, p in drawn if z == y] for y in (0, 1)}
    if not by[0] or not by[1]:
        share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
        return Model(b"", b"", np.zeros(2), np.ones(2), np.array([np.log((share + 1e-3) / (1 - share + 1e-3)), 0.0]))
    model = Model(_dictionary(by[1]), _dictionary(by[0]), None, None, None)

    def measure(batches):
        good, bad = model.compressors()
        for rows in batches:
            own = [(i, y, difference(t, good, bad)) for i, y, t in zip(*(rows.column(c).to_pylist() for c in ("id", "y", "t"))) if calibrates(i)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in own], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.float64()))], names=["id", "y", "d"])

    seen = sorted((r.id, r.y, r.d) for r in texts.mapInArrow(measure, "id long, y int, d double").collect())
    table = np.array(seen, float).reshape(-1, 3)
    y = table[:, 1]
    if not 0 < y.sum() < len(y):  # too few rows to calibrate: the mean difference decides
        model.center, model.scale, model.weight = np.zeros(2), np.ones(2), np.array([0.0, -2.0])
        return model
    weight = np.where(y == 1, counts[1] / y.sum(), counts[0] / (len(y) - y.sum()))
    model.center, model.scale, model.weight = logistic(design(table[:, 2]), y, weight)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """The rows with a double column ``out``: the calibrated probability of label 1.

    Only the text counts; a null text scores as an empty one. All rows and
    other columns are kept; ``out`` replaces a column of that name.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType

    kept = [c for c in docs.columns if c != out]
    docs = docs.select(*kept)
    at = kept.index(text_col)
    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])

    def run(batches):
        good, bad = model.compressors()
        for rows in batches:
            d = np.array([difference(t, good, bad) for t in rows.column(at).cast(pa.binary()).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(model.score(d))], names=[*kept, out])

    return docs.mapInArrow(run, schema)
