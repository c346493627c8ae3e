"""Perceptual hashes of grey images and of vectors."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of images that are hashed together.
TOGETHER = 1 << 20


def dct_rows(n: int = 32, rows: int = 8) -> np.ndarray:
    """The first rows of the orthonormal DCT-II of n samples."""
    k, i = np.arange(rows)[:, None], np.arange(n)[None, :]
    basis = np.cos(np.pi * k * (2 * i + 1) / (2 * n)) * np.sqrt(2 / n)
    basis[0] = np.sqrt(1 / n)
    return basis


def phashes(grey: np.ndarray) -> np.ndarray:
    """64 bits of each of an array of square images, first the highest: is a low-frequency coefficient above their median without the first?"""
    basis = dct_rows(grey.shape[-1])
    low = (basis @ grey.astype(np.float64) @ basis.T).reshape(len(grey), 64)
    return np.packbits(low > np.median(low[:, 1:], axis=1, keepdims=True), axis=1).view(">i8").ravel().astype(np.int64)


def phash(grey: np.ndarray) -> int:
    """The hash of one image."""
    return int(phashes(grey[None])[0])


def phash64(content: Column) -> Column:
    """Hash of raw grey bytes of a square image; null when they are no square.

    Images of one size are hashed together, some bytes of them at a time.
    """
    @F.arrow_udf("bigint")
    def read(raw: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        out, known = np.zeros(len(raw), np.int64), np.zeros(len(raw), bool)
        for size in np.unique(sizes).tolist():
            side = math.isqrt(size)
            if side < 8 or side * side != size:
                continue
            rows = np.flatnonzero(sizes == size)
            step = max(1, TOGETHER // size)
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                grey = np.frombuffer(b"".join(raw.take(pa.array(some)).to_pylist()), np.uint8)
                out[some] = phashes(grey.reshape(-1, side, side))
            known[rows] = True
        return pa.array(out, mask=~known)

    return read(content)


def vector_signature(vector: Column) -> Column:
    """64 bits of a vector of 64: is a component above the median of all but the first?

    The median is bound to a variable; named inside the fold, it would be sorted
    out again for every component.
    """
    middle = F.get(F.array_sort(F.slice(vector, 2, 63)), 31)
    fold = lambda m: F.aggregate(vector, F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1).bitwiseOR(F.when(x > m, 1).otherwise(0)))
    return F.element_at(F.transform(F.array(middle), fold), 1)
