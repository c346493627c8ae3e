"""The Hamming join against brute force, with hot groups dealt by blocks; signatures and image hashes."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.images import phash, phash64, phashes, vector_signature
from millrace.operators import dedup as D
from millrace.operators import similarity as S

ALL = (1 << 64) - 1


def planted():
    """id -> hash: families within six bits of one another, and many hashes that share most bands."""
    draw, out = random.Random(3), []
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(25):
            x = base
            for _ in range(draw.randrange(7)):
                x ^= 1 << draw.randrange(64)
            out.append(x)
    out += [draw.getrandbits(9) for _ in range(120)]
    return dict(enumerate(out))


def brute(hashes):
    first = {}
    for i, h in hashes.items():
        first[h] = min(i, first.get(h, i))
    rows = sorted((i, h) for h, i in first.items())
    return rows, sorted((a, b, (x ^ y).bit_count()) for k, (a, x) in enumerate(rows) for b, y in rows[k + 1 :] if (x ^ y).bit_count() <= 6)


@pytest.mark.parametrize("few", [1, 7, 100_000])
def test_near_meets_every_pair_once(few):
    rows, want = brute(planted())
    h = np.array([x for _, x in rows], dtype=np.uint64)
    got = [tuple(sorted((rows[a][0], rows[b][0]))) for i, j in S._near(h, 6, ALL, few) for a, b in zip(i, j)]
    assert sorted(got) == [(a, b) for a, b, _ in want]


@pytest.mark.parametrize("few", [100, 100_000])
def test_near_walks_no_long_run_of_a_family(few, monkeypatch):
    """A family of near copies took as many steps as its longest run has hashes, times the choices of bands."""
    h = np.unique(np.array([sum(1 << p for p in some) for k in range(4) for some in itertools.combinations(range(0, 64, 4), k)], np.uint64))
    h = np.unique(np.concatenate([h, np.random.default_rng(2).integers(0, 1 << 63, 300, np.uint64)]))
    steps, count = [0], np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: [count(x), steps.__setitem__(0, steps[0] + 1)][0])
    got = sorted((min(a, b), max(a, b)) for i, j in S._near(h, 6, ALL, few) for a, b in zip(i.tolist(), j.tolist()))
    a, b = np.nonzero(count(h[:, None] ^ h[None, :]) <= 6)
    assert got == sorted(zip(a[a < b].tolist(), b[a < b].tolist()))
    assert steps[0] < 28 * 64


@pytest.mark.parametrize("more,most", [(None, S.HOT), (None, 30), (2, 30)])
def test_hamming_links_are_those_of_brute_force(spark, more, most):
    hashes = planted()
    df = spark.createDataFrame([(i, h - (1 << 64) if h >> 63 else h) for i, h in hashes.items()] + [(-5, None)], "id long, h long")
    assert sorted(map(tuple, S.hamming_links(df, "id", "h", 6, more, most).collect())) == brute(hashes)[1]


def test_a_signature_sorts_its_vector_once(spark):
    told = str(vector_signature(F.col("e")))
    assert told.index("array_sort") < told.index("aggregate") and told.count("array_sort") == 1
    draw = random.Random(1)
    rows = [[draw.random() for _ in range(64)] for _ in range(5)] + [[1.0] * 64]
    got = [r[0] & ALL for r in spark.createDataFrame([(e,) for e in rows], "e array<double>").select(vector_signature(F.col("e"))).collect()]
    assert got == [sum((x > sorted(e[1:])[31]) << (63 - k) for k, x in enumerate(e)) for e in rows]


def test_images_of_a_batch_are_hashed_as_each_alone(spark):
    draw = np.random.default_rng(4)
    images = [draw.integers(0, 256, (side, side), dtype=np.uint8) for side in (32, 8, 32, 16, 8, 32)]
    raw = [(k, bytearray(x.tobytes())) for k, x in enumerate(images)] + [(6, None), (7, bytearray()), (8, bytearray(b"x" * 63)), (9, bytearray(b"x" * 9))]
    got = dict(spark.createDataFrame(raw, "k int, raw binary").coalesce(1).select("k", phash64(F.col("raw"))).collect())
    assert got == {k: phash(x) for k, x in enumerate(images)} | dict.fromkeys(range(6, 10))
    same = [x for x in images if x.shape == (32, 32)]
    assert phashes(np.stack(same)).tolist() == [phash(x) for x in same]


def greedy(hashes):
    led, out = [], {}
    for i, h in sorted(hashes.items()):
        out[i] = i if h is None else next((k for k, x in led if (x ^ h).bit_count() <= 6), i)
        if out[i] == i and h is not None:
            led.append((i, h))
    return out


@pytest.mark.parametrize("rest", [0, 40, D.REST])
def test_leaders_are_those_of_a_scan_in_order(spark, rest):
    hashes = planted() | {1000 + k: (1 << k) - 1 for k in range(0, 64, 5)} | {-5: None, 2000: None, 2001: 0}
    df = spark.createDataFrame([(i, h if h is None or h < 1 << 63 else h - (1 << 64)) for i, h in hashes.items()], "id long, h long")
    assert dict(map(tuple, D.leaders(df, "id", "h", 6, rest).collect())) == greedy(hashes)


def test_later_rounds_read_only_open_links(spark, monkeypatch):
    """A chain of 60 decisions took a round of jobs over all links for every second row; the rest is settled at once."""
    cuts, cut = [0], D.cut
    monkeypatch.setattr(D, "cut", lambda df: [cut(df), cuts.__setitem__(0, cuts[0] + 1)][0])
    hashes = {k: sum(1 << p % 64 for p in range(3 * k, 3 * k + 16)) for k in range(60)}
    df = spark.createDataFrame([(i, h - (1 << 64) if h >> 63 else h) for i, h in hashes.items()], "id long, h long")
    assert dict(map(tuple, D.leaders(df, "id", "h", 6).collect())) == greedy(hashes)
    assert cuts[0] <= 5
