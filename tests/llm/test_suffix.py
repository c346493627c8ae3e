import hashlib

import numpy as np
import pytest

from millrace.llm import suffix


def corpus():
    rng = np.random.default_rng(11)
    text = lambda n, k=4: bytes(rng.integers(97, 97 + k, n).astype(np.uint8))
    shared, other = text(300, 20), text(130, 20)
    docs = [text(500, 20), shared + text(50, 20), text(80, 20) + shared + text(70, 20) + other, b"", b"a" * 1000, b"ab" * 400, shared[:99], shared[:100], other + other + shared]
    docs += [text(2000, 1 + k % 3) for k in range(4)] + [docs[1], docs[2][:200] + b"!" + docs[2][201:], "é".encode() * 150 + shared]
    return [(i * 3, d) for i, d in enumerate(docs)]


@pytest.mark.parametrize("hot,shard,length", [(20_000, 1 << 20, 100), (2, 500, 100), (2, 500, 8), (20_000, 1 << 20, 40), (20_000, 1000, 130), (2, 1 << 20, 200), (20_000, 1 << 20, 300)])
def test_equals_brute_force(spark, hot, shard, length):
    rows = corpus()
    df = spark.createDataFrame([(i, t.decode()) for i, t in rows], "doc_id long, text string").repartition(5)
    want = suffix.brute_force(rows, length)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.digest(suffix.remove_repeats(df, length, hot=hot, shard=shard)).collect()}
    assert got == want


@pytest.mark.parametrize("parts", [1, 7])
def test_many_copies_equal_brute_force(spark, parts, monkeypatch):
    rng = np.random.default_rng(3)
    text = lambda n: bytes(rng.integers(97, 117, n).astype(np.uint8))
    base, line = text(900), text(130)
    rows = [(i, base if i % 3 else base[: 300 + i] + line + text(40)) for i in range(90)]
    df = spark.createDataFrame([(i, t.decode()) for i, t in rows], "doc_id long, text string").repartition(parts)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.digest(suffix.remove_repeats(df)).collect()}
    assert got == suffix.brute_force(rows)


def test_a_copy_is_covered_by_comparison_only():
    """Fragments that agree in their hashes but not in their bytes lose nothing."""
    a, b = (bytes(np.random.default_rng(k).integers(97, 117, 170).astype(np.uint8)) for k in (1, 2))
    z = lambda *v: np.array(v, np.int64)
    cols, lead, later = suffix.collapse(z(1, 1, 1), z(2, 2, 2), z(10, 20, 30), z(0, 0, 0), z(170, 170, 170), z(0, 170, 340))
    at, to = suffix.copy_sets(cols[2], cols[3], lead, later)
    assert later.sum() == 2 and len(set(to.tolist())) == 1
    spans = suffix.covered_locally(a + b + a, to, cols[5][at], cols[2][at], cols[3][at], cols[4][at], 100, 1 << 20)
    assert [x.tolist() for x in spans] == [[30], [0], [170]]


@pytest.mark.parametrize("length", [7, 2049])
def test_lengths_beyond_the_bounds_are_refused(odd_docs, length):
    with pytest.raises(ValueError):
        suffix.remove_repeats(odd_docs, length)


def test_short_strings_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, bytes(rng.integers(97, 100, int(rng.integers(0, 400))).astype(np.uint8))) for i in range(60)]
    parts = [t for _, t in rows]
    doc, start, end = suffix.repeated_windows(parts, np.array([i for i, _ in rows]), np.zeros(len(rows), np.int64), 40)
    want = {}
    seen = {}
    for i, t in rows:
        for p in range(len(t) - 39):
            if seen.setdefault(t[p : p + 40], (i, p)) != (i, p):
                want.setdefault(i, np.zeros(500, bool))[p : p + 40] = True
    got = {}
    for d, s, e in zip(doc.tolist(), start.tolist(), end.tolist()):
        got.setdefault(d, np.zeros(500, bool))[s:e] = True
    assert set(got) == set(want) and all((got[k] == want[k]).all() for k in want)


def test_odd_rows(odd_docs, no_docs):
    got = suffix.digest(suffix.remove_repeats(odd_docs)).collect()
    assert len(got) == odd_docs.count()
    rows = {}
    for r in odd_docs.where("doc_id IS NOT NULL").select("doc_id", "text").collect():
        rows[r.doc_id] = (r.text or "").encode()
    nulls = [r for r in got if r.doc_id is None]
    assert len(nulls) == 2 and sorted(r.n_removed for r in nulls) == [0, 0]
    want = suffix.brute_force(sorted(rows.items()))
    for r in got:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
    assert suffix.digest(suffix.remove_repeats(no_docs)).count() == 0
    assert hashlib.sha256(b"").hexdigest() in {r.kept_sha256 for r in got}
