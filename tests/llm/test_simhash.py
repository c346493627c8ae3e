import numpy as np
import pytest
import xxhash

from millrace.llm import simhash


def plain_fingerprint(text):
    """Straight from the definition."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(marks, radius):
    """Smallest reachable id of each (id, fingerprint) by comparing all pairs."""
    ids, fps = [i for i, _ in marks], [f for _, f in marks]
    label = {i: i for i in ids if i is not None}
    changed = True
    while changed:
        changed = False
        for i, f in zip(ids, fps):
            for j, g in zip(ids, fps):
                if i is not None and j is not None and (f ^ g).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprints_follow_the_definition(odd_docs):
    for r in odd_docs.select("text").distinct().collect():
        raw = None if r.text is None else r.text.encode()
        assert simhash.fingerprint(raw) == plain_fingerprint(r.text)


@pytest.mark.parametrize("shard", [1, 4, 2048])
def test_groups_equal_all_pairs(odd_docs, shard):
    got = simhash.near_duplicates(odd_docs, shard=shard).collect()
    assert len(got) == odd_docs.count()
    want = components([(r.doc_id, int(r.fingerprint, 16)) for r in got], 2)
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]


def test_links_across_shards_are_found(spark):
    rng = np.random.default_rng(3)
    fp = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    fp = np.unique(np.concatenate([fp, fp ^ np.uint64(5), fp[:50] ^ np.uint64(3 << 40)]))
    for depth in (0, 3, 7):
        tree = simhash.Vantage.fit(fp, depth)
        row, shard, home = tree.route(fp, 2)
        assert np.array_equal(np.sort(row[home]), np.arange(len(fp)))
        found = set()
        for s in np.unique(shard):
            at = row[shard == s]
            own = home[shard == s]
            a, b = [], []
            simhash.close_pairs(fp[at], np.flatnonzero(own), np.flatnonzero(~own), 2, a, b)
            found |= {tuple(sorted((int(at[x]), int(at[y])))) for x, y in zip(np.concatenate(a), np.concatenate(b)) if x != y}
        want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if (int(fp[i]) ^ int(fp[j])).bit_count() <= 2}
        assert found == want


def test_no_rows(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
