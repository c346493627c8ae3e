import functools
import itertools
import re

import numpy as np
import pytest

from millrace.llm import decontam as D


def test_the_mask_meets_every_pair_of_substitutions():
    """Every 13 words with at most 2 substitutions hold an untouched seed."""
    for lost in itertools.combinations(range(D.LEAST), 2):
        assert any(not {p + k for k in D.MASK} & set(lost) for p in range(D.LEAST - D.MASK[-1]))
    for n in range(8, D.LEAST):
        lost_most = int(n * (1 - D.SIMILARITY) + 1e-9)
        for lost in itertools.combinations(range(n), lost_most):
            assert any(not {p, p + 1, p + 2} & set(lost) for p in range(n - 2))


@pytest.mark.parametrize("n", range(D.LEAST, 26))
def test_the_masks_meet_every_overlap_that_counts(n):
    """Longer overlaps hold one of 13 to 25 words that counts: not every part can be worse than the whole."""
    seeds = [sum(1 << p + k for k in mask) for mask in D.MASKS for p in range(n - mask[-1])]
    for lost in itertools.combinations([1 << i for i in range(n)], int(n * (1 - D.SIMILARITY) + 1e-9)):
        assert not all(sum(lost) & s for s in seeds)


@pytest.mark.parametrize("n, lost", [(15, (6, 7, 8)), (15, (3, 7, 11)), (20, (3, 7, 11, 15))])
def test_overlaps_of_more_substitutions_are_found(spark, n, lost):
    item = [f"w{i}" for i in range(n)]
    text = ["before", *("other" if i in lost else w for i, w in enumerate(item)), "after"]
    docs = spark.createDataFrame([(1, " ".join(text)), (2, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    assert [tuple(r) for r in D.find_leaks(docs, items).collect()] == [(1, 7, n, n - len(lost))]
    assert [r.doc_id for r in D.drop_leaks(docs, items).collect()] == [2]


_NUMBER: dict[str, int] = {}


@functools.lru_cache(1000)
def words(text):
    found = re.findall("[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return np.array([_NUMBER.setdefault(w, len(_NUMBER)) for w in found], np.int64)


def plain(text, item, least=D.LEAST, similarity=D.SIMILARITY):
    """Whether some alignment without gaps has a long enough stretch, by trying all, over the whole text."""
    a, y = words(text), words(item)
    if len(y) < 5:
        return False
    need, share = min(least, len(y)), similarity if len(y) >= 8 else 1.0
    pad = np.full(len(y), -1)
    aligned = np.lib.stride_tricks.sliding_window_view(np.concatenate([pad, a, pad]), len(y))
    for k in np.flatnonzero((aligned == y).sum(axis=1) >= share * need - 1e-9):
        same, there = aligned[k] == y, aligned[k] >= 0
        for i in range(len(y)):
            for j in range(i + need, len(y) + 1):
                if there[i:j].all() and same[i:j].sum() >= share * (j - i) - 1e-9:
                    return True
    return False



@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(8)
    vocab = [f"w{i}" for i in range(400)] + ["naïve", "Ünï"]
    say = lambda n: [str(x) for x in rng.choice(vocab, n)]
    items = [say(n) for n in (4, 5, 7, 8, 10, 12, 13, 20, 40, 60)]
    docs = [say(80) for _ in range(12)]
    for k, item in enumerate(items):
        docs.append(say(30) + item + say(30))
        swapped = list(item)
        for p in range(2, len(swapped), 7):
            swapped[p] = "other"
        docs.append(say(20) + swapped + say(5))
        docs.append(say(9) + item[: len(item) // 2] + say(9))
    docs.append([w.upper() + "," for w in items[8]])
    texts = [" ".join(d) for d in docs] + ["", None, " ".join(items[9]) + " " + " ".join(say(30_000))]
    benchmark = [(i, " ".join(w)) for i, w in enumerate(items)] + [(98, None), (99, "")]
    return list(enumerate(texts)), benchmark


def test_pairs_equal_all_alignments(spark, tables):
    docs, benchmark = tables
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(benchmark, "item_id long, text string")).collect()
    want = {(d, i) for d, t in docs if len(t or "") < 20_000 for i, b in benchmark if plain(t, b)}
    assert {(r.doc_id, r.item_id) for r in got if len(docs[r.doc_id][1]) < 20_000} == want and len(want) > 15
    assert (docs[-1][0], 9) in {(r.doc_id, r.item_id) for r in got}


def test_blocks_change_nothing(spark, tables, monkeypatch):
    docs, benchmark = tables
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(benchmark, "item_id long, text string")
    whole = sorted(map(str, D.find_leaks(a, b).collect()))
    monkeypatch.setattr(D, "BLOCK", 100)
    assert sorted(map(str, D.find_leaks(a, b).collect())) == whole
    kept = {r.doc_id for r in D.drop_leaks(a, b).collect()}
    assert kept == {d for d, _ in docs} - {int(re.search(r"doc_id=(\d+)", x)[1]) for x in whole}


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "nothing of this kind occurs in any of the texts at all here")], "item_id long, text string")
    assert D.find_leaks(odd_docs, items).count() == 0
    assert D.drop_leaks(odd_docs, items).count() == odd_docs.count()
    assert D.find_leaks(odd_docs, items.limit(0)).count() == 0 and D.drop_leaks(odd_docs, items.limit(0)).count() == odd_docs.count()
    assert D.find_leaks(no_docs, items).count() == 0


def test_items_and_texts_are_lower_cased_alike(spark):
    upper = "ΟΔΟΣ ΜΕΓΑΣ ΛΟΓΟΣ ΝΟΜΟΣ ΚΟΣΜΟΣ ΤΟΠΟΣ"
    mixed = "İstanbul ǅ ẞtraße ÀÉ ΣΑΣ Σ' ΑΣ. one two three four five six"
    items = spark.createDataFrame([(1, upper), (2, mixed)], "item_id long, text string")
    docs = spark.createDataFrame([(10, upper), (11, upper.lower()), (12, mixed), (13, "x " + mixed + " y"), (14, "clean")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(docs, items).collect()}
    assert {(10, 1), (12, 2), (13, 2)} <= got and not any(d == 14 for d, _ in got)


def test_a_word_repeated_without_end(spark, monkeypatch):
    monkeypatch.setattr(D, "SEEDS", 1000)
    index = D.Index.build([(1, b"no " * 40), (2, b"yes no " * 20)])
    text = b"no " * 3000
    assert [x[:2] + (x[2] == x[3],) for x in index.search(np.frombuffer(text, np.uint8), np.array([0, len(text)]), D.LEAST, D.SIMILARITY)] == [(0, 0, True)]


def test_the_shortest_item_is_a_parameter(spark):
    items = spark.createDataFrame([(1, "just three words")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "these are just three words of it")], "doc_id long, text string")
    assert D.find_leaks(docs, items).count() == 0 and D.find_leaks(docs, items, shortest=3).count() == 1
