"""The first look of contamination against regular expressions: no text that may match is lost."""

import random
import re

import pyarrow as pa

from millrace.operators import similarity as S


def texts():
    draw = random.Random(1)
    some = ["", "é", "alpha", "betaé", "gamma 7", "Alpha BETA alpha alpha alpha alpha alpha alpha alpha", "K7 İx ﬁx"]
    for _ in range(250):
        words = [draw.choice(["a", "b", "cc", "Dd", "e9", "ü", "x" * 9, str(draw.randrange(40))]) for _ in range(draw.choice([0, 1, 3, 7, 8, 9, 30]))]
        some.append(draw.choice(["", " ", "é"]) + draw.choice([" ", ", ", "é"]).join(words))
    return some


def words_of(text):
    return re.findall("[a-z0-9]+", text)


def test_words_meet_by_equal_hashes_and_end_with_their_text():
    lowered = [t.lower() for t in texts()]
    row, word = S._word_hashes(pa.array(["cut off", *lowered])[1:])
    want = [(i, w) for i, t in enumerate(lowered) for w in words_of(t)]
    assert row.tolist() == [i for i, _ in want]
    pairs = set(zip((w for _, w in want), word.tolist()))
    assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})


def test_matches_are_those_without_the_first_look(spark):
    refs = S.references(spark.createDataFrame([(0, "alpha beta"), (1, "a b cc dd e9 3 4 5 6 7 8"), (2, "k7 i x"), (3, "")], "i long, t string"), "i", "t")
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts())] + [(999, None)], "k long, line string").repartition(3)
    kept = {r.k for r in S.worth_matching(df, refs, "line").collect()}
    want = sorted(map(str, S.best_matches(S.prepared(df, "line"), refs, ["k"]).collect()))
    assert sorted(map(str, S.contaminated(df, refs, ["k"], "line").collect())) == want and want
    assert len(kept) < df.count() and not kept & {0, 999}
    assert S.worth_matching(df, refs, "line", most=1).count() == df.count()
