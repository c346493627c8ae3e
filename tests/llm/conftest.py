import numpy as np
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra map<string,string>, fp string, id long, shard long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows, ties and clashing columns."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 8))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words, n))
    base = say(120)
    near = base.split()
    near[50] = "changed"
    texts = [None, "", "   \n", "one", "two words", base, base, " ".join(near), base.upper(), say(40), say(20_000), "Ünïcode ÄÖ ß é " * 30, say(60) + "\n" + say(60), "x" * 5000, base + " " + say(200)]
    rows = [(i, t, "en", "s", None if t is None else len(t), {"a": "b"}, "f", -i, 3) for i, t in enumerate(texts)]
    rows += [rows[9], (None, say(50), None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
