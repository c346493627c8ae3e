import hashlib

from oracle import difference

from millrace.llm import chat
from millrace.llm.queries import ORACLE_SQL, QUERIES

ROWS = [
    (1, 0, "user", "a <|user|> \\s \\l </turn> <+>"), (1, 1, "assistant", "b\\"), (1, 2, "assistant", None), (1, 3, "user", ""), (2, None, "assistant", "x"), (2, 0, None, "y"), (2, 0, None, "y"),
    (None, 5, "sys|tem<", "z"), (3, 1, "tool", "late"), (3, 0, "tool", "early"), (4, 0, "assistant", "ü<" * 50_000),
]
SCHEMA = "conv_id long, turn long, role string, text string, s string, segments int"


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, "q", 1) for r in ROWS], SCHEMA)
    found = {r.conv_id: r for r in chat.parse_formatted(chat.format_conversations(df)).collect()}
    by = {}
    for c, turn, role, text in ROWS:
        by.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    for c, turns in by.items():
        assert [(t.role, t.text) for t in found[c].turns] == [(r, t) for _, r, t in sorted(turns)]
        assert "".join(x.text for x in found[c].segments) == found[c].formatted
        said = [t for _, r, t in sorted(turns) if r == "assistant"]
        assert [x.text.replace("\\l", "<").replace("\\s", "\\") for x in found[c].segments if x.loss] == said
    assert found[1].formatted.count("<|assistant|>") == 1


def test_digest_reads_the_output(spark):
    df = spark.createDataFrame([(*r, "q", 1) for r in ROWS], SCHEMA)
    found = {r.conv_id: r for r in chat.digest(chat.format_conversations(df)).collect()}
    assert found[1].loss_chars == 2 and found[1].loss_sha256 == hashlib.sha256(b"b\\").hexdigest()
    assert found[3].turns_sha256 == hashlib.sha256(b"tool\nearly\ntool\nlate\n").hexdigest()
    assert chat.digest(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_equals_its_sql(spark, sf):
    assert difference(spark, sf, QUERIES["op4_chat"], ORACLE_SQL["op4_chat"]) == ""


def test_no_python_in_the_plan(spark, sf):
    plan = QUERIES["op4_chat"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
