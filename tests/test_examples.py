"""Hand-computed cases of functions and operators."""

import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import actions as A
from millrace.functions import fixed, hashing, labels, scores, text
from millrace.functions import geometry as G
from millrace.functions import validators as V
from millrace.functions.images import phash
from millrace.operators import dedup, evaluation, selection, trajectory, validate
from millrace.operators import similarity as S
from millrace.operators.common import fixed_rows, running_total


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def cases():
    return [
        (text.normalize(F.lit("Hello,  World!HELLO")), "hello world hello"),
        (text.tokens(F.lit("")), 0),
        (text.tokens(F.lit("x" * 400)), 100),
        (text.image_tokens(F.lit(1600), F.lit(900)), 58 * 33 + 8),
        (text.template(F.lit("See https://a.b/c on 3.5 of Straße deadbeefdeadbeef00")), "see <url> on <n> of strasse <id>"),
        (text.sanitize(F.lit("a b/c")), "a_b_c"),
        (text.sanitize(F.lit("")), "x"),
        (text.action_line(F.lit("Plan: x\nAction: click(x=1, y=2)\n")), "click(x=1, y=2)"),
        (text.action_line(F.lit("only this\n\n")), "only this"),
        (text.task_line(F.lit("<image>\nTask: do it\nmore")), "do it"),
        (text.compose_target(F.lit("wait()"), F.lit("Plan: Plan it")), "Plan: Plan it\nAction: wait()"),
        (text.compose_target(F.lit("wait()"), F.lit(None).cast("string")), "wait()"),
        (text.prompt(F.lit("t"), F.array(F.lit("a"), F.lit("b")), 1), "<image>\nTask: t\nPrevious actions:\n- b"),
        (text.redact(F.lit("x hf_" + "a" * 20)), "x [REDACTED]"),
        (text.code_language(F.lit("write java"), F.lit("```py\nx\n```")), "python"),
        (text.problem_type(F.lit("please fix it")), "debugging"),
        (G.to_pixel(F.lit(38), F.lit(1040), "thousand"), 39),
        (G.to_pixel(F.lit(96), F.lit(736), "thousand"), 71),
        (G.to_pixel(F.lit(500), F.lit(1000), "thousand"), 500),
        (G.to_pixel(F.lit(0.25), F.lit(1080), "unit"), 270),
        (G.scale(F.lit(960), F.lit(1920), F.lit(1600)), 800),
        (G.scale(F.lit(1919), F.lit(1920), F.lit(1600)), 1599),
        (G.inside(F.lit(1600), F.lit(450), F.lit(1600), F.lit(900)), False),
        (G.inside(F.lit(1599), F.lit(899), F.lit(1600), F.lit(900)), True),
        (G.size_bucket(F.lit(8)), "tiny"), (G.size_bucket(F.lit(20)), "small"), (G.size_bucket(F.lit(50)), "medium"), (G.size_bucket(F.lit(500)), "large"),
        (G.hamming(F.lit(0), F.lit(15)), 4),
        (G.conversion_space(F.lit(1040), F.lit(736), F.lit(2080), F.lit(1472)), "mismatch_used_actual"),
        (G.target_box(F.lit(-10.0), F.lit(0.0), F.lit(500.0), F.lit(500.0), F.lit(1001), F.lit(1001)), (0, 0, 500, 500)),
        (G.center_offset(F.lit(5.0), F.lit(5.0), F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(10.0)), 0.0),
        (labels.task_signals(F.lit("Sort the files by name and export the list")), ["export", "sorting"]),
        (labels.task_signals(F.lit("Select exactly 3 rows")), ["exact_quantity"]),
        (labels.task_signals(F.lit("Rank the top 5 songs")), ["ranking"]),
        (labels.task_signals(F.lit("Open settings")), []),
        (labels.referent(F.lit("Click on the 'File' tab to begin")), "File tab"),
        (labels.referent(F.lit("Use the keyboard shortcut ctrl+s")), None),
        (labels.referent(F.lit("Clicking 'File'")), "File"),
        (labels.control_kind(F.lit(None).cast("string"), F.lit("Submit button")), "button"),
        (labels.plan_category(F.array(F.lit("x"), F.lit("wait_evidenced"), F.lit("recovery_evidenced"))), "wait"),
        (labels.usable_element(F.array(F.lit(0.0), F.lit(0.0), F.lit(12.0), F.lit(12.0)), F.lit("gear")), True),
        (labels.usable_element(F.array(F.lit(0.0), F.lit(0.0), F.lit(12.0), F.lit(12.0)), F.lit("cursor")), False),
        (scores.trajectory_priority(F.lit(10)), 1.0), (scores.trajectory_priority(F.lit(2)), 0.5), (scores.trajectory_priority(F.lit(5)), 0.8), (scores.trajectory_priority(F.lit(90)), 0.9),
        (evaluation.verdict(F.lit(0.80), F.lit(0.76)), "INVESTIGATE"),
        (evaluation.mcnemar(F.lit(5), F.lit(5)), 1.0), (evaluation.mcnemar(F.lit(0), F.lit(0)), 1.0),
        (evaluation.effective_batch(F.lit(3)), 33), (evaluation.effective_batch(F.lit(64)), 64),
        (evaluation.optimizer_steps(F.lit(100003)), 3126),
        (hashing.canonical_json(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"))), '{"a":"1","b":"2"}'),
    ]


def test_expressions(spark):
    known = cases()
    row = spark.range(1).select(*[c.alias(f"x{i}") for i, (c, _) in enumerate(known)]).first()
    off = [(i, want, got) for i, ((_, want), got) in enumerate(zip(known, row)) if (tuple(got) if isinstance(want, tuple) else got) != want]
    assert off == []


def test_mcnemar_equals_binomial_sums(spark):
    for b, c in [(1, 9), (0, 8), (17, 40), (300, 420), (1500, 1500)]:
        n, k = b + c, min(b, c)
        want = min(1.0, 2 * sum(math.comb(n, i) for i in range(k + 1)) / 2**n)
        assert math.isclose(one(spark, evaluation.mcnemar(F.lit(b), F.lit(c))), want, rel_tol=1e-9)


def test_artifact_name_is_stable(spark):
    import hashlib
    import json

    name = one(spark, hashing.artifact_name(F.lit("t/1 ü"), F.array(F.lit("a"), F.lit("b"))))
    digest = hashlib.sha256(json.dumps(["t/1 ü", ["a", "b"]], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()[:20]
    assert name == f"t_1___{digest}.webp" or name.endswith(f"__{digest}.webp")


def test_split_shares(spark):
    rows = spark.range(5000).select(hashing.split_of(F.concat(F.lit("id"), F.col("id").cast("string"))).alias("s")).groupBy("s").count().collect()
    share = {r.s: r["count"] for r in rows}["validation"] / 5000
    assert 0.01 < share < 0.06


@pytest.mark.parametrize("verb", fixed.VERBS)
def test_rendered_actions_parse_back(verb):
    made = {
        "drag": A.action("drag", [(1, 2), (3, 4)], button="left"), "scroll": A.action("scroll", [(5, 6)], clicks=-3), "type": A.action("type", text='say "x, y=1" (é)'),
        "press": A.action("press", key="enter"), "hotkey": A.action("hotkey", keys=["ctrl", "a=b"]), "wait": A.action("wait", seconds=2.0), "finish": A.action("finish", status="success"),
    }.get(verb) or (A.action(verb, [(7, 8)]) if verb in fixed.POINT_VERBS else A.action(verb, key="x"))
    said = A.render(made)
    found = A.parse(said)
    assert found["verb"] == verb and found["points"] == made["points"]
    if verb not in ("key_down", "key_up", "mouse_down", "mouse_up"):
        assert A.render(found) == said


def test_ambiguous_actions_are_refused():
    for said in ("click(x=1)", "drag(x1=1, y1=2, x2=3)", "jump()", "", None, "click(x=a, y=2)", "type(txt=1)"):
        assert A.parse(said) is None
    assert A.from_python("pyautogui.click(1, 2); pyautogui.click(3, 4)", 10, 10) is None
    assert A.from_python("pyautogui.click(11, 2)", 10, 10) is None
    assert A.from_python("import os", 10, 10) is None
    assert A.combination(["ctrl", "ctrl", "a"]) is None and A.combination(["ctrl", "shift", "a"]) == ["ctrl", "shift", "a"]
    assert A.from_log("DRAG_TO", {"x": 1, "y": 2}) is None


def test_schema_subset():
    assert V.matches(3, {"type": "integer", "minimum": 1, "maximum": 3}) and not V.matches(4, {"type": "integer", "maximum": 3})
    assert not V.matches(True, {"type": "integer"}) and V.matches(None, {"type": ["null", "string"]})
    assert V.matches("b", {"anyOf": [{"const": "a"}, {"enum": ["b"]}]}) and not V.matches("", {"type": "string", "minLength": 1})
    assert not V.matches({"a": 1, "b": 2}, {"type": "object", "properties": {"a": {}}, "additionalProperties": False})
    assert not V.matches([1, "x"], {"type": "array", "items": {"type": "number"}})


def test_arithmetic_is_exact():
    assert V.math_verified("What is 0.1 + 0.2?", "0.3") is True
    assert V.math_verified("Compute 1/0", "1") is None and V.math_verified("What is (1+2", "3") is None
    assert V.math_answer_ok("What is 2 + 2 then?", "It is 4.") is True and V.math_answer_ok("Compute 2 + 2 + 0", "It is 5") is False


def test_controls_are_chosen_for_spread():
    raw = [{"control_text": f"item {i}", "control_rect": [10 * i, 5, 10 * i + 8, 20], "control_type": "button"} for i in range(60)] + [{"control_text": "far", "control_rect": [900, 900, 990, 990], "control_type": "slider"}]
    found = V.diverse_controls(raw)
    assert len(found) == 24 and "far" in {c["control_text"] for c in found}
    keys = [(c["control_rect"][1], c["control_rect"][0]) for c in found]
    assert keys == sorted(keys)


def test_phash_ignores_brightness():
    import numpy as np

    grey = np.random.default_rng(0).integers(0, 200, (32, 32))
    assert (phash(grey) ^ phash(grey + 20)) & ((1 << 64) - 1) in (0, 1 << 63)


def test_contamination_cases(spark):
    ref = "rename the file report to summary and move it into the archive folder"
    refs = S.references(fixed_rows(spark, "id long, t string", (1, ref), (2, "change the vlc audio output device to speakers please now"), (3, "")), "id", "t")
    texts = S.prepared(fixed_rows(
        spark, "k long, t string", (1, ref.upper() + "!!"), (2, ref + " and print it"), (3, "rename the other picture quickly while nobody watches the open window there"),
        (4, "Change the VLC audio output device"), (5, ""), (6, "zebra"), (7, "file"),
    ), "t")
    got = {r.k: (r.kind, r.ref_id) for r in S.best_matches(texts, refs, ["k"]).collect()}
    assert got == {1: ("exact", 1), 2: ("containment", 1), 4: ("containment", 2), 7: ("containment", 1)} or got[2][0] in ("near_jaccard", "containment")
    assert set(got) == {1, 2, 4, 7}


def test_hamming_join_equals_all_pairs(spark):
    import random

    draw = random.Random(5)
    h = [draw.getrandbits(63) - (1 << 62) for _ in range(60)]
    h += [x ^ (1 << draw.randrange(63)) ^ (1 << draw.randrange(63)) for x in h[:40]] + h[:5]
    rows = fixed_rows(spark, "id long, h long", *enumerate(h))
    own = {r.id: r.representative for r in S.hamming_classes(rows, "id", "h").collect()}
    assert own == {i: h.index(x) for i, x in enumerate(h)}
    classes = sorted(set(own.values()))
    far = lambda i, j: ((h[i] ^ h[j]) & ((1 << 64) - 1)).bit_count()
    for radius, more in ((0, None), (3, None), (6, 1), (6, 2), (6, 3)):
        got = sorted((r.a, r.b, r.distance) for r in S.hamming_links(rows, "id", "h", radius, more).collect())
        assert got == [(i, j, far(i, j)) for i in classes for j in classes if i < j and far(i, j) <= radius]


def test_leaders_differ_from_components(spark):
    chain = [0, 0b11111, 0b1111111111, 0b111111111111111, (1 << 20) - 1, (1 << 25) - 1]
    got = {r.seq: r.leader for r in dedup.leaders(fixed_rows(spark, "seq long, h long", *enumerate(chain)), "seq", "h", 6).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4}


def test_context_duplicates_follow_the_order(spark):
    keep, none = ["recovery_evidenced"], []
    rows = [(0, 0, "t", "a", none), (1, 1, "t", "a", none), (2, 1, "t", "b", none), (3, 3, "t", "a", keep), (4, 3, "t", "a", none), (5, 0, "t", "a", keep), (6, 3, "u", "a", none)]
    got = {r.seq: r.decision for r in dedup.context_duplicates(fixed_rows(spark, "seq long, h long, task string, action string, signals array<string>", *rows), "seq", "h", "task", "action", "signals").collect()}
    assert got == {0: "kept", 1: "near_duplicate_image_action", 2: "kept", 3: "kept_meaningful", 4: "task_action_state_duplicate", 5: "task_action_state_duplicate", 6: "near_duplicate_image_action"}


def test_running_total_of_a_hot_key(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("k"), "id", (F.col("id") % 7).alias("v")).repartition(8)
    got = {r.id: r.before for r in running_total(rows, ["k"], ["id"], "v", "before").collect()}
    sums = {"hot": 0, "cold": 0}
    for i in range(2000):
        k = "hot" if i % 10 < 8 else "cold"
        assert got[i] == sums[k]
        sums[k] += i % 7


def test_best_valid_prefers_breadth(spark):
    rows = fixed_rows(spark, "s string, c string, g string, score double, tie string", *[("x", "all", f"g{i // 10}", float(100 - i), str(i)) for i in range(30)])
    wanted = fixed_rows(spark, "s string, c string, want long", ("x", "all", 6))
    got = [r.g for r in selection.best_valid(rows, wanted, "s", "c", "g", "score", "tie").orderBy("rank").collect()]
    assert got == ["g0"] * 5 + ["g1"]
    all_of = fixed_rows(spark, "s string, c string, want long", ("x", "all", 40))
    assert selection.best_valid(rows, all_of, "s", "c", "g", "score", "tie").count() == 30


def test_cohorts():
    assert selection.cohort_targets(16000) == {"grounding": 2500, "understanding": 2650, "use": 10850}
    assert sum(selection.replay_targets(777).values()) == 777


def test_sample_validation(spark):
    from millrace.schema import SAMPLE

    meta = {"final_image_size": [100, 100]}
    said = lambda a: [("user", "<image>\nTask: t", None), ("assistant", a, None)]
    cases = {
        None: (said("Action: click(x=1, y=2)"), ["i/a.webp"], "s", "t", "action", meta), "invalid_roles": ([("user", "hi", None)], [], "s", "t", "action", meta),
        "empty_assistant_target": (said(" "), ["i/a.webp"], "s", "t", "action", meta), "unknown_source": (said("click(x=1, y=2)"), ["i/a.webp"], "z", "t", "action", meta),
        "image_placeholder_mismatch": (said("click(x=1, y=2)"), [], "s", "t", "action", meta), "non_portable_path": (said("click(x=1, y=2)"), ["/abs.webp"], "s", "t", "action", meta),
        "invalid_action_syntax": (said("hello"), ["i/a.webp"], "s", "t", "action", meta), "coordinate_out_of_bounds": (said("click(x=100, y=2)"), ["i/a.webp"], "s", "t", "action", meta),
        "finish_without_evidence": (said('finish(status="success")'), ["i/a.webp"], "s", "t", "action", meta), "missing_final_image_size": (said("click(x=1, y=2)"), ["i/a.webp"], "s", "t", "action", {}),
        "grounding_without_point": (said("wait()"), ["i/a.webp"], "s", "t", "grounding", meta), "missing_trajectory_id": (said("click(x=1, y=2)"), ["i/a.webp"], "s", "", "action", meta),
    }
    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string(SAMPLE)
    fields = kind["metadata"].dataType.names
    rows = [([tuple(m) for m in msgs], images, source, t, name or "ok", task, None, tuple(m.get(f) for f in fields)) for name, (msgs, images, source, t, task, m) in cases.items()]
    df = spark.createDataFrame(rows, kind)
    target = text.action_line(F.try_element_at(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(-1))["content"])
    df = df.withColumn("target", F.coalesce(target, F.lit(""))).withColumn("action", A.parse_action(F.col("target"))).withColumn("controls", F.lit(None).cast("array<struct<control_text:string,control_rect:array<int>>>"))
    got = {r.step_id: r.reason for r in df.select("step_id", validate.first_failure(validate.sample_checks(("s",))).alias("reason")).collect()}
    assert got == {k or "ok": k for k in cases}


def test_window_starts_and_spacing(spark):
    rows = spark.range(50).select(trajectory.window_starts(F.col("id"), F.lit(20), 4, 5).alias("s")).select("s", trajectory.spaced(F.col("s"), 4, 3).alias("k")).collect()
    for r in rows:
        assert all(0 <= s <= 16 for s in r.s) and len(r.k) <= 3
        assert all(abs(a - b) >= 4 for i, a in enumerate(r.k) for b in r.k[:i])


def test_bootstrap_draws_ten_thousand_times(spark, sf):
    """The query's interval is that of 10,000 draws with seed 1337, made one by one."""
    import random

    from millrace.plans import QUERIES

    sf = sf.replace("sf0.001", "sf0.01")  # on the smallest tables fewer draws give the same ends
    marks = sorted((r.doc_id, (r.toxic == 0) - (r.quality == 1)) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id % 9)
    delta, rng = [d for _, d in marks], random.Random(1337)
    n = len(delta)
    found = sorted(100.0 * sum(delta[rng.randrange(n)] for _ in range(n)) / n for _ in range(10_000))
    assert tuple(QUERIES["bootstrap_ci"](spark, sf).first()) == (n, found[249], found[9750])


def test_blocks_of_draws_equal_single_ones():
    import random

    for n in (1, 2, 3, 8, 1000, 70_001):
        rng, blocks = random.Random(1337), evaluation._draws(n, 1337, 500)
        got = [x for _ in range(8) for x in next(blocks).tolist()]
        assert got == [rng.randrange(n) for _ in got] and got
