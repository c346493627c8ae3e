"""Queries on the action grammar and on validators, over literal cases."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import actions as A
from millrace.functions import validators as V
from millrace.operators.common import fixed_rows
from millrace.plans.registry import query

RENDERED = (
    (1, "click(x=10, y=20)"), (2, 'drag(x1=1, y1=2, x2=3, y2=4, button="left")'), (3, "scroll(clicks=-3, x=5, y=6)"), (4, 'type(text="a, \\"b\\" = (c)")'),
    (5, 'hotkey("ctrl", "s")'), (6, "wait(seconds=2.0)"), (7, 'finish(status="success")'), (8, "click(x=10)"), (9, "jump(x=1)"), (10, 'press(key="enter")'),
)


@query("""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'click', CAST(1 AS BIGINT), true, 'click', 'click'), (2, 'drag', 2, true, 'drag', 'drag'), (3, 'scroll', 1, true, 'scroll(clicks=-3)', 'scroll'),
  (4, 'type', 0, true, 'type(text="a, \\"b\\" = (c)")', 'type'), (5, 'hotkey', 0, true, 'hotkey("ctrl", "s")', 'hotkey'), (6, 'wait', 0, true, 'wait(seconds=2.0)', 'wait'),
  (7, 'finish', 0, true, 'finish(status="success")', 'finish'), (8, NULL, NULL, false, 'previous_action', 'click'), (9, NULL, NULL, false, 'previous_action', 'jump'), (10, 'press', 0, true, 'press(key="enter")', 'press')) v(id, verb, points, same, history, head)
""")
def action_parse(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "id long, text string", *RENDERED).withColumn("a", A.parse_action(F.col("text")))
    return rows.select("id", "a.verb", F.size("a.points").cast("long").alias("points"), F.col("a.rendered").eqNullSafe(F.col("text")).alias("same"), A.history_text(F.col("text")).alias("history"), A.verb_of(F.col("text")).alias("head"))


@query("""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), NULL), (2, 'empty_output'), (3, 'multiple_action_blocks'), (4, 'trailing_content'), (5, 'missing_action'), (6, 'unknown_verb:jump'), (7, 'unparseable_action'), (8, NULL)) v(id, error)
""")
def model_output_errors(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "id long, text string", (1, "Plan: look\nAction: click(x=1, y=2)"), (2, "  "), (3, "Action: wait()\nAction: wait()"), (4, "Action: wait()\nthen more"),
        (5, "Plan: only"), (6, "jump(x=1)"), (7, "click(x=1)"), (8, "click(x=3, y=4)"),
    )
    return rows.select("id", A.model_output(F.col("text"))["error"].alias("error"))


@query("""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'click(x=10, y=20)'), (2, 'press(key="a")'), (3, 'drag(x1=1, y1=2, x2=3, y2=4, button="left")'), (4, NULL), (5, 'hotkey("ctrl", "c")'), (6, 'right_click(x=5, y=6)'), (7, 'wait(seconds=1.0)')) v(id, action)
""")
def python_actions(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "id long, code string", (1, "pyautogui.click(10, 20)"), (2, "pyautogui.keyDown('a'); pyautogui.keyUp('a')"), (3, "pyautogui.moveTo(1, 2)\npyautogui.dragTo(3, 4)"),
        (4, "pyautogui.click(x)"), (5, "pyautogui.hotkey('ctrl', 'c')"), (6, "pyautogui.rightClick(5, 6)"), (7, "pyautogui.sleep()"),
    )
    return rows.select("id", A.python_action(F.col("code"), F.lit(100), F.lit(100))["rendered"].alias("action"))


@query("""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'click(x=100, y=200)'), (2, 'type(text="hello")'), (3, 'hotkey("Ctrl", "A")'), (4, 'scroll(clicks=-2)'), (5, 'drag(x1=383, y1=299, x2=763, y2=299, button="left")'), (6, 'press(key="enter")'), (7, NULL), (8, 'scroll(clicks=-3)')) v(id, action)
""")
def phrase_actions(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "id long, text string", (1, "click (100, 200)"), (2, "type text: hello"), (3, "hotkey (Ctrl, A)"), (4, "scroll (-2)"), (5, "drag from (383, 299) to (763, 299)"), (6, "press key enter"), (7, "dance"), (8, "scroll up"),
    )
    return rows.select("id", A.phrase_action(F.col("text"))["rendered"].alias("action"))


@query("""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'double_click(x=5, y=6)'), (2, NULL), (3, 'drag(x1=1, y1=1, x2=5, y2=6, button="left")'), (4, 'finish(status="success")'), (5, 'hotkey("ctrl", "v")')) v(id, action)
""")
def log_actions(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "id long, kind string, params string", (1, "CLICK", '{"x":5,"y":6,"numClicks":2}'), (2, "DRAG_TO", '{"x":5,"y":6}'), (3, "DRAG_TO", '{"x":5,"y":6,"start_x":1,"start_y":1}'),
        (4, "TERMINATE", None), (5, "HOTKEY", '{"text":"ctrl+v"}'),
    )
    return rows.select("id", A.log_action(F.col("kind"), F.col("params"))["rendered"].alias("action"))


@query("""
SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'click(x=39, y=71)'), (2, 'hotkey("ctrl", "s")'), (3, NULL), (4, 'scroll(clicks=-3)'), (5, NULL), (6, 'finish(status="success")')) v(id, action)
""")
def tool_actions(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "id long, name string, args string", (1, "click", '{"coordinate":[38,96]}'), (2, "key", '{"keys":["ctrl","s"]}'), (3, "key", '{"keys":["a","b"]}'),
        (4, "scroll", '{"clicks":3,"direction":"up"}'), (5, "click", '{"coordinate":[1200,5]}'), (6, "terminate", '{"status":"odd"}'),
    )
    return rows.select("id", A.tool_action(F.col("name"), F.col("args"), F.lit(1040), F.lit(736))["rendered"].alias("action"))


@query("SELECT * FROM (VALUES (CAST(1 AS BIGINT), true), (2, false), (3, NULL), (4, NULL), (5, true)) v(id, verified)")
def math_verify(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "id long, q string, a string", (1, "What is 12 * (3 + 4)?", "The answer is 84"), (2, "Calculate 7 / 2", "It is 3"), (3, "How many apples are left?", "5"), (4, "Solve the equation x + 1 = 3", "x = 2"), (5, "1/3 + 1/6 = ?", "1/2"),
    )
    return rows.select("id", V.math_check(F.col("q"), F.col("a")).alias("verified"))


TOOLS = json.dumps([{"type": "function", "function": {"name": "set_light", "parameters": {"type": "object", "properties": {"scene": {"type": "string"}, "level": {"type": "integer", "maximum": 10}}, "required": ["scene"], "additionalProperties": False}}}])


def _call(**args) -> str:
    return json.dumps([{"from": "human", "value": 'use scene="dim"'}, {"from": "gpt", "value": "<tool_call>" + json.dumps({"name": "set_light", "arguments": args}) + "</tool_call>"}])


@query("SELECT * FROM (VALUES (CAST(1 AS BIGINT), true), (2, false), (3, false), (4, false), (5, false), (6, false)) v(id, ok)")
def tool_schema_validate(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(
        spark, "id long, turns string, tools string", (1, _call(scene="dim", level=3), TOOLS), (2, _call(scene="bright"), TOOLS), (3, _call(level=3), TOOLS), (4, _call(scene="dim", other=1), TOOLS),
        (5, _call(scene="dim", level=11), TOOLS), (6, _call(scene="dim"), "[]"),
    )
    return rows.select("id", V.tool_conversation(F.col("turns"), F.col("tools")).alias("ok"))


@query("SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'python_ast_ok'), (2, NULL), (3, 'partial_or_unchecked')) v(id, syntax)")
def code_syntax(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixed_rows(spark, "id long, text string", (1, "```python\ndef f():\n    return 1\n```"), (2, "```python\ndef f(:\n```"), (3, "no code here"))
    return rows.select("id", V.code_syntax(F.col("text")).alias("syntax"))


@query("SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'File@0,0,100,20;Save@10,300,60,330'), (2, '')) v(id, controls)")
def screen_controls(spark: SparkSession, sf: str) -> DataFrame:
    raw = [{"control_text": " Save ", "control_rect": [10, 300, 60, 330]}, {"control_text": "File", "control_rect": [-5, 0, 100, 20]}, {"control_text": "save", "control_rect": [10, 300, 60, 330]}, {"control_text": "", "control_rect": [1, 1, 2, 2]}]
    found = fixed_rows(spark, "id long, raw string", (1, json.dumps(raw)), (2, "oops")).select("id", V.screen_controls(F.col("raw")).alias("c"))
    shown = F.array_join(F.transform("c", lambda c: F.concat(c["control_text"], F.lit("@"), F.array_join(F.transform(c["control_rect"], lambda v: v.cast("string")), ","))), ";")
    return found.select("id", shown.alias("controls"))
