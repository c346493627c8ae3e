"""The action grammar: rendering, parsing, and readers of four source notations.

An action is a dict of verb, args and points (final pixels). Every reader
returns None where a text is ambiguous. The columns at the end run the readers
over Arrow batches; verbs and plain coordinates need no reader, see ``verb_of``
and ``coordinate_free``.
"""

from __future__ import annotations

import ast
import json
import math
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from millrace.functions import fixed

ACTION = "struct<verb:string,points:array<struct<x:int,y:int>>,args:map<string,string>,rendered:string>"
_CALL = re.compile(rf"({'|'.join(sorted(fixed.VERBS, key=len, reverse=True))})\((.*)\)", re.S)
_PIECE = re.compile(r"""((?:"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*'|\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}|[^,])*)(?:,|$)""", re.S)
_NEEDS = {"drag": ("x1", "y1", "x2", "y2"), "scroll": ("clicks",), "type": ("text",), "press": ("key",)} | dict.fromkeys(fixed.POINT_VERBS, ("x", "y"))


def action(verb: str, points=(), **args) -> dict:
    return {"verb": verb, "points": [tuple(p) for p in points], "args": args}


# --- rendered actions ---


def _quoted(value) -> str:
    return json.dumps(str(value), ensure_ascii=False)


def render(a: dict) -> str:
    """The canonical text of an action."""
    verb, args, points = a["verb"], a["args"], a["points"]
    if verb in fixed.POINT_VERBS and points:
        if verb == "click":
            verb = "double_click" if args.get("count") == 2 else {"right": "right_click", "middle": "middle_click"}.get(args.get("button"), "click")
        elif verb != "point" and args.get("button") == "right":
            verb = "right_click"
        return "{}(x={}, y={})".format(verb, *points[-1])
    if verb == "drag" and len(points) > 1:
        return 'drag(x1={}, y1={}, x2={}, y2={}, button="{}")'.format(*points[0], *points[1], args.get("button", "left"))
    if verb == "scroll":
        where = ", x={}, y={}".format(*points[-1]) if points else ""
        return f"scroll(clicks={int(args.get('clicks', args.get('amount', 0)) or 0)}{where})"
    if verb == "type":
        return f"type(text={json.dumps(args.get('text', ''), ensure_ascii=False)})"
    if verb == "press":
        return f"press(key={_quoted(args.get('key', ''))})"
    if verb == "hotkey":
        return f"hotkey({', '.join(map(_quoted, args.get('keys') or []))})"
    if verb in ("key_down", "key_up", "mouse_down", "mouse_up"):
        return f"{verb}({_quoted(args.get('key') or args.get('button', 'left'))})"
    if verb == "wait":
        return "wait()" if args.get("seconds") is None else f"wait(seconds={float(args['seconds'])})"
    if verb == "finish":
        return f'finish(status="{args.get("status", "success")}")'
    return f"{verb}({json.dumps(args, ensure_ascii=False)})"


def _value(token: str):
    token = token.strip()
    for kind in (int, float):
        try:
            return kind(token)
        except ValueError:
            pass
    if len(token) > 1 and token[0] == token[-1] and token[0] in "\"'":
        try:
            return json.loads(token)
        except ValueError:
            return token[1:-1]
    return token


def parse(text: str | None) -> dict | None:
    """The action that a canonical text denotes."""
    found = _CALL.fullmatch((text or "").strip())
    if not found:
        return None
    verb, pieces = found[1], [p.strip() for p in _PIECE.findall(found[2].strip()) if p.strip()]
    named = [p.partition("=") for p in pieces if "=" in p and p[0] not in "\"'"]
    args = {k.strip(): _value(v) for k, _, v in named}
    need = _NEEDS.get(verb, ())
    if any(args.get(k) is None for k in need):
        return None
    try:
        if verb in fixed.POINT_VERBS or verb == "drag":
            at = [int(args[k]) for k in need]
            return action(verb, zip(at[::2], at[1::2]), **args)
        if verb == "scroll":
            both = args.get("x") is not None and args.get("y") is not None
            return action(verb, [(int(args["x"]), int(args["y"]))] if both else [], **args)
    except (TypeError, ValueError):
        return None
    if verb in ("type", "press"):
        return action(verb, **{need[0]: str(args[need[0]])})
    if verb == "hotkey":
        return action(verb, keys=[str(_value(p)) for p in pieces if "=" not in p or p[0] in "\"'"])
    return action(verb, **args)


def without_coordinates(text: str) -> str:
    """An action's text for old history: places are left out, unknown syntax is not copied."""
    a = parse(text)
    if a is None:
        return "previous_action"
    if a["verb"] in fixed.POINT_VERBS or a["verb"] == "drag":
        return a["verb"]
    return render(a | {"points": []}) if a["verb"] == "scroll" else render(a)


# --- model output: a plan and one action ---

_HEAD = re.compile(r"(plan|action)[ \t]*:(.*)", re.I)


def parse_output(text: str | None) -> dict:
    """(plan, action text, parsed action, error) of a model's answer.

    Every line is a plan head P, an action head A, blank or text; the order of
    these signs decides.
    """
    def told(error, plan=None, raw=None, parsed=None):
        return {"plan": plan, "action_text": raw, "action": parsed, "error": error}

    whole = (text or "").strip()
    if not whole:
        return told("empty_output")
    lines = whole.splitlines()
    heads = [_HEAD.match(line) for line in lines]
    signs = "".join(h[1][0].upper() if h else "." if line.strip() else " " for h, line in zip(heads, lines))
    if signs[0] in "PA":
        if signs.count("A") > 1:
            return told("multiple_action_blocks")
        before, at, after = signs.partition("A")
        if after.strip():
            return told("trailing_content")
        if not at:
            return told("missing_action")
        k = len(before)
        said = [h[2].strip() if h else line.rstrip() for h, line in zip(heads[:k], lines[:k])]
        plan, whole = "\n".join(said).strip() if said else None, heads[k][2].strip()
    else:
        plan = None
    if not whole:
        return told("missing_action", plan)
    if not re.match(rf"(?:{'|'.join(fixed.VERBS)})\s*\(", whole):
        return told("unknown_verb:" + whole.partition("(")[0].partition(" ")[0][:40], plan, whole)
    parsed = parse(whole)
    return told(None if parsed else "unparseable_action", plan, whole, parsed)


# --- source notations ---


def pixel(x: float, y: float, width: int, height: int, space: str = "pixel") -> tuple[int, int]:
    if space != "pixel":
        unit = 1 if space == "unit" else 1000
        x, y = x / unit * max(0, width - 1), y / unit * max(0, height - 1)
    return round(x), round(y)


def _number(x) -> bool:
    return isinstance(x, (int, float))


def _calls(code: str):
    """(name, positional, named) of literal calls on one module; None for any other code."""
    found = []
    for node in ast.parse(code.strip()).body:
        call = getattr(node, "value", None)
        if not (isinstance(node, ast.Expr) and isinstance(call, ast.Call) and isinstance(call.func, ast.Attribute) and isinstance(call.func.value, ast.Name) and call.func.value.id == "pyautogui"):
            return None
        found.append((call.func.attr.lower(), [ast.literal_eval(a) for a in call.args], {k.arg: ast.literal_eval(k.value) for k in call.keywords if k.arg}))
    return found


def from_python(code: str | None, width: int, height: int, space: str = "pixel") -> dict | None:
    """One literal automation call, or a key press or drag spelt as two calls."""
    try:
        calls = _calls(code or "") if width > 0 and height > 0 else None
    except (SyntaxError, ValueError, TypeError, MemoryError, RecursionError):
        return None
    if not calls or len(calls) > 2:
        return None
    pick = lambda c, i, *names, default=None: next((c[2][n] for n in names if n in c[2]), c[1][i] if len(c[1]) > i else default)

    def spot(c):
        x, y = pick(c, 0, "x", "xcoordinate"), pick(c, 1, "y", "ycoordinate")
        if not (_number(x) and _number(y)):
            return None
        p = pixel(float(x), float(y), width, height, space)
        return p if 0 <= p[0] < width and 0 <= p[1] < height else None

    name = calls[0][0]
    if len(calls) == 2:
        a, b = calls
        if (name, b[0]) == ("keydown", "keyup"):
            down, up = pick(a, 0, "key"), pick(b, 0, "key")
            return action("press", key=str(down)) if down is not None and str(down) == str(up) else None
        if name in ("moveto", "move") and b[0] in ("dragto", "drag"):
            start, end = spot(a), spot(b)
            return action("drag", [start, end], button=str(b[2].get("button", "left") or "left").lower()) if start and end else None
        return None
    c = calls[0]
    if name in ("click", "clickxy", "doubleclick", "rightclick", "middleclick"):
        p, clicks = spot(c), pick(c, 99, "clicks", "numclicks", default=1)
        button = {"rightclick": "right", "middleclick": "middle"}.get(name) or str(c[2].get("button", "left") or "left").lower()
        return p and action("double_click" if name == "doubleclick" or clicks == 2 else "click", [p], button=button, count=clicks if isinstance(clicks, int) else 1)
    if name in ("moveto", "move"):
        p = spot(c)
        return p and action("move", [p])
    if name == "scroll":
        clicks = pick(c, 0, "clicks")
        placed = "x" in c[2] or "y" in c[2]
        p = spot((name, [], c[2])) if placed else None
        return action("scroll", [p] if p else [], clicks=int(clicks)) if _number(clicks) and bool(p) == placed else None
    if name in ("typewrite", "write", "type"):
        text = pick(c, 0, "text")
        text = "".join(map(str, text)) if isinstance(text, (list, tuple)) else text
        return action("type", text=str(text)) if isinstance(text, (str, int, float)) else None
    if name in ("press", "keydown", "keyup"):
        key = pick(c, 0, "key", *(["keys"] if name == "press" else []))
        if name == "press" and isinstance(key, (list, tuple)):
            key = key[0] if len(key) == 1 else None
        return action({"press": "press", "keydown": "key_down", "keyup": "key_up"}[name], key=str(key)) if key not in (None, "") else None
    if name == "hotkey":
        keys = c[2].get("keys", c[1])
        keys = [k.strip() for k in keys.split("+") if k.strip()] if isinstance(keys, str) else keys
        return action("hotkey", keys=[str(k) for k in keys]) if isinstance(keys, (list, tuple)) and keys else None
    if name in ("mousedown", "mouseup"):
        return action("mouse_" + name[5:], button=str(pick(c, 0, "button", default="left") or "left").lower())
    if name in ("sleep", "wait", "pause"):
        seconds = pick(c, 0, "seconds", "duration", default=1.0)
        return action("wait", seconds=float(seconds)) if _number(seconds) else None
    return None


def _less(label: str, said: str) -> str:
    return re.sub(label, "", said, count=1, flags=re.I)


def _keys(said: str) -> dict | None:
    """Several keys joined by plus signs or listed in parentheses are a hotkey, one is a press."""
    listed = said.strip("()").split(",") if re.fullmatch(fixed.PHRASE_KEYS, said, re.A) else said.split("+") if "+" in said else None
    if listed is not None:
        return action("hotkey", keys=[k.strip() for k in listed if k.strip()])
    return action("press", key=_less(fixed.PHRASE_KEY_LABEL, said)) if said else None


def _scrolled(said: str, whole: str) -> dict:
    if count := re.fullmatch(fixed.PHRASE_COUNT, said):
        return action("scroll", clicks=int(count[1]))
    place = re.search(fixed.PHRASE_PLACE, whole)
    way = (said.lower().split() or ["down"])[0]
    return action("scroll", [tuple(map(int, place.groups()))] if place else [], clicks=fixed.PHRASE_SCROLL.get(way, fixed.PHRASE_SCROLL_ELSE))


def _clicked(how: str, x: str, y: str) -> dict:
    verb = next((v for part, v in (("double", "double_click"), ("right", "right_click")) if part in how.lower()), "click")
    return action(verb, [(int(x), int(y))])


def _waited(said: str) -> dict:
    seconds = re.search(fixed.PHRASE_NUMBER, said)
    return action("wait", seconds=float(seconds[0])) if seconds else action("wait")


#: Reader of each notation: from its captured parts and the whole phrase.
_READ: dict[str, Callable] = {
    "click": lambda whole, *place: _clicked(*place),
    "type": lambda whole, said: action("type", text=_less(fixed.PHRASE_TEXT_LABEL, said.lstrip(">").strip())),
    "press": lambda whole, said: _keys(said),
    "finish": lambda whole, said: action("finish", status="failure" if "fail" in said.lower() else "success"),
    "wait": lambda whole, said: _waited(said),
    "scroll": lambda whole, said: _scrolled(said, whole),
    "drag": lambda whole, *ends: action("drag", [tuple(map(int, ends[:2])), tuple(map(int, ends[2:]))]),
}
_PHRASES = {name: re.compile(pattern, re.I | re.S) for name, pattern in fixed.PHRASES.items()}


def from_phrase(text: str | None) -> dict | None:
    """English-like action strings in pixels, such as ``drag from (1, 2) to (3, 4)``."""
    whole = (text or "").strip()
    found = next(((name, m) for name, p in _PHRASES.items() if (m := p.fullmatch(whole))), None)
    return found and _READ[found[0]](whole, *((part or "").strip() for part in found[1].groups()))


def from_log(kind: str | None, params: dict | None) -> dict | None:
    """An entry of a timed action log, in pixels."""
    kind, p = (kind or "").upper(), params or {}
    spot = lambda x, y: [pixel(float(p[x]), float(p[y]), 0, 0)] if p.get(x) is not None and p.get(y) is not None else []
    at = spot("x", "y")
    key = p.get("key", p.get("text", "")) or ""
    if kind in ("TERMINATE_SUCCESS", "TERMINATE", "AFTER_LAST_ACTION"):
        return action("finish", status="success")
    if kind == "CLICK" and at:
        button = str(p.get("text", "left") or "left").lower()
        if button in ("right", "middle"):
            return action("click", at, button=button)
        return action("double_click" if int(p.get("numClicks") or 1) > 1 else "click", at)
    if kind == "MOVE_TO" and at:
        return action("move", at)
    if kind == "DRAG_TO" and at and (start := spot("start_x", "start_y")):
        return action("drag", start + at, button=str(p.get("button", "left") or "left").lower())
    if kind == "SCROLL":
        return action("scroll", at, clicks=int(p.get("scrollY", p.get("scroll", 0)) or 0))
    if kind in ("TYPE", "TYPING", "TEXT"):
        return action("type", text=str(p.get("text", "")))
    if kind == "PRESS" and key:
        return action("press", key=str(key))
    if kind == "HOTKEY":
        keys = p.get("keys") or [k.strip() for k in str(key).split("+") if k.strip()]
        return action("hotkey", keys=[str(k) for k in keys]) if keys else None
    if kind in ("KEY_DOWN", "KEY_UP"):
        return action(kind.lower(), key=str(key))
    if kind in ("MOUSE_DOWN", "MOUSE_UP"):
        return action(kind.lower(), button=str(p.get("button", "left") or "left").lower())
    return None


def combination(keys) -> list[str] | None:
    """Keys pressed at once: one key, or modifiers and one other key; None for a sequence."""
    keys = [k for k in (str(x).strip().lower() for x in keys) if k]
    held = [k in fixed.MODIFIER_KEYS for k in keys]
    if len(keys) == 1 or (keys and len(set(keys)) == len(keys) and all(held[:-1]) and not held[-1]):
        return keys
    return None


def from_tool_call(name: str | None, args: dict | None, width: int, height: int) -> dict | None:
    """A tool call whose coordinates are 0 to 1000."""
    if width <= 0 or height <= 0 or not isinstance(args, dict):
        return None
    name = (name or "").lower().strip()

    def spot(raw):
        try:
            x, y = float(raw[0]), float(raw[1])
        except (TypeError, ValueError, IndexError, KeyError):
            return None
        if not (math.isfinite(x) and math.isfinite(y) and 0 <= min(x, y) and max(x, y) <= 1000):
            return None
        return pixel(x, y, width, height, "thousand")

    button = str(args.get("button", "left") or "left").lower()
    where = args.get("coordinate") or args.get("point")
    if name in ("terminate", "done", "finish", "stop"):
        status = str(args.get("status") or "success").lower()
        return action("finish", status=status if status in ("success", "failure", "failed", "cancelled", "canceled") else "success")
    if name in ("point", "click", "double_click", "right_click", "move"):
        p = spot(where)
        if p is None:
            return None
        if name == "point":
            return action("point", [p])
        if name == "right_click":
            return action("click", [p], button="right")
        return action("double_click" if int(args.get("clicks", 1) or 1) > 1 else name, [p], button=button)
    if name == "drag":
        start, end = args.get("start_coordinate"), args.get("coordinate")
        path = args.get("path") or args.get("points") or []
        if (start is None or end is None) and len(path) > 1:
            start, end = path[0], path[-1]
        a, b = spot(start), spot(end)
        return action("drag", [a, b], button=button) if a and b and a != b else None
    if name in ("type", "typewrite"):
        text = args.get("text")
        return action("type", text=str(text)) if text is not None and str(text) else None
    if name == "scroll":
        way = str(args.get("direction") or "").lower().strip()
        sign = {"up": -1, "left": -1, "down": 1, "right": 1}.get(way)
        try:
            amount = int(args.get("clicks", args.get("amount", 0)) or 0)
        except (TypeError, ValueError):
            return None
        p = None if where is None else spot(where)
        if not amount or (sign is None and way not in ("", "vertical", "horizontal")) or (where is not None and p is None):
            return None
        return action("scroll", [p] if p else [], clicks=sign * abs(amount) if sign else amount)
    if name in ("press", "key", "hotkey"):
        one = args.get("key") if name == "press" else None
        keys = [one] if one is not None else args.get("keys") or []
        keys = combination(keys if isinstance(keys, (list, tuple)) else [keys])
        if not keys or (name == "hotkey" and len(keys) < 2):
            return None
        return action("press", key=keys[0]) if len(keys) == 1 else action("hotkey", keys=keys)
    return None


# --- columns ---


def arrow_function(kind: str, read: Callable, *inputs: Column) -> Column:
    """``read`` over rows in Arrow batches: Python values in, a value of type ``kind`` out."""
    arrow = to_arrow_type(_parse_datatype_string(kind))

    @F.arrow_udf(kind)
    def run(rows: pa.Array) -> pa.Array:
        return pa.array([read(*row.values()) for row in rows.to_pylist()], arrow)

    return run(F.struct(*[c.alias(f"a{i}") for i, c in enumerate(inputs)]))


def shown(a: dict | None) -> dict | None:
    if a is None:
        return None
    args = [(k, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)) for k, v in a["args"].items()]
    return {"verb": a["verb"], "points": [{"x": x, "y": y} for x, y in a["points"]], "args": args, "rendered": render(a)}


def parse_action(text: Column) -> Column:
    return arrow_function(ACTION, lambda t: shown(parse(t)), text)


def model_output(text: Column) -> Column:
    """(plan, action_text, error, action) of model answers."""
    def read(t):
        out = parse_output(t)
        return out | {"action": shown(out["action"])}

    return arrow_function(f"struct<plan:string,action_text:string,error:string,action:{ACTION}>", read, text)


def python_action(code: Column, width: Column, height: Column) -> Column:
    return arrow_function(ACTION, lambda c, w, h: shown(from_python(c, w or 0, h or 0)), code, width, height)


def phrase_action(text: Column) -> Column:
    return arrow_function(ACTION, lambda t: shown(from_phrase(t)), text)


def log_action(kind: Column, params: Column) -> Column:
    """``params`` is JSON text."""
    return arrow_function(ACTION, lambda k, p: shown(from_log(k, json.loads(p or "{}"))), kind, params)


def tool_action(name: Column, args: Column, width: Column, height: Column) -> Column:
    """``args`` is JSON text."""
    return arrow_function(ACTION, lambda n, a, w, h: shown(from_tool_call(n, json.loads(a or "{}"), w or 0, h or 0)), name, args, width, height)


def history_text(text: Column) -> Column:
    return arrow_function("string", lambda t: without_coordinates(t or ""), text)


def verb_of(text: Column) -> Column:
    """The name before the bracket, of what follows the last ``action:``; ``text`` without one."""
    low = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", ""))
    tail = F.trim(F.substring_index(low, "action:", -1))
    head = F.trim(F.substring_index(tail, "(", 1))
    return F.when(head == "", "text").otherwise(head)
