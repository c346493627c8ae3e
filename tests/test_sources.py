"""Scans and sinks on small files."""

import hashlib
import json
import struct

from pyspark.sql import functions as F

from millrace.functions.geometry import png_size, webp_size
from millrace.operators.common import fixed_rows
from millrace.operators.reports import tree_hash
from millrace.sources import files


def test_json_lines(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"id": 1, "t": "x"}\n\n{broken\n{"id": 2, "t": "é"}\n', encoding="utf-8")
    assert [r.id for r in files.read_jsonl(spark, str(path), "id long, t string").orderBy("id").collect()] == [1, 2]
    told = files.read_jsonl_reporting(spark, str(path), "id long, t string").collect()
    assert [r["__bad"] for r in told if r["__bad"]] == ["{broken"] and len(told) == 3
    files.append_jsonl(fixed_rows(spark, "id long, t string", (3, None)), str(tmp_path / "out"))
    files.append_jsonl(fixed_rows(spark, "id long, t string", (4, "y")), str(tmp_path / "out"))
    assert {r.id: r.t for r in files.read_jsonl(spark, str(tmp_path / "out"), "id long, t string").collect()} == {3: None, 4: "y"}


def test_splits(spark, tmp_path):
    rows = fixed_rows(spark, "id long, split string", (1, "train"), (2, "validation"), (3, "train"))
    files.write_splits(rows, str(tmp_path / "final"))
    assert sorted(tuple(r) for r in files.read_splits(spark, str(tmp_path / "final"), "id long").collect()) == [(1, "train"), (2, "validation"), (3, "train")]


def test_references(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "q1", "prompt": " Do it "}\n{"text": ""}\n{"question": "Why?"}\n')
    (tmp_path / "b.json").write_text(json.dumps({"x": [{"task": "one", "uuid": 7}, "two"], "y": {"z": [{"name": "n", "instruction": "three", "text": "no"}]}}))
    (tmp_path / "c.txt").write_text("first\n\n second \n")
    read = lambda n: [tuple(r) for r in files.read_references(spark, str(tmp_path / n)).collect()]
    assert read("a.jsonl") == [("extra/a.jsonl/q1", "Do it"), ("extra/a.jsonl/2", "Why?")]
    assert read("b.json") == [("extra/b.json/7", "one"), ("extra/b.json/root/x/1", "two"), ("extra/b.json/n", "three")]
    assert read("c.txt") == [("extra/c.txt/0", "first"), ("extra/c.txt/2", "second")]


def test_task_lists(spark):
    pairs = fixed_rows(spark, "j string", ('[["os/1", "do"], ["os/2", "see"]]',))
    objects = fixed_rows(spark, "j string", ('[{"task_id": "a", "domain": "d", "instruction": "i"}, {"task_id": "b"}]',))
    assert [tuple(r) for r in files.task_list(pairs, "j").collect()] == [("os/1", "os", "do"), ("os/2", "os", "see")]
    assert [tuple(r) for r in files.task_list(objects, "j").collect()] == [("a", "d", "i"), ("b", "", "")]
    bundle = fixed_rows(spark, "j string", (json.dumps({"os": [{"id": "1", "instruction": "do"}, {"instruction": "see"}, {"id": "3"}]}),))
    assert [tuple(r) for r in files.bundle(bundle, "j").collect()] == [("os/1", "do"), ("os/os_1", "see")]


def test_file_trees(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 640, 480) + b"\x08\x02\0\0\0"
    webp = b"RIFF\0\0\0\0WEBPVP8X" + b"\x0a\0\0\0" + b"\0\0\0\0" + (1599).to_bytes(3, "little") + (899).to_bytes(3, "little")
    for name, raw in {"images/a.png": png, "images/b.webp": webp, "x/c.txt": b"hi"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    found = files.files(spark, str(tmp_path))
    assert {r.path: (tuple(r.p) if r.p else None, tuple(r.w) if r.w else None) for r in found.select("path", png_size(F.col("content")).alias("p"), webp_size(F.col("content")).alias("w")).collect()} == {
        "images/a.png": ((640, 480), None), "images/b.webp": (None, (1600, 900)), "x/c.txt": (None, None)
    }
    lines = files.sums(found).collect()
    assert [r.value for r in lines][2] == f"{hashlib.sha256(b'hi').hexdigest()}  x/c.txt"
    listed = spark.createDataFrame([(r.value,) for r in lines] + [("0" * 64 + "  gone",)], "value string")
    (tmp_path / "x/c.txt").write_bytes(b"changed")
    assert {r.path: r.status for r in files.verify_sums(listed, files.files(spark, str(tmp_path))).collect()} == {"images/a.png": "ok", "images/b.webp": "ok", "x/c.txt": "changed", "gone": "missing"}
    whole = tree_hash(files.files(spark, str(tmp_path / "images")), "path", "bytes", "sha256").first()
    want = "".join(f"{n}\t{len(b)}\t{hashlib.sha256(b).hexdigest()}\n" for n, b in (("a.png", png), ("b.webp", webp)))
    assert whole.tree_sha256 == hashlib.sha256(want.encode()).hexdigest() and whole.files == 2


def test_ledgers(spark):
    units = fixed_rows(spark, "u string", ("a",), ("b",))
    assert [r.u for r in files.undone(units, fixed_rows(spark, "u string", ("a",), ("a",)), ["u"]).collect()] == ["b"]
    catalog = fixed_rows(spark, "repository string, revision string", ("r", "abc"), ("s", None))
    assert files.pinned(catalog, "r").count() == 1 and [x.repository for x in files.unresolved(catalog).collect()] == ["s"]
