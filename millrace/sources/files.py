"""Scans and sinks: JSON lines, references, task lists, file trees."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.actions import arrow_function
from millrace.functions.text import strip

TEXT_KEYS = ("instruction", "prompt", "task", "question", "text")
ID_KEYS = ("id", "task_id", "uuid", "name")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; blank and malformed lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_jsonl_reporting(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines with ``__bad``: the text of a line that is malformed, else null."""
    return spark.read.schema(schema + ", __bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__bad").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append rows as JSON lines; the commit protocol makes the append whole or nothing."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder of JSON lines per split."""
    df.write.mode("overwrite").partitionBy(split).json(path)


def read_splits(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of all splits with the column ``split``; a split without files has none."""
    return spark.read.schema(schema).json(path)


def undone(units: DataFrame, ledger: DataFrame, key: list[str]) -> DataFrame:
    """Units of work that the ledger does not hold."""
    return units.join(ledger.select(*key).distinct(), key, "left_anti")


def pinned(catalog: DataFrame, repository: str) -> DataFrame:
    """The pinned revision of a repository; rows without one are unresolved."""
    return catalog.where((F.col("repository") == repository) & (F.coalesce(F.col("revision"), F.lit("")) != ""))


def unresolved(catalog: DataFrame) -> DataFrame:
    return catalog.where(F.coalesce(F.col("revision"), F.lit("")) == "")


# --- references and task lists ---


def _text(x) -> str:
    if isinstance(x, str):
        return x.strip()
    named = [x.get(k) for k in TEXT_KEYS] if isinstance(x, dict) else []
    return next((v.strip() for v in named if isinstance(v, str) and v.strip()), "")


def _id(x, other: str) -> str:
    named = [x.get(k) for k in ID_KEYS] if isinstance(x, dict) else []
    return next((str(v) for v in named if v is not None), other)


def walk(value) -> list[tuple[str, str]]:
    """(id, text) of all instructions in nested JSON, breadth first; what has a text is not searched further."""
    level, out = [("root", value)], []
    while level:
        deeper = []
        for place, x in level:
            if said := _text(x):
                out.append((_id(x, place), said))
            elif isinstance(x, list):
                deeper += [(f"{place}/{i}", v) for i, v in enumerate(x)]
            elif isinstance(x, dict):
                deeper += [(f"{place}/{k}", v) for k, v in x.items() if isinstance(v, (list, dict))]
        level = deeper
    return out


def read_references(spark: SparkSession, path: str) -> DataFrame:
    """(task_id, instruction) of a .jsonl, .json or text file; ids start with ``extra/`` and the file's name."""
    base = path.rstrip("/").rpartition("/")[2]
    pair = "array<struct<id:string,text:string>>"
    if base.endswith(".json"):
        whole = spark.read.text(path, wholetext=True)
        found = whole.select(F.explode(arrow_function(pair, lambda t: [{"id": i, "text": s} for i, s in walk(json.loads(t))], F.col("value"))).alias("x"))
        rows = found.select("x.id", "x.text")
    else:
        lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r\n|\n")).alias("at", "value")).where(strip(F.col("value")) != "")
        if base.endswith(".jsonl"):
            def read(at, line):
                x = json.loads(line)
                return [{"id": _id(x, str(at)), "text": _text(x)}]

            rows = lines.select(F.explode(arrow_function(pair, read, F.col("at"), F.col("value"))).alias("x")).select("x.id", "x.text").where("text != ''")
        else:
            rows = lines.select(F.col("at").cast("string").alias("id"), strip(F.col("value")).alias("text"))
    return rows.select(F.concat(F.lit(f"extra/{base}/"), F.col("id")).alias("task_id"), F.col("text").alias("instruction"))


def bundle(df: DataFrame, json_col: str) -> DataFrame:
    """(task_id, instruction) of JSON {domain: [{id, instruction}]}; tasks without an instruction are dropped."""
    tasks = F.from_json(json_col, "map<string,array<struct<id:string,instruction:string>>>")
    rows = df.select(F.explode(tasks).alias("domain", "tasks")).select("domain", F.posexplode("tasks").alias("n", "t"))
    named = F.coalesce(F.when(F.col("t.id") != "", F.col("t.id")), F.concat_ws("_", "domain", F.col("n").cast("string")))
    return rows.where(F.coalesce(F.col("t.instruction"), F.lit("")) != "").select(F.concat_ws("/", "domain", named).alias("task_id"), F.col("t.instruction").alias("instruction"))


def task_list(df: DataFrame, json_col: str) -> DataFrame:
    """(task_id, domain, instruction) of a JSON list of objects or of [id, instruction] pairs."""
    text = F.trim(F.col(json_col))
    objects = F.from_json(text, "array<struct<task_id:string,domain:string,instruction:string>>")
    pairs = F.transform(
        F.from_json(text, "array<array<string>>"),
        lambda p: F.struct(F.get(p, 0).alias("task_id"), F.substring_index(F.get(p, 0), "/", 1).alias("domain"), F.get(p, 1).alias("instruction")),
    )
    blank = lambda x: F.coalesce(x, F.lit(""))
    rows = df.select(F.explode(F.when(text.rlike(r"^\[\s*\["), pairs).otherwise(objects)).alias("t"))
    return rows.select("t.task_id", blank(F.col("t.domain")).alias("domain"), blank(F.col("t.instruction")).alias("instruction")).where("task_id IS NOT NULL")


# --- file trees ---


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path below the folder, bytes, sha256, content) of every file of a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    bare = path.rstrip("/").partition(":")[2].lstrip("/") if ":" in path else path.strip("/")
    below = F.substring_index(F.col("path"), bare + "/", -1)
    return found.select(below.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), "content")


def sums(df: DataFrame) -> DataFrame:
    """Checksum lines, ``digest  path``, by path."""
    return df.orderBy("path").select(F.concat_ws("  ", "sha256", "path").alias("value"))


def verify_sums(lines: DataFrame, df: DataFrame) -> DataFrame:
    """(path, status) of every listed file: ok, changed or missing."""
    listed = lines.select(F.substring_index("value", "  ", 1).alias("want"), F.regexp_extract("value", r"^\S+  (.*)$", 1).alias("path"))
    status = F.when(F.col("sha256").isNull(), "missing").when(F.col("want") == F.col("sha256"), "ok").otherwise("changed")
    return listed.join(df.select("path", "sha256"), "path", "left").select("path", status.alias("status"))


def hygiene(df: DataFrame, text: Column, suffixes: tuple[str, ...], patterns: tuple[str, ...], most: int = 5 << 20) -> DataFrame:
    """(path, problem) of files that should not be published."""
    p = F.lower("path")
    wrong = F.lit(False)
    for s in suffixes:
        wrong = wrong | p.endswith(s)
    told = F.lit(False)
    for s in patterns:
        told = told | F.coalesce(text.rlike(s), F.lit(False))
    found = F.array_compact(F.array(
        F.when(wrong, F.lit("forbidden_suffix")), F.when(F.substring_index(p, "/", -1).rlike(r"^\.env"), F.lit("environment_file")),
        F.when(F.col("bytes") > most, F.lit("too_large")), F.when(told, F.lit("secret")),
    ))
    return df.select("path", F.explode(found).alias("problem"))
