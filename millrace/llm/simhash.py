"""SimHash near-duplicate groups through a vantage-point tree.

Fingerprints are metric points under Hamming distance. A tree of vantage
points, fitted on a bounded sample, partitions them into shards: a point goes
to the near side of a node when its distance to the vantage point is at most
the node's radius, else to the far side. By the triangle inequality a pair
within ``radius`` bits can only be parted by a node whose shell both points
touch, so a point close to a shell also visits the other side. Each shard
then joins its own points with themselves and its visitors, again by
vantage-point recursion, and every pair is verified exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Stage, connected_components, star_labels

#: Fingerprints the vantage tree is fitted on, at most.
SAMPLE = 1 << 20
#: Distinct fingerprints a shard owns, about.
SHARD = 2048


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text; 0 without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < width:
        marks = [xxhash.xxh64_digest(joined, seed)]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        start = end - size
        digest = xxhash.xxh64_digest
        marks = [digest(joined[s:e], seed) for s, e in zip(start[: len(start) - width + 1].tolist(), end[width - 1 :].tolist())]
    n, ones = len(marks), np.zeros(64, np.int64)
    raw = np.frombuffer(b"".join(marks), np.uint8).reshape(n, 8)
    for i in range(0, n, 16384):
        ones += np.unpackbits(raw[i : i + 16384], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, fp) for every row; fp is the signed view of the 64 bits."""

    def run(batches):
        for rows in batches:
            marks = np.fromiter((fingerprint(x.as_py()) for x in rows.column(1)), np.uint64, len(rows))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(marks.view(np.int64))], names=["id", "fp"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, "id long, fp long")


@dataclass
class Vantage:
    """Nodes of the top tree; a negative child -1-s is shard s."""

    point: np.ndarray
    radius: np.ndarray
    near: np.ndarray
    far: np.ndarray
    shards: int

    @staticmethod
    def fit(sample: np.ndarray, depth: int) -> "Vantage":
        point, radius, near, far = [], [], [], []
        shards = 0

        def grow(at: np.ndarray, left: int) -> int:
            nonlocal shards
            if left and len(at) > 1:
                tries = at[:: max(1, len(at) // 8)][:8]
                spread = [np.bitwise_count(at[:512] ^ v).astype(int).std() for v in tries]
                v = tries[int(np.argmax(spread))]
                d = np.bitwise_count(at ^ v)
                r = int(np.median(d))
                if (d <= r).all():
                    r = int(d.max()) - 1
                if (d <= r).any():
                    k = len(point)
                    point.append(v)
                    radius.append(r)
                    near.append(0)
                    far.append(0)
                    near[k] = grow(at[d <= r], left - 1)
                    far[k] = grow(at[d > r], left - 1)
                    return k
            shards += 1
            return -shards

        top = grow(sample, depth)
        assert top == 0 or not point
        return Vantage(np.array(point, np.uint64), np.array(radius, np.int64), np.array(near, np.int64), np.array(far, np.int64), shards)

    def route(self, fp: np.ndarray, reach: int):
        """(row, shard, home) for each shard a point owns or visits."""
        out = []

        def walk(node: int, own: np.ndarray, visit: np.ndarray) -> None:
            if not len(own) and not len(visit):
                return
            if node < 0:
                rows = np.concatenate([own, visit])
                home = np.zeros(len(rows), bool)
                home[: len(own)] = True
                out.append((rows, np.full(len(rows), -1 - node), home))
                return
            (no, nv), (fo, fv) = sides(fp, own, visit, self.point[node], self.radius[node], reach)
            walk(int(self.near[node]), no, nv)
            walk(int(self.far[node]), fo, fv)

        walk(0 if len(self.point) else -1, np.arange(len(fp)), np.zeros(0, np.int64))
        return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]


def sides(fp, own, visit, point, radius, reach):
    """Owned and visiting rows of the near and of the far side of a node.

    A far-owned point visits the near side when it is within ``reach`` of the
    shell; that meets each parted pair once, so near-owned points need not
    visit the far side. Visitors go wherever an owned partner may be.
    """
    d, e = np.bitwise_count(fp[own] ^ point).astype(np.int64), np.bitwise_count(fp[visit] ^ point).astype(np.int64)
    far = d > radius
    near = own[~far], np.concatenate([own[far & (d <= radius + reach)], visit[e <= radius + reach]])
    return near, (own[far], visit[e > radius - reach])


def close_pairs(fp: np.ndarray, own: np.ndarray, visit: np.ndarray, reach: int, a: list, b: list) -> None:
    """Append the rows of every pair own-own and own-visit within reach bits."""
    if not len(own):
        return
    if len(own) * (len(own) + len(visit)) > 1 << 17:
        point = fp[own[0]]
        d = np.bitwise_count(fp[own] ^ point)
        r = int(np.median(d))
        if (d <= r).all():
            r = int(d.max()) - 1
        if r >= 0 and (d <= r).any():
            (no, nv), (fo, fv) = sides(fp, own, visit, point, r, reach)
            if len(no) < len(own) and len(fo) < len(own):
                close_pairs(fp, no, nv, reach, a, b)
                close_pairs(fp, fo, fv, reach, a, b)
                return
    every = np.concatenate([own, visit])
    step = max(1, (1 << 20) // len(every))
    for i in range(0, len(own), step):
        x, y = np.nonzero(np.bitwise_count(fp[own[i : i + step], None] ^ fp[None, every]) <= reach)
        a.append(own[i : i + step][x])
        b.append(every[y])


def shard_edges(fp: np.ndarray, node: np.ndarray, home: np.ndarray, reach: int):
    """Spanning stars (node, smallest node) of the close pairs met in a shard."""
    order = np.argsort(node, kind="stable")
    fp, node, home = fp[order], node[order], home[order]
    a: list = []
    b: list = []
    close_pairs(fp, np.flatnonzero(home), np.flatnonzero(~home), reach, a, b)
    empty = np.zeros(0, np.int64)
    x, y = (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)
    label = star_labels(len(fp), x[x != y], y[x != y])
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return node[moved], node[label[moved]]


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Near-duplicate groups of texts by SimHash.

    Returns (doc_id, fingerprint, component_id) for every input row:
    fingerprints are linked when they differ in at most ``radius`` bits, and
    component_id is the smallest id reachable over links.

    Exact copies share a fingerprint and are collapsed by a combining
    aggregation before anything is compared, so a group of copies costs one
    point. Null, empty and wordless texts have fingerprint 0 and link like any
    other. Repeated rows are all returned. A null id stays in the result, takes
    the component of its fingerprint and never names one. Other columns of the
    input are ignored. An empty table gives an empty result.
    """
    spark = df.sparkSession
    stage = Stage(spark, "simhash")
    marks = stage.put(fingerprints(df, id_col, text_col))
    reps = stage.put(marks.groupBy("fp").agg(F.min("id").alias("node")))
    known = reps.where("node IS NOT NULL")
    n = known.count()
    depth = max(0, int(np.ceil(np.log2(max(1, n / shard)))))
    want = min(sample, 64 << depth)
    drawn = known.select("fp").orderBy(F.xxhash64("fp")).limit(want) if n > want else known.select("fp")
    tree = Vantage.fit(np.sort(np.array([r.fp for r in drawn.toLocalIterator()], np.int64)).view(np.uint64), depth)

    def route(batches):
        for rows in batches:
            fp = rows.column(0).to_numpy()
            row, part, home = tree.route(fp.view(np.uint64), radius)
            node = rows.column(1).to_numpy()
            for i in range(0, len(row), 1 << 16):
                at = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(part[at]), pa.array(fp[row[at]]), pa.array(node[row[at]]), pa.array(home[at])], names=["shard", "fp", "node", "home"])

    def join(table: pa.Table) -> pa.Table:
        a, b = shard_edges(table["fp"].to_numpy().view(np.uint64), table["node"].to_numpy(), table["home"].to_numpy(), radius)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = known.select("fp", "node").mapInArrow(route, "shard long, fp long, node long, home boolean")
    found = connected_components(stage, dealt.groupBy("shard").applyInArrow(join, "a long, b long"))
    named = stage.put(
        reps.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    )
    return marks.join(named, "fp").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
