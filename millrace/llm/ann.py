"""Embedding near-duplicates with hierarchical navigable small-world graphs.

Vectors of one label are dealt into shards, and every shard gets a graph:
layers of nodes, each with links to diverse near neighbours, the upper layers
thinning out. Every vector is searched for in every shard of its label, from
the top layer down, with a beam that keeps the best nodes met. A beam that
fills with links is widened, up to the whole shard; then a recall audit
compares a sample of the queries with brute force and widens all beams until
it passes. The sample grows until it holds enough links of a vector with
another; where a search has fewer, it grows to all queries, so that recall is
measured on all there are. The graph is searched at every size: the first beam
is at most a quarter of the shard (``LEAST_BEAM`` at least), and only where
widening asks for an eighth or more are those queries compared with all. Found
pairs are verified in double precision, and the links are united into components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Stage, connected_components, star_labels

#: Distinct vectors in a shard, about.
SHARD = 8192
LINKS = 16
BEAM, LEAST_BEAM = 64, 4
#: Queries that the audit adds to its sample at once, links that the sample must hold, and the recall asked for.
AUDIT, AUDIT_LINKS, RECALL = 256, 256, 0.99
_BATCH = 256


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    big = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(big > 0, big, 1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _diverse(sim: np.ndarray, cand: np.ndarray, vec: np.ndarray, keep: int) -> np.ndarray:
    """Choose up to ``keep`` of the candidates of each row (-1: none), best first.

    A candidate nearer to one already chosen than to the row waits; places left
    over go to those that waited.
    """
    order = np.argsort(-np.where(cand < 0, -9, sim), axis=1, kind="stable")
    sim, cand = np.take_along_axis(sim, order, 1), np.take_along_axis(cand, order, 1)
    near = np.einsum("bid,bjd->bij", vec[cand], vec[cand])
    n, c = cand.shape
    chosen, count = np.zeros((n, c), bool), np.zeros(n, int)
    for k in range(c):
        block = np.where(chosen, near[:, k, :], -9).max(axis=1)
        ok = (cand[:, k] >= 0) & (sim[:, k] > block) & (count < keep)
        chosen[:, k] = ok
        count += ok
    rank = np.where(cand < 0, 2 * c, np.where(chosen, 0, c)) + np.arange(c)
    best = np.argsort(rank, axis=1)[:, :keep]
    return np.take_along_axis(cand, best, 1)


def _beam(q: np.ndarray, entry: np.ndarray, vec: np.ndarray, links: np.ndarray, width: int, step: int = 4):
    """(ids, similarities) of the beam of each query; ids are -1 where unused."""
    n, m = len(q), len(vec)
    seen = np.zeros((n, m + 1), bool)
    seen[:, m] = True
    rows = np.arange(n)[:, None]
    ids = np.full((n, max(width, entry.shape[1])), -1)
    sims = np.full(ids.shape, -9, np.float32)
    ids[:, : entry.shape[1]] = entry
    sims[:, : entry.shape[1]] = np.where(entry < 0, -9, np.einsum("bd,bkd->bk", q, vec[entry]))
    seen[rows, np.where(entry < 0, m, entry)] = True
    open_ = ids >= 0
    live = np.arange(n)
    while len(live):
        score = np.where(open_[live], sims[live], -9)
        top = np.argpartition(-score, min(step, score.shape[1] - 1), axis=1)[:, :step] if score.shape[1] > step else np.tile(np.arange(score.shape[1]), (len(live), 1))
        use = np.take_along_axis(score, top, 1) > -9
        some = use.any(axis=1)
        live, top, use = live[some], top[some], use[some]
        if not len(live):
            break
        at = np.where(use, np.take_along_axis(ids[live], top, 1), -1)
        marks = open_[live]
        np.put_along_axis(marks, top, False, 1)
        open_[live] = marks
        nxt = np.where(at[:, :, None] < 0, -1, links[at]).reshape(len(live), -1)
        nxt = np.sort(np.where(nxt < 0, m, nxt), axis=1)
        fresh = ~seen[live[:, None], nxt]
        fresh[:, 1:] &= nxt[:, 1:] != nxt[:, :-1]
        seen[live[:, None], nxt] = True
        r, c = np.nonzero(fresh)
        new_ids = np.full(nxt.shape, -1)
        new_sims = np.full(nxt.shape, -9, np.float32)
        new_ids[r, c] = nxt[r, c]
        new_sims[r, c] = np.einsum("kd,kd->k", q[live[r]], vec[nxt[r, c]])
        all_ids, all_sims = np.concatenate([ids[live], new_ids], 1), np.concatenate([sims[live], new_sims], 1)
        all_open = np.concatenate([open_[live], new_ids >= 0], 1)
        best = np.argpartition(-all_sims, ids.shape[1] - 1, axis=1)[:, : ids.shape[1]]
        ids[live], sims[live], open_[live] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_sims, all_open))
    return ids, sims


class Graph:
    """A hierarchical navigable small-world graph over unit vectors.

    Nodes are in a fixed shuffled order; a layer holds the first ``size`` of
    them, so that the upper layers are prefixes of the lower ones.
    """

    def __init__(self, vec: np.ndarray, layers: list[np.ndarray]):
        self.vec, self.layers = vec, layers

    @staticmethod
    def build(vec: np.ndarray, links: int = LINKS, beam: int = BEAM) -> "Graph":
        sizes = [len(vec)]
        while sizes[-1] > 4 * links:
            sizes.append(-(-sizes[-1] // links))
        graph = Graph(vec, [])
        for level, size in enumerate(reversed(sizes)):
            base = level == len(sizes) - 1
            graph.layers.append(graph._layer(size, 2 * links if base else links, links, beam))
        return graph

    def _layer(self, size: int, most: int, links: int, beam: int) -> np.ndarray:
        table = np.full((size, most), -1)
        done = 0
        while done < size:
            upto = min(size, done + max(32, min(done, 2 * _BATCH)))
            new = np.arange(done, upto)
            q = self.vec[new]
            peers = np.where(np.tri(len(new), k=-1, dtype=bool), new[None, :], -1)  # earlier ones of the batch
            near = q @ q.T
            near = np.where(peers >= 0, near, -9)
            k = min(links, len(new))
            at = np.argpartition(-near, k - 1, axis=1)[:, :k]
            cand, sim = np.take_along_axis(peers, at, 1), np.take_along_axis(near, at, 1)
            if done:
                ids, sims = [], []
                for i in range(0, len(new), _BATCH):
                    entry = self._descend(q[i : i + _BATCH], min(4, done)) if self.layers else np.zeros((len(q[i : i + _BATCH]), 1), int)
                    a, b = _beam(q[i : i + _BATCH], np.where(entry < done, entry, 0), self.vec[:done], table[:done], min(beam, done))
                    ids.append(a)
                    sims.append(b)
                cand, sim = np.concatenate([cand, np.concatenate(ids)], 1), np.concatenate([sim, np.concatenate(sims)], 1)
            if cand.shape[1] > 3 * links:
                best = np.argpartition(-sim, 3 * links, axis=1)[:, : 3 * links]
                cand, sim = np.take_along_axis(cand, best, 1), np.take_along_axis(sim, best, 1)
            chosen = _diverse(sim, cand, self.vec, links)
            table[new, : chosen.shape[1]] = chosen
            src = np.repeat(new, chosen.shape[1])[chosen.ravel() >= 0]
            dst = chosen.ravel()[chosen.ravel() >= 0]
            self._back(table, dst, src)
            done = upto
        return table

    def _back(self, table: np.ndarray, dst: np.ndarray, src: np.ndarray) -> None:
        """Add links dst -> src; a full list keeps its diverse best."""
        while len(dst):
            order = np.argsort(dst, kind="stable")
            dst, src = dst[order], src[order]
            first = np.concatenate([[True], dst[1:] != dst[:-1]])
            nth = np.arange(len(dst)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            take = nth < 16
            at, where = np.unique(dst[take], return_inverse=True)
            extra = np.full((len(at), 16), -1)
            extra[where, nth[take]] = src[take]
            cand = np.concatenate([table[at], extra], 1)
            room = (cand >= 0).sum(1) <= table.shape[1]
            packed = np.take_along_axis(cand, np.argsort(cand < 0, axis=1, kind="stable"), 1)
            table[at[room]] = packed[room, : table.shape[1]]
            full = np.flatnonzero(~room)
            for i in range(0, len(full), _BATCH):
                rows = full[i : i + _BATCH]
                sim = np.einsum("bd,bkd->bk", self.vec[at[rows]], self.vec[cand[rows]])
                table[at[rows]] = _diverse(np.where(cand[rows] < 0, -9, sim), cand[rows], self.vec, table.shape[1])
            dst, src = dst[~take], src[~take]

    def _descend(self, q: np.ndarray, keep: int) -> np.ndarray:
        """The best nodes of the last finished layer."""
        entry = np.zeros((len(q), 1), int)
        for table in self.layers:
            ids, sims = _beam(q, entry, self.vec[: len(table)], table, min(8, len(table)))
            best = np.argsort(-sims, axis=1)[:, :keep]
            entry = np.take_along_axis(ids, best, 1)
        return entry

    def search(self, q: np.ndarray, width: int):
        out = []
        base = self.layers[-1]
        upper = Graph(self.vec, self.layers[:-1])
        for i in range(0, len(q), _BATCH):
            part = q[i : i + _BATCH]
            entry = upper._descend(part, 4) if upper.layers else np.zeros((len(part), 1), int)
            out.append(_beam(part, entry, self.vec, base, min(width, len(self.vec))))
        return [np.concatenate(x) for x in zip(*out)]


def close_rows(graph: Graph, q: np.ndarray, least: float, own: bool = False, audit: int = AUDIT, recall: float = RECALL, beam: int = BEAM):
    """(query row, node) of pairs that may reach cosine ``least``, by widening beams.

    With ``own`` the queries are the nodes; a node's pair with itself is left out.
    The links that the audit's brute force met are among the pairs.
    """
    n, edge = len(graph.vec), least - 1e-5
    scan = lambda rows: [(rows[i : i + 64][r], c) for i in range(0, len(rows), 64) for r, c in [np.nonzero(q[rows[i : i + 64]] @ graph.vec.T >= edge)]]
    order, probed, truth = np.random.default_rng(len(q)).permutation(len(q)), 0, np.zeros(0, int)
    while probed < len(q) and len(truth) < AUDIT_LINKS:
        probe = order[probed : probed + audit]
        truth = np.concatenate([truth, *[a * n + b for a, b in ((a[a != b], b[a != b]) if own else (a, b) for a, b in scan(probe))]])
        probed += len(probe)
    width = first = min(beam, max(LEAST_BEAM, n // 4))
    while True:
        pairs, todo, wide = [], np.arange(len(q)), width
        while len(todo):
            if wide >= n or (wide > first and 8 * wide >= n):  # a widened beam of that size costs more than comparing with all
                pairs += scan(todo)
                break
            ids, sims = graph.search(q[todo], wide)
            hit = sims >= edge
            full = hit.sum(axis=1) * 2 > wide
            r, c = np.nonzero(hit & ~full[:, None])
            pairs.append((todo[r], ids[r, c]))
            todo, wide = todo[full], 4 * wide
        a, b = (np.concatenate([p[k] for p in pairs]) for k in (0, 1)) if pairs else (np.zeros(0, int), np.zeros(0, int))
        links = (a * n + b)[a != b] if own else a * n + b
        if not len(truth) or np.isin(truth, links).mean() >= recall or width >= n:
            links = np.union1d(links, truth)
            return links // n, links % n
        width *= 4


def _verified(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, least: float):
    keep = np.zeros(len(a), bool)
    for i in range(0, len(a), 1 << 16):
        s = slice(i, i + (1 << 16))
        keep[s] = np.einsum("kd,kd->k", x[a[s]], y[b[s]]) >= least
    return a[keep], b[keep]


def _freeze(node, count, raw, graph: Graph) -> bytes:
    head = np.array([len(raw), raw.shape[1], len(graph.layers), *[v for t in graph.layers for v in t.shape]], np.int64)
    parts = [np.array([len(head)], np.int64), head, node, count, raw, *[t.astype(np.int32) for t in graph.layers]]
    return b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def _thaw(blob: bytes):
    k = int(np.frombuffer(blob, np.int64, 1)[0])
    head = np.frombuffer(blob, np.int64, k, 8)
    n, d, layers = head[:3].tolist()
    at = 8 + 8 * k
    node, count = np.frombuffer(blob, np.int64, n, at), np.frombuffer(blob, np.int64, n, at + 8 * n)
    at += 16 * n
    raw = np.frombuffer(blob, np.float64, n * d, at).reshape(n, d)
    at += 8 * n * d
    tables = []
    for i in range(layers):
        shape = head[3 + 2 * i : 5 + 2 * i].tolist()
        tables.append(np.frombuffer(blob, np.int32, shape[0] * shape[1], at).reshape(shape).astype(np.int64))
        at += 4 * shape[0] * shape[1]
    exact = unit(raw)
    return node, count, exact, Graph(exact.astype(np.float32), tables)


def near_duplicates(df: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", shard: int = SHARD) -> DataFrame:
    """Near-duplicate vectors of equal labels by cosine.

    Returns (vec_id, n_links, component_id, kept) for every row: the number of
    other vectors linked directly, the smallest id reachable over links, and
    whether that is the vector itself.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, nor do rows with a null label or id; vectors of other
    lengths never link with each other. Equal vectors are collapsed before the
    search and counted with their number, so a group of copies costs one node;
    repeated rows are such copies. Other columns are ignored; an empty table
    gives no rows.
    """
    stage = Stage(df.sparkSession, "vectors")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    able = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("able", able)
    points = stage.put(rows.where("able").groupBy("label", "v").agg(F.count("*").alias("n"), F.min("id").alias("node")))
    sizes = points.groupBy("label", F.size("v").alias("d")).agg(F.ceil(F.count("*") / shard).cast("long").alias("shards"))
    dealt = points.withColumn("d", F.size("v")).join(sizes, ["label", "d"]).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")))
    label = df.schema[label_col].dataType.simpleString()

    def build(table):
        node = table["node"].to_numpy()
        order = np.argsort((node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0x5BF03635), kind="stable")
        raw = np.stack(table["v"].to_numpy())[order].astype(np.float64)
        graph = Graph.build(unit(raw).astype(np.float32))
        blob = _freeze(node[order], table["n"].to_numpy().astype(np.int64)[order], raw, graph)
        return pa.table({**{c: table[c].slice(0, 1) for c in ("label", "d", "shards", "shard")}, "blob": pa.array([blob], pa.binary())})

    graphs = stage.put(
        dealt.select("label", "d", "shards", "shard", "node", "n", "v").groupBy("label", "d", "shards", "shard")
        .applyInArrow(build, f"label {label}, d int, shards long, shard long, blob binary")
    )
    # every shard of a label meets every other once, and itself
    met = graphs.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).select(
        "label", "d", F.least("shard", "other").alias("i"), F.greatest("shard", "other").alias("j"), "shard", "blob"
    )

    def search(table):
        blobs = [x for _, x in sorted(zip(table["shard"].to_pylist(), table["blob"].to_pylist()))]
        node, count, exact, graph = _thaw(blobs[0])
        own = len(blobs) == 1
        node2, count2, exact2, graph2 = (node, count, exact, graph) if own else _thaw(blobs[1])
        b, a = close_rows(graph, graph2.vec, least, own)
        a, b = _verified(exact, exact2, a, b, least)
        if own:
            pair = np.unique(np.concatenate([a * len(node) + b, b * len(node) + a]))
            a, b = pair // len(node), pair % len(node)
            a, b = a[a != b], b[a != b]
            links = np.bincount(a, count[b], len(node))
            nodes = node
        else:
            links = np.concatenate([np.bincount(a, count2[b], len(node)), np.bincount(b, count[a], len(node2))])
            nodes = np.concatenate([node, node2])
            b = b + len(node)
        order = np.argsort(nodes, kind="stable")
        place = np.empty(len(nodes), np.int64)
        place[order] = np.arange(len(nodes))
        root = nodes[order][star_labels(len(nodes), place[a], place[b])][place]
        some = links > 0
        return pa.table({"node": nodes[some], "links": links[some].astype(np.int64), "root": root[some]})

    found = stage.put(met.groupBy("label", "d", "i", "j").applyInArrow(search, "node long, links long, root long"))
    named = connected_components(stage, found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = stage.put(
        points.join(degree, "node", "left").join(named, "node", "left")
        .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "node").alias("component"), F.lit(True).alias("able"))
    )
    return rows.join(known, ["label", "v", "able"], "left").select(
        F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"), F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept"),
    )
