"""Exact repeated-passage removal with Burrows-Wheeler interval expansion.

A byte goes when it is covered by a ``length``-byte string that also starts
earlier. Three steps make that a distributed job:

1. *Cut.* Every window of ``length`` bytes is filed under the smallest hash of
   the ``GRAM``-byte strings inside it, which depends on its content alone, so
   equal windows anywhere share a key. Neighbouring windows that take their key
   from one place, the leftmost of equal ones, form a fragment; so two equal
   windows are never in one fragment. Keys that occur once cannot repeat.
   Fragments with equal hashes are taken for copies of the earliest, their
   leader: only leaders are compared with other fragments of their key, and a
   copy is compared with its leader (within the task where it holds both, so
   that a group of copies is thinned out before the shuffle).
2. *Expand.* Fragments that meet are dealt into sets: leaders by their key,
   copies with the part of a document that holds their leaders, joined to runs
   and a bounded number of copies at a time. Per set the Burrows-Wheeler
   transform of all its strings is expanded
   backwards, breadth first: from the intervals of all strings of 8 bytes,
   every interval is extended to the left by each byte before it, and the right
   end of a new interval gets the current length as its common prefix unless it
   has one. Common prefixes thus appear in increasing order, and expansion
   stops at ``length``: boundaries without a value join suffixes that share
   ``length`` bytes, and of such a group all but the earliest are covered.
3. *Remove.* The covered spans of a document are united and cut out.

Matches never cross documents, since windows do not. Every span comes from an
expansion, which compares bytes: whatever is removed is a true repeat. By the
key every repeat meets an equal string, unless two different fragments agree in
all of 116 hash bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Stage, text_bytes
from millrace.llm.secretscan import _blocks, column_bytes

LENGTH, GRAM = 100, 32
#: Bytes of fragments in a shard, about.
SHARD = 1 << 19
#: Fragments of one key beyond which its windows are dealt by their own hash.
HOT = 20_000
#: Copies that are compared with their leader together, about, and bytes of the leading document.
COPIES, REACH = 16, 1 << 14
#: Longest ``length``.
MOST = 2048
#: Documents without an id take the ids from here on, by a hash of their text.
_NULL_ID = (1 << 63) - (1 << 60)
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _RANDOM.integers(1, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours along the last axis."""
    n, span = a.shape[-1] - width + 1, 1
    while 2 * span <= width:
        a = np.minimum(a[..., :-span], a[..., span:])
        span *= 2
    return np.minimum(a[..., :n], a[..., width - span : width - span + n]) if span < width else a[..., :n]


def _leftmost_min(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, place) of the least hash of every window, the leftmost where equal.

    The low 12 bits of a hash give way to its place in a row; rows overlap, so
    every window lies in one.
    """
    n, row = len(h) - width + 1, 4096
    step = row - width + 1
    rows = -(-n // step)
    h = np.concatenate([h, np.full(rows * step + width - 1 - len(h), ~np.uint64(0))]) if rows * step + width - 1 > len(h) else h
    place = np.uint64(row - 1)
    low = _sliding_min(np.lib.stride_tricks.sliding_window_view(h, row)[::step] & ~place | np.arange(row, dtype=np.uint64), width)
    at = (low & place).astype(np.int64) + (np.arange(rows) * step)[:, None]
    return (low & ~place).ravel()[:n], at.ravel()[:n]


def fragments(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text number, start, end, key) of the fragments of joined texts.

    ``end`` is exclusive and counts from the text's own start, as ``start``.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, np.zeros(0, np.uint64)
    h, span = _BYTE[data], 1
    for k in range(gram.bit_length() - 1):
        h = h[:-span] * _STEP[k] + h[span:]
        span *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    low, at = _leftmost_min(h, length - gram + 1)
    cut = np.zeros(len(low), bool)
    cut[0] = True
    cut[1:] = at[1:] != at[:-1]
    first, last = bounds[:-1], bounds[1:] - length + 1  # valid window starts of each text
    for edge in (first, np.maximum(last, first)):
        cut[edge[edge < len(low)]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(low))
    text = np.searchsorted(bounds, start, "right") - 1
    ok = start < last[text]
    start, end, text = start[ok], end[ok], text[ok]
    return text, start - first[text], end - 1 + length - first[text], low[start]


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, bytes of equal weight together, compressed."""
    n = len(columns[0])
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(n, 8).T.tobytes() for c in columns) if n else b""
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(blob: bytes, count: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n = len(raw) // (8 * count)
    return [np.ascontiguousarray(part.reshape(8, n).T).view(np.int64).ravel() for part in np.split(raw, count)]


def _spread(doc: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket for each document id."""
    return (doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % buckets


def merge_spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """The union of spans, per document, sorted."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    new_doc = np.concatenate([[True], doc[1:] != doc[:-1]])
    lift = (np.cumsum(new_doc) - 1) << 40
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate([[True], (start + lift)[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    stop = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], reach[stop] - lift[stop]


def listed(doc: np.ndarray, **columns: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Documents, and for each the list of its rows of the other columns."""
    order = np.argsort(doc, kind="stable")
    ids, count = np.unique(doc, return_counts=True)
    bounds = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    rows = pa.StructArray.from_arrays([pa.array(c[order], pa.int64()) for c in columns.values()], names=list(columns))
    return ids, pa.ListArray.from_arrays(pa.array(bounds), rows)


def collapse(key, print_, *rest):
    """Order by key, fragment and place (doc, start); (columns, first occurrence of each row, mask of copies)."""
    order = np.lexsort((rest[1], rest[0], print_, key))
    cols = [c[order] for c in (key, print_, *rest)]
    key, print_, doc, start = cols[:4]
    first = np.concatenate([[True], (key[1:] != key[:-1]) | (print_[1:] != print_[:-1])]) if len(key) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0)) if len(key) else np.zeros(0, int)
    later = (doc != doc[lead]) | (start != start[lead])  # a repeated row is not its own copy
    return cols, lead, later


def _mixed(x: np.ndarray) -> np.ndarray:
    h = x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(29)


def copy_sets(doc: np.ndarray, start: np.ndarray, lead: np.ndarray, later: np.ndarray):
    """(row, set) of copies and of their leaders: each copy shares a set with its leader.

    A set holds about ``COPIES`` copies of ``REACH`` bytes of a leading document.
    """
    copy = np.flatnonzero(later)
    head = lead[copy]
    many = -(-np.bincount(head, minlength=len(doc))[head] // COPIES)
    parts = 1 << np.ceil(np.log2(np.maximum(many, 1))).astype(np.int64)
    part = (_mixed(doc[copy]) >> np.uint64(20)).astype(np.int64) & (parts - 1)
    own = _mixed(_mixed(doc[head]).view(np.int64) + (start[head] // REACH)).view(np.int64)
    to = (_mixed(own + (parts << 32 | part)) >> np.uint64(1)).view(np.int64)
    order = np.lexsort((to, head))
    head, to2 = head[order], to[order]
    new = np.concatenate([[True], (head[1:] != head[:-1]) | (to2[1:] != to2[:-1])]) if len(head) else np.zeros(0, bool)
    return np.concatenate([copy, head[new]]), np.concatenate([to, to2[new]])


def joined_runs(to: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray):
    """(set, text, start, end): the spans of one set and text united."""
    order = np.lexsort((text, to))
    to, text = to[order], text[order]
    which = np.cumsum(np.concatenate([[False], (to[1:] != to[:-1]) | (text[1:] != text[:-1])])) if len(to) else to
    k, s, e = merge_spans(which, start[order], end[order])
    at = np.searchsorted(which, k)
    return to[at], text[at], s, e


def covered_locally(raw: bytes, to: np.ndarray, text: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray, length: int, shard: int):
    """Covered spans (doc, start, end) within sets whose strings a task holds; ``text`` is the place of each row's text in ``raw``."""
    to, base, s, e = joined_runs(to, text, start, end)
    at = np.argsort(text, kind="stable")
    doc = doc[at][np.searchsorted(text[at], base)]
    out = [np.zeros((3, 0), np.int64)]
    held = np.cumsum(e - s)
    edge = np.append(np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else np.zeros(0, np.int64), len(to))
    a = 0
    while a < len(to):
        b = int(edge[min(len(edge) - 1, np.searchsorted(edge, max(a + 1, np.searchsorted(held, (held[a - 1] if a else 0) + shard))))])
        parts = [raw[x:y] for x, y in zip((base[a:b] + s[a:b]).tolist(), (base[a:b] + e[a:b]).tolist())]
        out.append(np.stack(repeated_windows(parts, doc[a:b], s[a:b], length)))
        a = b
    return merge_spans(*np.concatenate(out, axis=1))


def repeated_windows(parts: list[bytes], doc: np.ndarray, start: np.ndarray, length: int = LENGTH):
    """Covered spans (doc, start, end) among fragments, by BWT interval expansion.

    ``doc`` and ``start`` place each fragment. A window is covered when an
    equal one has a smaller (doc, position).
    """
    none = np.zeros(0, np.int64)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    if not len(parts) or size.sum() < length:
        return none, none, none
    text = np.frombuffer(b"\xff".join(parts) + b"\xff" * 9, np.uint8)
    n = int(size.sum()) + len(parts)
    sa, rank, gram_start = suffix_order(text, n, length)
    before = text[sa - 1]
    lf = rank[sa - 1]  # the first place of those that begin alike for at least ``length`` bytes
    starts = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    inner = np.ones(n, bool)  # a fragment's first byte is not extended
    inner[starts] = False
    inner = inner[sa]
    run = np.cumsum(np.concatenate([[False], (before[1:] != before[:-1]) | ~inner[1:] | ~inner[:-1]]))
    known = np.zeros(n + 1, bool)
    known[gram_start] = True
    known[n] = True
    left = gram_start
    right = np.append(gram_start[1:], n) - 1
    for _ in range(8, length):
        one = run[left] == run[right]  # a single byte comes before: the interval moves as a whole
        l, r = left[one], right[one]
        ok = inner[l]
        wide = r[ok] - l[ok]
        l = lf[l[ok]]
        r = l + wide
        fresh = ~known[r + 1]
        l, r = l[fresh], r[fresh]
        many_l, many_r = left[~one], right[~one]
        if len(many_l):
            order = np.argsort(many_l)
            many_l, many_r = many_l[order], many_r[order]
            width = many_r - many_l + 1
            group = np.repeat(np.arange(len(width)), width)
            pos = np.arange(len(group)) + np.repeat(many_l - np.concatenate([[0], np.cumsum(width)[:-1]]), width)
            use = inner[pos]
            pos, group = pos[use], group[use]
            order = np.argsort(before[pos], kind="stable")  # equal bytes keep the order of their suffixes
            pos, tag = pos[order], (group << 8 | before[pos])[order]
            first = np.flatnonzero(np.concatenate([[True], tag[1:] != tag[:-1]])) if len(pos) else pos
            a = lf[pos[first]]
            b = a + np.diff(np.append(first, len(pos))) - 1
            fresh = ~known[b + 1]
            l, r = np.concatenate([l, a[fresh]]), np.concatenate([r, b[fresh]])
        left, right = l, r
        known[right + 1] = True
        if not len(left):
            break
    # suffixes between known boundaries share `length` bytes
    group = np.cumsum(known[:n]) - 1
    part = np.searchsorted(starts, sa, "right") - 1
    offset = sa - starts[part]
    room = offset + length <= size[part]
    count = np.bincount(group)
    room &= count[group] > 1
    group, part, offset = group[room], part[room], offset[room]
    if not len(group):
        return none, none, none
    docs, rank = np.unique(doc, return_inverse=True)
    place = rank[part] << 40 | (start[part] + offset)
    lead = np.concatenate([[True], group[1:] != group[:-1]])
    low = np.minimum.reduceat(place, np.flatnonzero(lead))[np.cumsum(lead) - 1]
    place = np.unique(place[place > low])
    at = place & ((1 << 40) - 1)
    return merge_spans(docs[place >> 40], at, at + length)


def suffix_order(text: np.ndarray, n: int, depth: int):
    """(suffixes in order, first place of each one's ties, first places of the 8-byte intervals).

    Ordered to ``depth`` bytes at least, by doubling; beyond the end follow
    separators, the greatest byte.
    """
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | text[k : k + n]
    sa = np.argsort(key)
    new = np.concatenate([[True], key[sa][1:] != key[sa][:-1]])
    gram_start = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[sa] = gram_start[np.cumsum(new) - 1]  # a group's rank is its first place
    span, tied = 8, ~(new & np.append(new[1:], True))
    while span < depth and tied.any():
        at = np.flatnonzero(tied)  # places still in groups; singles keep theirs
        suffix = sa[at]
        nxt = suffix + span
        pair = rank[suffix] << 32 | np.where(nxt < n, rank[np.minimum(nxt, n - 1)], nxt)
        order = np.argsort(pair)
        suffix, pair = suffix[order], pair[order]
        sa[at] = suffix
        cut = np.concatenate([[True], pair[1:] != pair[:-1]])
        rank[suffix] = at[np.flatnonzero(cut)][np.cumsum(cut) - 1]
        tied[at] = ~(cut & np.append(cut[1:], True))
        span *= 2
    return sa, rank, gram_start


def repeated_spans(stage: Stage, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD, hot: int = HOT, flush: int = 32 << 20) -> list[DataFrame]:
    """Tables (id, spans array<(s, e)>) of covered spans of docs (id long, t binary)."""
    if not 8 <= length <= MOST:
        raise ValueError(f"length must be 8 to {MOST}")
    gram = min(gram, 1 << length.bit_length() - 2)
    buckets = max(16, text_bytes(docs, "t") // (8 << 20))

    def cut(batches):
        held: list = []
        raws: list[bytes] = []
        size = turn = 0

        def out():
            nonlocal held, size, turn
            cols, lead, later = collapse(*(np.concatenate([x[k] for x in held]) for k in range(6)))
            key, print_, doc, start, end, text = cols
            at, to = copy_sets(doc, start, lead, later)
            raw = b"".join(raws)
            raws.clear()
            spans = covered_locally(raw, to, text[at], doc[at], start[at], end[at], length, shard)
            key, print_, doc, start, end = (c[np.unique(lead)] for c in cols[:5])
            to = (key.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            edge = np.searchsorted(to[order], np.arange(buckets + 1))
            rows = [(b, 0, _pack(*(c[order[edge[b] : edge[b + 1]]] for c in (key, print_, doc, start, end)))) for b in range(buckets) if edge[b + 1] > edge[b]]
            if len(spans[0]):
                rows.append((turn % buckets, 1, _pack(*spans)))
            turn, held, size = turn + 7919, [], 0
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.binary()))], names=["bucket", "kind", "blob"])

        for big in batches:
            turn += len(big)
            for rows in _blocks(big, 1, 1 << 20):
                data, bounds = column_bytes(rows.column(1))
                text, start, end, key = fragments(data, bounds, length, gram)
                raw, base = data.tobytes(), bounds[text]
                mark = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip((base + start).tolist(), (base + end).tolist())), np.uint64, len(text))
                held.append((key.view(np.int64), mark.view(np.int64), rows.column(0).to_numpy()[text], start, end, size + base))
                raws.append(raw)
                size += len(data)
                if size >= flush:
                    yield out()
        if held:
            yield out()

    def meet(table):
        keyed, spans = [np.zeros((5, 0), np.int64)], [np.zeros((3, 0), np.int64)]
        for kind, blob in zip(table["kind"].to_pylist(), table["blob"].to_pylist()):
            (spans if kind else keyed).append(np.stack(_unpack(blob, 3 if kind else 5)))
        cols = np.concatenate(keyed, axis=1)
        order = np.argsort(cols[0], kind="stable")
        key = cols[0][order]
        same = key[1:] == key[:-1] if len(key) else np.zeros(0, bool)
        cols = cols[:, order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]] if len(key) else cols
        cols, lead, later = collapse(*cols)
        doc, start, end = merge_spans(*np.concatenate(spans, axis=1))
        at, to = copy_sets(cols[2], cols[3], lead, later)
        key, _, fdoc, fstart, fend = (c[np.unique(lead)] for c in cols)
        _, where, count = np.unique(key, return_inverse=True, return_counts=True)
        mixed = count[where] > 1
        kind = np.where(count[where] > hot, 2, 1)
        rows = [(doc, start, end, np.zeros(len(doc), np.int64), 0), (*(c[at] for c in cols[2:]), to, 3)]
        rows += [(fdoc[use], fstart[use], fend[use], key[use], k) for k in (1, 2) for use in [mixed & (kind == k)]]
        out = []
        for i, s, e, x, k in rows:
            windows = e - s - length + 1
            work = windows * length if k == 2 else windows if k == 3 else e - s
            to = _spread(i, buckets)
            order = np.argsort(to, kind="stable")
            edge = np.searchsorted(to[order], np.arange(buckets + 1))
            for t in np.flatnonzero(np.diff(edge)).tolist():
                at = order[edge[t] : edge[t + 1]]
                out.append((t, k, int(work[at].sum()), _pack(i[at], s[at], e[at], x[at])))
        return pa.table([pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names=["target", "kind", "work", "blob"])

    def read(table, kind):
        found = [_unpack(b, 4) for b in table.filter(pa.array(table["kind"].to_numpy() == kind))["blob"].to_pylist()]
        return [np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.int64) for c in range(4)]

    def unite(table):
        parts = []
        for k in (0, 1, 2):
            i, s, e, x = read(table, k)
            if k == 1:  # runs of copies go the way of leaders
                to, text, a, b = joined_runs(*(read(table, 3)[c] for c in (3, 0, 1, 2)))
                i, s, e, x = (np.concatenate(pair) for pair in ((i, text), (s, a), (e, b), (x, to)))
            ids, spans = listed(i, s=s, e=e, key=x)
            parts.append(pa.table({"id": ids, "kind": np.full(len(ids), k, np.int32), "spans": spans}))
        return pa.concat_tables(parts)

    blobs = docs.mapInArrow(cut, "bucket long, kind int, blob binary")
    met = stage.put(blobs.groupBy("bucket").applyInArrow(meet, "target long, kind int, work long, blob binary"))
    del blobs
    shards = max(1, -(-int(met.where("kind > 0").agg(F.sum("work")).first()[0] or 0) // shard))
    found = stage.put(met.groupBy("target").applyInArrow(unite, "id long, kind int, spans array<struct<s:bigint,e:bigint,key:bigint>>"))
    asked = found.where("kind > 0")

    def take(batches):
        for rows in batches:
            out: list = []
            held = 0
            for i, t, want in zip(*(rows.column(c).to_pylist() for c in ("id", "t", "want"))):
                for kind, w in ((x["kind"], w) for x in want for w in x["spans"]):
                    if kind == 1:
                        out.append((w["key"] % shards, i, w["s"], t[w["s"] : w["e"]]))
                    else:
                        for s in range(w["s"], w["e"] - length + 1):
                            out.append((xxhash.xxh3_64_intdigest(t[s : s + length]) % shards, i, s, t[s : s + length]))
                    held += w["e"] - w["s"]
                if held > 4 << 20:
                    yield batch(out)
                    out, held = [], 0
            if out:
                yield batch(out)

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["shard", "id", "s", "part"])

    def expand(table):
        doc, start, end = repeated_windows(table["part"].to_pylist(), table["id"].to_numpy(), table["s"].to_numpy(), length)
        ids, spans = listed(doc, s=start, e=end)
        return pa.table({"id": ids, "spans": spans})

    wants = asked.groupBy("id").agg(F.collect_list(F.struct("kind", "spans")).alias("want"))
    parts = docs.join(wants, "id").select("id", "t", "want").mapInArrow(take, "shard long, id long, s long, part binary")
    matched = stage.put(parts.groupBy("shard").applyInArrow(expand, "id long, spans array<struct<s:bigint,e:bigint>>"))
    bare = F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    return [found.where("kind = 0").select("id", bare.alias("spans")), matched]


def _united(spans: list[dict], size: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], min(x["e"], size)) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        elif s < e:
            out.append([s, e])
    return [(s, e) for s, e in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """(id, n_bytes, spans array<struct<s, e>>, kept binary) for every row.

    ``spans`` are the maximal removed runs in bytes, ``kept`` the remaining
    bytes. Order is by id, then by start: of equal strings the one in the
    document with the smallest id stays. A null text is empty. Null ids rank
    after all others, in the order of a hash of their text. Rows that repeat an
    id, or a text without an id, are one document (they should repeat the text
    too: spans are united over them). Ids of 2^63 - 2^60
    and more are taken. ``length`` is 8 to 2048. Texts shorter than ``length`` lose nothing. Other columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "repeats")
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID) + F.pmod(F.xxhash64(text_col), F.lit(1 << 60))).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    covered, matched = repeated_spans(stage, texts, length, shard=shard, hot=hot)
    spans = covered.unionByName(matched).groupBy("id").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def apply(batches):
        for big in batches:
            for rows in _blocks(big, 1):
                out = []
                for t, spans in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist()):
                    runs = _united(spans, len(t))
                    at, kept = 0, []
                    for s, e in runs:
                        kept.append(t[at:s])
                        at = e
                    out.append((len(t), [{"s": s, "e": e} for s, e in runs], b"".join(kept) + t[at:]))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), pa.array([x[2] for x in out], pa.binary())],
                    names=["id", "n_bytes", "spans", "kept"],
                )

    return texts.join(spans, "id", "left").mapInArrow(apply, "id long, n_bytes long, spans array<struct<s:bigint,e:bigint>>, kept binary").withColumn(
        "id", F.when(F.col("id") < _NULL_ID, F.col("id"))
    )


def digest(removed: DataFrame) -> DataFrame:
    """The figures of ``op2`` from ``remove_repeats`` rows."""
    return removed.select(
        F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def brute_force(rows: list[tuple[int, bytes]], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """id -> (n_bytes, n_removed, n_spans, kept_sha256), from a table of all strings."""
    seen: dict[bytes, tuple[int, int]] = {}
    out = {}
    for i, t in sorted(rows):
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if seen.setdefault(t[p : p + length], (i, p)) != (i, p):
                gone[p : p + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone[: len(t)]].tobytes()
        out[i] = (len(t), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return out
