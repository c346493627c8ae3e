"""Token ids of whole text columns, by remembered chunks of their bytes.

A chunk is a run without white space and the one white-space character before
it; white space before that is a chunk of its own, and a comma or full stop
that ends a word of Latin letters begins one. No pre-token of the tokenizers
here crosses such a cut. Chunks tile the joined texts, so that cutting,
looking up and assembling are column operations: a 64-bit hash of every chunk
is looked up in an open-addressing table, the bytes of the chunk are compared
with those of the entry found, and the ids of all entries are gathered at
once. Only chunks without an entry are handed to the tokenizer.

The table is bounded in entries and in bytes. When it is full, it keeps the
entries that were met again since it was last full (or none, where they would
fill half of it). Chunks of more than ``LONGEST`` bytes are never remembered.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from millrace.llm.secretscan import column_bytes

#: Entries and bytes of text that a worker remembers, and the longest chunk that is remembered.
ENTRIES, BYTES, LONGEST = 3 << 19, 24 << 20, 64
#: Bytes looked up together.
TOGETHER = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(20250117).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: UTF-8 of the white-space characters beyond ASCII.
_WIDE_SPACE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_WIDE2, _WIDE3 = (np.array([int.from_bytes(w, "big") for w in _WIDE_SPACE if len(w) == n]) for n in (2, 3))
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LETTER_AFTER_C3 = np.zeros(256, bool)
_LETTER_AFTER_C3[128:192] = True
_LETTER_AFTER_C3[[0x97, 0xB7]] = False  # the signs of multiplication and division
_MARK = np.zeros(256, bool)
_MARK[[*b",."]] = True


def cuts_of(data: np.ndarray, bounds: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """First bytes of the chunks of joined texts, and the end; texts in ``whole`` are one chunk each."""
    n = len(data)
    if not n:
        return np.zeros(1, np.int64)
    head = np.zeros(n + 1, bool)
    head[bounds] = True
    space = np.append(_SPACE[data], False)
    lead = np.flatnonzero(_LEAD[data])
    wide, width = [np.zeros(0, np.int64)], []
    for size, kinds in ((2, _WIDE2), (3, _WIDE3)):
        at = lead[lead + size <= n]
        code = np.zeros(len(at), np.int64)
        for k in range(size):
            code = code << 8 | data[at + k]
        at = at[np.isin(code, kinds)] if len(at) else at
        for k in range(size):
            space[at + k] = True
        wide.append(at)
        width.append(np.full(len(at), size))
    follow = space[1:] | head[1:]  # the next byte is white space, or of another text
    start = space[:n].copy()
    start[1:] &= ~space[: n - 1] | ~follow[1:]  # the first of a run, or its last character before a word
    some = np.concatenate(wide)
    if len(some):
        size = np.concatenate(width)
        for k in (0, 1, 2):
            at, its = some[size > k] + k, size[size > k]
            first = (at == 0) | ~space[at - 1]
            last = ~follow[at - k + its - 1]
            start[at] = (first | last) if k == 0 else False
    start |= head[:n]
    mark = np.flatnonzero(_MARK[data] & follow)
    mark = mark[mark > 0]
    before = data[mark - 1]
    latin = _LETTER[before] | (_LETTER_AFTER_C3[before] & (data[np.maximum(mark - 2, 0)] == 0xC3) & (mark > 1))
    start[mark[latin & ~head[mark]]] = True
    for a, b in zip(bounds[:-1][whole].tolist(), bounds[1:][whole].tolist()):
        start[a + 1 : b] = False
    return np.append(np.flatnonzero(start), n)


class ChunkTable:
    """Remembered ids of short byte strings.

    ``learn`` gives the ids of chunks as little-endian bytes of ``kind``.
    """

    def __init__(self, learn: Callable[[list[bytes]], list[bytes]], kind, entries: int = ENTRIES, room: int = BYTES, longest: int = LONGEST, together: int = TOGETHER):
        self.learn, self.kind, self.entries, self.room, self.longest, self.together = learn, np.dtype(kind), entries, room, longest, together
        bits = max(4, (2 * entries - 1).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._slot = np.full(1 << bits, -1, np.int32)
        self._hash = np.zeros(entries, np.uint64)
        self._key_at, self._id_at = np.zeros(entries, np.int64), np.zeros(entries, np.int64)
        self._key_n, self._id_n = np.zeros(entries, np.int32), np.zeros(entries, np.int32)
        self._met = np.zeros(entries, bool)
        self._keys = np.zeros(room + 1, np.uint8)
        self._ids = np.zeros(1 << 16, self.kind)
        self.count = self._key_end = self._id_end = 0
        self._up = self._down = np.ones(1, np.uint64)

    def encode(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks end to end, and the bounds of each chunk's."""
        ids, sizes = [np.zeros(0, self.kind)], [np.zeros(1, np.int64)]
        a, last = 0, len(cuts) - 1
        while a < last:
            b = min(last, max(a + 1, int(np.searchsorted(cuts, cuts[a] + self.together, "right")) - 1))
            got, n = self._part(data[cuts[a] : cuts[b]], cuts[a : b + 1] - cuts[a])
            ids.append(got)
            sizes.append(n)
            a = b
        return np.concatenate(ids), np.cumsum(np.concatenate(sizes))

    def _part(self, data: np.ndarray, cuts: np.ndarray):
        size, raw = np.diff(cuts), data.tobytes()
        if len(size) == 1 and len(data) > self.together:
            ids = np.frombuffer(self.learn([raw])[0], self.kind)
            return ids, np.array([len(ids)])
        short = size <= self.longest
        h = self._hashes(data, cuts)
        text = lambda at: [raw[s:e] for s, e in zip(cuts[at].tolist(), cuts[at + 1].tolist())]
        for _ in range(3):  # a full table is cut down, then emptied
            entry = self._find(h, size, short)
            self._verify(data, cuts, size, entry)
            lost = np.flatnonzero((entry < 0) & short)
            fresh = lost[np.unique(h[lost], return_index=True)[1]]
            if self.count + len(fresh) <= self.entries and self._key_end + int(size[fresh].sum()) <= self.room:
                self._met[entry[entry >= 0]] = True
                break
            self._forget()
        else:  # too many for an empty table: learned for this once
            fresh = fresh[:0]
        if len(fresh):
            self._add(h[fresh], text(fresh))
            entry[lost] = self._find(h[lost], size[lost], short[lost])
            self._verify(data, cuts, size, entry, lost)
        known = entry >= 0
        at, n = np.where(known, self._id_at[entry], 0), np.where(known, self._id_n[entry], 0)
        alone = np.flatnonzero(~known)
        if len(alone):  # long chunks, and those whose hash belongs to another: learned for this once
            own = self.learn(text(alone))
            n[alone] = np.fromiter(map(len, own), np.int64, len(own)) // self.kind.itemsize
            at[alone] = self._id_end + np.cumsum(n[alone]) - n[alone]
            self._put_ids(b"".join(own))
        end = np.cumsum(n)
        return self._ids[np.repeat(at - (end - n), n) + np.arange(end[-1])], n

    def _hashes(self, data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        if len(self._up) <= len(data):
            size = 1 << int(len(data)).bit_length()
            self._up, self._down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, f, np.uint64)])) for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64)))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self._up[: len(data)], out=total[1:])
        h = (total[cuts[1:]] - total[cuts[:-1]]) * self._down[cuts[:-1]]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ h >> np.uint64(32)

    def _find(self, h: np.ndarray, size: np.ndarray, use: np.ndarray) -> np.ndarray:
        """Entry with a chunk's hash and length, or -1."""
        at = (h >> self._shift).astype(np.int64)
        entry = self._slot[at].astype(np.int64)
        entry[~use] = -1
        wrong = np.flatnonzero((entry >= 0) & ((self._hash[entry] != h) | (self._key_n[entry] != size)))
        at = at[wrong]
        while len(wrong):
            at = at + 1 & self._mask
            entry[wrong] = self._slot[at]
            more = (entry[wrong] >= 0) & ((self._hash[entry[wrong]] != h[wrong]) | (self._key_n[entry[wrong]] != size[wrong]))
            wrong, at = wrong[more], at[more]
        return entry

    def _verify(self, data: np.ndarray, cuts: np.ndarray, size: np.ndarray, entry: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Set to -1 the entries (of ``rows``, else all) whose bytes are not the chunk's."""
        shift = np.where(entry >= 0, self._key_at[entry] - cuts[:-1], 0)
        if rows is None:
            at, shift = np.arange(len(data)), np.repeat(shift, size)
        else:
            rows = rows[entry[rows] >= 0]
            n = size[rows]
            end = np.cumsum(n)
            at = np.repeat(cuts[rows] - (end - n), n) + np.arange(n.sum())
            data, shift = data[at], np.repeat(shift[rows], n)
        off = np.flatnonzero(np.take(self._keys, at + shift, mode="clip") != data)
        entry[np.searchsorted(cuts, at[off], "right") - 1] = -1

    def _put_ids(self, raw: bytes) -> int:
        """Place ids behind those remembered; the end."""
        new = np.frombuffer(raw, self.kind)
        end = self._id_end + len(new)
        if end > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros(max(end, 2 * len(self._ids)) - len(self._ids), self.kind)])
        self._ids[self._id_end : end] = new
        return end

    def _add(self, h: np.ndarray, chunks: list[bytes]) -> None:
        own = self.learn(chunks)
        at = slice(self.count, self.count + len(chunks))
        for sizes, to, end, got in ((self._key_n, self._key_at, self._key_end, chunks), (self._id_n, self._id_at, self._id_end, own)):
            n = np.fromiter(map(len, got), np.int64, len(got)) // (1 if got is chunks else self.kind.itemsize)
            sizes[at] = n
            to[at] = end + np.cumsum(n) - n
        raw = np.frombuffer(b"".join(chunks), np.uint8)
        self._keys[self._key_end : self._key_end + len(raw)] = raw
        self._key_end += len(raw)
        self._id_end = self._put_ids(b"".join(own))
        self._hash[at] = h
        self._met[at] = False
        self._place(np.arange(self.count, self.count + len(chunks)))
        self.count += len(chunks)

    def _place(self, entry: np.ndarray) -> None:
        at = (self._hash[entry] >> self._shift).astype(np.int64)
        while len(entry):
            free = np.flatnonzero(self._slot[at] < 0)
            self._slot[at[free]] = entry[free]  # the last of several stays
            left = self._slot[at] != entry
            entry, at = entry[left], at[left] + 1 & self._mask

    def _forget(self) -> None:
        keep = np.flatnonzero(self._met[: self.count])
        if 2 * len(keep) > self.entries or 2 * int(self._key_n[keep].sum()) > self.room:
            keep = keep[:0]
        for sizes, to, held in ((self._key_n, self._key_at, self._keys), (self._id_n, self._id_at, self._ids)):
            n, old = sizes[keep].astype(np.int64), to[keep]
            end = np.cumsum(n)
            moved = held[np.repeat(old - (end - n), n) + np.arange(n.sum())]
            held[: len(moved)] = moved
            sizes[: len(keep)], to[: len(keep)] = n, end - n
            if held is self._keys:
                self._key_end = len(moved)
            else:
                self._id_end = len(moved)
        self._hash[: len(keep)] = self._hash[keep]
        self._met[:] = False
        self.count = len(keep)
        self._slot[:] = -1
        self._place(np.arange(self.count))


class ColumnEncoder:
    """Ids of a column of texts; a tokenizer adds ``learn`` and ``special``."""

    kind = np.dtype("<u4")
    #: Strings that stand for one token wherever they occur; a text with one is encoded as a whole.
    special: list[str] = []

    def __init__(self, **limits: int):
        self.table = ChunkTable(self.learn, self.kind, **limits)

    def learn(self, chunks: list[bytes]) -> list[bytes]:
        """Little-endian ids, of ``kind``, of chunks or whole texts."""
        raise NotImplementedError

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (binary) end to end, and the bounds of each text's; a null is empty.

        Bytes that are no UTF-8 count as U+FFFD, as Python replaces them.
        """
        data, bounds = column_bytes(column)
        raw, n = data.tobytes(), len(bounds) - 1
        broken = np.zeros(n, bool)
        filled = bounds[:-1] < bounds[1:]
        try:
            raw.decode("utf-8")
            broken[filled] = (data[bounds[:-1][filled]] & 0xC0) == 0x80
        except UnicodeDecodeError:
            broken[filled] = True
        if broken.any():
            texts = [raw[s:e].decode("utf-8", "replace").encode() if b else raw[s:e] for s, e, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), broken)]
            data, bounds = column_bytes(pa.array(texts, pa.binary()))
            raw = data.tobytes()
        whole = np.zeros(n, bool)
        for s in self.special:
            at = raw.find(s.encode())
            while at >= 0:
                k = int(np.searchsorted(bounds, at, "right")) - 1
                whole[k] = True
                at = raw.find(s.encode(), int(bounds[k + 1]))
        cuts = cuts_of(data, bounds, whole)
        ids, ends = self.table.encode(data, cuts)
        return ids, ends[np.searchsorted(cuts, bounds)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        ids, bounds = self.encode_column(pa.array([t.encode("utf-8", "surrogatepass") for t in texts], pa.binary()))
        return np.split(ids, bounds[1:-1]) if texts else []
