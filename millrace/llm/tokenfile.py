"""Binary token-id shards with a minimal perfect hash index.

Documents are range-partitioned and sorted by id; every partition becomes one
shard file in the shared folder:

    magic ``MILLTOK2`` | raw ids, little-endian, of all documents end to end |
    hash levels (sizes, then 64-bit words) | slots | documents | footer

A document key is hashed to a level bit; keys that collide on a level move to
the next. A key's bit rank is its slot, so n keys use exactly n slots. A slot
stores the key's 32-bit fingerprint and the first and last id offset of its
document: one lookup reads one slot at its offset, whatever the shard's size.
An unknown key is refused by the fingerprint alone, all but one in 2^32 of
them. The document list (key and end of each, in file order) serves scans.

A shard is written under a name of its task attempt and only counts once its
row in the manifest (a table Spark commits) names it, so a lost executor leaves
at most an unnamed file.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.bpe import byte_symbols
from millrace.llm.chunks import ColumnEncoder
from millrace.llm.common import Stage, text_bytes
from millrace.llm.secretscan import _blocks

MAGIC = b"MILLTOK2"
_FOOTER = struct.Struct("<QQQQQQB7x8s")  # levels at, levels, slots at, keys, documents, of them without a key, id width
SLOT = np.dtype([("print", "<u4"), ("first", "<u8"), ("last", "<u8")])
DOCUMENT = np.dtype([("key", "<i8"), ("end", "<u8")])
LEVELS = 64


class ByteEncoder(ColumnEncoder):
    """The tokenizers library behind remembered chunks.

    Words of Latin letters are one pre-token each and go to the library's model
    directly; other chunks go to the library together, a line each, where a line
    end is a token of its own; chunks with other white space go one by one.
    """

    def __init__(self, path: str, **limits: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.line = self.library.token_to_id("\u010a")  # the byte-level sign of a line end
        self.line_bytes = self.kind.type(self.line).tobytes()
        self.signs = dict(enumerate(byte_symbols()))
        self.each = [self.kind.type(i).tobytes() for i in range(self.library.get_vocab_size())]
        super().__init__(**limits)

    def learn(self, chunks: list[bytes]) -> list[bytes]:
        out, rest = [b""] * len(chunks), []
        model, each = self.library.model.tokenize, self.each
        for k, c in enumerate(chunks):
            line = c[:1] == b"\n"
            body = c[1:] if line else c
            word = body[1:] if body[:1] == b" " and not line else body
            if word.isalpha() or (len(word) <= 64 and _latin(word)):
                ids = b"".join([each[t.id] for t in model(body.decode("latin-1").translate(self.signs))])
                out[k] = self.line_bytes + ids if line else ids
            else:
                rest.append(k)
        lines = [k for k in rest if len(chunks[k]) <= 64 and chunks[k].decode().split() == [chunks[k].decode().removeprefix(" ").removeprefix("\n")]]
        alone = sorted({*rest}.difference(lines))
        for i in range(0, len(lines), 8192):
            part = lines[i : i + 8192]
            text = b"\n".join([chunks[k].lstrip(b"\n") for k in part]).decode()
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
            cut = np.flatnonzero(ids == self.line)
            if len(cut) != len(part) - 1:
                alone += part
                continue
            raw, width = ids.tobytes(), self.kind.itemsize
            for k, s, e in zip(part, [0, *(cut + 1).tolist()], [*cut.tolist(), len(ids)]):
                own = raw[s * width : e * width]
                out[k] = self.line_bytes + own if chunks[k][:1] == b"\n" else own
        for i in range(0, len(alone), 256):
            part = alone[i : i + 256]
            for k, e in zip(part, self.library.encode_batch_fast([chunks[k].decode() for k in part], add_special_tokens=False)):
                out[k] = np.array(e.ids, self.kind).tobytes()
        return out


def _latin(word: bytes) -> bool:
    """Whether a word has only letters below U+0250."""
    text = word.decode()
    return text.isalpha() and max(text) < "\u0250"


_ENCODERS: dict[str, ByteEncoder] = {}


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys.view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _print(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 997) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bits, rank is the slot."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.words, self.sizes = words, sizes.astype(np.int64)
        self.base = np.concatenate([[0], np.cumsum(self.sizes)])
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])

    @staticmethod
    def build(keys: np.ndarray) -> "PerfectHash":
        parts, sizes, left = [], [], keys
        for level in range(LEVELS):
            n = max(1, -(-2 * len(left) // 64))  # words: two bits a key
            if not len(left):
                break
            at = (_mix(left, level) % np.uint64(64 * n)).astype(np.int64)
            alone = np.bincount(at, minlength=64 * n) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            parts.append(bits)
            sizes.append(n)
            left = left[~alone[at]]
        if len(left):
            raise ValueError("keys of an index must be distinct")
        return PerfectHash(np.concatenate([*parts, np.zeros(0, "<u8")]), np.array(sizes, np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for some keys that were never added."""
        out, todo = np.full(len(keys), -1), np.arange(len(keys))
        for level, (n, base) in enumerate(zip(self.sizes.tolist(), self.base.tolist())):
            at = (_mix(keys[todo], level) % np.uint64(64 * n)).astype(np.int64)
            word, bit = base + (at >> 6), (at & 63).astype(np.uint64)
            hit = self.words[word] >> bit & np.uint64(1) == 1
            below = self.words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[todo[hit]] = self.rank[word[hit]] + np.bitwise_count(below)
            todo = todo[~hit]
        return out


def _open(path: str):
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


class ShardWriter:
    def __init__(self, path: str, width: int):
        fs, at = _open(path)
        fs.create_dir(at.rpartition("/")[0], recursive=True)
        self.out, self.width, self.n = fs.open_output_stream(at), width, 0
        self.keys: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        self.nameless = 0
        self.out.write(MAGIC)

    def add(self, keys: np.ndarray, keyless: int, ids: np.ndarray, ends: np.ndarray) -> None:
        """Documents in file order: ids end to end and where each ends; the last ``keyless`` have no key."""
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.keys.append(keys)
        self.ends.append(self.n + ends)
        self.n += len(ids)
        self.nameless += keyless

    def close(self) -> int:
        keys = np.concatenate([*self.keys, np.zeros(0, np.int64)])
        ends = np.concatenate([*self.ends, np.zeros(0, np.int64)])
        starts = np.concatenate([[0], ends])[: len(ends)]
        named = len(keys) - self.nameless
        head = np.flatnonzero(np.concatenate([[True], keys[1:named] != keys[: named - 1]])) if named else np.zeros(0, np.int64)
        tail = np.append(head[1:], named)[: len(head)] - 1  # documents that repeat a key follow each other
        index = PerfectHash.build(keys[head])
        slots = np.zeros(len(head), SLOT)
        at = index.slots(keys[head])
        slots["print"][at] = _print(keys[head])
        slots["first"][at] = starts[head]
        slots["last"][at] = ends[tail]
        listed = np.zeros(len(keys), DOCUMENT)
        listed["key"], listed["end"] = keys, ends
        words, sizes = index.words.tobytes(), index.sizes.astype("<i8").tobytes()
        at0 = len(MAGIC) + self.n * self.width
        slots_at = at0 + len(sizes) + len(words)
        for part in (sizes, words, slots.tobytes(), listed.tobytes()):
            self.out.write(part)
        self.out.write(_FOOTER.pack(at0, len(index.sizes), slots_at, len(head), len(keys), self.nameless, self.width, MAGIC))
        self.out.close()
        return self.n


class ShardReader:
    """Keyed access to one shard file; opening it reads the footer and the hash levels (two to three bits a key)."""

    def __init__(self, path: str):
        fs, at = _open(path)
        self.file = fs.open_input_file(at)
        size = self.file.size()
        foot = self.file.read_at(_FOOTER.size, size - _FOOTER.size)
        at0, levels, self._slots_at, self.n_keys, self.n_docs, self.nameless, self.width, magic = _FOOTER.unpack(foot)
        if magic != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no token shard")
        head = self.file.read_at(self._slots_at - at0, at0)
        self.index = PerfectHash(np.frombuffer(head, "<u8", offset=8 * levels), np.frombuffer(head, "<i8", count=levels))

    def find(self, keys: np.ndarray):
        """(known, first, last) of each key: the id span of its documents, by one slot read at its offset."""
        at = self.index.slots(keys) if self.n_keys else np.full(len(keys), -1)
        raw = b"".join([bytes(SLOT.itemsize) if k < 0 else self.file.read_at(SLOT.itemsize, self._slots_at + k * SLOT.itemsize) for k in at.tolist()])
        return self._checked(keys, at, np.frombuffer(raw, SLOT))

    def find_all(self, keys: np.ndarray):
        """As ``find``, for a large share of the shard's keys: the slots are read in one go."""
        at = self.index.slots(keys) if self.n_keys else np.full(len(keys), -1)
        slots = np.frombuffer(self.file.read_at(self.n_keys * SLOT.itemsize, self._slots_at), SLOT)
        return self._checked(keys, at, slots[np.maximum(at, 0)] if self.n_keys else np.zeros(len(keys), SLOT))

    def _checked(self, keys: np.ndarray, at: np.ndarray, slot: np.ndarray):
        known = (at >= 0) & (slot["print"] == _print(keys))
        return known, np.where(known, slot["first"], 0).astype(np.int64), np.where(known, slot["last"], 0).astype(np.int64)

    def ids(self, first: int, last: int) -> np.ndarray:
        raw = self.file.read_at((last - first) * self.width, len(MAGIC) + first * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """(keys, ends) of all documents in file order; the last ``nameless`` keys mean nothing."""
        at = self._slots_at + self.n_keys * SLOT.itemsize
        listed = np.frombuffer(self.file.read_at(self.n_docs * DOCUMENT.itemsize, at), DOCUMENT)
        return listed["key"].astype(np.int64), listed["end"].astype(np.int64)


def write_shards(docs: DataFrame, tokenizer: str, folder: str, stage: Stage, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 64 << 20) -> DataFrame:
    """Encode all texts into shard files in ascending id order; returns the manifest.

    Manifest: (shard int, path string, n_docs long, n_tokens long), one row per
    file, ``shard`` ascending with the ids. ``end_id`` closes every document. A
    null or empty text is ``end_id`` alone. Rows that repeat an id are all
    written, one after the other in the order of a hash of their text, and a
    lookup gives them together (they may reach into a second shard). Rows with
    a null id come after all others, where only a scan finds them. Other
    columns are ignored; without rows the manifest is empty.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    order = (F.col("id").asc_nulls_last(), F.xxhash64("t").asc())
    conf = docs.sparkSession.conf
    least = int(conf.get("spark.sql.shuffle.partitions"))
    parts = max(min(least, 64), text_bytes(rows, "t") // shard_bytes)

    def run(batches):
        path = None
        for big in batches:
            for part in _blocks(big, 1, 4 << 20):
                if path is None:
                    enc = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, ByteEncoder(tokenizer))
                    shard = TaskContext.get().partitionId()
                    path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.tok"
                    out, n = ShardWriter(path, enc.kind.itemsize), 0
                ids, bounds = enc.encode_column(part.column(1))
                ids = np.insert(ids, bounds[1:], end_id)
                out.add(part.column(0).fill_null(0).to_numpy(), part.column(0).null_count, ids, bounds[1:] + np.arange(1, len(part) + 1))
                n += len(part)
        if path is not None:
            total = out.close()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([path]), pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["shard", "path", "n_docs", "n_tokens"])

    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "t")
    return stage.put(dealt.mapInArrow(run, "shard int, path string, n_docs long, n_tokens long"))


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files.

    ``start`` counts the ids of all documents before it. The keys of a shard
    are looked up through its perfect hash, and the payload is read back. The
    manifest has one small row per shard; it is summed by a window, not on the
    driver.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    todo = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base")).repartition(min(10_000, max(1, manifest.count())))

    def run(batches):
        for rows in batches:
            for path, base in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                shard = ShardReader(path)
                keys, end = shard.documents()
                named = len(keys) - shard.nameless
                known, first, last = shard.find_all(keys[:named])
                start = np.concatenate([[0], end[:-1]])
                if not known.all() or (start[:named] < first).any() or (end[:named] > last).any():
                    raise ValueError(f"{path}: the index misses keys")
                for i in range(0, len(keys), 4096):
                    a, b = start[i : i + 4096], end[i : i + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[i : i + 4096], mask=np.arange(i, i + len(a)) >= named), pa.array(base + a), pa.array(b - a), pa.array(_crc(shard, a, b), pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return todo.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _crc(shard: ShardReader, start: np.ndarray, end: np.ndarray, together: int = 1 << 22) -> list[int]:
    """CRC-32 of the ids of documents that follow each other, read about ``together`` ids at a time."""
    out: list[int] = []
    while len(out) < len(start):
        k = len(out)
        upto = max(k + 1, int(np.searchsorted(end, start[k] + together, "right")))
        raw = memoryview(shard.ids(int(start[k]), int(end[upto - 1])).tobytes())
        out += [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((start[k:upto] - start[k]).tolist(), (end[k:upto] - start[k]).tolist())]
    return out
