"""BPE encoding and decoding with a pair occurrence index.

Texts are cut into chunks at white space; each chunk that is not yet known is
normalised, cut into pre-tokens and turned into symbols. All unknown
pre-tokens of a partition's batch are merged together: an index maps each
mergeable pair (by its rank) to the positions where it occurs, a heap holds
the active ranks, the lowest rank is applied at all its positions at once, and
the lists of the pairs to the left and right of each merge are updated.
Words are independent and every word sees its own ranks in ascending order, so
the result is that of merging word by word.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.chunks import ColumnEncoder
from millrace.llm.secretscan import _blocks

#: Unicode White_Space, as a regular-expression class body.
_W = "".join(map(chr, [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_PRETOKEN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_W}\p{{L}}\p{{N}}]+")
_NONE = np.iinfo(np.int64).max
#: Bytes of chunks merged together, about.
TOGETHER = 1 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(kept) else chr(next(spare)) for b in range(256)]


class WordBpe:
    """A word-end BPE vocabulary read from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for t, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        self._split_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        sign = byte_symbols()
        self.byte_of = {c: i for i, c in enumerate(sign)}
        self.library = Tokenizer.from_file(path)
        self.inner = np.array([vocab[s] for s in sign], np.int64)
        self.final = np.array([vocab[s + self.suffix] for s in sign], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self._key, self._rank = key[order], order
        self.left = key >> 20
        self.right = key & ((1 << 20) - 1)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
        return np.where(self._key[at] == key, self._rank[at], _NONE)

    def pretokens(self, chunk: str) -> list[str]:
        """Normalised pre-tokens of a chunk, before the byte-level mapping.

        Outside Latin letters the library's own normaliser and splitter decide,
        so that its Unicode version holds.
        """
        if max(chunk, default="") >= "\u0250":
            cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
            return [bytes(map(self.byte_of.__getitem__, w)).decode("utf-8") for w, _ in cut]
        if not unicodedata.is_normalized("NFC", chunk):
            chunk = unicodedata.normalize("NFC", chunk)
        low = chunk.lower()
        return [low] if low.isalpha() else _PRETOKEN.findall(low)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words end to end, and the bounds of each word."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        n, end = len(data), np.cumsum(size)
        last = end - 1
        sym = self.inner[data]
        sym[last] = self.final[data[last]]
        word = np.repeat(np.arange(len(words)), size)
        after = np.arange(1, n + 1)
        after[last] = n
        before = np.arange(-1, n - 1)
        before[end[:-1]] = n
        before[:1] = n
        sym, after, before = (np.concatenate([x, [v]]) for x, v in ((sym, -1), (after, n), (before, n)))
        alive = np.ones(n + 1, bool)

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(at: np.ndarray) -> None:
            """Index the pairs that start at these positions."""
            nxt = after[at]
            at = at[(at < n) & (nxt < n)]
            if not len(at):
                return
            rank = self.ranks(sym[at], sym[after[at]])
            keep = rank != _NONE
            at, rank = at[keep], rank[keep]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = np.flatnonzero(np.diff(rank)) + 1
            for r, p in zip(rank[np.concatenate([[0], cut])].tolist(), np.split(at, cut)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(p)

        note(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
            a, b = self.left[r], self.right[r]
            nxt = after[at]
            ok = alive[at] & (nxt < n) & (sym[at] == a) & (sym[nxt] == b)
            at, nxt = at[ok], nxt[ok]
            if a == b and len(at) > 1:  # runs such as aaa: every other position, from the left
                joined = at[1:] == nxt[:-1]
                start = np.concatenate([[True], ~joined])
                run = np.cumsum(start) - 1
                keep = (np.arange(len(at)) - np.flatnonzero(start)[run]) % 2 == 0
                at, nxt = at[keep], nxt[keep]
            if not len(at):
                continue
            sym[at] = self.merged[r]
            alive[nxt] = False
            over = after[nxt]
            after[at] = over
            inner = over < n
            before[over[inner]] = at[inner]
            left = before[at]
            note(np.unique(np.concatenate([left[left < n], at])))
        live = np.flatnonzero(alive[:n])
        return sym[live], np.concatenate([[0], np.cumsum(np.bincount(word[live], minlength=len(words)))])


class Encoder(ColumnEncoder):
    """Chunks between white space, encoded with the pair occurrence index."""

    def __init__(self, path: str, **limits: int):
        self.bpe = WordBpe(path)
        self.special = [s for s in self.bpe.special if any(c.isspace() for c in s)]  # others lie within a chunk
        self.kind = np.dtype("<u2" if len(self.bpe.tokens) <= 1 << 16 else "<u4")
        super().__init__(**{"together": 2 * TOGETHER, **limits})

    def learn(self, chunks: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        held = 0
        part: list[str] = []
        for c in chunks:
            part.append(c.decode().strip(" \t\n\r\x0b\x0c"))
            held += len(c)
            if held >= TOGETHER:
                out += self._learn(part)
                part, held = [], 0
        return out + self._learn(part) if part else out

    def _learn(self, chunks: list[str]) -> list[bytes]:
        bpe, parts, words = self.bpe, [], {}
        for c in chunks:
            own: list[int] = []
            cuts = [(m.start(), m.end()) for m in bpe._split_special.finditer(c)] if "<|" in c and bpe._split_special else []
            at = 0
            for s, e in [*cuts, (len(c), len(c))]:
                own += [words.setdefault(w, len(words)) for w in bpe.pretokens(c[at:s])]
                if e > s:
                    own.append(-1 - bpe.special[c[s:e]])
                at = e
            parts.append(own)
        ids, bounds = bpe.merge(list(words)) if words else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        ids, cut = ids.astype(self.kind).tobytes(), (self.kind.itemsize * bounds).tolist()
        return [b"".join(ids[cut[w] : cut[w + 1]] if w >= 0 else self.kind.type(-1 - w).tobytes() for w in own) for own in parts]

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by spaces: the file names no decoder."""
        return " ".join(map(self.bpe.tokens.__getitem__, ids.tolist()))


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_documents(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of every row.

    ``tokenizer`` is the path of a tokenizers JSON file with a word-end BPE
    model, on every executor. A null or empty text has no ids and decodes to
    the empty string. Ids null or repeated are kept as they come; other
    columns are ignored; texts of any length are encoded whole.
    """

    def run(batches):
        enc = _encoder(tokenizer)
        for big in batches:
            for rows in _blocks(big, 1, 4 << 20):
                ids, bounds = enc.encode_column(rows.column(1))
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([rows.column(0), lists, pa.array([enc.decode(x) for x in np.split(ids, bounds[1:-1])], pa.string())], names=["id", "ids", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"id {kind}, ids array<int>, decoded string")


def token_digests(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the figures of ``op3``.

    The same encoder and decoder as ``encode_documents``; the ids stay in the
    worker and only their digests are returned.
    """

    def run(batches):
        enc = _encoder(tokenizer)
        digit = [str(i) for i in range(len(enc.bpe.tokens))]
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for big in batches:
            for rows in _blocks(big, 1, 4 << 20):
                flat, bounds = enc.encode_column(rows.column(1))
                ids = np.split(flat, bounds[1:-1])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([sha(" ".join(map(digit.__getitem__, x.tolist()))) for x in ids]), pa.array([sha(enc.decode(x)) for x in ids])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
