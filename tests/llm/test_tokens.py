import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import bpe, tokenfile
from millrace.llm.common import Stage
from millrace.llm.queries import tokenizer_path

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
HARD = [
    "", " ", "\n\n", "a", "Hello, World! It's we'll don't 12345", "<|startoftext|>x<|endoftext|>", "x<|endoftext|>", "<|endoftext|><|endoftext|> a", "<|end", "ÀÉÎ ñ ß ﬁ Å",
    "日本語テキスト と English", "emoji 👩‍👩‍👧 flags 🇩🇪", "a b c　d", "tabs\tand\r\nlines\n", "İstanbul ǅ Ω", "é combining", "\u0000\u0001 ctl", "aaaaaaaaaaaaaaaaaaaa", "''' ''s 'S 'LL",
    "x" * 300, "word " * 500, "ünï" * 100, "﻿ bom", "½ ² ٣ Ⅷ", "\x1c\x1d sep \x85 nel", "<|startoftext |>", "a<|ENDOFTEXT|>b", " <|endoftext|> ",
]


@pytest.fixture(scope="module")
def word():
    t = Tokenizer.from_file(tokenizer_path(WORD))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def byte():
    t = Tokenizer.from_file(tokenizer_path(BYTE))
    t.no_truncation()
    t.no_padding()
    return t


def test_word_encoder_equals_the_library(word):
    enc = bpe.Encoder(tokenizer_path(WORD))
    for text, ids in zip(HARD, enc.encode(HARD)):
        want = word.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, repr(text)
        assert enc.decode(ids) == word.decode(want, skip_special_tokens=False), repr(text)


def test_byte_encoder_equals_the_library(byte):
    enc = tokenfile.ByteEncoder(tokenizer_path(BYTE))
    for text, ids in zip(HARD, enc.encode(HARD)):
        assert ids.tolist() == byte.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), st.text("ab., \n\t\u00a0\u3000é×Σσ'1<|", max_size=40)))
def test_any_text_encodes_as_the_library_does(text):
    for cls, name in ((bpe.Encoder, WORD), (tokenfile.ByteEncoder, BYTE)):
        key = name
        if key not in _KEPT:
            t = Tokenizer.from_file(tokenizer_path(name))
            t.no_truncation()
            t.no_padding()
            _KEPT[key] = cls(tokenizer_path(name)), t
        enc, lib = _KEPT[key]
        assert enc.encode([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids


_KEPT: dict = {}


def test_digests_of_odd_rows(odd_docs, no_docs, word):
    got = bpe.token_digests(odd_docs, tokenizer_path(WORD)).collect()
    assert len(got) == odd_docs.count()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in odd_docs.select("doc_id", "text").collect():
        ids = word.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(word.decode(ids, skip_special_tokens=False))))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert bpe.token_digests(no_docs, tokenizer_path(WORD)).count() == 0
    whole = bpe.encode_documents(odd_docs, tokenizer_path(WORD)).collect()
    assert sum(len(r.ids) for r in whole) == sum(w[1] for w in want)


def test_token_files(spark, odd_docs, no_docs, byte):
    stage = Stage(spark, "t")
    manifest = tokenfile.write_shards(odd_docs, tokenizer_path(BYTE), f"{stage.root}/shards", stage, shard_bytes=20_000)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokenfile.read_shards(manifest).collect())
    rows = odd_docs.selectExpr("doc_id", "text", "xxhash64(cast(coalesce(text, '') as binary)) AS h").collect()
    at, want = 0, []
    for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h)):
        ids = [*byte.encode(r.text or "", add_special_tokens=False).ids, 0]
        want.append((at, r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want and sum(r[1] is None for r in got) == 2
    for shard in manifest.collect():
        reader = tokenfile.ShardReader(shard.path)
        keys = np.unique(reader.documents()[0][: reader.n_docs - reader.nameless])
        known, first, last = reader.find(keys)
        assert known.all() and sorted(reader.index.slots(keys).tolist()) == list(range(len(keys)))
        assert all((x == y).all() for x, y in zip(reader.find(keys), reader.find_all(keys)))
        for k, a, b in zip(keys.tolist(), first.tolist(), last.tolist()):
            assert b - a == sum(n for _, i, n, _ in want if i == k)
        assert not reader.find(keys + 1_000_003)[0].any()
    empty = tokenfile.write_shards(no_docs, tokenizer_path(BYTE), f"{stage.root}/none", stage)
    assert tokenfile.read_shards(empty).count() == 0


@pytest.mark.parametrize("limits", [{"entries": 40, "room": 300}, {"entries": 500, "room": 4000, "together": 200}, {"longest": 4}, {"entries": 3, "room": 10}])
def test_a_full_table_forgets_and_encodes_alike(word, byte, limits):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdeéßñ."), rng.integers(1, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(words, 60)) + rng.choice([".", "\n", " ", ",", "\u00a0 x"]) for _ in range(40)] + HARD
    for cls, name, lib in ((bpe.Encoder, WORD, word), (tokenfile.ByteEncoder, BYTE, byte)):
        enc = cls(tokenizer_path(name), **limits)
        for _ in range(2):
            for k in range(0, len(texts), 7):
                got = enc.encode(texts[k : k + 7])
                assert [x.tolist() for x in got] == [lib.encode(t, add_special_tokens=False).ids for t in texts[k : k + 7]]
        assert enc.table.count <= enc.table.entries and enc.table._key_end <= enc.table.room


def test_equal_hashes_are_told_apart(byte):
    enc = tokenfile.ByteEncoder(tokenizer_path(BYTE))
    enc.table._hashes = lambda data, cuts: (np.diff(cuts) % 2).astype(np.uint64)  # nearly all chunks collide
    for _ in range(2):
        assert [x.tolist() for x in enc.encode(HARD)] == [byte.encode(t, add_special_tokens=False).ids for t in HARD]


def test_bytes_that_are_no_text(byte):
    import pyarrow as pa

    enc = tokenfile.ByteEncoder(tokenizer_path(BYTE))
    raw = [b"ok then", b"bad \xff\xfe x", b"cut \xc3", b"\xa9 rest", None, b"", b"fine \xc3\xa9."]
    ids, bounds = enc.encode_column(pa.array(raw, pa.binary()))
    assert [x.tolist() for x in np.split(ids, bounds[1:-1])] == [byte.encode((t or b"").decode("utf-8", "replace"), add_special_tokens=False).ids for t in raw]


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(0).integers(-(1 << 62), 1 << 62, 50_000))
    index = tokenfile.PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        tokenfile.PerfectHash.build(np.array([1, 1, 2]))
