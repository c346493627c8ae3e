import hashlib

import corpus_pipeline
import numpy as np
from test_decontam import plain as overlaps
from test_secrets import plain as secrets
from test_simhash import components
from tokenizers import Tokenizer

from millrace.llm import quality, simhash
from millrace.llm.queries import tokenizer_path


def test_stages_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit(docs, marks)
    good, bad = model.compressors()
    score = lambda t: float(model.score(np.array([quality.difference((t or "").encode(), good, bad)]))[0])
    kept = {r.doc_id: r.text for r in docs.collect() if score(r.text) >= corpus_pipeline.REJECT_BELOW}
    root = components([(i, simhash.fingerprint(t.encode())) for i, t in kept.items()], 2)
    kept = {i: t for i, t in kept.items() if root[i] == i}
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = {i: t for i, t in kept.items() if not any(overlaps(t, b) for b in items)}
    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    lib.no_truncation()
    want = {}
    for i, t in kept.items():
        end, out = 0, []
        for _, s, e in secrets(t):
            if s >= end:
                out += [t[end:s], "[SECRET]"]
            end = max(end, e)
        ids = lib.encode("".join(out) + t[end:], add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want


def test_stages_keep_columns_and_stand_odd_rows(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        seen = docs
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            assert out.count() <= docs.count()
            seen = out
    assert seen.count() == 0
    once = corpus_pipeline.drop_near_duplicates(spark, odd_docs, sf)
    ids = [r.doc_id for r in once.where("doc_id IS NOT NULL").collect()]
    assert len(ids) == len(set(ids)) and once.where("doc_id IS NULL").count() == 2


def test_rows_without_text_or_id_stay_whole(spark, sf):
    rows = [(7, None, "en", "src", 0), (7, None, "en", "src", 0), (None, None, "fr", "keepme", 1), (8, None, "de", "b", 2), (9, None, "de", "a", 2), (None, "own words", "en", "y", 9), (None, "own words", "en", "x", 9),
            (3, "some other words of a text", "en", "z", 1), (3, "some other words of a text", "en", "q", 1), (5, "unlike all the rest here", None, None, None), (5, None, "en", "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect()), key=repr)
    want = [(None, None, "fr", "keepme", 1), (None, "own words", "en", "x", 9), (3, "some other words of a text", "en", "q", 1), (5, "unlike all the rest here", None, None, None)]
    assert got == sorted(want, key=repr)


def test_stages_stand_clashing_and_missing_columns(spark, sf):
    docs = spark.createDataFrame([(1, "password = hunter2hunter2 and more", 0.5, "s", 1)], "doc_id long, text string, score double, __score string, __id int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() <= 1
    assert corpus_pipeline.redact_secrets(spark, docs, sf).first().text == "[SECRET] and more"
