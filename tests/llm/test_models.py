import numpy as np

from millrace.llm import langid, quality
from millrace.llm.queries import QUERIES


def test_held_out_ids(spark):
    import zlib

    rows = spark.range(200).select("id", quality.held_out(__import__("pyspark").sql.functions.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_quality_on_held_out_rows(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in QUERIES["op5_quality"](spark, sf).collect()}
    marks = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    score = np.array([got[r.doc_id].score for r in marks])
    y = np.array([r.quality for r in marks])
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    auc = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.9
    assert ((score >= 0.5) == (y == 1)).mean() > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    marks = spark.createDataFrame([(0, 1, 0), (3, 0, None), (5, 1, 0), (6, 0, 1), (6, 1, 1), (None, 1, 0), (9, None, 0), (10, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(odd_docs, marks)
    got = quality.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.score(no_docs, model).count() == 0
    alone = quality.fit(odd_docs, marks.where("quality = 1"))
    assert {r.score > 0.5 for r in quality.score(odd_docs, alone).collect()} == {True}
    unknown = quality.fit(no_docs, marks.limit(0))
    assert {round(r.score, 2) for r in quality.score(odd_docs, unknown).collect()} == {0.5}


def test_labels_and_source_do_not_change_scores(spark, sf):
    from pyspark.sql import functions as F

    docs, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, marks)
    a = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    b = {r.doc_id: r.score for r in quality.score(docs.withColumn("source", F.lit("z")).withColumn("lang", F.lit("q")), model).collect()}
    assert a == b


def test_language_on_held_out_rows(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    told = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in QUERIES["op7_langid"](spark, sf).collect() if r.held_out and told[r.doc_id].lang]
    right = np.mean([r.lang_pred == told[r.doc_id].lang for r in got])
    assert right > 0.95


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    mixed = odd_docs.withColumn("lang", __import__("pyspark").sql.functions.expr("CASE doc_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END"))
    model = langid.fit(mixed)
    got = langid.identify(mixed, model).collect()
    assert len(got) == odd_docs.count()
    text = {r.doc_id: r.text for r in odd_docs.where("doc_id IS NOT NULL").collect()}
    for r in got:
        blank = r.id is not None and not any(c.isalpha() for c in text[r.id] or "")
        assert (r.lang_pred == "und") == (blank or (r.id is None and r.score == 0)) and 0 <= r.score <= 1
    assert langid.identify(no_docs, model).count() == 0
    nothing = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.identify(odd_docs, nothing).collect()} == {"und"}


def test_codewords_are_apart():
    for k in (2, 3, 4, 6, 9, 20):
        code = langid.codewords(k)
        assert len(code) == k and len({tuple(row) for row in code.tolist()}) == k
        assert all((code[i] != code[j]).sum() >= max(1, code.shape[1] // 4) for i in range(k) for j in range(i))


def test_texts_without_letters_are_undetermined(spark):
    from unicodedata import category

    texts = ["½ ²", "Ⅷ Ⅳ", "ⓐ", "١٢٣", "1 2 3", "_ - !", "\u0301", "ª", "ʰ", "中", "a1", "é", "名 12"]
    docs = spark.createDataFrame([(i, "the words of the language " * 3, "en") for i in range(0, 40)] + [(100 + i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.id: r for r in langid.identify(docs, langid.fit(docs)).collect()}
    for i, t in enumerate(texts):
        letter = any(category(c).startswith("L") for c in t)
        assert (got[100 + i].lang_pred == "und") == (not letter), t
        assert letter or got[100 + i].score == 0


def plain_grams(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in b" " + text + b" ")
    out = {}
    for i in range(len(raw) - 2):
        a, b, c = raw[i : i + 3]
        h = ((a << 16 | b << 8 | c) * 2654435761 % (1 << 32)) >> 18
        out[h] = out.get(h, 0) + 1
    return out


def test_language_scores_equal_a_plain_computation(spark, sf):
    """Codewords, bit classifiers and loss-weighted decoding, one text at a time from their definitions."""
    import math
    import zlib

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    learned = [r for r in rows if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    langs = sorted({r.lang for r in learned})
    assert all(sum(r.lang == x for r in learned) <= langid.SAMPLE for x in langs)  # so that all are fitted on
    total = {x: {} for x in langs}
    for r in learned:
        for h, n in plain_grams(r.text.encode()).items():
            total[r.lang][h] = total[r.lang].get(h, 0) + n
    p = {x: [(total[x].get(h, 0) + 0.5) / (sum(total[x].values()) + 0.5 * langid.BUCKETS) for h in range(langid.BUCKETS)] for x in langs}
    code = langid.codewords(len(langs)).tolist()
    bits = range(len(code[0]))
    mean = lambda v: sum(v) / len(v)
    weight = [[math.log(mean([p[x][h] for i, x in enumerate(langs) if code[i][j] > 0])) - math.log(mean([p[x][h] for i, x in enumerate(langs) if code[i][j] < 0])) for h in range(langid.BUCKETS)] for j in bits]
    own = [[sum(a * b for a, b in zip(p[x], weight[j])) for j in bits] for x in langs]
    scale = [mean([abs(own[i][j]) for i in range(len(langs))]) for j in bits]
    trust = [min(max(min(code[i][j] * own[i][j] / scale[j] for i in range(len(langs))), 0.05), 1) for j in bits]
    trust = [t / sum(trust) * min(8, len(trust)) for t in trust]
    got = {r.doc_id: r for r in QUERIES["op7_langid"](spark, sf).collect()}
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert got[r.doc_id].lang_pred == "und"
            continue
        grams = plain_grams(r.text.encode())
        margin = [sum(n * weight[j][h] for h, n in grams.items()) / sum(grams.values()) / scale[j] for j in bits]
        loss = [sum(t * math.log1p(math.exp(-4 * c * m)) for t, c, m in zip(trust, row, margin)) for row in code]
        best = min(range(len(langs)), key=lambda i: loss[i])
        score = 1 / sum(math.exp(loss[best] - x) for x in loss)
        assert got[r.doc_id].lang_pred == langs[best] and abs(got[r.doc_id].score - score) < 1e-6


def test_quality_scores_equal_a_plain_computation(spark, sf):
    """Each score from two compressions of each piece and the calibration, one text at a time."""
    import math

    import zstandard

    docs, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, marks)
    again = quality.fit(docs.repartition(7), marks.repartition(3))
    assert (again.good, again.bad) == (model.good, model.bad) and np.allclose(again.weight, model.weight)
    size = lambda piece, book: len(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(book), write_content_size=False, write_dict_id=False, write_checksum=False).compress(piece))
    got = {r.doc_id: r.score for r in QUERIES["op5_quality"](spark, sf).collect()}
    for r in docs.select("doc_id", "text").where("doc_id % 5 = 0").collect():  # a check of a fifth: compressors are made anew for each piece
        text = (r.text or "").encode()
        sizes = [(size(text[i : i + quality.PIECE], model.good), size(text[i : i + quality.PIECE], model.bad)) for i in range(0, len(text), quality.PIECE)]
        d = sum(a - b for a, b in sizes) / max(1, len(text))
        z = model.weight[0] + model.weight[1] * (math.asinh(d / quality.BEND) - model.center[1]) / model.scale[1]
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-z))) < 1e-6
