"""Set-similarity and Hamming joins, and contamination by n-gram overlap.

A text pair without a common shingle scores nothing, so the comparison of all
pairs is an equi-join on shingles followed by counting. Texts of fewer than
eight distinct words are compared by words; of those only the rarest are
joined on, as many as any pair above the threshold must share.

Shingles are exploded with nulls kept: the optimizer would otherwise test the
array's size below the projection and compute the words once per shingle. The
joins drop the nulls.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.common import BROADCAST_BYTES, BROADCAST_ROWS, cut, ranked, small

NGRAM, THRESHOLD = 8, 0.5
#: Hashes that are compared with all, hashes that one key should file, hashes of one task, hashes of one key in one task, rows of one batch.
FEW, FILED, TOGETHER, HOT, PIECE = 8_000, 8_000, 20_000, 200_000, 100_000
#: Comparisons of one piece, and hashes of a run that are compared by a walk over all runs at once.
CACHED, RUN = 1 << 16, 32
#: Bytes of texts that are looked through at once, bytes of words, and odd factors of the hashes that texts are first looked through by.
LOOK = 1 << 20
WORD_BYTES = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8))
BASE, MIX, GRAM = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_KNOWN_POWERS: dict[bool, np.ndarray] = {}


def lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line of a text: (id, line_no, line, kept columns)."""
    return df.select(id_col, *keep, F.posexplode(F.split(text_col, "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))


def prepared(df: DataFrame, text_col: str, n: int = NGRAM) -> DataFrame:
    """Adds norm, the set of shingle hashes and the set of words of a text column."""
    w = T.words(F.col(text_col))
    return df.withColumn("__w", w).select("*", F.array_join("__w", " ").alias("norm"), T.shingle_hashes(F.col("__w"), n).alias("grams"), F.array_distinct("__w").alias("words")).drop("__w")


def references(df: DataFrame, id_col: str, text_col: str, n: int = NGRAM) -> DataFrame:
    """(ref_id, ref_norm, ref_shingles, ref_words); empty instructions are dropped."""
    told = df.where(F.coalesce(F.col(text_col), F.lit("")) != "").select(F.col(id_col).alias("ref_id"), T.words(F.col(text_col)).alias("__w"))
    return told.select("ref_id", F.array_join("__w", " ").alias("ref_norm"), T.shingles(F.col("__w"), n).alias("ref_shingles"), F.array_distinct("__w").alias("ref_words"))


def postings(refs: DataFrame) -> DataFrame:
    """(ref_id, n_ref, ref_norm, shingle, gram): the references' shingles with the hashes texts are compared by."""
    each = refs.select("ref_id", F.size("ref_shingles").alias("n_ref"), "ref_norm", F.explode("ref_shingles").alias("shingle"))
    return each.withColumn("gram", F.xxhash64(F.split("shingle", " ")))


def shingle_matches(texts: DataFrame, refs: DataFrame, key: list[str], rows: int = BROADCAST_ROWS) -> DataFrame:
    """(key, ref_id, same, jaccard, containment, n_words, fragments) of pairs that share a shingle.

    Shingles meet by 64-bit hashes, so that texts carry numbers through the
    join; fragments are the references' own strings. ``same`` compares the
    normal forms by their SHA-256.
    """
    theirs = small(postings(refs).withColumn("__same", F.sha2("ref_norm", 256)).drop("ref_norm"), rows)
    own = texts.select(*key, F.size("grams").alias("n_own"), F.size("words").alias("n_words"), "norm", F.explode_outer("grams").alias("gram"))
    shared = own.join(theirs, "gram").withColumn("same", F.col("n_own") == F.col("n_ref")).withColumn("same", F.when(F.col("same"), F.sha2("norm", 256) == F.col("__same")).otherwise(False))
    counted = shared.groupBy(*key, "ref_id").agg(
        F.count("*").alias("n"), F.first("n_own").alias("n_own"), F.first("n_ref").alias("n_ref"), F.first("n_words").alias("n_words"), F.bool_or("same").alias("same"), F.collect_list("shingle").alias("found")
    )
    return counted.select(
        *key, "ref_id", "same", (F.col("n") / (F.col("n_own") + F.col("n_ref") - F.col("n"))).alias("jaccard"),
        (F.col("n") / F.col("n_own")).alias("containment"), "n_words", F.slice(F.array_sort("found"), 1, 5).alias("fragments"),
    )


def word_matches(texts: DataFrame, refs: DataFrame, key: list[str], threshold: float = THRESHOLD, rows: int = BROADCAST_ROWS) -> DataFrame:
    """(key, ref_id, overlap) where at least ``threshold`` of a text's distinct words are in a reference.

    Of n words at least ceil(threshold n) must be shared, so one of the
    n - ceil(threshold n) + 1 rarest among the references must be.
    """
    theirs = refs.select("ref_id", F.explode("ref_words").alias("word"))
    frequency = small(theirs.groupBy("word").agg(F.count("*").alias("df")), rows)
    each = texts.select(*key, "words", F.explode_outer("words").alias("word")).join(frequency, "word", "left")
    each = each.withColumn("__rank", ranked(key, F.coalesce("df", F.lit(0)), F.col("word")))
    probes = each.where(F.col("df").isNotNull() & (F.col("__rank") <= F.size("words") - F.ceil(threshold * F.size("words")) + 1))
    pairs = probes.join(small(theirs, rows), "word").groupBy(*key, "ref_id").agg(F.first("words").alias("words"))
    found = pairs.join(small(refs.select("ref_id", "ref_words"), rows), "ref_id")
    share = F.size(F.array_intersect("words", "ref_words")) / F.greatest(F.lit(1), F.size("words"))
    return found.select(*key, "ref_id", share.alias("overlap")).where(F.col("overlap") >= threshold)


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The row and a 64-bit hash of every word [a-z0-9]+ of lower-cased texts, in order.

    A word's hash is a polynomial over its bytes, taken from running sums over
    the whole batch.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if pa.types.is_string(texts.type) else np.int64)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = WORD_BYTES[data]
    starts_here = inside.copy()
    starts_here[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    starts_here[firsts] |= inside[firsts]  # a text's first byte is no word's continuation
    starts = np.flatnonzero(starts_here)
    ends_here = ~inside
    ends_here[firsts] = True
    ends = np.flatnonzero(ends_here)
    ends = ends[np.searchsorted(ends, starts, side="right")]
    power = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    # the sum of a word is its polynomial times the power of its start, which multiplying by the inverse power undoes
    hashes = (sums[ends] - sums[starts]) * _powers(len(data) + 1, True)[starts]
    hashes = (hashes ^ (hashes >> np.uint64(29))) * MIX
    return np.searchsorted(offsets, starts, side="right") - 1, hashes ^ (hashes >> np.uint64(32))


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    known = _KNOWN_POWERS.get(inverse)
    if known is None or len(known) < n:
        step = pow(BASE, -1, 1 << 64) if inverse else BASE
        known = np.full(max(n, 1 << 16), step, np.uint64)
        known[0] = 1
        known = _KNOWN_POWERS[inverse] = np.multiply.accumulate(known)
    return known[:n]


def _gram_hashes(row: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The row and a hash of every run of n words of a row; a row of fewer words is one run."""
    size = np.bincount(row) if len(row) else np.zeros(0, np.int64)
    whole = np.flatnonzero(row[n - 1 :] == row[: max(0, len(row) - n + 1)])
    out = np.zeros(len(whole), np.uint64)
    for k in range(n):
        out = out * GRAM + word[whole + k]
    rows, runs = [row[whole]], [out]
    first = np.cumsum(size) - size
    for m in range(1, n):
        some = np.flatnonzero(size == m)
        short = np.zeros(len(some), np.uint64)
        for k in range(m):
            short = short * GRAM + word[first[some] + k]
        rows.append(some)
        runs.append(short)
    return np.concatenate(rows), np.concatenate(runs)


def _scarce(row: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The row and hash of the distinct words of the rows that have fewer than n of them."""
    size = np.bincount(row) if len(row) else np.zeros(0, np.int64)
    first = np.cumsum(size) - size
    place = np.arange(len(row)) - first[row]
    look = place < 4 * n  # enough to tell that most rows have n
    for some in (look, None):
        if some is None:
            some = few[row]
        r, w = row[some], word[some]
        order = np.lexsort((w, r))
        r, w = r[order], w[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (w[1:] != w[:-1])
        r, w = r[new], w[new]
        few = np.bincount(r, minlength=len(size)) < n
    keep = few[r]
    return r[keep], w[keep]


def worth_matching(texts: DataFrame, refs: DataFrame, text_col: str, threshold: float = THRESHOLD, n: int = NGRAM, words: bool = True, most: int = BROADCAST_BYTES) -> DataFrame:
    """The texts that may match a reference: all that do, and few others.

    Kept are texts that share a hash of a shingle with the references and, with
    ``words``, those of fewer than n distinct words of which at least
    ``threshold`` occur in the references; hashes that collide only keep more.
    References are held by every worker, so beyond ``most`` bytes all texts stay.
    """
    told = refs.select("ref_norm")
    size = told.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.coalesce(F.sum(F.length("ref_norm")), F.lit(0))).first()
    if size[0] > BROADCAST_ROWS or size[1] > most:
        return texts
    known = pa.array([r[0] for r in told.collect()], pa.string())
    row, word = _word_hashes(known)
    grams, vocabulary = np.unique(_gram_hashes(row, word, n)[1]), np.unique(word)
    held = texts.sparkSession.sparkContext.broadcast((_table(grams), grams, _table(vocabulary), vocabulary))

    def keep(text: pa.Array) -> pa.Array:
        some = np.arange(len(text)) if not len(text) else pc.binary_length(text).to_numpy(zero_copy_only=False).cumsum() // LOOK
        cuts = np.flatnonzero(np.diff(some)) + 1
        return pa.array(np.concatenate([look(text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)])]))

    def look(text: pa.Array) -> np.ndarray:
        gram_table, grams, word_table, vocabulary = held.value
        row, word = _word_hashes(text)
        out = np.zeros(len(text), bool)
        rows, runs = _gram_hashes(row, word, n)
        out[rows[_known(runs, gram_table, grams)]] = True
        if words:
            rows, some = _scarce(row, word, n)
            have, shared = np.bincount(rows, minlength=len(text)), np.bincount(rows[_known(some, word_table, vocabulary)], minlength=len(text))
            out |= (have > 0) & (shared >= threshold * have)
        return out

    test = F.arrow_udf(keep, "boolean")
    return texts.where(test(F.lower(F.coalesce(F.col(text_col), F.lit("")))))


def _table(hashes: np.ndarray) -> np.ndarray:
    """Which low bits of a hash occur at all, eight times as many places as hashes at least."""
    places = np.zeros(1 << max(10, int(8 * len(hashes)).bit_length()), bool)
    places[(hashes & np.uint64(len(places) - 1)).astype(np.int64)] = True
    return places


def _known(hashes: np.ndarray, places: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where the hashes are among the sorted ``known``."""
    maybe = np.flatnonzero(places[(hashes & np.uint64(len(places) - 1)).astype(np.int64)])
    at = np.searchsorted(known, hashes[maybe])
    return maybe[known[np.minimum(at, len(known) - 1)] == hashes[maybe]] if len(known) else maybe[:0]


def best_matches(texts: DataFrame, refs: DataFrame, key: list[str], threshold: float = THRESHOLD, n: int = NGRAM) -> DataFrame:
    """The best reference of every text at or above the threshold.

    ``texts`` as from ``prepared``; ``refs`` as from ``references``. Returns
    (key, kind, ref_id, score, fragments): kind is exact, near_jaccard or
    containment; equal scores go to the smallest reference id.
    """
    is_short = F.size("words") < n
    grams = shingle_matches(texts, refs, key)
    exact = grams.where("same").select(*key, "ref_id", F.lit("exact").alias("kind"), F.lit(2.0).alias("__by"), F.lit(1.0).alias("score"), F.array().cast("array<string>").alias("fragments"))
    words = word_matches(texts.select(*key, "words").where(is_short), refs, key, threshold)
    long_pairs = grams.where(F.col("n_words") >= n).select(*key, "ref_id", "jaccard", "containment", "fragments")
    # a short text's containment is its word overlap; a pair that shares the shingle shares all its words
    short_pairs = words.join(grams.select(*key, "ref_id", "jaccard", "fragments"), [*key, "ref_id"], "left").select(
        *key, "ref_id", F.coalesce("jaccard", F.lit(0.0)).alias("jaccard"), F.col("overlap").alias("containment"), F.coalesce("fragments", F.array().cast("array<string>")).alias("fragments")
    )
    fuzzy = long_pairs.unionByName(short_pairs).withColumn("score", F.greatest("jaccard", "containment")).where(F.col("score") >= threshold)
    fuzzy = fuzzy.select(*key, "ref_id", F.when(F.col("jaccard") >= F.col("containment"), "near_jaccard").otherwise("containment").alias("kind"), F.col("score").alias("__by"), "score", "fragments")
    best = exact.unionByName(fuzzy).groupBy(*key).agg(F.min_by(F.struct("kind", "ref_id", "score", "fragments"), F.struct(-F.col("__by"), "ref_id")).alias("b"))
    return best.select(*key, "b.kind", "b.ref_id", F.round("b.score", 4).alias("score"), "b.fragments")


def contaminated(texts: DataFrame, refs: DataFrame, key: list[str], text_col: str, threshold: float = THRESHOLD, n: int = NGRAM) -> DataFrame:
    """``best_matches`` of plain texts: those worth it are prepared, written once and matched."""
    some = worth_matching(texts.select(*key, text_col), refs, text_col, threshold, n)
    return best_matches(cut(prepared(some, text_col, n).drop(text_col)), refs, key, threshold, n)


def remove_contaminated(df: DataFrame, flagged: DataFrame, key: list[str]) -> DataFrame:
    """Rows without a flag. Flags are many where contamination is; AQE picks the join."""
    return df.join(flagged.select(*key).distinct(), key, "left_anti")


def contamination_report(texts: DataFrame, flagged: DataFrame, key: list[str], source: str) -> DataFrame:
    """(source, scanned, exact, similar, removed) for each source and, with a null source, in all."""
    marked = texts.select(*key, source).join(flagged.select(*key, "kind"), key, "left")
    removed = F.col("kind").isNotNull()
    return marked.groupingSets([[source], []], source).agg(
        F.count("*").alias("scanned"), F.count_if(F.coalesce(F.col("kind") == "exact", F.lit(False))).alias("exact"),
        F.count_if(F.coalesce(F.col("kind") != "exact", F.lit(False))).alias("similar"), F.count_if(removed).alias("removed"),
    )


def similarity_histogram(matches: DataFrame, score: str = "score") -> DataFrame:
    return matches.groupBy((F.least(F.lit(9), F.floor(F.round(score, 3) * 10)) / 10).alias("bin")).agg(F.count("*").alias("n"))


def reference_containment(df: DataFrame, refs: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs where a text holds at least ``threshold`` of a reference's shingles (an extension)."""
    theirs = small(postings(refs).select("ref_id", "n_ref", "gram"))
    some = worth_matching(df.select(id_col, text_col), refs, text_col, words=False)
    own = prepared(some, text_col).select(id_col, F.explode_outer("grams").alias("gram"))
    counted = own.join(theirs, "gram").groupBy(id_col, "ref_id").agg(F.count("*").alias("n"), F.first("n_ref").alias("n_ref"))
    return counted.select(id_col, "ref_id", (F.col("n") / F.col("n_ref")).alias("share")).where(F.col("share") >= threshold)


def _masks(radius: int, more: int, within: int = (1 << 64) - 1) -> list[int]:
    """Bit masks of ``more`` of radius + more bands of the bits ``within``, for every choice of bands."""
    n, places = radius + more, [i for i in range(64) if within >> i & 1]
    band = [sum(1 << p for p in places[i * len(places) // n : (i + 1) * len(places) // n]) for i in range(n)]
    return [sum(some) for some in itertools.combinations(band, more)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _all_near(h: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j of hashes that differ in at most ``radius`` bits: all are compared, by pieces that a core's cache holds."""
    n, at = len(h), 0
    while at < n - 1:
        step, width = max(1, CACHED // (n - at)), n - at
        found = np.flatnonzero(np.bitwise_count(h[at : at + step, None] ^ h[None, at:]) <= radius)
        i, j = found // width, found % width
        later = i < j
        if later.any():
            yield i[later] + at, j[later] + at
        at += step


def _near(h: np.ndarray, radius: int, within: int, few: int = FEW) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of distinct hashes that agree outside ``within`` and differ in at most ``radius`` bits, each once, in pieces.

    Few hashes are compared with all; more are sorted by choices of bands of the
    bits left, and compared along runs of equal bands, unless the runs are so
    long, as families of near copies make them, that comparing all is less work.
    """
    n = len(h)
    more = next((m for m in range(2, 4) if 1 << bin(within).count("1") * m // (radius + m) >= n), 4)
    masks = [np.uint64(m) for m in _masks(radius, more, within)] if n > few else []
    work = 0
    for mask in masks:
        bits = np.sort(h & mask)
        sizes = np.diff(np.flatnonzero(np.concatenate([[True], bits[1:] != bits[:-1], [True]])))
        work += int((sizes.astype(np.int64) ** 2).sum())
        if work > n * n:
            break
    if n <= few or work > n * n:
        yield from _all_near(h, radius)
        return
    for k, mask in enumerate(masks):
        bits = h & mask
        order = np.argsort(bits, kind="stable")
        sorted_ = h[order]
        for i, j in _near_in_runs(sorted_, bits[order], radius):
            x, new = sorted_[i] ^ sorted_[j], np.ones(len(i), bool)
            for earlier in masks[:k]:
                new &= (x & earlier) != 0
            if new.any():
                yield order[i[new]], order[j[new]]


def _near_in_runs(h: np.ndarray, bits: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j of hashes within ``radius`` bits in each run of equal ``bits``: long runs one by one, the others by a walk over all."""
    edges = np.flatnonzero(np.concatenate([[True], bits[1:] != bits[:-1], [True]]))
    starts, sizes = edges[:-1], np.diff(edges)
    for start, size in zip(starts[sizes > RUN], sizes[sizes > RUN]):
        for i, j in _all_near(h[start : start + size], radius):
            yield i + start, j + start
    ends, at = np.repeat(np.where(sizes > RUN, 0, starts + sizes), sizes), np.arange(len(h))
    for gap in range(1, RUN):
        at = at[at + gap < ends[at]]
        near = at[np.bitwise_count(h[at] ^ h[at + gap]) <= radius]
        yield near, near + gap


def hamming_links(df: DataFrame, id_col: str, hash_col: str, radius: int = 6, more: int | None = None, most: int = HOT) -> DataFrame:
    """(a, b, distance) of the classes of equal hashes that are within ``radius`` bits of 64.

    A class is named by its smallest id; copies are not expanded into pairs, see
    ``hamming_classes`` for who belongs to whom. Two such hashes agree in
    ``more`` of radius + more bands of bits, so the hashes are filed under every
    choice of that many bands, and ``_near`` compares what agrees in one; a pair
    is kept in the first choice it agrees in. Unless given, ``more`` is the
    least that files some thousands of hashes together. A task takes what some
    keys file; what one key files beyond ``most`` hashes is dealt as pairs of
    blocks, so that no key is gathered in one task.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(hash_col).cast("long").alias("h"))
    points = cut(rows.groupBy("h").agg(F.min("id").alias("id")).where(F.col("h").isNotNull() & F.col("id").isNotNull()))
    n = points.count()
    if more is None:
        more = next((m for m in range(1, 4) if (1 << 64 * m // (radius + m)) * FILED >= n), 4)
    masks = _masks(radius, more)
    filed = points.select("id", "h", F.posexplode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("choice", "mask"))
    filed = filed.select("id", "h", "choice", F.col("h").bitwiseAND(F.col("mask")).alias("bits"))
    hot = filed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where(F.col("n") > most)
    hot = F.broadcast(hot.select("choice", "bits", F.ceil(F.col("n") / (most // 2)).cast("int").alias("blocks")))  # at most len(masks) n / most rows
    dealt = filed.join(hot, ["choice", "bits"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("part", F.when(F.col("blocks") > 1, F.col("bits")).otherwise(F.pmod(F.xxhash64("bits"), F.lit(2 + n // TOGETHER))))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("id", "h", "choice", "part", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    kind = df.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()

    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, (choice, _, low, high) = pa.Table.from_batches(batches), (k.as_py() for k in key)
        ids, h, block = rows["id"].combine_chunks(), rows["h"].to_numpy().view(np.uint64), rows["block"].to_numpy()
        bits = h & np.uint64(masks[choice])
        order = np.argsort(bits, kind="stable")
        ends = np.append(np.flatnonzero(np.diff(bits[order])) + 1, len(order))
        told, held = [], 0
        for start, end in zip([0, *ends[:-1]], ends):
            one = order[start:end]
            for i, j in _near(h[one], radius, ((1 << 64) - 1) ^ masks[choice]):
                i, j = one[i], one[j]
                x = h[i] ^ h[j]
                kept = np.ones(len(x), bool) if low == high else block[i] != block[j]
                for earlier in masks[:choice]:
                    kept &= (x & np.uint64(earlier)) != 0
                told.append((i[kept], j[kept], np.bitwise_count(x[kept])))
                held += len(told[-1][0])
                if held >= PIECE:
                    yield links(ids, told)
                    told, held = [], 0
        if held:
            yield links(ids, told)

    def links(ids: pa.Array, told: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        i, j, distance = (np.concatenate(x) for x in zip(*told))
        return pa.RecordBatch.from_arrays([ids.take(pa.array(i)), ids.take(pa.array(j)), pa.array(distance.astype(np.int32))], names=["i", "j", "distance"])

    found = dealt.groupBy("choice", "part", "low", "high").applyInArrow(compare, f"i {kind}, j {kind}, distance int")
    return found.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), "distance")


def hamming_classes(df: DataFrame, id_col: str, hash_col: str) -> DataFrame:
    """(id, h, representative): the smallest id with the same hash, by an aggregation and a join."""
    rows = df.select(F.col(id_col).alias("id"), F.col(hash_col).alias("h"))
    return rows.join(rows.groupBy("h").agg(F.min("id").alias("representative")), "h").select("id", "h", "representative")
