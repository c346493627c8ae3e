"""Queries that SQL does not express, against plain computations."""

import random
from collections import Counter

from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.operators import evaluation as E
from millrace.operators import runs, selection, trajectory
from millrace.operators.common import best_ranked, fixed_rows
from millrace.plans import QUERIES


def test_bootstrap_draws_one_by_one(spark):
    draw = random.Random(3)
    rows = [(i, draw.random() < 0.5, draw.random() < 0.6) for i in range(37)]
    base, other = (fixed_rows(spark, "id long, ok boolean", *[(r[0], r[k]) for r in rows]) for k in (1, 2))
    got = E.bootstrap(base, other, "id", resamples=400, seed=11).first()
    source, found = random.Random(11), []
    for _ in range(400):
        found.append(100.0 * sum(int(o) - int(b) for _, b, o in (rows[source.randrange(37)] for _ in range(37))) / 37)
    found.sort()
    assert (got.n, got.low, got.high) == (37, found[int(0.025 * 400) - 1], found[int(0.975 * 400)])


def test_motif_swaps_by_trying_all(spark):
    for seed in range(4):
        draw = random.Random(seed)
        names = ["a", "b", "c", "d"]
        rows = [(i, draw.choice("xy"), draw.choice("pq"), float(draw.randrange(20)), f"t{draw.random()}", draw.sample(names, draw.randrange(4))) for i in range(80)]
        first = {r[0] for r in rows if draw.random() < 0.4}
        floors = {"a": 0.5, "b": 14, "c": 12.0}
        pool = fixed_rows(spark, "k long, s string, c string, score double, tie string, motifs array<string>", *rows)
        chosen = pool.where(F.col("k").isin(*first))
        swaps = selection.motif_swaps(pool, chosen, floors, "k", "s", "c", "score", "tie", "motifs", counted=len(first))
        by, held = {r[0]: r for r in rows}, set(first)
        need = {"a": -(-len(first) // 2), "b": 14, "c": 12}
        have = lambda kept: Counter(m for k in kept for m in set(by[k][5]))

        def allowed(out, into, motif):
            if motif in by[out][5] or by[out][1:3] != by[into][1:3]:
                return False
            count = have(held)
            return all(count[m] > need[m] for m in set(by[out][5]) - set(by[into][5]) if m in need)

        want = []
        for motif in sorted(need, key=lambda m: (-need[m], m)):
            while have(held)[motif] < need[motif]:
                pairs = [(-by[i][3], by[i][4], by[o][3], by[o][4], i, o) for i in by if i not in held and motif in by[i][5] for o in held if allowed(o, i, motif)]
                if not pairs:
                    break
                *_, into, out = min(pairs)
                held = held - {out} | {into}
                want.append({"motif": motif, "in": into, "out": out})
        assert swaps == want and (seed or swaps)


def test_bucket_quota_in_order(spark):
    draw = random.Random(1)
    rows = [(i, draw.choice(["tiny", "small", "medium", "large", "odd"])) for i in range(300)]
    shares = {"tiny": 0.25, "small": 0.4, "medium": 0.25, "large": 0.1}
    got = sorted(r.k for r in trajectory.bucket_quota(fixed_rows(spark, "k long, b string", *rows).repartition(5), "b", "k", shares).collect())
    taken, count = [], Counter()
    for k, b in rows:
        if not taken or count[b] < 1.25 * shares.get(b, 0.0) * len(taken) + 2:
            count[b] += 1
            taken.append(k)
    assert got == taken


def test_emission_follows_its_rules(spark, sf):
    rows = {}
    for r in QUERIES["representation_emission"](spark, sf).collect():
        rows.setdefault(r.user_id, []).append(r)
    told = {r.user_id: r for r in QUERIES["window_start_draw"](spark, sf).collect()}
    form = {r.user_id: r.form for r in QUERIES["representation_draw"](spark, sf).collect()}
    assert rows and set(rows) <= set(told)
    for user, found in rows.items():
        found.sort(key=lambda r: r["rank"])
        n, kinds = told[user].n, [r.form for r in found]
        assert [r["rank"] for r in found] == list(range(len(found))) and len(found) <= 4
        assert all(0 <= r.start and r.start + r.steps <= n for r in found)
        windows = [r.start for r in found if r.form == "window"]
        assert all(abs(a - b) >= 4 for i, a in enumerate(windows) for b in windows[:i])
        if form[user] == "single":
            assert set(kinds) == {"single"} and len(kinds) == told[user].picks
        elif form[user] == "window":
            assert "chunk" not in kinds and kinds.count("single") == (1 if windows else min(2, told[user].picks))
        else:
            assert kinds.count("chunk") <= 1 and (not windows or "chunk" not in kinds) and kinds.count("single") == 1
            assert all(8 <= r.steps <= 12 for r in found if r.form == "chunk")


def test_plan_gate_keeps_to_its_rate_and_shares(spark):
    draw = random.Random(5)
    rows = [(i, draw.choice([*fixed.PLAN_SHARES, None, None]), draw.random()) for i in range(2000)]
    df = fixed_rows(spark, "k long, c string, u double", *rows).repartition(3)
    got = sorted(runs.plan_gate(df, "k", "c", "u", 0.1).collect())
    assert runs.plan_gate(df, "k", "c", "u", 0.0).count() == 0
    taken = Counter()
    for n, (k, c, _) in enumerate(got):
        assert n <= 0.1 * max(1, k) + 1  # what was given before step k does not exceed the rate
        taken[c] += 1
    assert set(taken) == set(fixed.PLAN_SHARES) and 0.08 <= len(got) / 2000 <= 0.105
    assert all(taken[c] <= share * len(got) + 3.5 for c, share in fixed.PLAN_SHARES.items())


def test_best_ranked_equals_one_window(spark):
    draw = random.Random(2)
    rows = [(i, draw.choice("aaab"), draw.randrange(9), {"a": 17, "b": 3}[k]) for i in range(400) for k in [draw.choice("ab")]]
    df = fixed_rows(spark, "k long, g string, v long, most long", *[(i, g, v, 11) for i, g, v, _ in rows])
    got = sorted((r.g, r["rank"], r.k) for r in best_ranked(df, ["g"], "most", F.desc("v"), F.asc("k"), salts=7).collect())
    want = [(g, i + 1, k) for g in "ab" for i, (_, k) in enumerate(sorted((-v, k) for k, x, v, _ in rows if x == g)[:11])]
    assert got == want


def test_merged_config_is_one_level_deep():
    assert runs.merged_config({"a": {"x": 1, "y": {"z": 1}}, "b": 2}, {"a": {"y": {"q": 3}}, "b": {"k": 1}, "c": 4}) == {"a": {"x": 1, "y": {"q": 3}}, "b": {"k": 1}, "c": 4}
    assert runs.config_hash({"b": 1, "a": [1]}) == runs.config_hash({"a": [1], "b": 1})


def test_exact_loss_tokens(spark, sf):
    from millrace.session import table

    try:
        import public_tokenizers
        from tokenizers import Tokenizer
    except ImportError:
        return
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = table(spark, sf, "conversations").collect()
    count = lambda r: len(lib.encode(r.text or "", add_special_tokens=False).ids)
    total = next(r for r in QUERIES["exact_loss_tokens"](spark, sf).collect() if r.axis == "total")
    assert (total.loss_tokens, total.input_tokens) == tuple(sum(count(r) for r in rows if (r.role == "assistant") == said) for said in (True, False))


def test_lanes_give_up_the_oldest_first():
    from millrace.streaming.assembly import Lane

    lane = Lane()
    for folder, name, named, size in (("a", "1", None, 40), ("b", "1", None, 40), ("c", "m", ["1", "2"], 0), ("c", "1", None, 30), ("d", "1", None, 30)):
        lane.add(folder, name, named, size)
    assert lane.settle(200, 10) == []
    lane = Lane(lane.state())
    lane.add("c", "c/2", None, 5)
    lane.add("e", "1", None, 60)
    assert lane.settle(100, 10) == [("c", "complete", 2, 35), ("a", "evicted", 1, 40), ("b", "evicted", 1, 40)]
    lane = Lane(lane.state())
    lane.add("a", "2", None, 500)  # late: known as closed
    assert lane.settle(100, 2) == [] and list(lane.have) == ["d", "e"]
    lane.add("f", "1", None, 20)
    assert lane.settle(100, 2) == [("d", "evicted", 1, 30)] and list(lane.closed) == ["b", "d"]
    lane.add("a", "2", None, 10)  # forgotten: opened anew
    assert list(lane.have) == ["e", "f", "a"] and len(lane.settle(0, 2, over=True)) == 3 and not lane.have


def test_the_stream_is_bounded_in_all(spark, tmp_path):
    from millrace.streaming import assembly, ingest

    rows = [(f"f{i % 40}", f"n{i // 40}", None, 100) for i in range(400)] + [(f"f{i}", "m", [f"n{k}" for k in range(10)], 0) for i in range(0, 40, 2)]
    df = fixed_rows(spark, "folder string, name string, refs array<string>, bytes long", *rows)
    for part in range(4):
        df.where(F.pmod(F.xxhash64("name"), F.lit(4)) == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for limit, lanes in ((1 << 20, 4), (8000, 2)):
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        at = str(tmp_path / f"out{limit}")
        ingest.ingest(assembly.assemble_stream(stream, limit, lanes), at, at + "-state").awaitTermination()
        got = [tuple(r)[:4] for r in spark.read.schema(assembly.OUTPUT).parquet(at).collect()]
        if limit > 8000:
            assert sorted(got) == sorted((f"f{i}", "complete", 10, 1000) for i in range(0, 40, 2))
        else:
            assert any(r[1] == "evicted" for r in got) and all(r[3] <= 1000 for r in got)


def test_plan_gate_decides_in_order_over_packed_runs(spark):
    draw = random.Random(8)
    rows = [(i * 3, draw.choice([*fixed.PLAN_SHARES, None, "none"]), draw.random()) for i in range(30_000)]
    seen, given, total, want = set(), dict.fromkeys(fixed.PLAN_SHARES, 0), 0, []
    for n, (k, c, u) in enumerate(rows):
        if c in given:
            seen.add(c)
            now, share = total / max(1, n), fixed.PLAN_SHARES[c] / sum(fixed.PLAN_SHARES[x] for x in seen)
            if (total == 0 or given[c] <= share * total + 2.0) and not (now > 0.12 or (now > 0.8 * 0.12 and u > 0.5)):
                given[c], total = given[c] + 1, total + 1
                want.append(k)
    draw.shuffle(rows)
    gate = runs.plan_gate(fixed_rows(spark, "k long, c string, u double", *rows).repartition(7), "k", "c", "u", 0.12)
    assert sorted(r.k for r in gate.collect()) == want
    plan = gate._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 1" not in plan and "MapInPandas" not in plan  # no task sorts whole rows
