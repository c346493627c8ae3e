import numpy as np
import pytest

from millrace.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, v string, n int"


def brute(rows, least=0.98):
    ok = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float32).astype(float)
        ok[i] = (label, x / np.sqrt((x * x).sum()))
    links = {i: set() for i, _, _ in rows if i is not None}
    for i in ok:
        for j in ok:
            if i != j and ok[i][0] == ok[j][0] and len(ok[i][1]) == len(ok[j][1]) and ok[i][1] @ ok[j][1] >= least:
                links[i].add(j)
    root = {i: i for i in links}
    for _ in range(len(links)):
        before = dict(root)
        for i, near in links.items():
            for j in near:
                root[i] = root[j] = min(root[i], root[j])
        if before == root:
            break
    return {i: (len(links[i]), root[i], root[i] == i) for i in links}


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for c in range(40):
        center = rng.normal(size=16)
        for _ in range(12):
            rows.append((center + rng.normal(size=16) * 0.06).tolist())
    rows += rng.normal(size=(200, 16)).tolist()
    rows += [rows[0]] * 40
    out = [(i, v, i % 3 if i % 50 else None) for i, v in enumerate(rows)]
    n = len(out)
    return out + [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] + [1.0] * 15, 1), (n + 3, [None] + [1.0] * 15, 1), (n + 4, [float("inf")] * 16, 1), (n + 5, [], 1), (n + 6, [1.0, 2.0], 1), (n + 7, [1.0, 2.0], 1), (None, [1.0] * 16, 1)]


@pytest.mark.parametrize("shard", [64, 8192])
def test_links_equal_brute_force(spark, vectors, shard):
    df = spark.createDataFrame([(i, v, y, "x", 1) for i, v, y in vectors], SCHEMA).repartition(4)
    got = ann.near_duplicates(df, shard=shard).collect()
    assert len(got) == len(vectors)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == brute(vectors)


def test_no_rows(spark):
    assert ann.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_of_the_graph_alone():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 24))
    x[1500:] = x[:1500] + rng.normal(size=(1500, 24)) * 0.05
    unit = ann.unit(x).astype(np.float32)
    graph = ann.Graph.build(unit)
    ids, _ = graph.search(unit[:500], 16)
    nearest = np.argsort(-(unit[:500] @ unit.T), axis=1)[:, :2]
    assert np.mean([n in row for row, pair in zip(ids, nearest) for n in pair]) > 0.95


class Blind(ann.Graph):
    """A graph whose search meets nothing but the vector itself, as if its links were lost."""

    def search(self, q, width):
        sims = q @ self.vec.T
        ids = np.argmax(sims, axis=1)[:, None]
        return ids, np.take_along_axis(sims, ids, 1)


@pytest.mark.parametrize("pairs, between", [(2, False), (10, False), (0, True), (3, True)])
def test_the_audit_sees_few_links(pairs, between):
    rng = np.random.default_rng(pairs)
    x = rng.normal(size=(3000, 24))
    x[1000 : 1000 + pairs] = x[:pairs] + rng.normal(size=(pairs, 24)) * 0.01
    unit = ann.unit(x).astype(np.float32)
    y = ann.unit(rng.normal(size=(2000, 24))).astype(np.float32)
    if between:
        y[5 : 5 + 2 * pairs] = np.repeat(unit[:pairs], 2, axis=0)  # with the copies, 2 nodes each
    q = y if between else unit
    near = q @ unit.T >= 0.98
    if not between:
        np.fill_diagonal(near, False)
    a, b = ann.close_rows(Blind(unit, []), q, 0.98, *([] if between else [True]))
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(*[v.tolist() for v in np.nonzero(near)]))


@pytest.mark.parametrize("shard", [1500, 8192])
@pytest.mark.parametrize("pairs", [5, 400])
def test_a_label_of_thousands(spark, shard, pairs):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 16)).astype(np.float32)
    x[2000 : 2000 + pairs] = x[:pairs] + rng.normal(size=(pairs, 16)).astype(np.float32) * 0.02
    unit = ann.unit(x)
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)
    assert near.sum() == 2 * pairs
    df = spark.createDataFrame([(i, v.tolist(), 0, "x", 1) for i, v in enumerate(x)], SCHEMA).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ann.near_duplicates(df, shard=shard).collect()}
    first = np.where(near.any(axis=1), np.minimum(near.argmax(axis=1), np.arange(4000)), np.arange(4000))
    assert got == {i: (int(near[i].sum()), int(first[i]), bool(first[i] == i)) for i in range(4000)}


def test_cosines_are_taken_in_double_precision(spark):
    at = lambda c: [c, float(np.sqrt(1 - c * c))]
    rows = [(i, v, y) for y, c in enumerate((0.98 + 1e-10, 0.98 - 1e-10)) for i, v in ((2 * y, [1.0, 0.0]), (2 * y + 1, at(c)))]
    got = {r.vec_id: r.n_links for r in ann.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: 0}


@pytest.mark.parametrize("n", [5, 12, 60, 200, 256, 300, 1000])
def test_graphs_of_all_sizes_are_searched(n):
    """Links come from the graph, without the audit's, at every size."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 16))
    half = n // 2
    x[half : 2 * half] = x[:half] + rng.normal(size=(half, 16)) * 0.05
    unit = ann.unit(x).astype(np.float32)
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)

    class Counted(ann.Graph):
        asked = 0

        def search(self, q, width):
            Counted.asked += len(q)
            assert width < n
            return super().search(q, width)

    graph = Counted(unit, ann.Graph.build(unit).layers)
    ids, sims = graph.search(unit, min(ann.BEAM, max(ann.LEAST_BEAM, n // 4)))
    found = np.zeros((n, n), bool)
    r, c = np.nonzero(sims >= 0.98)
    found[r, ids[r, c]] = True
    assert (found & near).sum() >= 0.9 * near.sum()
    before = Counted.asked
    a, b = ann.close_rows(graph, unit, 0.98, True)
    assert Counted.asked >= before + n
    assert set(zip(a.tolist(), b.tolist())) >= set(zip(*[v.tolist() for v in np.nonzero(near)]))
