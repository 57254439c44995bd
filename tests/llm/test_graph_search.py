import numpy as np
import pytest

from strata.llm.graph_search import _lifted, build_graph, nearest_neighbours, robust_prune


def brute(rows, asked, k):
    def good(v):
        return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(c != 0 for c in v)

    named = {}
    for key, v in rows:
        if key is not None and good(v):
            named[key] = min(named.get(key, v), v)
    out = {}
    for q in asked:
        if q in named:
            near = [(-float((np.array(v) * np.array(named[q])).sum()), key) for key, v in named.items() if key != q and len(v) == len(named[q])]
            out[q] = [(key, -s) for s, key in sorted(near)[:k]]
    return {q: near for q, near in out.items() if near}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        near = out.setdefault(r.query_id, [])
        near.append((r.vec_id, r.score))
        assert r.rank == len(near)
    return out


def share(got, want):
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    return np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / len(want[q]) for q in want])


def table(spark, rows):
    return spark.createDataFrame([(k, v, k) for k, v in rows], "vec_id long, embedding array<double>, rank long").repartition(5)


@pytest.mark.parametrize("clusters", [0, 30])
def test_recall_against_brute_force(spark, clusters):
    rng = np.random.default_rng(6)
    n = 3000
    x = rng.normal(size=(n, 16))
    if clusters:
        x = rng.normal(size=(clusters, 16))[rng.integers(clusters, size=n)] * 3 + 0.1 * x
    x *= rng.uniform(0.5, 2, (n, 1))  # lengths matter to inner products
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = table(spark, rows)
    got, want = found(nearest_neighbours(df, df.where("vec_id % 20 = 0"), shard=1200)), brute(rows, range(0, n, 20), 20)
    assert share(got, want) >= 0.95
    assert all(s == pytest.approx(float(x[q] @ x[v]), rel=1e-12) for q, near in got.items() for v, s in near)


def test_odd_rows_and_copies(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(300)]  # ties go to the smaller key
    rows += [(1000, None), (1020, []), (1040, [0.0] * 4), (1060, [float("nan")] * 4), (1080, [None] * 4), (1100, [float("inf"), 1.0, 1.0, 1.0])]
    rows += [(1200, [1.0, -1.0]), (1201, [2.0, -0.0]), (1202, [2.0, 0.0]), (1220, [5.0] * 3), (None, [9.0] * 4), (7, rows[7][1]), (8, [-9.0] * 4)]
    rows += [(1300, [1e300, 1.0, 0.0, 0.0]), (1320, [1e-300, 1e-300, 0.0, 0.0])]
    df = table(spark, rows)
    want = brute(rows, range(0, 1400, 20), 20)
    got = found(nearest_neighbours(df, df.where("vec_id % 20 = 0"), shard=50))
    assert got.keys() == want.keys() and 1220 not in got and [v for v, _ in got[100]] == [v for v, _ in want[100]]
    assert share(got, want) >= 0.95
    assert nearest_neighbours(df.limit(0), df).count() == 0
    assert nearest_neighbours(df, df.limit(0)).columns == ["query_id", "rank", "vec_id", "score"]


def test_pruning_keeps_the_nearest_and_drops_what_it_stands_for():
    points = np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 2], [-3, 0], [0, 2.05]], np.float32)
    kept = robust_prune(points, np.array([0]), np.array([[5, 4, 3, 2, 1, 0, -1]]), degree=4, relax=1.2)
    assert kept.tolist() == [[1, 3, 4, -1]]
    graph, entry = build_graph(_lifted(np.random.default_rng(1).normal(size=(500, 8))), degree=8)
    seen, todo = {entry}, [entry]
    while todo:
        for j in graph[todo.pop()]:
            if j >= 0 and j not in seen:
                seen.add(int(j))
                todo.append(int(j))
    assert len(seen) == 500  # all nodes can be reached
