import numpy as np
import pytest

from strata.llm.embed_dedup import embedding_groups, linked_pairs, quantise, unit_rows


def brute(rows, threshold):
    def good(v):
        return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(c != 0 for c in v)

    units = [unit_rows(np.array([v], np.float32).astype(float))[0] if good(v) else None for _, v in rows]
    near = [[b for b, y in enumerate(units) if b != a and x is not None and y is not None and len(x) == len(y) and x @ y >= threshold] for a, x in enumerate(units)]
    component = {}
    for a in range(len(rows)):
        stack = [a]
        while stack:
            u = stack.pop()
            if u not in component:
                component[u] = a
                stack += near[u]
    least = {}
    for a, (key, _) in enumerate(rows):
        if key is not None:
            least[component[a]] = min(least.get(component[a], key), key)
    return sorted(((key, len(near[a]), least.get(component[a]), key is not None and key == least.get(component[a])) for a, (key, _) in enumerate(rows)), key=str)


def some_vectors(n=300):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8))
    rows = [(i, ((centres[rng.integers(40)] + rng.normal(size=8) * rng.choice([0, 0.1, 0.2, 0.4])) * rng.choice([1, 2])).astype(np.float32).tolist()) for i in range(n)]
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [None] * 8, [float("inf")] + [1.0] * 7, [1.0, 0.0], [2.0, 0.0], [-0.0] + [1.0] * 7, [0.0] + [1.0] * 7]
    return rows + [(1000 + k, v) for k, v in enumerate(odd)] + [(None, rows[3][1]), (7, rows[7][1])]


@pytest.mark.parametrize("tile", [50, 4096])
def test_equals_brute_force(spark, tile):
    rows = some_vectors()
    frame = spark.createDataFrame([(k, v, k) for k, v in rows], "vec_id long, embedding array<float>, kept long")
    assert sorted(map(tuple, embedding_groups(frame, tile=tile, pivots=12).collect()), key=str) == brute(rows, 0.95)
    assert embedding_groups(frame.limit(0)).count() == 0


def test_error_bounds_hold_and_no_pair_is_lost():
    rng = np.random.default_rng(5)
    x = unit_rows(rng.normal(size=(200, 16)))
    y = unit_rows(x + 0.08 * rng.normal(size=x.shape))
    (qx, sx, ex), (qy, sy, ey) = quantise(x), quantise(y)
    near = (qx.astype(float) @ qy.T.astype(float)) * sx[:, None] * sy[None, :]
    assert (np.abs(near - x @ y.T) <= ex[:, None] + ey[None, :] * (1 + ex[:, None]) + 1e-12).all()
    for threshold in (0.5, 0.9, 0.95):
        got = {(i, j) for a, b in linked_pairs(x, y, threshold) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
        assert got == set(map(tuple, np.argwhere(x @ y.T >= threshold).tolist()))


def test_large_group_of_copies_counts_all_links(spark):
    frame = spark.range(3000).selectExpr("id as vec_id", "array(cast(1 as float), cast(id % 3 as float) / 1000) as embedding")
    out = embedding_groups(frame).collect()
    assert {r.n_links for r in out} == {2999} and {r.component_id for r in out} == {0} and sum(r.kept for r in out) == 1
