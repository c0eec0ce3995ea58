"""Operators 1 and 7 against brute force, and their stated results at the edges."""

from __future__ import annotations

import numpy as np
import pytest

from orderlens.llm import embeddings, topk

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, shard int, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, 1, 2, 3) for i, v, k in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    rows = []
    centres = rng.normal(size=(6, 16))
    for i in range(240):
        v = centres[i % 6] + rng.normal(scale=0.02 + 0.3 * (i % 5 == 0), size=16)
        rows.append((i * 5, [float(np.float32(c)) for c in v], i % 3 if i % 11 else None))
    rows += [(3000 + i, rows[7][1], rows[7][2]) for i in range(40)]  # copies
    rows += [(4000, [0.0] * 16, 1), (4001, None, 1), (4002, [], 1), (4003, [1.0] * 15 + [float("nan")], 1), (4004, [1.0] * 15 + [float("inf")], 1),
             (4005, [1.0] * 15 + [None], 1), (4006, [1.0] * 8, 1), (4007, [2.0] * 8, 1), (4008, [-0.0] * 16, 1), (None, rows[7][1], rows[7][2])]
    return rows


def usable(v):
    return v and all(c is not None and np.isfinite(c) for c in v)


def test_links_and_components_equal_brute_force(spark, vectors):
    out = embeddings.near_links(frame(spark, vectors), 0.93, tile=32).collect()
    assert len(out) == len(vectors)
    got = {r.vec_id: r for r in out}
    known = [(i, np.array(v), k) for i, v, k in vectors if i is not None and k is not None and usable(v) and any(v)]
    links = {i: set() for i, *_ in vectors if i is not None}
    for a, x, k in known:
        for b, y, m in known:
            if a != b and k == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links[a].add(b)
    low = {i: i for i in links}
    changed = True
    while changed:
        changed = False
        for a, near in links.items():
            m = min([low[a], *(low[b] for b in near)])
            if m < low[a]:
                low[a], changed = m, True
    for i in links:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(links[i]), low[i], low[i] == i), i
    assert got[None].n_links == 0 and got[None].component_id is None
    assert max(map(len, links.values())) > 40


def test_quantisation_bound_holds():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 24)) * rng.choice([1e-3, 1, 1e3], size=(200, 1))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    q, s, n, e = embeddings.quantise(u)
    near = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None, :]
    bound = e[:, None] * n[None, :] + n[:, None] * e[None, :] + e[:, None] * e[None, :]
    assert (np.abs(u @ u.T - near) <= bound).all()


def test_links_of_nothing(spark):
    assert embeddings.near_links(frame(spark, [])).count() == 0
    one = embeddings.near_links(frame(spark, [(1, [1.0], 0), (1, [1.0], 0), (2, None, None)])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in one) == [(1, 0, 1), (1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("shard,block", [(16, 7), (4096, 4096)])
def test_top_k_equals_brute_force(spark, vectors, shard, block):
    table = frame(spark, vectors)
    out = topk.top_k(table, table.where("vec_id % 50 = 0"), 5, shard, block).collect()
    known = [(i, np.floor(256 * np.array(v))) for i, v, _ in vectors if i is not None and usable(v)]
    want = []
    for q, x in known:
        if q % 50 == 0:
            scores = sorted((-int(x @ y), i) for i, y in known if i != q and len(y) == len(x))
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == sorted(want)


def test_top_k_edges(spark):
    empty = frame(spark, [])
    assert topk.top_k(empty, empty).count() == 0
    few = frame(spark, [(50, [0.5, -0.25], 0), (1, [0.5, -0.25], 0), (1, [0.5, -0.25], 0), (2, [-1.0, 0.0], 0), (3, None, 0)])
    out = topk.top_k(few, few.where("vec_id = 50")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in out] == [(1, 128 * 128 + 64 * 64), (2, -128 * 256)]


def test_tree_finds_exact_best_with_big_numbers():
    rng = np.random.default_rng(6)
    big = (rng.normal(size=(300, 5)) * 1e6)
    ints = topk.to_integers([r.astype("<f8").tobytes() for r in big])
    assert ints.dtype == object or np.abs(ints).max() ** 2 * 5 < 2**53
    tree = topk.KDTree(ints, np.arange(300), leaf=8)
    bounds = tree.bounds(ints)
    for q in range(0, 300, 29):
        want = sorted(((-int(sum(int(a) * int(b) for a, b in zip(ints[q], y, strict=True))), i) for i, y in enumerate(ints) if i != q))[:4]
        assert [(-s, -m) for s, m in tree.search(ints[q], bounds[q], q, 4, None)] == want


def test_code_products_are_exact_in_any_dimension():
    rng = np.random.default_rng(6)
    for size in (3, 1_000, 1_040, 4_096):
        a = rng.choice([-127, 127, 126], size=(20, size)).astype(np.int8)
        a[1] = a[0]
        assert (embeddings.code_products(a, a) == a.astype(np.int64) @ a.T.astype(np.int64)).all()


def test_no_borderline_pair_is_lost_in_many_dimensions():
    """Integer components, the threshold just under each pair's own cosine."""
    rng = np.random.default_rng(7)
    for _ in range(60):
        x = rng.integers(-127, 128, size=4_096).astype(float)
        x[0] = 127
        y = np.clip(x + rng.integers(-1, 2, size=4_096), -127, 127)
        y[0] = 127
        cosine = (x @ y) / np.sqrt((x @ x) * (y @ y))
        i, _ = embeddings.linked_pairs(np.stack([x, y]), np.stack([x, y]), cosine - 1e-11, True)
        assert len(i) == 1


def test_scores_stay_in_a_long(spark):
    """Vectors that could give a score beyond a long take no part; the longest others are exact."""
    top = 2.0**31 / 256
    rows = [(0, [top, 1.0], 1), (50, [1e9, 1e9], 1), (1, [top, 0.5], 1), (2, [1e300, 0.0], 1), (3, [-top, 2.0], 1)]
    table = spark.createDataFrame([(i, v, k) for i, v, k in rows], "vec_id long, embedding array<double>, label int")
    out = [tuple(r) for r in topk.top_k(table, table.where("vec_id % 50 = 0"), 5).collect()]
    assert out == [(0, 1, 1, 2**62 + 256 * 128), (0, 2, 3, -(2**62) + 256 * 512)]
