"""Vector operators against brute force."""

import math

import numpy as np
import pytest

from cartouche.llm import graph, itq, topk


def rows_of(rng):
    base = rng.normal(size=(300, 16))
    rows = [(i + 1, (base[rng.integers(300)] * rng.uniform(0.5, 2) + rng.normal(size=16) * rng.choice([0, 0.05, 0.2, 0.3])).astype("f4").tolist(), 0)
            for i in range(700)]
    return rows + [(1000, None, 1), (1100, [0.0] * 16, 1), (1200, [float("nan")] * 16, 1), (1201, [None] + [1.0] * 15, 1), (1202, [], 1),
                   (None, rows[4][1], 1), (7, rows[6][1], 1), (100, rows[99][1], 1)]


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


@pytest.fixture(scope="module")
def rows():
    return rows_of(np.random.default_rng(1))


@pytest.fixture(scope="module")
def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def test_near_duplicates(monkeypatch, rows, vectors):
    monkeypatch.setattr(itq, "CHUNK_ROWS", 16)
    good = [r for r in rows if usable(r[1]) and any(r[1])]
    x = np.array([r[1] for r in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    got = itq.near_duplicates(vectors).collect()
    assert len(got) == len(rows)
    links = sum(r.n_links for r in got)
    assert 0.9 * near.sum() <= links <= near.sum()  # none below the threshold; recall of the index
    odd = {1000, 1100, 1200, 1201, 1202}
    assert all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in got if r.vec_id in odd)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert itq.near_duplicates(vectors.limit(0)).count() == 0


@pytest.mark.parametrize("n", [10**4, 10**5, 10**6, 10**7])
def test_recall_holds_as_tables_grow(n):
    """Pairs at the threshold meet in some table with the bits that n vectors take."""
    rng = np.random.default_rng(8)
    sample = itq.unit(rng.normal(size=(3000, 64)))
    bits = itq.substring_bits(n, 64)
    learned = itq.enough_rotations(sample, bits, 0.95)
    x = itq.unit(rng.normal(size=(4000, 64)))
    aside = rng.normal(size=x.shape)
    aside = itq.unit(aside - (aside * x).sum(1, keepdims=True) * x)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * aside
    assert (itq.substrings(x, learned, bits) == itq.substrings(y, learned, bits)).any(1).mean() >= 0.95


def directed(rng, n, width, cosine):
    """Unit vectors of a mean cosine, with near copies at cosines around the threshold."""
    common = itq.unit(rng.normal(size=(1, width)))
    x = itq.unit(np.sqrt(cosine) * common + np.sqrt(1 - cosine) * itq.unit(rng.normal(size=(n, width))))
    c = rng.uniform(0.95, 1, (n // 2, 1))
    aside = rng.normal(size=(n // 2, width))
    aside = itq.unit(aside - (aside * x[:n // 2]).sum(1, keepdims=True) * x[:n // 2])
    x[n // 2:] = c * x[:n // 2] + np.sqrt(1 - c**2) * aside
    return x


@pytest.mark.parametrize("cosine", [0.0, 0.5, 0.8, 0.9])
def test_vectors_that_share_a_direction(spark, cosine):
    x = directed(np.random.default_rng(3), 1600, 32, cosine)
    near = itq.unit(x) @ itq.unit(x).T >= 0.95
    np.fill_diagonal(near, False)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    assert 0.97 * near.sum() <= sum(r.n_links for r in itq.near_duplicates(frame).collect()) <= near.sum() + 2


@pytest.mark.parametrize("n", [10**4, 10**6, 10**7])
@pytest.mark.parametrize("cosine", [0.5, 0.8, 0.9])
def test_recall_holds_where_vectors_share_a_direction(n, cosine):
    rng = np.random.default_rng(9)
    sample = directed(rng, 3000, 64, cosine)[:1500]
    bits = itq.substring_bits(n, 64)
    learned = itq.enough_rotations(sample, bits, 0.95)
    x = directed(rng, 4000, 64, cosine)[:2000]
    for aside in (rng.normal(size=x.shape), x[::-1]):  # any direction, and towards others
        aside = itq.unit(aside - (aside * x).sum(1, keepdims=True) * x)
        y = 0.95 * x + np.sqrt(1 - 0.95**2) * aside
        assert (itq.substrings(x, learned, bits) == itq.substrings(y, learned, bits)).any(1).mean() >= 0.95


def test_few_and_ragged_vectors(spark):
    rng = np.random.default_rng(4)
    tight = (np.ones(64) + 0.005 * rng.normal(size=(4, 64))).tolist()
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.001]), (3, [1.0, 2.0]), (4, [1.0, 2.0, 3.0]), (9, [5.0])] + [(10 + i, v) for i, v in enumerate(tight)]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        got = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_duplicates(spark.createDataFrame(order, "vec_id long, embedding array<double>").coalesce(1)).collect()}
        assert got == {1: (2, 1), 2: (2, 1), 4: (2, 1), 3: (0, 3), 9: (0, 9), **{10 + i: (3, 10) for i in range(4)}}


def brute_top_k(rows):
    held = [(r[0], r[1]) for r in rows if r[0] is not None and usable(r[1])]
    asking = {}
    for i, v in held:
        if i % 100 == 0:
            asking[i] = min(asking.get(i, v), v)
    whole = [(i, np.floor(np.array(v, "f8") * 1024).astype(int)) for i, v in held]
    want = []
    for i, v in asking.items():
        own = held.index((i, v))
        best = sorted((-int(whole[own][1] @ w), j) for at, (j, w) in enumerate(whole) if at != own and len(w) == len(v))[:10]
        want += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)]
    return sorted(want)


def test_top_k(spark, rows, vectors):
    assert sorted(tuple(r) for r in topk.top_k(vectors).collect()) == brute_top_k(rows)
    assert topk.top_k(vectors.limit(0)).count() == 0
    # repeated ids with other vectors, a twin with a null component, foreign widths at the head of a batch
    odd = [(5000, [1.0, 2.0], 1), (5001, [2.0, 2.0], 1), (5100, [3.0], 1), *rows, (100, rows[3][1], 1), (100, [None] + rows[3][1][1:], 1), (8, rows[9][1], 1), (300, rows[10][1], 1)]
    for order in (odd, odd[::-1]):
        frame = spark.createDataFrame(order, "vec_id long, embedding array<float>, label int").coalesce(1)
        assert sorted(tuple(r) for r in topk.top_k(frame).collect()) == brute_top_k(odd)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    q, x = np.floor(rng.normal(size=(20, 30)) * 1024), np.floor(rng.normal(size=(50, 30)) * 1024)
    before = np.full((20, 50), np.inf)
    for segments in topk.RESOLUTIONS:
        bound = topk.statistics(q, segments) @ topk.statistics(x, segments).T
        assert (bound >= q @ x.T - 1e-6).all() and bound.sum() <= before.sum()
        before = bound


def test_large_components_are_exact():
    q = np.array([[2.0**40, 3.0]])
    assert topk.exact(q, np.array([[2.0**20, 1.0]])).tolist() == [[2**60 + 3]]
    with pytest.raises(OverflowError):
        topk.exact(q, q)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 200)] + [(500, 400), (400, 500), (7, 7), (900, 901), (901, 902), (903, 902)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(chain, "a long, b long").repartition(4)).collect()}
    assert got == {i: 0 for i in range(201)} | {400: 400, 500: 400} | {i: 900 for i in (900, 901, 902, 903)}
