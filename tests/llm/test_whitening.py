"""Embedding whitening on exact components, against exact and numpy computations."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import SMOKE

from funnel_engine.llm import whitening as w

SCHEMA = "vec_id bigint, embedding array<float>, x string, n int, component string"


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(i, v, "c", 1, "d") for i, v in zip(ids or range(len(vectors)), vectors, strict=True)], SCHEMA)


def exact(matrix):
    """det(xI - matrix) by Faddeev and LeVerrier in integers."""
    d = len(matrix)
    a = np.array(matrix, object).reshape(d, d)
    m, out = np.zeros((d, d), object), [1]
    for k in range(1, d + 1):
        m = a.dot(m) + np.eye(d, dtype=object) * out[-1]
        out.append(-sum(a.dot(m).diagonal()) // k)
    return out


def grams(rng, d, rank, size=1000):
    a = np.array([[rng.randint(-size, size) for _ in range(rank)] for _ in range(d)], object).reshape(d, rank)
    return a.dot(a.T).tolist()


def test_polynomial_is_exact(spark):
    rng = random.Random(4)
    for d, rank in [(1, 1), (2, 2), (3, 1), (5, 5), (6, 3), (9, 9), (4, 0)]:
        matrix = grams(rng, d, rank) if rank else [[0] * d for _ in range(d)]
        assert w.characteristic_polynomial(spark, matrix) == exact(matrix)
    blocks = [[2, 0, 0, 0], [0, 0, 0, 0], [0, 0, 5, 1], [0, 0, 1, 5]]  # zero pivots
    assert w.characteristic_polynomial(spark, blocks) == exact(blocks)
    assert w.polynomial_mod(matrix := grams(rng, 8, 8), 10007) == [c % 10007 for c in exact(matrix)]


def test_primes():
    got = w.primes_for(10**80)
    assert math.prod(got) > 10**80 and len(set(got)) == len(got) and got[0] == 2**31 - 1
    assert all(p % q for p in got for q in range(2, 46341))


def test_roots_are_isolated_with_their_multiplicities():
    def times(roots):
        p = [1]
        for r in roots:
            p = [a - r * b for a, b in zip([*p, 0], [0, *p], strict=True)]
        return p

    for roots in ([7], [10**9, 10**9 - 1, 3, 3, 3], [5, 5, 5, 5], [10**30, 1, 1, 2], [6, 4, 4, 1], [2**40, 2**40 - 1, 2**40 - 2, 9]):
        got = w.largest_roots(times(roots), min(4, len(roots)))
        want = sorted(roots, reverse=True)[:4]
        assert [(a + (1 << s >> 1)) >> s for a, s in got] == want
        assert [x == y for x, y in zip(got, got[1:], strict=False)] == [x == y for x, y in zip(want, want[1:], strict=False)]
    a, s = w.largest_roots([1, -4, 2], 1)[0]  # 2 + sqrt 2
    assert abs(a - ((2 << s) + math.isqrt(2 << 2 * s))) <= 2


def brute(vectors):
    """n, S, eigenvalues (numpy), whitened values and deviations of each vector, from the definition."""
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n = len(fit)
    s = [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[c - t / n for c, t in zip(v, s, strict=True)] for v in fit])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(v, s, strict=True)) for v in x]
    z = (np.array(x) - np.array(s) / n) @ (u[:, :4] / np.sqrt(e[:4]))
    return n, e, z, deviation


def compare(rows, vectors, ids):
    n, e, z, deviation = brute(vectors)
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(by) == 4 * len(vectors)
    for c in range(4):
        got = np.array([by[i, c + 1].whitened for i in ids])
        sign = 1 if got @ z[:, c] > 0 else -1
        assert np.allclose(got * sign, z[:, c], atol=1e-8)
        for k, i in enumerate(ids):
            r = by[i, c + 1]
            assert (r.n, r.deviation) == (n, deviation[k])
            assert abs(r.explained - e[c] / e.sum()) < 1e-9 and r.identity_error < 1e-9


def test_op13_against_numpy(spark):
    rows = spark.read.parquet(f"{SMOKE}/embeddings.parquet").collect()
    got = w.op13_whitening(spark, SMOKE)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(got.collect(), [r.embedding for r in rows], [r.vec_id for r in rows])


def whitened(spark, df):
    vectors = w.integer_vectors(df)
    model = w.fit_whitening(vectors)
    return model, (w.whiten(vectors, model).collect() if model else [])


def test_repeats_count_once_and_bad_rows_go(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(0, 0.3, (40, 6)).astype(np.float32).tolist()
    good += [good[0]] * 30  # a hot vector
    bad = [None, [0.1] * 5 + [None], [0.1] * 5 + [math.nan], [math.inf] + [0.0] * 5, [0.5] * 3, []]
    model, rows = whitened(spark, frame(spark, good + bad, [*range(69), None, *range(100, 106)]))
    n, e, z, deviation = brute(good)
    assert model.n == n == 40 and len(rows) == 70
    by = {r.vec_id: r for r in rows}
    assert [by[i].deviation for i in range(69)] == deviation[:69] and by[None].deviation == deviation[69]
    got = np.array([by[i].whitened for i in range(69)])
    assert np.allclose(np.abs(got), np.abs(z[:69]), atol=1e-8) and model.identity_error < 1e-9


def test_equal_eigenvalues(spark):
    # Plus and minus each axis: all eigenvalues are the same.
    d = 5
    vectors = [[s * (1.0 if i == j else 0.0) for j in range(d)] for i in range(d) for s in (1, -1)]
    model, rows = whitened(spark, frame(spark, vectors))
    assert model.identity_error < 1e-12 and len(set(model.eigenvalues)) == 1
    assert all(abs(x - 1 / d) < 1e-12 for x in model.explained)


def test_less_than_full_rank(spark):
    model, rows = whitened(spark, frame(spark, [[0.0, 0.0, 0.0, 0.0, 0.0], [1.0, 0.0, 1.0, 0.0, 0.0], [0.0, 3.0, 0.0, 0.0, 0.0]]))
    assert model.identity_error < 1e-12 and [a is None for a in model.axes] == [False, False, True, True]
    assert all(r.whitened[0] is not None and r.whitened[2:] == [None, None] for r in rows) and model.explained[2:] == (0.0, 0.0)
    model, rows = whitened(spark, frame(spark, [[0.5, 0.5]] * 3))
    assert (model.n, model.axes, model.explained, model.identity_error) == (1, (None, None), (None, None), None)
    assert [(r.deviation, r.whitened) for r in rows] == [(0, [None, None])] * 3


def test_large_entries_stay_exact(spark):
    rng = random.Random(6)
    vectors = [[rng.uniform(-1, 1) * 10 ** rng.randint(0, 15) for _ in range(4)] for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")
    x = [[math.floor(256 * c) for c in v] for v in vectors]
    bits = max(abs(c) for v in x for c in v).bit_length() + 1
    g, s = w.scatter_sums(w.integer_vectors(df), 4, bits)
    assert s == [sum(c) for c in zip(*x, strict=True)]
    assert g == [[sum(v[i] * v[j] for v in x) for j in range(4)] for i in range(4)]
    model, rows = whitened(spark, df)
    assert model.identity_error < 1e-6 and len(rows) == 50
    want = {i: sum((50 * c - t) ** 2 for c, t in zip(v, s, strict=True)) for i, v in enumerate(x)}
    assert {r.vec_id: r.deviation for r in rows} == {i: v if v < 2**63 else None for i, v in want.items()}


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[math.nan]]])
def test_nothing_to_fit(spark, vectors):
    assert w.fit_whitening(w.integer_vectors(frame(spark, vectors))) is None


def test_query_without_vectors(spark, scratch_dir):
    frame(spark, []).write.parquet(f"{scratch_dir}/embeddings.parquet")
    got = w.op13_whitening(spark, scratch_dir)
    assert got.count() == 0 and got.columns[1] == "component"
