import math

import numpy as np
import pytest

from tallyhouse.llm.spectrum import above, factorise, leading, slices
from tallyhouse.llm.whitening import components_of, fit, vectors_of, whiten


def test_factors_and_counts():
    r = np.random.default_rng(0)
    for n in (1, 2, 7, 30):
        a = r.standard_normal((n, n))
        a = a + a.T
        f = factorise(a)
        d = np.zeros((n, n))
        for k, block in f.blocks:
            d[k : k + len(block), k : k + len(block)] = block
        assert np.allclose(f.lower @ d @ f.lower.T, a[np.ix_(f.order, f.order)])
        b = r.standard_normal(n)
        assert np.allclose(a @ f.solve(b, 1e-300), b)
        for shift in r.standard_normal(5) * 3:
            assert above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()


def test_slices_hold_one_eigenvalue_each():
    a = np.diag([9.0, 8.99, 3.0, 1.0, 1.0, 0.0])
    found = slices(a, 4, 1e-9)
    assert [(s.first, s.last) for s in found] == [(1, 1), (2, 2), (3, 3), (4, 5)]
    assert all(s.low <= v <= s.high for s, v in zip(found, (9, 8.99, 3, 1)))


@pytest.mark.parametrize("values", [[5.0] * 3 + [4.0] * 2 + [1.0] * 20, [1e6, 1e6 - 1e-5, *range(20)], list(range(25)), [1.0] + [0.0] * 24, [1.0] * 25])
def test_leading_pairs_of_near_and_equal_eigenvalues(values):
    q = np.linalg.qr(np.random.default_rng(2).standard_normal((len(values), len(values))))[0]
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    found, axes = leading(a, 10)
    scale = max(values)
    assert np.allclose(found, sorted(values, reverse=True)[:10], rtol=0, atol=1e-12 * scale * 25)
    assert np.abs(a @ axes - axes * found).max() < 1e-12 * scale * 25 and np.abs(axes.T @ axes - np.eye(10)).max() < 1e-13


def brute(rows, components=32):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, total = len(x), x.sum(0)
    deviation = ((n * x - total) ** 2).sum(1)
    y = (x - total / n).astype(float)
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return deviation, values, y @ axes / np.sqrt(values), np.trace(y.T @ y / n)


def test_query_against_plain_eigenvectors(spark, sf):
    from tallyhouse.llm.queries import op11_embedding_whitening

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    deviation, values, white, trace = brute(rows)
    got = op11_embedding_whitening(spark, sf).collect()
    assert len(got) == len(rows) * 32
    place = {v: i for i, (v, _) in enumerate(rows)}
    table = np.zeros((len(rows), 32))
    for r in got:
        i = place[r.vec_id]
        table[i, r.component - 1] = r.whitened
        assert r.n == len(rows) and r.deviation == deviation[i] and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-12
    assert np.abs(table * np.sign((table * white).sum(0)) - white).max() < 1e-9


def test_rows_that_drop_out_and_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 0.0]), (5, [inf, 0.0]), (6, [-inf, 0.0]), (None, [0.5, -7.25]), (7, [3.0]), (8, []), (9, [1.0, 2.0])]
    table = spark.createDataFrame([(a, b, 0, "x") for a, b in rows], "vec_id long, embedding array<float>, n int, component string")
    kept = [(a, (b + [0.0, 0.0])[:2]) for a, b in rows if b is not None and all(c is not None and math.isfinite(c) for c in b)]
    deviation, values, white, _ = brute(kept, 2)
    got = components_of(table).collect()
    assert sorted((r.vec_id, r.deviation) for r in got if r.vec_id) == sorted((v, d) for (v, _), d in zip(kept, deviation) if v for _ in range(2))
    assert sorted(round(abs(r.whitened), 9) for r in got) == sorted(round(abs(w), 9) for w in white.ravel())
    assert {r.n for r in got} == {len(kept)} and max(r.identity_error for r in got) < 1e-12


def test_tables_without_variance_or_rows(spark):
    kind = "vec_id long, embedding array<float>"
    assert components_of(spark.createDataFrame([], kind)).collect() == []
    assert components_of(spark.createDataFrame([(1, None)], kind)).collect() == []
    assert components_of(spark.createDataFrame([(1, [])], kind)).collect() == []
    same = vectors_of(spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(5)], kind))
    found = fit(same)
    assert found.n == 5 and len(found.values) == 0 and [r.deviation for r in whiten(same, found).collect()] == [0] * 5
    line = components_of(spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0]) for i in range(5)], kind)).collect()
    assert len(line) == 5 and {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 for r in line)


def test_large_entries_stay_exact_or_are_null(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 5e8]), (4, [1e30, 0.0])]
    got = {r.vec_id: r.deviation for r in components_of(spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>"), 1).collect()}
    assert got == dict.fromkeys((1, 2, 3))
    small = [(i, [c / 10 for c in v]) for i, v in ((1, [1e8, 0.0]), (2, [-1e8, 1.0]), (3, [0.0, 5e7]))]
    got = {r.vec_id: r.deviation for r in components_of(spark.createDataFrame(small, "vec_id long, embedding array<double>"), 1).collect()}
    x = np.array([[math.floor(64 * c) for c in v] for _, v in small], dtype=object)
    assert got == {i + 1: int(d) if d < 2**63 else None for i, d in enumerate(((3 * x - x.sum(0)) ** 2).sum(1))} and any(got.values())
    assert len(components_of(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()) > 0
