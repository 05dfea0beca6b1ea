"""Whitening against exact fractions and the dense eigensolver."""

from fractions import Fraction
from math import floor, prod

import numpy as np
import pytest

from tripledger.llm import whitening
from tripledger.llm.queries import op13_whitening

SCHEMA = "vec_id long, embedding array<double>, row string, deviation int, v string"


def exact_polynomial(m):
    """Coefficients of det(t I - M), highest power first, by Faddeev and LeVerrier."""
    n = len(m)
    out, b = [Fraction(1)], [[Fraction(i == j) for j in range(n)] for i in range(n)]
    for k in range(1, n + 1):
        b = [[sum(m[i][x] * b[x][j] for x in range(n)) for j in range(n)] for i in range(n)]
        out.append(-sum(b[i][i] for i in range(n)) / k)
        for i in range(n):
            b[i][i] += out[-1]
    return out


def test_primes():
    found = whitening.primes_below(1 << 31, 40)
    assert found[0] == 2**31 - 1 and found == sorted(set(found), reverse=True)
    assert all(p % d for p in found for d in range(2, 46_341))
    between = set(range(found[-1], 1 << 31)) - set(found)
    assert all(any(x % d == 0 for d in range(2, 46_341)) for x in between)


@pytest.mark.parametrize("kind", ["dense", "zeros", "diagonal", "one", "repeated"])
def test_polynomials(kind):
    rng = np.random.default_rng(4)
    x = rng.integers(-60, 60, (9, 7))
    m = {
        "dense": (x.T @ x).tolist(),
        "zeros": np.pad((x.T @ x)[:4, :4], 2).tolist(),
        "diagonal": np.diag([5, 0, 3, 3, 9]).tolist(),
        "one": [[42]],
        "repeated": np.kron(np.eye(3, dtype=int), (x.T @ x)[:2, :2]).tolist(),
    }[kind]
    primes = [*whitening.primes_below(1 << 31, 3), 101, 7]
    want = exact_polynomial(m)[::-1]
    assert whitening.polynomials(m, primes).tolist() == [[int(c) % p for c in want] for p in primes]


def test_roots():
    roots = [Fraction(9), Fraction(9), Fraction(7), Fraction(1, 1) + 0, Fraction(2), Fraction(2), Fraction(2)]
    sums = [1]
    for r in roots:
        sums = [a + b * r for a, b in zip([*sums, 0], [0, *sums])]
    poly = whitening.RealRoots([int(s) for s in sums] + [0, 0])
    got = poly.greatest(16, int(sum(roots)))
    assert [(round(float(r), 15), k) for r, k in got] == [(9.0, 2), (7.0, 1), (2.0, 3), (1.0, 1)]
    assert poly.above(Fraction(2)) == 3 and poly.above(Fraction(0)) == 7
    assert [k for _, k in poly.greatest(3, 40)] == [2, 1]


def test_products_of_any_size():
    rng = np.random.default_rng(0)
    for high in (10, 1 << 19, (1 << 19) + 1, 1 << 33, whitening.LARGEST):
        x = rng.integers(-high, high, (50, 6), endpoint=True)
        exact = x.astype(object)
        assert (whitening.products(x) == exact.T @ exact).all()


def brute(rows, components=16):
    """Distinct whole vectors, S, and the dense solution of the covariance."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    whole = [(i, [floor(64 * c) + 1_000_000 for c in v]) for i, v in kept]
    fit = sorted({tuple(x) for _, x in whole})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(x, s)] for x in fit])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)[:components]
    deviation = [(i, sum((n * a - b) ** 2 for a, b in zip(x, s))) for i, x in whole]
    return n, s, whole, e[order], v[:, order], deviation, e.sum()


def check(spark, rows, components=16, expect=None):
    df = spark.createDataFrame([(i, v, "r", 1, "v") for i, v in rows], SCHEMA).repartition(3)
    model = whitening.fit(df, "embedding", components)
    n, s, whole, e, v, deviation, trace = brute(rows, components)
    if expect is not None:
        e, v = e[:expect], v[:, :expect]
    assert model.n == n and len(model.eigenvalues) == len(e)
    assert np.allclose(model.eigenvalues, e, rtol=1e-9)
    assert np.allclose(model.explained, e / trace, rtol=1e-9) and model.identity_error < 1e-12
    out = whitening.transform(df, "embedding", model).collect()
    assert sorted((r["row"]["vec_id"], int(r["deviation"])) for r in out) == sorted(deviation)
    return model, out


def test_equals_the_dense_solution(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 12)) * np.geomspace(3, 0.2, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[0].tolist()) for i in range(200)]
    rows += [(1, None), (2, []), (3, [None] * 12), (4, [float("nan")] * 12), (5, [float("inf")] + [0.0] * 11)]
    rows += [(7, x[7].tolist()), (7, x[7].tolist())]
    model, out = check(spark, rows)
    n, s, whole, e, v, _, _ = brute(rows)
    own = model.components.T
    assert np.allclose(np.abs((own * v).sum(axis=0)), 1, atol=1e-9)
    for r in out[::37]:
        i = r["row"]["vec_id"]
        xs = np.array(dict(whole)[i], float) - np.array(s) / n
        assert np.allclose(r["whitened"], xs @ own / np.sqrt(e), atol=1e-7)
    fitted = {tuple(r["row"]["embedding"]): r["whitened"] for r in out}
    white = np.array(list(fitted.values()))
    assert abs(white.T @ white / n - np.eye(12)).max() < 1e-6
    assert out[0]["row"].asDict().keys() == {"vec_id", "embedding", "row", "deviation", "v"}


def test_equal_eigenvalues_and_lost_dimensions(spark):
    """A cross in three of five dimensions: one eigenvalue three times, and two that are zero."""
    rows = [(2 * i + (sign > 0), [sign * float(i == j) for j in range(5)]) for i in range(3) for sign in (-1, 1)]
    model, out = check(spark, rows, expect=3)
    assert np.allclose(model.components @ model.components.T, np.eye(3), atol=1e-14)
    assert len(out[0]["whitened"]) == 3


def test_few_components_of_many_equal_ones(spark):
    rows = [(2 * i + (sign > 0), [sign * float(i == j) for j in range(20)]) for i in range(20) for sign in (-1, 1)]
    df = spark.createDataFrame([(i, v, "r", 1, "v") for i, v in rows], SCHEMA)
    assert len(whitening.fit(df, "embedding", 16).eigenvalues) == 16


def test_huge_entries(spark):
    rows = [(i, [float(a), float(b)]) for i, (a, b) in enumerate([(1e12, 3), (-2e12, 7), (5e11, -1), (0, 0), (1e300, -1e300)])]
    df = spark.createDataFrame([(i, v, "r", 1, "v") for i, v in rows], SCHEMA)
    model = whitening.fit(df, "embedding")
    assert model.n == 5 and model.identity_error < 1e-4
    assert whitening.transform(df, "embedding", model).count() == 5


def test_other_lengths_go(spark):
    rows = [(i, [float(i), float(i * i % 7)]) for i in range(6)] + [(9, [1.0]), (10, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, "r", 1, "v") for i, v in rows], SCHEMA)
    model = whitening.fit(df, "embedding")
    out = whitening.transform(df, "embedding", model).collect()
    assert sorted(r["row"]["vec_id"] for r in out) == list(range(6))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5]), (2, [0.501])], [(1, [1.0]), (2, [1.0])]])
def test_nothing_to_fit(spark, rows):
    df = spark.createDataFrame([(i, v, "r", 1, "v") for i, v in rows], SCHEMA)
    assert whitening.fit(df, "embedding") is None


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(i * 10**9), 1.0]) for i in range(40)]
    model, out = check(spark, rows, expect=1)
    assert max(r["deviation"] for r in out) > 2**63


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    n, s, whole, e, v, deviation, trace = brute(rows)
    got = op13_whitening(spark, sf_dir).toPandas()
    assert len(got) == 16 * len(whole) and set(got["n"]) == {n}
    first = got[got["component"] == 1].set_index("vec_id")
    assert first["deviation"].to_dict() == dict(deviation)
    for c in (1, 5, 16):
        mine = got[got["component"] == c].set_index("vec_id")
        white = np.array([mine["whitened"][i] for i, _ in whole])
        want = (np.array([x for _, x in whole], float) - np.array(s) / n) @ v[:, c - 1] / np.sqrt(e[c - 1])
        assert np.allclose(white * np.sign(white[0]), want * np.sign(want[0]), atol=1e-7)
        assert np.allclose(mine["explained"], e[c - 1] / trace, rtol=1e-9)
    assert prod(got["identity_error"] < 1e-4)
