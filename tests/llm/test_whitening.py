import numpy as np
import pytest
from helpers_llm import CLASHES
from pyspark.sql import functions as F

from eventlens.llm import whitening as W

NAN, INF = float("nan"), float("inf")


def frame(spark, vectors, dtype="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], f"vec_id long, embedding array<{dtype}>").repartition(3)


def integers(vectors):
    return [tuple(int(np.floor(64.0 * c)) + 1_000_000 for c in v) for v in vectors if v and all(c is not None and np.isfinite(c) for c in v)]


def brute(vectors, most=16):
    x = integers(vectors)
    fit = np.array(sorted(set(x)), dtype=float)
    v = np.cov(fit.T, bias=True).reshape(fit.shape[1], -1)
    e, q = np.linalg.eigh(v)
    order = np.argsort(-e)
    e, q = e[order], q[:, order]
    keep = [k for k in range(min(most, len(e))) if e[k] > 1e-9 * e[0]]
    return fit, e, q, keep


def random_vectors(n, d, seed=1):
    r = np.random.default_rng(seed)
    return (r.normal(size=(n, d)) @ np.diag(np.linspace(1.5, 0.2, d))).tolist()


@pytest.mark.parametrize("dtype", ["float", "double"])
def test_against_eigh(spark, dtype):
    vectors = [[float(np.float32(c)) for c in v] for v in random_vectors(300, 20)]
    vectors += [None, [], [None] * 20, [NAN] * 20, [INF] + [0.0] * 19, [0.0] * 20, [0.0] * 20] + [vectors[0]] * 50 + [[1.0] * 7]
    df = frame(spark, vectors, dtype).select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHES])
    model = W.fit_whitening(df)
    good = [v for v in vectors if v is None or len(v) != 7]
    fit, e, q, keep = brute([v for v in good if v is not None])
    got = W.whiten(df, model).collect()
    x = {i: integers([v])[0] for i, v in enumerate(vectors) if v and len(v) == 20 and integers([v])}
    assert {(r["vec_id"], r["component"]) for r in got} == {(i, k + 1) for i in x for k in range(16)} and len(got) == 16 * len(x)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    for r in got:
        k, xi = r["component"] - 1, x[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(xi, sums, strict=True))
        assert r["explained"] == pytest.approx(e[k] / e.sum(), rel=1e-9)
        w = float((np.array(xi) - fit.mean(axis=0)) @ q[:, k] / np.sqrt(e[k]))
        assert abs(abs(r["whitened"]) - abs(w)) < 1e-6
        assert r["identity_error"] < 1e-9
    for k in range(16):  # one sign for all rows
        signs = {np.sign(r["whitened"]) == np.sign((np.array(x[r["vec_id"]]) - fit.mean(axis=0)) @ q[:, k]) for r in got if r["component"] == k + 1 and abs(r["whitened"]) > 1e-3}
        assert len(signs) == 1


def test_multiple_roots_and_lost_rank(spark):
    # +-unit vectors: an eigenvalue of multiplicity 4; two dimensions never vary
    vectors = [[s if i == j else 0.0 for j in range(6)] for i in range(4) for s in (1.0, -1.0)]
    model = W.fit_whitening(frame(spark, vectors))
    assert model.components.shape == (6, 4) and model.identity_error < 1e-12
    assert np.allclose(model.components.T @ model.components, np.eye(4), atol=1e-14)
    assert np.allclose(model.eigenvalues, 2 * 64**2 / 8) and np.allclose(model.explained, 0.25)


def test_nothing_to_fit(spark):
    for vectors in ([], [None, [NAN]], [[1.0, 2.0]], [[1.0, 2.0]] * 3):
        df = frame(spark, vectors)
        model = W.fit_whitening(df)
        assert model is None and W.whiten(df, model).collect() == []


def test_polynomial_and_roots():
    r = np.random.default_rng(4)
    b = r.integers(-50, 50, (9, 7))
    a = (b.T @ b).astype(object)
    p = 2_147_483_647
    coeffs = W.charpoly_mod((a % p).astype(np.int64), p)
    for t in (0, 3, 11):  # det(t - a) by fractions
        from fractions import Fraction

        m = [[Fraction(int(t == t and (t if i == j else 0) - a[i, j])) for j in range(7)] for i in range(7)]
        det = Fraction(1)
        for k in range(7):
            i = next(i for i in range(k, 7) if m[i][k])
            if i != k:
                m[k], m[i], det = m[i], m[k], -det
            det *= m[k][k]
            for i in range(k + 1, 7):
                f = m[i][k] / m[k][k]
                m[i] = [x - f * y for x, y in zip(m[i], m[k], strict=True)]
        assert det % p == sum(int(c) * t**k for k, c in enumerate(coeffs)) % p
    poly = np.polynomial.polynomial.polyfromroots([0, 0, 2, 5, 5, 11]).round().astype(int).tolist()
    assert [round(float(x), 9) for x, _ in W.largest_roots(poly, 9)] == [11, 5, 5, 2]
    assert [W.roots_above(poly, a) for a in (0, 1, 2, 4, 5, 11)] == [4, 4, 3, 3, 1, 0]


def test_exact_products_of_any_size():
    z = np.array([[1, -(2**40)], [2**45, 7], [-3, 2**51]], dtype=np.int64)
    assert W.exact_products(z).tolist() == (z.astype(object).T @ z.astype(object)).tolist()
    assert all(W.is_prime(p) for p in W.primes_beyond(1 << 200)) and not W.is_prime(2_147_483_645)
