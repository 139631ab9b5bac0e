"""Exact whitening of embeddings: eigenvectors of an integer scatter matrix.

1. Entries become integers, ``floor(scale * c) + shift``; each distinct vector
   is in the fit list once.
2. The scatter about the mean is an integer matrix: partial sums in the tasks
   of entries centred at the mean's integer part, exact in every step, and one
   exact correction for the mean's fraction.  ``A = n^2 V`` for the covariance V.
3. A's characteristic polynomial is found modulo many 31-bit primes, a task
   taking some of them, by reduction to Hessenberg form; the Chinese remainder
   theorem gives its integer coefficients, whose size the trace bounds.
4. All its roots are real, so the sign changes of the polynomial shifted by a
   are exactly the number of roots above a.  Bisection by that count isolates
   the largest roots; bisection by sign refines each to ``BITS`` bits.
5. A root's eigenvector spans the null space of A - root: inverse iteration in
   decimals of ``DIGITS`` places.  Vectors of a multiple root are made
   orthogonal.  Clusters of roots are spread over tasks.

What the driver holds is the matrix, the polynomial and the components: sizes
set by the vectors' length alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

#: Roots are known to the largest one's size divided by 2**BITS.
BITS = 200
#: Decimal places of the inverse iteration; roots closer than 10**-CLOSE of the largest are one cluster.
DIGITS, CLOSE = 80, 30
#: Rows that a task holds in its arithmetic at a time.
BLOCK = 4096
#: Entries from this size on (after scaling) count as not finite.
HUGE = 2.0**52


def integer_vector(vector: Column, scale: int, shift: int) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long") + shift)


def usable(vector: Column, scale: int) -> Column:
    """Not null or empty; every entry finite and, scaled, below ``HUGE``."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < HUGE)), F.lit(False))


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for pdf in batches:
        for a in range(0, len(pdf), BLOCK):
            part = pdf.iloc[a : a + BLOCK]
            yield part, np.stack([np.asarray(v, dtype=np.int64) for v in part["x"]])


def _summed(fit: DataFrame, value: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[int, object]:
    """The sum over the fit list of ``value(block)``, position by position.

    A task sends one number for each position; Spark adds those of the tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: np.ndarray | None = None
        for _, x in _blocks(batches):
            got = value(x)
            total = got if total is None else total + got
        if total is not None:
            cells = [Decimal(int(v)) for v in total] if kind.startswith("decimal") else total
            yield pd.DataFrame({"at": np.arange(len(total)), "v": cells})

    rows = fit.select("x").mapInPandas(run, f"at long, v {kind}").groupBy("at").agg(F.sum("v").alias("v")).collect()
    return {r["at"]: r["v"] for r in rows}


def exact_products(z: np.ndarray) -> np.ndarray:
    """``z.T @ z`` of integers as Python integers, whatever their size."""
    most = int(np.abs(z).max(initial=0))
    if most * most * len(z) < 1 << 53:  # every partial sum is exact in doubles
        return (z.astype(np.float64).T @ z.astype(np.float64)).astype(np.int64).astype(object)
    if most * most * len(z) < 1 << 63:
        return (z.T @ z).astype(object)
    wide = z.astype(object)
    return wide.T @ wide


def scatter(fit: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """``n``, the sums S and the integer matrix ``n^2 V`` of the fit list."""
    n = fit.count()
    sums = _summed(fit, lambda x: x.astype(object).sum(axis=0), "decimal(38,0)")
    total = [int(sums[i]) for i in range(dim)]
    centre = np.array([t // n for t in total], dtype=np.int64)
    upper = np.triu_indices(dim)
    cells = _summed(fit, lambda x: exact_products(x - centre)[upper], "decimal(38,0)")
    rest = [t - n * int(c) for t, c in zip(total, centre, strict=True)]
    a = [[0] * dim for _ in range(dim)]
    for at, (i, j) in enumerate(zip(*upper, strict=True)):
        a[i][j] = a[j][i] = n * int(cells[at]) - rest[i] * rest[j]
    return n, total, a


def hessenberg_mod(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``a`` modulo ``p``, zero below its first subdiagonal."""
    a = a.copy()
    for m in range(1, len(a) - 1):
        live = np.flatnonzero(a[m:, m - 1])
        if not len(live):
            continue
        i = m + int(live[0])
        if i != m:
            a[[m, i]] = a[[i, m]]
            a[:, [m, i]] = a[:, [i, m]]
        u = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1 :, m - 1 :] = (a[m + 1 :, m - 1 :] - u[:, None] * a[m, m - 1 :][None, :] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * u[None, :] % p).sum(axis=1)) % p
    return a


def charpoly_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - a) modulo ``p``, constant first."""
    h, d = hessenberg_mod(a, p), len(a)
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        q = np.zeros(d + 1, dtype=np.int64)
        q[1:] = polys[k - 1, :-1]
        weights, run = np.zeros(k, dtype=np.int64), 1
        weights[k - 1] = h[k - 1, k - 1]
        for i in range(1, k):
            run = run * int(h[k - i, k - i - 1]) % p
            if not run:
                break
            weights[k - 1 - i] = int(h[k - 1 - i, k - 1]) * run % p
        polys[k] = (q - (weights[:, None] * polys[:k] % p).sum(axis=0)) % p
    return polys[d]


def is_prime(m: int) -> bool:
    """Exact for numbers below 3.2e9."""
    if m < 2 or any(m % q == 0 for q in (2, 3, 5, 7)):
        return m in (2, 3, 5, 7)
    s = ((m - 1) & (1 - m)).bit_length() - 1
    for base in (2, 3, 5, 7):
        y = pow(base, (m - 1) >> s, m)
        if y not in (1, m - 1) and not any((y := y * y % m) == m - 1 for _ in range(s - 1)):
            return False
    return True


def primes_beyond(product: int) -> list[int]:
    """The largest primes below 2**31 whose product exceeds ``product``."""
    out, so_far, m = [], 1, (1 << 31) - 1
    while so_far <= product:
        if is_prime(m):
            out.append(m)
            so_far *= m
        m -= 2
    return out


def characteristic_polynomial(spark: SparkSession, a: list[list[int]]) -> list[int]:
    """Coefficients of det(x - a), constant first, of a positive semidefinite integer matrix.

    The k-th symmetric function of roots with sum t is at most C(d, k) (t / d)^k."""
    d = len(a)
    mean = Fraction(sum(a[i][i] for i in range(d)), d)
    bound = max(math.comb(d, k) * math.ceil(mean**k) for k in range(d + 1))
    primes = primes_beyond(2 * bound + 1)
    wide = np.array(a, dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf["p"]:
                yield pd.DataFrame({"p": [p], "c": [charpoly_mod((wide % int(p)).astype(np.int64), int(p))]})

    parts = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(parts).mapInPandas(run, "p long, c array<long>").collect()
    product = math.prod(primes)
    weight = {p: (product // p) * pow(product // p, -1, p) for p in primes}
    out = []
    for k in range(d + 1):
        c = sum(r["c"][k] * weight[r["p"]] for r in rows) % product
        out.append(c - product if 2 * c > product else c)
    return out


def roots_above(poly: list[int], a: int) -> int:
    """How many roots, by multiplicity, of a polynomial with only real roots are above ``a``."""
    c = poly[::-1]
    for end in range(len(c), 1, -1):  # synthetic division, one coefficient of poly(x + a) a round
        for i in range(1, end):
            c[i] += a * c[i - 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def value_at(poly: list[int], a: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * a + c
    return out


def largest_roots(poly: list[int], most: int) -> list[tuple[Fraction, int]]:
    """The ``most`` largest positive roots, falling, each with the number of its cluster.

    ``poly`` has only real, non-negative roots.  Roots that ``BITS`` bits do not
    tell apart are one cluster with one value."""
    zeros = next(i for i, c in enumerate(poly) if c)
    poly = poly[zeros:]
    d = len(poly) - 1
    most = min(most, d)
    if not most:
        return []
    top = -poly[-2]  # the roots' sum
    shift = max(0, BITS - top.bit_length())
    scaled = [c << (shift * (d - k)) for k, c in enumerate(poly)]
    top <<= shift
    known = {0: d, top: 0}

    def above(a: int) -> int:
        if a not in known:
            known[a] = roots_above(scaled, a)
        return known[a]

    out: list[tuple[Fraction, int]] = []
    while len(out) < most:
        k = len(out) + 1  # the next root is the k-th
        low = max(a for a, held in known.items() if held >= k)
        high = min(a for a, held in known.items() if held < k)
        while high - low > 1 and not (known[low] == k and known[high] == k - 1):
            mid = (low + high) // 2
            if above(mid) >= k:
                low = mid
            else:
                high = mid
        inside = known[low] - known[high]
        while inside == 1 and high - low > 1:
            mid = (low + high) // 2
            v = value_at(scaled, mid)
            if not v:
                low = high = mid
            elif (v > 0) == (k % 2 == 0):  # the sign says whether k roots or k - 1 are above
                low = mid
            else:
                high = mid
        root = Fraction(low + high, 2 << shift)
        out += [(root, len(out))] * inside
    return out[:most]


def _solver(a: np.ndarray, tiny: Decimal) -> Callable[[np.ndarray], np.ndarray]:
    """Solutions of ``a y = b`` in decimals; a zero pivot counts as ``tiny``."""
    u, d = a.copy(), len(a)
    order = np.arange(d)
    for k in range(d):
        i = k + max(range(d - k), key=lambda r: abs(u[k + r, k]))
        if i != k:
            u[[k, i]] = u[[i, k]]
            order[[k, i]] = order[[i, k]]
        if abs(u[k, k]) < tiny:
            u[k, k] = tiny
        u[k + 1 :, k] = u[k + 1 :, k] / u[k, k]
        u[k + 1 :, k + 1 :] = u[k + 1 :, k + 1 :] - u[k + 1 :, k][:, None] * u[k, k + 1 :][None, :]

    def solve(b: np.ndarray) -> np.ndarray:
        y = b[order].copy()
        for k in range(d):
            y[k + 1 :] = y[k + 1 :] - u[k + 1 :, k] * y[k]
        for k in range(d - 1, -1, -1):
            y[k] = (y[k] - (u[k, k + 1 :] * y[k + 1 :]).sum()) / u[k, k]
        return y

    return solve


def null_vectors(a: list[list[int]], roots: list[Fraction]) -> list[list[float]]:
    """Orthonormal eigenvectors of one cluster of roots, by inverse iteration."""
    d = len(a)
    with localcontext() as ctx:
        ctx.prec = DIGITS
        exact = np.array([[Decimal(v) for v in row] for row in a], dtype=object)
        size = sum(abs(exact[i, i]) for i in range(d)) + 1
        found: list[np.ndarray] = []
        for number, root in enumerate(roots):
            shifted = exact.copy()
            value = Decimal(root.numerator) / Decimal(root.denominator)
            for i in range(d):
                shifted[i, i] -= value
            solve = _solver(shifted, size * Decimal(10) ** (2 - DIGITS))
            start = np.random.default_rng(number).integers(-1000, 1000, d)
            y = np.array([Decimal(int(v)) for v in start], dtype=object)
            for _ in range(3):
                y = solve(y)
                y = y / max(abs(v) for v in y)
                for _ in range(2):
                    for f in found:
                        y = y - f * (f * y).sum()
                y = y / (y * y).sum().sqrt()
            found.append(y)
        out = []
        for y in found:
            v = [float(c) for c in y]
            lead = max(range(d), key=lambda i: (abs(v[i]), -i))
            out.append([c if v[lead] > 0 else -c for c in v])
    return out


def components_of(spark: SparkSession, a: list[list[int]], roots: list[Fraction]) -> np.ndarray:
    """Unit eigenvectors of ``a`` for ``roots`` (falling), as columns."""
    clusters: list[list[int]] = []
    for k, r in enumerate(roots):
        if clusters and (roots[clusters[-1][-1]] - r) * 10**CLOSE < roots[0]:
            clusters[-1].append(k)
        else:
            clusters.append([k])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for c in pdf["c"]:
                own = clusters[int(c)]
                yield pd.DataFrame({"k": own, "v": null_vectors(a, [roots[k] for k in own])})

    rows = spark.createDataFrame([(c,) for c in range(len(clusters))], "c int").repartition(len(clusters)).mapInPandas(run, "k int, v array<double>").collect()
    return np.array([r["v"] for r in sorted(rows, key=lambda r: r["k"])]).T


@dataclass
class Whitening:
    """A fitted transform.  ``axes[:, k]`` is component k over the root of its eigenvalue."""

    scale: int
    shift: int
    n: int
    sums: list[int]
    eigenvalues: list[float]
    explained: list[float]
    components: np.ndarray
    axes: np.ndarray
    identity_error: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` in doubles, from the exact difference to the mean's integer part."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        part = np.array([float(Fraction(s % self.n, self.n)) for s in self.sums])
        return (x - whole).astype(np.float64) - part

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """``sum((n x - S)^2)``, exact; None beyond a long."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = [s % self.n for s in self.sums]
        z = x - whole
        most = self.n * int(np.abs(z).max(initial=0)) + self.n
        if most * most * self.dim < 1 << 63:
            y = self.n * z - np.array(rest, dtype=np.int64)
            return [int(v) for v in (y * y).sum(axis=1)]
        y = self.n * z.astype(object) - np.array(rest, dtype=object)
        return [int(v) if v < 1 << 63 else None for v in (y * y).sum(axis=1)]


def _vectors(df: DataFrame, vector_col: str, scale: int, shift: int, *keep: Column) -> DataFrame:
    v = F.col(vector_col)
    return df.where(usable(v, scale)).select(*keep, integer_vector(v, scale, shift).alias("x"))


def fit_whitening(df: DataFrame, vector_col: str = "embedding", most: int = 16, scale: int = 64, shift: int = 1_000_000) -> Whitening | None:
    """The whitening of the distinct integer vectors of ``df``.

    Null and empty vectors and those with a null, non-finite or huge entry (2**52
    and more after scaling) take no part, nor do those of another length than
    most have (of lengths alike in number, the longest).  Components with
    eigenvalue 0, which have no unit variance, are none.  None where no vector or
    no component is left (an empty table, one vector, equal vectors).
    """
    spark = df.sparkSession
    fit = stored(_vectors(df, vector_col, scale, shift).distinct(), "whitening-fit")
    lengths = fit.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return None
    dim = lengths["d"]
    fit = fit.where(F.size("x") == dim)
    n, sums, a = scatter(fit, dim)
    roots = [r for r, _ in largest_roots(characteristic_polynomial(spark, a), most)]
    if not roots:
        return None
    q = components_of(spark, a, roots)
    trace = sum(a[i][i] for i in range(dim))
    with localcontext() as ctx:
        ctx.prec = DIGITS
        deviations = [(Decimal(r.numerator) / Decimal(r.denominator)).sqrt() / n for r in roots]
        eigenvalues = [float(s * s) for s in deviations]
    axes = q / np.array([float(s) for s in deviations])
    model = Whitening(scale, shift, n, sums, eigenvalues, [float(r / trace) for r in roots], q, axes, 0.0)

    k = len(roots)
    means = _summed(fit, lambda x: (model.centred(x) @ axes).sum(axis=0), "double")
    mean = np.array([means[i] / n for i in range(k)])

    def products(x: np.ndarray) -> np.ndarray:
        w = model.centred(x) @ axes - mean
        return (w.T @ w).ravel()

    got = _summed(fit, products, "double")
    covariance = np.array([got[i] / n for i in range(k * k)]).reshape(k, k)
    model.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return model


def whiten(df: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each usable vector of the model's length and each component:
    ``id_col, component`` (from 1), ``n, deviation, whitened, explained, identity_error``.

    Null and repeated ids are rows like others; ``deviation`` is null where a long
    does not hold it; without a model there are no rows.  Other columns, whatever
    their names, are ignored."""
    scale, shift = (model.scale, model.shift) if model else (1, 0)
    rows = _vectors(df, vector_col, scale, shift, F.col(id_col).alias("id"))
    kind = dict(rows.dtypes)["id"]
    schema = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = model.axes.shape[1]
        for part, x in _blocks(batches):
            yield pd.DataFrame({
                "id": part["id"].repeat(k).to_numpy(),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(part)),
                "n": model.n,
                "deviation": pd.array(np.repeat(np.array(model.deviation(x), dtype=object), k), dtype="Int64"),
                "whitened": (model.centred(x) @ model.axes).ravel(),
                "explained": np.tile(model.explained, len(part)),
                "identity_error": model.identity_error,
            })

    out = rows.where(F.size("x") == model.dim).mapInPandas(run, schema.replace("id long", f"id {kind}", 1))
    return out.withColumnRenamed("id", id_col)
