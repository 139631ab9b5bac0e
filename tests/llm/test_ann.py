import inspect
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlens.llm.ann import axes, hadamard, nearest, rotated, rotations
from eventlens.llm.common import read_table

SCHEMA = "vec_id long, embedding array<float>, label int, key string, node string, rank string, asks string, q string"


def table(seed=0, n=300, dim=16):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(10, dim))
    rows = [(i, [float(np.float32(v)) for v in centres[i % 10] + 0.4 * r.normal(size=dim)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(40)]  # one very common vector
    rows += [(900, None), (901, []), (902, [0.0] * dim), (903, [float("nan")] + [1.0] * (dim - 1)), (904, [float("inf")] * dim), (905, [None] + [1.0] * (dim - 1)), (None, rows[5][1]), (906, [1.0, 2.0]), (907, [2.0, 4.0]), rows[0]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, None, None, None, None, None) for r in rows], SCHEMA)


def brute(rows, asks, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, dtype=float)
    out = {}
    for q, x in good.items():
        if asks(q):
            near = [(-float(x @ y / math.sqrt((x @ x) * (y @ y))), i) for i, y in good.items() if i != q and len(y) == len(x)]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in near)[:k]]
    return out


def test_exact_when_all_buckets_are_probed(spark):
    rows = table()
    got = {}
    for r in nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, tables=8, hashes=1, probes=32).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = brute(rows, lambda i: i % 20 == 0, 5)
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert sorted(got[q]) == list(range(1, len(near) + 1))
        assert [got[q][i + 1][0] for i in range(len(near))] == [i for i, _ in near]
        assert all(abs(got[q][i + 1][1] - s) < 1e-9 for i, (_, s) in enumerate(near))


def test_too_few_candidates_are_made_up_exactly(spark):
    rows = table(1, 80)
    got = {}
    for r in nearest(frame(spark, rows), F.col("vec_id") % 10 == 0, tables=1, hashes=3, probes=1).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    want = brute(rows, lambda i: i % 10 == 0, 5)
    assert {q: len(v) for q, v in got.items()} == {q: len(v) for q, v in want.items()}


def test_recall_at_production_parameters(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in read_table(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    want = brute(rows, lambda i: i % 50 == 0, 5)
    got = {}
    for r in nearest(frame(spark, rows), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(got[q] & {i for i, _ in near}) for q, near in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_tables_without_usable_vectors(spark):
    assert nearest(frame(spark, []), F.lit(True)).collect() == []
    assert nearest(frame(spark, [(1, None), (2, [0.0])]), F.lit(True)).collect() == []
    assert nearest(frame(spark, [(50, [1.0, 0.5])]), F.lit(True)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 8, 64])
def test_hadamard_is_orthogonal(n):
    h = hadamard(np.eye(n))
    assert np.allclose(h @ h.T, np.eye(n)) and np.allclose(np.abs(h), 1 / math.sqrt(n))


def test_close_vectors_share_axes_more_often():
    r = np.random.default_rng(3)
    random.seed(1)
    x = r.normal(size=(400, 64))
    near, far = x + 0.3 * r.normal(size=x.shape), r.normal(size=x.shape)
    signs = rotations(64, 1, 1, 5)[0, 0]
    own = axes(rotated(x, signs), 1)[0][:, 0]
    share = [(own == axes(rotated(y, signs), 1)[0][:, 0]).mean() for y in (near, far)]
    assert share[0] > 0.3 > 0.05 > share[1]


def test_probes_do_not_depend_on_the_number_of_vectors():
    assert inspect.signature(nearest).parameters["probes"].default == 128
