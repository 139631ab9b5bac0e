import random

import pytest
from helpers_llm import docs, rows, text, with_clashes

from eventlens.llm import near_dup
from eventlens.llm.components import connected_components
from eventlens.llm.near_dup import band_keys, minima, near_duplicates, packed_bits


def shingles(t, n):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(data, n):
    """(doc_id, n_shingles) -> component id, by all pairs."""
    sets = [shingles(d[1], n) for d in data]
    up = list(range(len(data)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    ids = {}
    for i, d in enumerate(data):
        if d[0] is not None:
            ids[find(i)] = min(ids.get(find(i), d[0]), d[0])
    return [(d[0], len(sets[i]), ids.get(find(i)) if sets[i] else d[0]) for i, d in enumerate(data)]


def chain(seed, n=60, words=120):
    """Near copies, each of the one before: linked in a chain, not all to all."""
    r = random.Random(seed)
    base, out = text(r, words).split(), []
    for i in range(n):
        base = list(base)
        base[r.randrange(words)] = f"w{i}"
        base[r.randrange(words)] = f"v{i}"
        out.append((1000 + (i * 37) % n, " ".join(base), "en", "src0", 0))
    return out


@pytest.mark.parametrize("n", [2, 5])
def test_equals_all_pairs(spark, n):
    data = rows(6, 150) + chain(1)
    got = near_duplicates(with_clashes(docs(spark, data)) if n == 2 else docs(spark, data), n=n).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=key) == sorted(brute(data, n), key=key)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_large_bucket_of_unlinked_texts_goes_block_by_block(spark, monkeypatch):
    from eventlens.llm import near_dup

    monkeypatch.setattr(near_dup, "BLOCK", 7)
    r = random.Random(9)
    shared = text(r, 40)
    data = [(i, f"{shared} {text(r, 40)}", "en", "src0", 0) for i in range(80)] + chain(2, 30)
    got = near_duplicates(docs(spark, data), n=2, bands=64, rows=1).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute(data, 2))


def test_bit_planes_estimate_similarity():
    import numpy as np

    r = np.random.default_rng(1)
    a = r.integers(1, 1 << 63, 1000).astype(np.uint64)
    b = np.r_[a[:900], r.integers(1, 1 << 63, 100).astype(np.uint64)]
    mins = np.stack([minima(x, np.array([0]), 640)[0] for x in (a, b)])
    x, y = packed_bits(mins, 2).view(np.uint64)
    differs = (x[:10] ^ y[:10]) | (x[10:] ^ y[10:])
    match = 1 - sum(int(w).bit_count() for w in differs) / 640
    assert abs((match - 0.25) / 0.75 - 900 / 1100) < 0.06
    assert (band_keys(mins, 32, 5)[0] == band_keys(mins, 32, 5)[1]).any()


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 103: 100}


def test_empty_table(spark):
    assert near_duplicates(docs(spark, [])).collect() == []


def test_shared_elements_equal_in_31_bits_count_each(spark):
    shared = [1, 1 + (1 << 31), 5, 6]  # two fall together when cut
    sets = spark.createDataFrame([(1, [*shared, 7]), (2, shared)], "node long, items array<long>")
    placed = spark.createDataFrame([(0, 1, 1), (0, 2, 2)], "key long, node long, component long")
    facts = spark.createDataFrame([(1, 5, [0, 0]), (2, 4, [0, 0])], "node long, n_shingles int, planes array<long>")
    rows = near_dup.open_members(placed, facts, sets).toPandas().assign(side=0)
    assert near_dup.block_links(rows, 80, 0.0, 64, 2)[["a", "b"]].values.tolist() == [[1, 2]]
