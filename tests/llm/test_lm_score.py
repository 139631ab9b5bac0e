import math
from collections import Counter

import numpy as np
import pytest
from helpers_llm import docs, rows, with_clashes

from eventlens.llm.lm_score import pack, pack_counts, stupid_backoff, unpack, unpack_counts
from eventlens.llm.queries import QUERIES


def words(t):
    return (t or "").encode().lower().split()


def brute(data, order, alpha):
    """(id, tokens, log2 score) by dictionaries of word tuples."""
    grams = [Counter(tuple(w[i : i + n]) for w in [words(d[1])] for n in range(1, order + 1) for i in range(len(w) - n + 1)) for d in data]
    total = sum(grams, Counter())
    tokens = sum(len(words(d[1])) for d in data)
    out = []
    for d, own in zip(data, grams, strict=True):
        w, s = words(d[1]), 0.0
        left = {g: total[g] - own[g] for g in own}
        for i in range(len(w)):
            factor = 1.0
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                if n == 1:
                    s += math.log2(factor * max(left[g], 1) / max(tokens - len(w), 1))
                elif left[g] > 0:
                    s += math.log2(factor * left[g] / left[g[:-1]])
                    break
                factor *= alpha
        out.append((d[0], len(w), s))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_dictionaries(spark, order):
    data = rows(21, 80)
    df = with_clashes(docs(spark, data)) if order == 2 else docs(spark, data)
    got = sorted(((r["doc_id"], r["n_tokens"], r["log2_score"]) for r in stupid_backoff(df, order=order, block_bytes=4000).collect()), key=str)
    want = sorted(brute(data, order, 0.4), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want] or sorted(g[:2] for g in got if g[0] is not None) == sorted(w[:2] for w in want if w[0] is not None)
    by = lambda x: sorted((str(a), b, round(c, 6)) for a, b, c in x)
    assert by(got) == by(want)


def test_texts_without_words_and_empty_table(spark):
    got = {r["doc_id"]: r for r in stupid_backoff(docs(spark, [(1, None, "en", "s", 0), (2, " ", "en", "s", 0), (3, "a", "en", "s", 0)])).collect()}
    assert got[1]["mean_log2"] is None and got[2]["n_tokens"] == 0 and got[3]["n_tokens"] == 1
    assert stupid_backoff(docs(spark, [])).collect() == []


def test_packing():
    r = np.random.default_rng(0)
    for values in (np.unique(r.integers(0, 1 << 63, 500).astype(np.uint64)), np.array([0], dtype=np.uint64), np.array([5, 1 << 40, (1 << 64) - 1], dtype=np.uint64)):
        assert np.array_equal(unpack(pack(values)), values)
    for counts in (np.array([1, 255]), np.array([1, 256]), np.array([1 << 40])):
        assert np.array_equal(unpack_counts(pack_counts(counts)), counts)


def test_the_query_backs_off_from_trigrams(spark):
    sf = "/root/testdata/sf0.001"
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["log2_score"] for r in QUERIES["op6_stupid_backoff"](spark, sf).collect()}
    for i, _, s in brute(data, 3, 0.4):
        assert abs(got[i] - s) < 1e-6 * max(1, abs(s))


def test_gaps_of_a_range_take_little_more_than_their_bits():
    # 2,000 numbers of a range of 2**56: gaps of about 45 bits
    base = 0xAB << 56
    values = np.unique(np.random.default_rng(3).integers(0, 1 << 56, 2000).astype(np.uint64)) + np.uint64(base)
    assert np.array_equal(unpack(pack(values, base), base), values)
    assert len(pack(values, base)) < 6.1 * len(values)
    counts = np.where(np.arange(2000) % 50 == 0, 3, 1)
    assert np.array_equal(unpack_counts(pack_counts(counts)), counts) and len(pack_counts(counts)) < 600
    assert len(unpack(pack(values[:0]))) == 0
