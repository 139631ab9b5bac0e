import itertools
import math
import random

import numpy as np
import pytest
from helpers_llm import docs, text, with_clashes

from eventlens.llm.toxicity import Crf, fit, fit_windows, toxicity, word_features


def brute_marginals(crf: Crf, words):
    """P(T) of each word over all label sequences."""
    emit = [crf.bias + sum(crf.weights.get(f, 0) for f in word_features(w)) for w in words]
    weight, on = 0.0, np.zeros(len(words))
    for tags in itertools.product((0, 1), repeat=len(words)):
        s = tags[0] * crf.start + sum(e * t for e, t in zip(emit, tags, strict=True)) + sum(crf.trans[a, b] for a, b in itertools.pairwise(tags))
        weight += math.exp(s)
        on += math.exp(s) * np.array(tags)
    return on / weight


def test_marginals_equal_enumeration():
    r = random.Random(3)
    crf = Crf({"=bad": 3.0, "<wor": 1.5, ">rse": 0.7}, -1.2, 0.4, np.array([[0.3, -0.8], [-0.2, 0.9]]), (0, 0, 0))
    for _ in range(30):
        words = [r.choice(["bad", "worse", "plain", "x", "other"]) for _ in range(r.randint(1, 9))]
        hits = [(i, crf.emission(w)) for i, w in enumerate(words) if crf.emission(w) is not None]
        got = crf.marginals(len(words), [i for i, _ in hits], [s for _, s in hits])
        assert np.allclose(got, brute_marginals(crf, words)[[i for i, _ in hits]])


def test_training_raises_the_conditional_likelihood():
    r = np.random.default_rng(0)
    n, length = 300, 7
    x = r.integers(0, 3, (n, length))
    tags = ((x == 2) | ((x == 1) & (r.random((n, length)) < 0.2))).astype(float)
    ids, offsets = x.ravel(), np.arange(n * length + 1)
    w, other = fit_windows(ids, offsets, tags, np.ones((n, length)), 3)
    assert w[2] > w[1] > w[0]
    crf = Crf({f"={k}": float(v) for k, v in zip("abc", w, strict=True)}, float(other[0]), float(other[1]), other[2:].reshape(2, 2), (0, 0, 0))
    assert brute_marginals(crf, ["c"])[0] > 0.9 > 0.1 > brute_marginals(crf, ["a"])[0]


def labelled(seed=4, n=400):
    """Toxic documents hold words of a stem, two of them at least."""
    r = random.Random(seed)
    data, labels = [], []
    for i in range(n):
        words = text(r, 60).split()
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            words.insert(r.randrange(60), "vile" + r.choice(["ness", "st", "ly", "er"]))
        data.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return data, labels


def test_held_out_accuracy_spans_and_edge_cases(spark):
    data, labels = labelled()
    extra = [(9000, None, None, None, None), (9001, "", "en", "s", 0), (None, "vileness and vilest words", "en", "s", 0), data[0]]
    frame = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    crf = fit(docs(spark, data[:250]), frame.where("doc_id < 250 or doc_id is null"))
    got = toxicity(with_clashes(docs(spark, data + extra)), crf, out_col="toxicity").collect()
    assert len(got) == len(data) + len(extra)
    for r in got:
        score, spans = r["toxicity"]["score"], r["toxicity"]["spans"]
        assert 0 <= score <= 1
        if r["doc_id"] is None:
            assert score >= 0.7
        elif r["doc_id"] >= 9000:
            assert score < 0.5 and spans == []
        else:
            assert (score >= 0.7) == (r["doc_id"] % 5 == 0)
            assert all("vile" in r["text"][s["start"] : s["stop"]] for s in spans)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, 1, 1)], [(1, 1, None)]])
def test_without_usable_labels(spark, labels):
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    small = docs(spark, [(1, "a b", "en", "s", 0), (2, "", "en", "s", 0)])
    got = toxicity(small, fit(small, frame)).collect()
    assert len(got) == 2 and len({r["toxicity"]["score"] for r in got}) == 1
    assert toxicity(docs(spark, []), fit(docs(spark, []), frame)).collect() == []


def test_long_text(spark):
    data, labels = labelled()
    crf = fit(docs(spark, data), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    long = text(random.Random(8), 30_000) + " vilest vileness vilely"
    assert toxicity(docs(spark, [(1, long, "en", "s", 0)]), crf).first()["toxicity"]["score"] >= 0.7
