import hashlib
import tracemalloc
from collections import Counter

import numpy as np
from helpers_llm import docs, rows, text, with_clashes

from eventlens.llm.fingerprint import edit_text, fingerprints_with_next, signatures, term_draws


def generalised_jaccard(a: str, b: str) -> float:
    def terms(t):
        w = t.encode().lower().split()
        return Counter(zip(w, w[1:], strict=False)) if len(w) > 1 else Counter(w)

    x, y = terms(a), terms(b)
    both = x.keys() | y.keys()
    return sum(min(x[k], y[k]) for k in both) / max(1, sum(max(x[k], y[k]) for k in both))


def test_collision_rate_is_generalised_jaccard():
    import random

    r = random.Random(4)
    base = text(r, 80).split()
    for changed in (0, 8, 25, 60):
        other = base[: 80 - changed] + text(r, changed).split()
        repeated = base[:10] * 4 + other
        for a, b in ((" ".join(base), " ".join(other)), (" ".join(base * 2), " ".join(other)), (" ".join(repeated), " ".join(other))):
            s = signatures([a, b], 2048)
            assert abs((s[0] == s[1]).mean() - generalised_jaccard(a, b)) < 0.06


def test_collision_rate_of_long_texts_with_heavy_shingles():
    for heavy, others in ((1000, 19_000), (200, 1_800)):
        a, b = (" ".join(["a"] * (heavy + 1) + [f"{side}{i}" for i in range(others)]) for side in "xy")
        want = generalised_jaccard(a, b)
        s = signatures([a, b], 3000)
        assert abs((s[0] == s[1]).mean() - want) < 4 * (want * (1 - want) / 3000) ** 0.5


def test_draws_of_one_term_are_exponential():
    terms = np.arange(1, 20_001, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    a = term_draws(terms, np.ones(len(terms), dtype=np.int64), 256).ravel()
    for y in (1e-1, 1e-3, 1e-4, 1e-5):
        want = 1 - np.exp(-y)
        assert abs((a < y).mean() / want - 1) < 5 / (want * len(a)) ** 0.5


def test_blocks_do_not_change_signatures(monkeypatch):
    import random

    from eventlens.llm import fingerprint

    r = random.Random(5)
    texts = [text(r, n) for n in (1, 3, 500, 40, 900)] + ["", "x"]
    whole = signatures(texts, 32)
    monkeypatch.setattr(fingerprint, "TERM_BLOCK", 64)
    assert np.array_equal(whole, signatures(texts, 32))


def test_neighbours_edits_and_edge_cases(spark):
    data = rows(3, 90)
    plain = [d for d in data if d[0] is not None]
    order = sorted(plain, key=lambda d: -d[0])
    for df in (docs(spark, data), with_clashes(docs(spark, data))):
        got = fingerprints_with_next(df, rows_per_range=10).collect()
        assert Counter(r["doc_id"] for r in got) == Counter(d[0] for d in data)
        by_id = {}
        for r in got:
            by_id.setdefault(r["doc_id"], []).append(r)
        texts = {d[0]: d[1] or "" for d in plain}
        ids = list(dict.fromkeys(d[0] for d in order))
        for a, b in zip(ids, ids[1:], strict=False):
            last = [r for r in by_id[a] if r["edited_sha256"] == hashlib.sha256(edit_text(texts[a], texts[b]).encode()).hexdigest()]
            assert last, a  # of repeated rows, the last one meets the next id
            own, new, following = signatures([texts[a], edit_text(texts[a], texts[b]), texts[b]], 64)
            wanted = (len(texts[a]), own.astype(">u2").tobytes().hex(), (own == new).mean(), (own == following).mean())
            assert wanted in [(r["n_chars"], r["fingerprint"], r["near_edited"], r["near_next"]) for r in last]
        nulls = by_id[None]
        wanted = {hashlib.sha256(edit_text(x, y).encode()).hexdigest() for x in ("no id here at all", "") for y in ("no id here at all", "", texts[ids[0]])}
        assert {r["edited_sha256"] for r in nulls} <= wanted
        same = {}
        for d in plain:
            same.setdefault(d[1] or "", set()).update(r["fingerprint"] for r in by_id[d[0]])
        assert all(len(v) == 1 for v in same.values())


def test_one_document_follows_itself_and_empty_table(spark):
    got = fingerprints_with_next(docs(spark, [(7, "a b c d e f", "en", "s", 0)])).collect()
    assert len(got) == 1 and got[0]["near_next"] == 1.0
    assert got[0]["edited_sha256"] == hashlib.sha256(edit_text("a b c d e f", "a b c d e f").encode()).hexdigest()
    assert fingerprints_with_next(docs(spark, [])).collect() == []


def test_draws_are_gathered_a_text_at_a_time():
    # 60,000 terms of 120 texts, few different ones
    texts = [" ".join(f"w{i}" for i in range(501))] * 120
    signatures(texts[:1], 64)
    tracemalloc.start()
    got = signatures(texts, 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == signatures(texts[:1], 64)).all()
    assert peak < 25e6  # the gathered draws of all would take 31 MB


def test_draws_by_the_formula():
    from eventlens.llm.common import mix64

    terms, weights = mix64(np.arange(1, 700, dtype=np.uint64)), np.arange(1, 700) % 4 + 1
    step = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        x = mix64(terms[:, None] ^ mix64(np.arange(1, 6, dtype=np.uint64) * step)[None, :])
        y = mix64(x + step)
    u1, u2, u3, u4 = (((z >> np.uint64(s) & np.uint64(0xFFFFFFFF)).astype(float) + 0.5) * 2.0**-32 for z in (x, y) for s in (0, 32))
    r = -np.log(u1 * u2)
    t = np.floor(np.log(weights)[:, None] / r + np.log(u2) / np.log(u1 * u2))
    assert np.allclose(term_draws(terms, weights, 5), -np.log(u3 * u4) * u1 * np.exp(-r * t))
