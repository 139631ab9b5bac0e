import hashlib
import re

import numpy as np
import pytest
from helpers_llm import docs, rows, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlens.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    """The patterns as they are written."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0
            ok = kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))) or (kind == "card" and 12 <= len(digits) <= 19 and luhn) or (kind == "phone" and 9 <= len(digits) <= 15)
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.b_-+()4 0251é\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


@pytest.mark.parametrize("text", ["4111 1111 1111 1111, 4111-1111-1111-1112", "a.b@c.d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4", "+1 (017) 555-7713 45", "@" * 50, "9" * 500, "a" * 3000 + "@b.c"])
def test_base_spans_of_chosen_texts(text):
    assert pii.base_spans(text) == brute(text)


def test_em_finds_reliable_labelers():
    r = np.random.default_rng(2)
    truth = r.random(4000) < 0.4
    votes = np.stack([np.where(r.random(4000) < acc, truth, ~truth).astype(int) for acc in (0.95, 0.9, 0.85, 0.6)], axis=1)
    votes[r.random(votes.shape) < 0.1] = pii.ABSTAIN
    patterns, index, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p, given_, prior = pii.expectation_maximisation(patterns, counts.astype(float))
    assert ((p[index.ravel()] > 0.5) == truth).mean() > 0.95 and abs(prior - 0.4) < 0.05
    assert given_[1, 0, 1] > given_[1, 3, 1]


NOISY = "mail jo.81@mail7.example.com call 555 123 4567 token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" bob (at) foo dot com version 1234567"


def test_query_columns_and_edge_cases(spark):
    data = rows(8, 60) + [(5000, NOISY, "en", "s", 0), (5001, NOISY + " é " + NOISY, "en", "s", 0)]
    got = pii.find_personal_data(with_clashes(docs(spark, data))).collect()
    assert len(got) == len(data)
    texts = {}
    for d in data:
        texts.setdefault(d[0], set()).add(d[1] or "")
    for r in got:
        base = [(s["start"], s["stop"], s["kind"]) for s in r["base"]]
        assert base in [brute(t) for t in texts[r["doc_id"]]]
        spans = base + [(s["start"], s["stop"], s["kind"]) for s in r["added"]]
        assert all(a < b for a, b, _ in spans)
    noisy = next(r for r in got if r["doc_id"] == 5000)
    assert "secret" in {s["kind"] for s in noisy["added"]}
    assert pii.find_personal_data(docs(spark, [])).collect() == []
    assert [r["added"] for r in pii.find_personal_data(docs(spark, [(1, "clean words only", "en", "s", 0)])).collect()] == [[]]


def test_masking(spark):
    got = pii.mask_personal_data(docs(spark, [(1, "x a@b.c y 1.2.3.4", "en", "s", 0), (2, None, "en", "s", 0), (3, "", "en", "s", 0)]))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "x [EMAIL] y [IP]", 2: None, 3: ""}
    assert pii.redact("abcdef", [(1, 3, "ip"), (2, 5, "card")]) == "a[IP]f"


def test_digest_of_the_query(spark, tmp_path):
    from eventlens.llm.queries import op1_weak_supervision_pii

    docs(spark, [(1, "x a@b.c y 1.2.3.4", "en", "s", 0), (2, None, "en", "s", 0)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op1_weak_supervision_pii(spark, str(tmp_path)).collect()}
    assert got[1]["base_sha256"] == hashlib.sha256(b"email:2:7,ip:10:17").hexdigest() and got[1]["spans"] == "email:2:7,ip:10:17"
    assert got[2]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[1]["n_email"] == 1 and got[2]["n_ip"] == 0


def test_candidates_of_long_texts():
    import random
    import time

    r = random.Random(8)
    text = " ".join(r.choice(["12 34 56", "+49 30 1234567", "call", "a.b (at) c.org", "token = abcdef0123456789abcdef0123456789", "10.0.0.1", "4111 1111 1111 1111", "7-77-777-7777,"]) for _ in range(60_000))
    start = time.perf_counter()
    base = pii.base_spans(text)
    found = pii.candidates(text, base)
    assert time.perf_counter() - start < 10 and len(text) > 900_000 and len(found) > 1000
    every = sorted([(a, b, 1) for a, b, _ in found] + [(a, b, 0) for a, b, _ in base])
    ends = [0, 0]  # of the base spans, of the candidates
    for a, b, mine in every:  # candidates touch nothing; base spans of different kinds may
        assert a >= ends[1] and (a >= ends[0] or not mine)
        ends[mine] = max(ends[mine], b)
