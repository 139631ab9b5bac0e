import random
from itertools import combinations

import pytest
from helpers_llm import docs, rows, text, with_clashes

from eventlens.llm.licenses import TEMPLATES, Scanner, longest_increasing, patience, scan_licenses, words_of


def test_longest_increasing_equals_all_subsequences():
    r = random.Random(1)
    for _ in range(200):
        values = [r.randrange(8) for _ in range(r.randint(0, 8))]
        got = longest_increasing(values)
        assert all(values[a] < values[b] for a, b in zip(got, got[1:], strict=False)) and got == sorted(got)
        best = max((k for k in range(len(values) + 1) for c in combinations(values, k) if all(a < b for a, b in zip(c, c[1:], strict=False))), default=0)
        assert len(got) == best


def brute_patience(a, b, da=0, db=0):
    """The definition, recursively."""
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(da, db), *brute_patience(a[1:], b[1:], da + 1, db + 1)]
    if a[-1] == b[-1]:
        return [*brute_patience(a[:-1], b[:-1], da, db), (da + len(a) - 1, db + len(b) - 1)]
    once = [(a.index(w), j) for j, w in enumerate(b) if b.count(w) == 1 and a.count(w) == 1]
    kept = [once[i] for i in longest_increasing([i for i, _ in once])]
    if not kept:
        return []
    out, (pa, pb) = [], (0, 0)
    for i, j in [*kept, (len(a), len(b))]:
        out += brute_patience(a[pa:i], b[pb:j], da + pa, db + pb)
        if i < len(a) or j < len(b):
            out.append((da + i, db + j))
        pa, pb = i + 1, j + 1
    return out


def test_patience_equals_its_definition():
    r = random.Random(2)
    for _ in range(500):
        a, b = ([r.choice("abcdefgh") for _ in range(r.randint(0, 12))] for _ in range(2))
        assert patience(a, b) == brute_patience(a, b)


@pytest.mark.parametrize("name", TEMPLATES)
def test_each_template_is_found_amid_other_text_and_with_small_changes(name):
    r, scanner = random.Random(3), Scanner(TEMPLATES)
    notice = TEMPLATES[name]
    whole = f"{text(r, 50)} {notice.upper()}. {text(r, 50)}"
    found = {x[0]: x for x in scanner.scan(whole)}
    assert found[name][1] == 1.0 and words_of(whole[found[name][2] : found[name][3]]) == words_of(notice)
    if len(words_of(notice)) > 10:
        changed = notice.split()
        changed[5] = "zzz"
        assert name in {x[0] for x in scanner.scan(f"{text(r, 9)} {' '.join(changed)} {text(r, 9)}")}
    assert len([x for x in scanner.scan(f"{notice} {text(r, 30)} {notice}") if x[0] == name]) == 2


def test_clean_texts_have_none(spark):
    data = rows(40, 80) + [(700, "x " + TEMPLATES["MIT"], "en", "s", 0)]
    got = scan_licenses(with_clashes(docs(spark, data)), out_col="licenses").collect()
    assert len(got) == len(data)
    assert {r["doc_id"] for r in got if r["licenses"]} == {700}
    assert scan_licenses(docs(spark, [])).collect() == []


def names(t, templates=TEMPLATES):
    return [x[0] for x in Scanner(templates).scan(t)]


@pytest.mark.parametrize("name", TEMPLATES)
def test_inserted_words_do_not_split_a_notice(name):
    r, notice = random.Random(5), TEMPLATES[name].split()
    tells = {"BSD-2-Clause": 20}  # not where two clauses meet, which tells it from its sibling
    at = tells.get(name, 3)
    whole = f"{text(r, 40)} {' '.join(notice[:at])} (zq zr 123 src/zs.py {text(r, 25)}) {' '.join(notice[at:])} {text(r, 40)}"
    if name in ("MIT", "CC-BY-NC-4.0"):  # inside the words that name the license
        whole = f"{text(r, 40)} {notice[0]} (zq zr 123 src/zs.py {text(r, 25)}) {' '.join(notice[1:])} {text(r, 40)}"
    found = {x[0]: x for x in Scanner(TEMPLATES).scan(whole)}
    assert name in found and found[name][1] == 1.0
    assert words_of(whole[found[name][2] : found[name][3]])[0] == words_of(TEMPLATES[name])[0]


@pytest.mark.parametrize("name", TEMPLATES)
@pytest.mark.parametrize("between", ["", "x", "x y z", "\n"])
def test_adjacent_copies_are_all_found(name, between):
    notice = TEMPLATES[name]
    whole = f" {between} ".join([notice] * 4)
    found = [x for x in Scanner(TEMPLATES).scan(whole) if x[0] == name]
    assert len(found) == 4 and all(x[1] == 1.0 for x in found)
    assert [words_of(whole[x[2] : x[3]]) for x in found] == [words_of(notice)] * 4


def test_adjacent_changed_copies():
    notice = words_of(TEMPLATES["GPL-3.0"])
    for missing in range(4):
        copy = notice[:missing] + notice[missing + 1 :]
        whole = " ".join([*copy, *notice, *copy, *copy])
        assert names(whole).count("GPL-3.0") == 4


def test_siblings_are_not_taken_for_one_another():
    for name, t in TEMPLATES.items():
        inside = {"Apache-2.0-notice": {"Apache-2.0"}, "MIT-text": {"MIT-grant"}, "BSD-2-Clause": {"BSD"}, "BSD-3-Clause": {"BSD"}}.get(name, set())
        assert set(names(t)) == {name} | inside
    for other in (
        "Licensed under the Apache License, Version 1.1", "Licensed under the Apache License, Version 1.1. See section 2.0", "Licensed under CC BY-NC-SA 4.0", "Licensed under CC BY-NC 3.0",
        "Released under the MIT-0 License", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "This work is licensed under a Creative Commons Attribution Share Alike 4.0 International License", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1",
    ):
        assert names(other) == []


def test_other_templates_and_templates_without_anchors():
    assert names("x a b a b y a b a b", {"z": "a b a b"}) == ["z", "z"]
    assert names("a b", {"z": ""}) == []
    far = "released " + "other " * 500 + TEMPLATES["MIT"] + " other" * 500 + " license"
    assert [far[a:b] for _, _, a, b in Scanner(TEMPLATES).scan(far)] == [TEMPLATES["MIT"]]


def test_copies_that_fail_cost_time_in_proportion():
    import time

    words = [f"w{i}x" for i in range(40)]
    scanner = Scanner({"T": " ".join([*words[:20], "left", "right", *words[20:]])}, required={"T": ["left right"]})

    def seconds(copies):
        body = " ".join(" ".join([*words[:20], "right", "left", *words[20:]]) for _ in range(copies))
        start = time.perf_counter()
        assert scanner.scan(body) == []
        return time.perf_counter() - start

    seconds(50)
    assert seconds(3200) < 16 * max(seconds(400), 0.02)  # eight times the text; quadratic is 64 times
    good = " ".join([*words[:20], "left", "right", *words[20:]])
    bad = good.replace("left right", "right left")
    assert len(scanner.scan(" . ".join([bad, good, bad, bad, good, good]))) == 3
