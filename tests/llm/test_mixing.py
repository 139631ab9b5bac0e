import hashlib
import re
from collections import defaultdict

import pytest
from helpers_llm import docs, rows, with_clashes
from pyspark.sql import functions as F

from eventlens.llm.mixing import budgets, mix


def brute_fill(budget, children):
    """Water filling by repeated shares: children are (supply, weight)."""
    got, open_ = [0.0] * len(children), set(range(len(children)))
    left = min(budget, sum(s for s, _ in children))
    while open_:
        weight = sum(children[i][1] for i in open_)
        full = [i for i in open_ if children[i][0] <= left * children[i][1] / weight + 1e-9]
        if not full:
            for i in open_:
                got[i] = left * children[i][1] / weight
            break
        for i in full:
            got[i] = children[i][0]
        left -= sum(children[i][0] for i in full)
        open_ -= set(full)
    return got


def brute_tree(leaves, budget, weights):
    """leaves: path -> supply; weights: path prefix -> weight. Quota per leaf."""
    out = {}

    def down(prefix, budget):
        if prefix in leaves:
            out[prefix] = budget
            return
        depth = len(prefix)
        kids = sorted({p[: depth + 1] for p in leaves if p[:depth] == prefix}, key=str)
        supply = [sum(s for p, s in leaves.items() if p[: depth + 1] == k) for k in kids]
        for k, b in zip(kids, brute_fill(budget, [(s, weights.get(k, 1.0)) for s, k in zip(supply, kids, strict=True)]), strict=True):
            down(k, b)

    down((), budget)
    return out


@pytest.mark.parametrize("budget", [0, 50, 400, 901, 5000])
def test_budgets_redistribute_among_siblings_first(spark, budget):
    leaves = {("a", "x", "1"): 10, ("a", "x", "2"): 200, ("a", "y", "3"): 5, ("b", "x", "4"): 400, ("b", None, "5"): 300, (None, "x", "6"): 20}
    weights = {("a",): 3.0, ("b",): 1.0, ("a", "x"): 2.0}
    frame = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "l0 string, l1 string, l2 string, supply long")
    w0 = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "l0 string, weight double")
    w1 = spark.createDataFrame([("a", "x", 2.0)], "l0 string, l1 string, weight double")
    got = {(r["l0"], r["l1"], r["l2"]): r["quota"] for r in budgets(frame, ["l0", "l1", "l2"], float(budget), {0: w0, 1: w1}).collect()}
    want = brute_tree(leaves, budget, weights)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) <= 0.5 + 1e-6 for k in got)
    if budget >= sum(leaves.values()):
        assert got == leaves


def draw(seed, value):
    return int(hashlib.md5(f"{seed}:{'' if value is None else value}".encode()).hexdigest()[:15], 16)


def test_prefixes_of_seeded_epochs_equal_a_plain_loop(spark):
    data = rows(12, 300)
    for df in (docs(spark, data), with_clashes(docs(spark, data))):
        got = mix(df, [F.col("lang"), F.col("source")], budget_share=0.6, max_epochs=2, weights={0: spark.createDataFrame([("en", 2.0), ("fr", 5.0)], "level0 string, weight double")}, rows_per_bucket=7)
        taken = sorted((r["doc_id"], r["text"], r["epochs"]) for r in got.select("doc_id", "text", "epochs").collect() if r["doc_id"] is not None)
        leaf = defaultdict(list)
        for d in data:
            n = len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or ""))
            if n:
                leaf[(d[2], d[3])].append((draw(13, d[0]), draw(13, d[1]), n, d))
        supply = {k: 2 * sum(x[2] for x in v) for k, v in leaf.items()}
        quota = brute_tree(supply, int(sum(supply.values()) / 2 * 0.6), {("en",): 2.0, ("fr",): 5.0})
        want = []
        for k, v in leaf.items():
            tokens, q = sum(x[2] for x in v), round(quota[k])
            whole, rest, done = q // tokens, q % tokens, 0
            units = defaultdict(list)
            for x in v:
                units[x[:2]].append(x)
            for key in sorted(units):
                last = done < rest
                done += sum(x[2] for x in units[key])
                want += [(x[3][0], x[3][1], whole + last) for x in units[key] if whole + last]
        assert taken == sorted(w for w in want if w[0] is not None)
        assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_table_and_texts_without_words(spark):
    assert mix(docs(spark, []), [F.col("lang")]).collect() == []
    assert mix(docs(spark, [(1, "", "en", "s", 0), (2, None, None, None, None)]), [F.col("lang"), F.col("source")]).collect() == []
