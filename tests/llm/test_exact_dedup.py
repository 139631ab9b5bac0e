import hashlib
from collections import Counter, defaultdict

import pytest
from helpers_llm import SCHEMA, docs, rows, text, with_clashes
from pyspark.sql import functions as F

from eventlens.llm.exact_dedup import MAX_CHUNK, chunks_of, exact_duplicates, hashed_names

LONG = "One sentence of a very long text. " * 20_000
DATA = rows(7, 150) + [(20_000 + i, "the same hot text", "en", "s", 0) for i in range(200)] + [(30_000, LONG, "en", "s", 0), (30_001, LONG, "en", "s", 0), (30_002, LONG + " ", "en", "s", 0), (30_003, "x" * 9_000, None, None, 0), (30_004, "x" * 9_001, None, None, 0)]


def expected(data):
    groups = defaultdict(list)
    for d in data:
        groups[d[1] or ""].append(d[0])
    out = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha, first = hashlib.sha256(t.encode()).hexdigest(), True
        for i in ids:
            out[i, keep, len(ids), i == keep and first, sha] += 1
            first = first and i != keep
    return out


@pytest.mark.parametrize("clash", [False, True])
def test_brute_force(spark, clash):
    df = docs(spark, DATA)
    assert Counter(map(tuple, exact_duplicates(with_clashes(df) if clash else df).collect())) == expected(DATA)


def test_all_groups_hot_or_none(spark, monkeypatch):
    for share in (1, 10**9):
        monkeypatch.setattr("eventlens.llm.exact_dedup.HOT_SHARE", share)
        assert Counter(map(tuple, exact_duplicates(docs(spark, DATA)).collect())) == expected(DATA)


def test_names_that_clash_are_given_anew(spark):
    asked = []

    def weak(value, salt):
        asked.append(salt)
        a, b = hashed_names(value, salt)
        return (a % 3, F.lit(0).cast("long")) if salt < 2 else (a, b)

    assert Counter(map(tuple, exact_duplicates(docs(spark, DATA), namer=weak).collect())) == expected(DATA)
    assert max(asked) == 2


def test_chunks_join_to_the_text_and_fall_into_step(spark):
    import random

    r = random.Random(3)
    body = ". ".join(text(r, 30) for _ in range(60))
    texts = [body, "Some other beginning here. " + body, "", "y" * 5_000, "é😀. " * 900, None]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", "t", chunks_of(F.coalesce("t", F.lit(""))).alias("c")).collect()
    by = {x["i"]: x["c"] for x in got}
    for x in got:
        assert "".join(x["c"]) == (x["t"] or "") and all(0 < len(c) <= MAX_CHUNK for c in x["c"])
    assert len(set(by[0]) & set(by[1])) >= len(by[0]) // 2


def test_empty_table_and_normalised_texts(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, "A b"), (2, "a b"), (3, None)], "doc_id long, text string")
    got = {x["doc_id"]: (x["keep_id"], x["kept"]) for x in exact_duplicates(df, normalize=F.lower).collect()}
    assert got == {1: (2, False), 2: (2, True), 3: (3, True)}


def test_no_python_in_the_plan(spark):
    out = exact_duplicates(docs(spark, DATA))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
