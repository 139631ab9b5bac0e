import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from helpers_llm import SCHEMA, docs, rows, with_clashes
from pyspark.sql import functions as F

from eventlens.llm.merkle import merkle_manifest, verified

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
DATA = rows(5, 90) + [(5_000 + i, "hot", "de", "s", i) for i in range(100)] + [(6_000, "alone", "zz", None, 1)]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(leaves, arity):
    """The root and, for each leaf, its siblings level by level as (left, right)."""
    level, above, paths = list(leaves), [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(level) > 1:
        runs = [range(i, min(i + arity, len(level))) for i in range(0, len(level), arity)]
        for run in runs:
            for k in run:
                for leaf in above[k]:
                    paths[leaf].append(([level[j] for j in run if j < k], [level[j] for j in run if j > k]))
        level, above = [h(*[level[j] for j in run]) for run in runs], [[x for j in run for x in above[j]] for run in runs]
    return level[0], paths


def expected(data, arity, tampered):
    groups = defaultdict(list)
    for d in data:
        groups[d[2]].append(d)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda d: (d[0] is not None, d[0] or 0, leaf_of(*d))) for g in names}
    trees = {g: tree([leaf_of(*d) for d in ordered[g]], arity) for g in names}
    root, upper = tree([trees[g][0] for g in names], arity)
    out = Counter()
    for i, g in enumerate(names):
        for d, own in zip(ordered[g], trees[g][1], strict=True):
            path = own + upper[i]
            sibs = h(*[s for left, right in path for s in left + right])
            acc = leaf_of(*d[:4], d[4] + 1) if tampered(d[0]) and d[4] is not None else leaf_of(*d)
            for left, right in path:
                acc = h(*left, acc, *right)
            out[d[0], leaf_of(*d), trees[g][0], root, sibs, acc, acc == root] += 1
    return out


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def manifest(df, arity):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle_manifest(df, FIELDS, "lang", "doc_id", {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}, arity)


@pytest.mark.parametrize(("arity", "clash"), [(2, False), (3, True)])
def test_brute_force(spark, arity, clash, monkeypatch):
    monkeypatch.setattr("eventlens.llm.merkle.PATH_STEP", 2)
    df = docs(spark, DATA)
    got = verified(manifest(with_clashes(df) if clash else df, arity), "doc_id").collect()
    assert Counter(map(tuple, got)) == expected(DATA, arity, tampered)
    assert {r["verified"] for r in got} == {True, False}


def test_one_row_and_equal_rows(spark):
    for data in ([(1, "t", None, None, None)], [(1, "t", "en", "s", 1)] * 5):
        got = verified(manifest(docs(spark, data), 2), "doc_id").collect()
        assert Counter(map(tuple, got)) == expected(data, 2, tampered)


def test_empty_table(spark):
    made = manifest(spark.createDataFrame([], SCHEMA), 2)
    assert made.root is None and made.rows.collect() == [] and made.groups.collect() == []


def test_any_change_shows_and_order_of_rows_does_not(spark):
    same, other = docs(spark, DATA[::-1]).repartition(5), docs(spark, [*DATA[:-1], (6_000, "alone!", "zz", None, 1)])
    roots = [manifest(df, 2).root for df in (docs(spark, DATA), same, other)]
    assert roots[0] == roots[1] != roots[2]
