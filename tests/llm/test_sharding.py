import zlib
from collections import Counter

import pytest
from helpers_llm import docs, rows, with_clashes

from eventlens.llm.sharding import shard_records

DATA = rows(2, 400) + [(10_000 + i, "the same hot text", "en", "src0", 0) for i in range(250)]


@pytest.mark.parametrize("clash", [False, True])
def test_every_row_once_gapless_and_near_equal(spark, clash):
    df = docs(spark, DATA)
    got = shard_records(with_clashes(df) if clash else df, n_shards=4, rows_per_range=40).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d[0] for d in DATA)
    crc = {(d[0], zlib.crc32((d[1] or "").encode()), len((d[1] or "").encode()) + 1) for d in DATA}
    assert {(r["doc_id"], r["text_crc32"], r["size"]) for r in got} == crc
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for s in range(4):
        own = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 4) <= largest + 0.02 * total / 4


def test_same_result_again_and_whatever_the_ranges(spark):
    df = docs(spark, DATA)
    a = sorted(map(tuple, shard_records(df, rows_per_range=40).collect()), key=str)
    b = sorted(map(tuple, shard_records(df.repartition(7), rows_per_range=90).collect()), key=str)
    strip = lambda x: Counter((r[0], r[1], r[2], r[3]) for r in x)  # noqa: E731  equal rows are interchangeable
    assert strip(a) == strip(b)


def test_small_groups_of_equal_texts_are_not_cut(spark):
    data = [(i, f"text {i // 3} " * 40, "en", "src0", 0) for i in range(3000)]
    got = shard_records(docs(spark, data), rows_per_range=200).collect()
    assert len({(r["text_crc32"], r["shard"]) for r in got}) == len({r["text_crc32"] for r in got})


def test_empty_table(spark):
    assert shard_records(docs(spark, [])).count() == 0
