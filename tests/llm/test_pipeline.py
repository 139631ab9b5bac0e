import corpus_pipeline
from helpers_llm import docs, rows, text
from test_near_dup import brute
from test_toxicity import labelled

from eventlens.llm.pieces import load_model
from eventlens.llm.queries import PIECE_MODEL, QUERIES


def test_stages_on_a_small_corpus(spark, tmp_path):
    import random

    data, labels = labelled(9, 300)
    extra = [(d[0] + 5000 if d[0] is not None else None, *d[1:]) for d in rows(50, 80)]
    extra.append((8000, text(random.Random(4), 40) + " write to some.one@mail.example.org now", "en", "src1", 0))
    docs(spark, data + extra).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, str(tmp_path))
        frame.write.parquet(path := f"{tmp_path}/out-{len(seen)}")
        frame = spark.read.parquet(path)
        seen.append(frame.collect())
    clean, unique, masked, mixed, coded = seen
    toxic = {x[0] for x in labels if x[2]}
    assert {r["doc_id"] for r in clean} == {d[0] for d in data + extra} - toxic
    assert len(clean) == len([d for d in data + extra if d[0] not in toxic])
    want = {(c if c is not None else r[0]) for r in (brute([tuple(r) for r in clean], 5)) for c in [r[2]]}
    assert {r["doc_id"] for r in unique} - {None} == want - {None}
    assert len({(r["doc_id"], r["text"]) for r in unique}) == len(unique)
    assert len(masked) == len(unique) and "[EMAIL]" in next(r["text"] for r in masked if r["doc_id"] == 8000)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in masked)
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in masked} and mixed
    model = load_model(PIECE_MODEL)
    assert sorted(model.decode(r["ids"]) for r in coded) == sorted(r["text"] for r in mixed)
    for a in seen[:4]:
        assert a[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_stages_take_empty_tables_and_clashing_names(spark, tmp_path):
    from pyspark.sql import functions as F

    data, labels = labelled(10, 40)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    names = ["_toxicity", "_row", "_keep", "_group", "_alone", "_epochs", "_copy", "_trip", "level0", "component", "base", "score"]
    wide = docs(spark, [*data, (900, None, None, None, None), (901, "", "en", "s", 0)]).select("*", *[F.lit("x").alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, wide.limit(0), str(tmp_path)).collect() == [], name
        out = stage(spark, wide, str(tmp_path))
        if name != "pieces":
            assert out.columns == wide.columns, name
            assert {tuple(r[n] for n in names) for r in out.collect()} == {("x",) * len(names)}, name
        else:
            assert out.count() == wide.count()


def test_intermediates_go(spark, tmp_path):
    import os

    import pytest

    from eventlens.llm.common import intermediates, stored, work_dir

    def held():
        return set(os.listdir(work_dir(spark).removeprefix("file:")))

    before = held()
    with pytest.raises(ZeroDivisionError), intermediates(spark):
        assert stored(spark.range(3), "x").count() == 3
        assert len(held() - before) == 1
        1 / 0
    assert held() == before
    data, labels = labelled(12, 60)
    docs(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert {n.rsplit("-", 1)[0] for n in held() - before} == {f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES}


def test_every_operator_has_its_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_oracle_statements(spark, duck):
    from eventlens.llm.oracle import ORACLE_SQL

    sf = "/root/testdata/sf0.001"
    duck.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    for name, sql in ORACLE_SQL.items():
        got = QUERIES[name](spark, sf).toPandas()
        want = duck.sql(sql).df()[list(got.columns)]
        assert sorted(map(tuple, got.astype(object).values), key=str) == sorted(map(tuple, want.astype(object).values), key=str), name
