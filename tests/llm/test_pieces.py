import hashlib
import random

import corpus_pipeline
import pytest
import sentencepiece
from helpers_llm import docs, rows, with_clashes
from sentencepiece import sentencepiece_model_pb2

from eventlens.llm.pieces import Window, decode_documents, encode_documents, load_model
from eventlens.llm.queries import PIECE_MODEL, QUERIES

TEXTS = ["Hello  world\n\tthis is 😀 a test  ", " ", "   ", "a", "▁x ▁", "日本語テキスト", "<unk> <s> </s>", "a" * 1000, "ab" * 777, " " * 100, "x" + " " * 50 + "y", "the,end.of\"it", "a\x00b", "²., x²."]


@pytest.fixture(scope="module")
def model():
    return load_model(PIECE_MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def random_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice("abcdeth er in▁ éñ\n.,12\"'") for _ in range(r.randint(1, 150))) for _ in range(n)]


def test_ids_equal_the_library(model, library):
    for t in TEXTS + random_texts(400) + [d[1] or "" for d in rows(30, 80)]:
        assert model.encode(t).tolist() == library.encode(t), t
        assert model.decode(model.encode(t)) == library.decode(library.encode(t)) == t.replace("▁", " ")


def test_stream_without_cuts_is_the_same_and_commits_early(model):
    for t in TEXTS + random_texts(200, 2):
        marked = "▁" + t.replace(" ", "▁")
        whole = [p for p in model.stream(marked)]
        assert "".join(whole) == marked
        assert b"".join(model.encode_cut(c) for c in [marked]) == model.encode(t).tobytes()
    assert next(iter(model.stream("▁the" * 100_000))) == "▁the"


def test_slices_of_any_length_give_the_same_ids(model, library, monkeypatch):
    texts = TEXTS + random_texts(60, 5) + ["x" * 300 + " the end, " + " " * 90 + "y" * 200, "a\n" * 100 + "b" * 400 + "\n c"]
    for size in (1, 2, 7, 50, 129):
        monkeypatch.setattr("eventlens.llm.pieces.SLICE", size)
        for t in texts:
            assert model.encode(t).tolist() == library.encode(t), (size, t)
            assert "".join(model.decode_stream(model.encode_stream(t))) == t.replace("▁", " ")


def test_windows_commit_and_stay_small(model):
    """Over a document's whole text the paths meet at every word, and the lattice stays short."""
    t = next(d[1] for d in rows(33, 80) if d[1] and len(d[1]) > 3000)
    window, widest = Window(model), 0
    pieces = []
    for c in "▁" + t.replace(" ", "▁"):
        pieces += window.feed(c)
        widest = max(widest, len(window.back))
    assert window.commits > len(t) / (8 * model.longest) and widest <= 6 * model.longest
    assert [model.ids[p] for p in pieces + window.flush() if p in model.ids] == [i for i in model.encode(t).tolist() if i not in model.byte_of]
    parts = list(model.encode_stream("word and word, " * 50_000))
    assert len(parts) > 10 and max(map(len, parts)) < 40_000


def test_unigram_paths_equal_the_library(tmp_path):
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PIECE_MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    r = random.Random(7)
    for p in proto.pieces:  # exact in 32 bits, so that sums don't depend on their order
        if p.type == proto.SentencePiece.NORMAL:
            p.score = -r.randrange(1, 1 << 16) / 4096
    proto.trainer_spec.model_type = 1
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    model, library = load_model(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    assert not model.bpe
    same = 0
    texts = random_texts(150, 3)
    for t in texts:
        ids = library.encode(t)
        score = lambda x: sum(proto.pieces[i].score for i in x)
        got = model.encode(t).tolist()
        same += got == ids
        assert got == ids or abs(score(got) - score(ids)) < 1e-3  # a tie
    assert same > 140


def test_documents(spark, model, library):
    data = rows(31, 60)
    coded = encode_documents(with_clashes(docs(spark, data)), model, out_col="ids")
    back = decode_documents(coded, model, "ids", "decoded").collect()
    assert len(back) == len(data)
    for r in back:
        assert r["ids"] == (None if r["text"] is None else library.encode(r["text"])) and r["decoded"] == r["text"]
    assert encode_documents(docs(spark, []), model).collect() == []


def test_query_and_last_stage_decode(spark, tmp_path, library):
    data = rows(32, 60) + [(900 + i, t, "en", "s", 0) for i, t in enumerate(TEXTS)]
    docs(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(((d[0], None if d[1] is None else hashlib.sha256(library.decode(library.encode(d[1])).encode()).hexdigest(), d[1] is None or "▁" not in d[1]) for d in data), key=str)
    for got in (QUERIES["op8_streaming_viterbi"](spark, str(tmp_path)), corpus_pipeline.encode(spark, frame, str(tmp_path))):
        assert sorted(((r["doc_id"], r["decoded_sha256"], r["round_trip"]) for r in got.collect()), key=str) == want
