import random

import numpy as np
import pytest

from specloom.llm import pieces as P

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def vocabulary():
    return P.load()


def random_texts(seed, n=200):
    rng = random.Random(seed)
    parts = ["the", "Hello", " ", "  ", "\n", "ü", "日本", "\U0001f600", "a" * 40, "e.g.", "12,5", "\x00", "ß", "Straße", "_x_", "'s", "\r\n", "\t", "--"]
    return ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.choice([0, 1, 5, 60]))) for _ in range(n)]


def test_same_as_whole_lattice_search(tmp_path):
    """The library's own unigram search over the same pieces and scores is the brute force."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb.ModelProto()
    proto.ParseFromString(open(P.PIECES, "rb").read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -50_000)  # the library sums in single precision
    (tmp_path / "model").write_bytes(proto.SerializeToString())
    other = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "model"))
    encoder = P.Encoder(P.load(str(tmp_path / "model")))
    for text in random_texts(1):
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == other.encode(text), text


def test_commits_in_a_bounded_window(vocabulary):
    search = P.StreamingViterbi(vocabulary)
    text = "internationalisation" * 2000
    widest = 0
    for c in text:
        search.feed(c)
        widest = max(widest, len(search.window))
    assert widest <= 8 * vocabulary.longest
    whole = search.close()
    assert P.decode_ids([vocabulary.pieces["▁"][0], *whole], vocabulary) == text


def test_round_trip_and_odd_rows(spark, docs):
    texts = [*random_texts(2), None, "", " ", "▁", "a▁ b", "▁▁ ", "x" * 100_000, "wort " * 30_000, "ab", "ab"]
    rows = list(enumerate(texts))
    out = P.decode(P.encode(docs(rows).withColumnRenamed("lang", "ids"))).collect()
    assert len(out) == len(rows)
    for r in sorted(out, key=lambda r: r["doc_id"]):
        assert r["decoded"] == texts[r["doc_id"]]
        assert (r["ids"] is None) == (texts[r["doc_id"]] is None)
        assert r["text"] != "" or r["ids"] == []


def test_both_ways_in_one_pass(spark, docs):
    rows = list(enumerate([*random_texts(3), None, "", "▁", "wort " * 30_000]))
    frame = docs(rows).withColumnRenamed("lang", "ids")
    both = P.encode_and_decode(frame)
    key = lambda r: r["doc_id"]
    assert sorted(both.collect(), key=key) == sorted(P.decode(P.encode(frame)).collect(), key=key)
    # one pass is one Python worker a task: two with a vocabulary each took an executor over its memory
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_empty_table(spark, docs):
    assert P.encode(docs([])).count() == 0
