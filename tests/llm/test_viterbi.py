"""Streaming Viterbi against the library's own search over the same scored pieces."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from storyloom.llm import viterbi

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return viterbi.Pieces(PATH)


@pytest.fixture(scope="module")
def library():
    """The same pieces and scores, searched as a unigram model."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def _ids(model, text):
    return np.frombuffer(model.encode(text), "<u4").tolist()


def test_equals_the_library(model, library, corpus):
    texts = [" ".join((t or "").split(" ")[:60]) for _, t, *_ in corpus]
    texts += ["hello world", "  two  blanks ", "日本語", "naïve café\n\tx", "internationalization " * 3, "\U0001f600", "x" * 40, "1234567890"]
    for text in texts:
        assert _ids(model, text) == library.encode(text), text


def _whole(model, text):
    """Plain Viterbi over the whole text."""
    best, back = [0.0] + [None] * len(text), [0] * (len(text) + 1)
    for i in range(1, len(text) + 1):
        for j in range(max(0, i - model.longest), i):
            found = model.pieces.get(text[j:i])
            score = best[j] + (found[1] if found else model.penalty)
            if (found or j == i - 1) and (best[i] is None or score > best[i]):
                best[i], back[i] = score, j
    cuts, at = [], len(text)
    while at:
        cuts.append((back[at], at))
        at = back[at]
    ids = []
    for a, b in reversed(cuts):
        model._emit(text, a, b, ids)
    return ids


def test_committing_does_not_change_the_best_path(model):
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choices(["an", "the", "e", "▁", "日", "ing", "x", "tion", "\n", "ab"], k=rng.randint(1, 150)))
        ids, widest = model.cut(text)
        assert ids == _whole(model, text)
    long = "".join(rng.choices("abcdefghij", k=20000))
    ids, widest = model.cut(long)
    assert widest < 40 * model.longest and ids == _whole(model, long)


def test_round_trip(spark, docs, corpus, model):
    got = {r.doc_id: r for r in viterbi.decode(viterbi.encode(docs, PATH), PATH).collect()}
    for doc_id, text, *_ in corpus:
        assert got[doc_id].text == (text or "") and got[doc_id].n_ids * 4 == len(got[doc_id].ids)
    assert model.decode(np.array([3 + 0xE9], "<u4").tobytes()) == "�"
    assert model.decode(model.encode(" lead ▁")) == " lead  "


def test_odd_rows(spark, nothing):
    assert viterbi.decode(viterbi.encode(nothing, PATH), PATH).count() == 0
    frame = spark.createDataFrame([(None, "a"), (1, None), (1, "")], "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS n_ids")
    assert sorted(r.n_ids for r in viterbi.encode(frame, PATH).collect()) == [0, 0, 1]
