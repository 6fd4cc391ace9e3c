"""The recurrent language model: gradients, probabilities and scores."""

import inspect
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from storyloom.llm import lm, recurrent


@pytest.fixture
def model():
    made = recurrent.Model(23, 5, 6)
    made.flat[:] = np.random.default_rng(0).standard_normal(len(made.flat)).astype(np.float32) * 0.3
    return made


def _docs(seed, n, top):
    rng = np.random.default_rng(seed)
    return [np.append(rng.integers(1, top, rng.integers(0, 40)), recurrent.END) for _ in range(n)]


def test_probabilities_add_up(model):
    h = np.random.default_rng(1).standard_normal((1, 6)).astype(np.float32)
    every = np.arange(23 + recurrent.SHAPES)
    logp, _ = model.loss(np.repeat(h, len(every), axis=0), every)
    assert math.isclose(np.exp(logp).sum(), 1, rel_tol=1e-4)


def test_state_is_carried_and_lanes_do_not_mix(model):
    docs = _docs(2, 30, 55)
    alone = [recurrent.run(model, [d])[0] for d in docs]
    for window, lanes in ((1, 3), (7, 256), (500, 30)):
        assert np.allclose(recurrent.run(model, docs, window, lanes), alone, rtol=1e-4)
    h, total = np.zeros((1, 6), np.float32), 0.0
    for before, word in zip([recurrent.END, *docs[0]], docs[0]):
        h = model.step(np.array([before]), h)[0]
        total += model.loss(h, np.array([word]))[0][0]
    assert math.isclose(total, alone[0], rel_tol=1e-4)


def test_gradient_equals_differences():
    """One update from a fresh Adagrad memory shows the sign and, through it, the gradient."""
    docs = _docs(4, 5, 50)
    made = recurrent.Model(23, 5, 6)
    start = made.flat.copy().astype(np.float64)
    memory = np.full(len(start), 1e8)
    before = memory.copy()
    recurrent.run(made, docs, window=1000, lanes=5, rate=1.0, clip=1e9, memory=memory)
    grad = (start - made.flat) * 1e4
    rng = np.random.default_rng(5)
    count = sum(map(len, docs))
    for at in rng.choice(np.flatnonzero(memory > before), 12):
        sides = []
        for sign in (1, -1):
            flat = start.copy()
            flat[at] += sign * 1e-3
            sides.append(-recurrent.run(recurrent.Model(23, 5, 6, flat), docs, window=1000, lanes=5).sum() / count)
        assert abs((sides[0] - sides[1]) / 2e-3 - grad[at]) < 2e-2 * max(0.05, abs(grad[at]))


def _plain(rows):
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for t in train for w in [*(t or "").encode().lower().split(), b"\n"])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), b"\n"]
        out.append((i, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)))
    return out


def test_base_equals_plain_counts_and_head_is_no_limit(spark, docs, corpus):
    want = {r[0]: r[1:] for r in _plain([(i, t) for i, t, *_ in corpus])}
    for head in (5, 10_000):
        rows = lm.score_documents(docs, vocabulary=64, head=head, hidden=4, rounds=1).collect()
        assert len(rows) == len(corpus)
        for r in rows:
            tokens, known, n, base = want[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (tokens, known, n, zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0


def test_model_beats_counts_where_words_follow_each_other(spark):
    rng = np.random.default_rng(0)
    names = [f"w{k}" for k in range(40)]

    def text():
        at, out = int(rng.integers(40)), []
        for _ in range(60):
            out.append(names[at])
            at = (at * 7 + 3 + int(rng.random() < 0.2)) % 40
        return " ".join(out)

    frame = spark.createDataFrame([(i, text()) for i in range(600)], "doc_id long, text string")
    rows = [r for r in lm.score_documents(frame, vocabulary=64, hidden=12, rounds=6, learn_every=1).collect() if r.held_out]
    assert sum(r.score > r.base_score for r in rows) > 0.95 * len(rows)
    assert sum(r.score for r in rows) > 0.8 * sum(r.base_score for r in rows)


def test_every_window_of_a_text_is_learnt_from_by_default(spark):
    """Words after the first window follow a rule that the first window does not show."""
    names = [f"w{k}" for k in range(40)]

    def text(i):
        rng = np.random.default_rng(i)
        at, out = int(rng.integers(40)), ["start"] * 32
        for _ in range(128):
            out.append(names[at])
            at = (at * 7 + 3) % 40
        return " ".join(out)

    frame = spark.createDataFrame([(i, text(i)) for i in range(400)], "doc_id long, text string").repartition(1)
    rows = [r for r in lm.score_documents(frame, rounds=6, rate=0.3).collect() if r.held_out]
    bound = 128 * math.log10(1 / 40)  # of the later words, by their counts alone
    assert rows and np.mean([r.score for r in rows]) > 0.6 * bound


def test_size_of_the_model_by_default():
    default = {k: p.default for k, p in inspect.signature(lm.score_documents).parameters.items()}
    assert default["learn_every"] == 1 and default["vocabulary"] >= 2048 and recurrent.SHAPES >= 96


def test_odd_rows(spark, nothing):
    assert lm.score_documents(nothing).count() == 0
    frame = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "A b É")], "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS words")
    rows = lm.score_documents(frame, hidden=4, rounds=1).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 1, 1, 4] and {r.held_out for r in rows if r.doc_id is None} == {zlib.crc32(b"None") % 5 == 1}
    only = spark.createDataFrame([(i, "x y") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    assert {(r.n_known, r.train_tokens, r.score < 0) for r in lm.score_documents(only, hidden=4, rounds=1).collect()} == {(0, 0, True)}


def test_scoring_holds_a_small_group_of_texts(model):
    # Scores do not depend on the texts scored beside them, so a task holds only a small group.
    assert lm.SCORED <= 1 << 20 < lm.GROUP
    docs = _docs(3, 300, 23)
    together = recurrent.run(model, docs)
    apart = np.concatenate([recurrent.run(model, docs[i:i + 7]) for i in range(0, len(docs), 7)])
    assert np.allclose(together, apart, rtol=1e-5)
