"""ProbMinHash near duplicates against all pairs."""

import numpy as np
import pytest

from storyloom.llm import graph, neardup
from tests.llm import plain


def test_classes_equal_all_pairs(docs, corpus):
    texts = {i: t for i, t, *_ in corpus}
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert {i: r.class_id for i, r in got.items()} == plain.classes(texts)
    assert all(r.keeper == (r.class_id == i) for i, r in got.items())
    assert got[1].n_shingles == len(plain.shingle_set(texts[1]))


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    a, w = rng.integers(0, 2 ** 63, 300).astype(np.uint64), rng.uniform(0.5, 4, 300)
    v = w * rng.uniform(0.3, 3, 300)
    sig = [neardup.prob_minhash(np.zeros(300, np.int64), a, x, 1, 4096)[0] for x in (w, v)]
    p, q = w / w.sum(), v / v.sum()
    exact = sum(1 / np.maximum(p / p[i], q / q[i]).sum() for i in range(300))
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.03
    assert np.array_equal(sig[0], neardup.prob_minhash(np.zeros(300, np.int64), a, 7 * w, 1, 4096)[0])


def test_links_between_members_that_are_unlike_the_leader(spark, prose):
    """A chain of texts, each like the next only, and a hub whose copies are not alike."""
    w = prose(1, 120).split()
    chain = []
    for k in range(12):
        w = w[:]
        w[(k * 9) % 100] = f"new{k}"
        chain.append(" ".join(w))
    hub = prose(2, 200).split()
    spokes = []
    for k in range(30):
        x = hub[:]
        for j in range(2):
            x[(k * 6 + 3 * j + 5) % 200] = f"s{k}-{j}"
        spokes.append(" ".join(x))
    texts = dict(enumerate([*chain, *spokes, " ".join(hub)]))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame).collect()}
    assert got == plain.classes(texts)


def test_near_copies_with_a_much_repeated_line(spark, prose):
    """Plain similarities just above 0.8 where the weighted ones are far lower, and pairs without repeats."""
    texts = {}
    for k in range(60):
        body, line = prose(1000 + k, 104), prose(2000 + k, 20)
        texts[2 * k], texts[2 * k + 1] = body, body + ("\n" + line) * (200 if k % 6 else 1)
    want = plain.classes({i: " ".join(t.split()) for i, t in texts.items()})
    assert sum(want[i] != i for i in texts) == 60
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(frame).collect()} == want


def test_families_compared_in_blocks(spark):
    rng = np.random.default_rng(1)
    base = [rng.choice(10 ** 6, 40, replace=False) for _ in range(6)]
    sets = [np.append(base[i % 6][:36 + i % 5], 10 ** 7 + i) for i in range(60)]
    sig = [np.full(8, i % 6, np.uint32).tobytes() for i in range(60)]
    rows = [(5, i, i, sig[i], len(s) - 1, s.tolist(), 60) for i, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "family long, doc_id long, component long, sig binary, common int, shingles array<long>, n long")
    def like(a, b):
        both = len(set(sets[a].tolist()) & set(sets[b].tolist()))
        return both >= 0.8 * (len(sets[a]) + len(sets[b]) - both)

    want = {(a, b) for a in range(60) for b in range(a + 1, 60) if like(a, b)}
    for block in (7, 100):
        assert {tuple(sorted((r.a, r.b))) for r in neardup._across(frame, 0.8, 0.6, block).collect()} == want


def test_components(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 150)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 150)}, 200: 200, 201: 200}


def test_odd_rows(spark, docs, nothing):
    assert neardup.near_duplicates(nothing).count() == 0
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "other text here"), (2, "other text here"), (3, None), (4, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS b", "2 AS sig", "3 AS bucket")
    got = {r.doc_id: (r.class_id, r.keeper) for r in neardup.near_duplicates(frame).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True), 4: (4, True)}


@pytest.mark.parametrize("block", [2, 64])
def test_verification_blocks(spark, docs, corpus, block):
    texts = {i: t for i, t, *_ in corpus}
    pairs = [(a, b) for a in texts for b in list(texts)[:3] if a != b]
    got = neardup.verify(docs, spark.createDataFrame(pairs, "a long, b long"), 5, 0.8, block).collect()
    sets = {i: plain.shingle_set(t) for i, t in texts.items()}
    want = {(a, b) for a, b in pairs if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in got} == want
