"""Removal of repeated byte strings against counts of every window."""

import random

import pytest
from pyspark.sql import functions as F

from storyloom.llm import substrings
from tests.llm import plain


def _check(frame, length, span):
    rows = frame.select("doc_id", "text").collect()
    want = sorted((r.doc_id or -1, kept, runs) for r, (kept, runs) in zip(rows, plain.cut_repeats([r.text for r in rows], length)))
    got = substrings.repeated_spans(frame, length, span).collect()
    assert sorted((r.doc_id or -1, bytes(r.kept), [tuple(s) for s in r.spans]) for r in got) == want
    assert sum(r.n_bytes for r in got) == sum(len((r.text or "").encode()) for r in rows)
    return want


@pytest.mark.parametrize("length,span", [(400, 160), (100, 40), (30, 15), (20, 20), (8, 2)])
def test_equals_counting_every_window(docs, length, span):
    assert any(runs for _, _, runs in _check(docs, length, span))


@pytest.mark.parametrize("seed", range(3))
def test_random_pieces(spark, seed):
    """Texts stuck together from few pieces, so that repeats begin and end everywhere."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choices("abcé", k=rng.randint(1, 60))) for _ in range(14)]
    rows = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 8)))) for i in range(60)]
    _check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 25, 11)


def test_chunks_do_not_change_the_result(docs, monkeypatch):
    whole = sorted(map(str, substrings.repeated_spans(docs, 100, 40).collect()))
    cut = substrings.chunks
    monkeypatch.setattr(substrings, "chunks", lambda batches, **k: cut(batches, size=200))
    assert sorted(map(str, substrings.repeated_spans(docs, 100, 40).collect())) == whole


def test_large_buckets_are_taken_apart(docs, monkeypatch):
    whole = sorted(map(str, substrings.repeated_spans(docs, 100, 40).collect()))
    monkeypatch.setattr(substrings, "MOST", 2)
    assert sorted(map(str, substrings.repeated_spans(docs, 100, 40).collect())) == whole


def test_odd_rows(spark, docs, nothing):
    assert substrings.repeated_spans(nothing).count() == 0
    text = "x" + "0123456789" * 60
    rows = [(None, text), (1, "plain"), (2, text), (2, text), (2, "other"), (3, None), (4, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("key", "h", "slots", "kept")})
    _check(frame, 400, 160)
