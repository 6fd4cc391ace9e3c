"""Toxicity: what is learnt, held-out accuracy, and odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storyloom.llm import toxicity

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def labelled(prose):
    """Prose, a fifth of it with a few of four insults between the words."""
    rng = random.Random(3)
    rows = []
    for i in range(500):
        words = prose(1000 + i, rng.randint(40, 160)).split()
        toxic = int(rng.random() < 0.2)
        for _ in range(rng.randint(3, 6) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "Numbskull", "dimwit!", "simpleton"]))
        rows.append((i, " ".join(words), toxic))
    return rows


def _tables(spark, rows):
    docs = spark.createDataFrame([(i, t, "zz", "s", 5) for i, t, _ in rows], SCHEMA + ", lang string, score string, n_windows int")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows if y is not None], "doc_id long, toxic int, text int")
    return docs.repartition(3), labels


def test_held_out_texts_are_told_apart(spark, labelled):
    docs, labels = _tables(spark, labelled)
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert len(got) == len(labelled) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(y, got[i].predicted) for i, _, y in labelled if got[i].held_out]
    assert np.mean([p for y, p in held if y]) > 0.85 and np.mean([p for y, p in held if not y]) < 0.05


def test_labels_of_held_out_rows_teach_nothing(spark, labelled):
    docs, labels = _tables(spark, labelled)
    want = {r.doc_id: r.score for r in toxicity.classify(docs, labels).collect()}
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in toxicity.classify(docs.repartition(7), turned).collect()} == want


def test_the_dictionary_holds_what_stands_out(labelled):
    model = toxicity.fit([t for _, t, _ in labelled], [y for *_, y in labelled])
    assert all(w in model.toxic for w in (b"blockhead", b"numbskull", b"dimwit", b"simpleton"))
    scorer = toxicity.Scorer(model.ordinary, model.toxic)
    data, offsets = toxicity._flat(pa.array(["ka lo mi blockhead ne tu", "ka lo mi neturasika ne tu"]))
    assert scorer.features(data, offsets)[:, 1].tolist() == [1, 0]


def test_windows_cover_every_word_once(prose):
    texts = ["", "a", "  ", prose(1, 300), "x" * 1000 + " y", "ab " * 200, "é ü\n\tß"]
    data, offsets = toxicity._flat(pa.array(texts))
    start, end, owner = toxicity.windows(data, offsets)
    assert (end - start <= toxicity.MOST_BYTES).all() and (end > start).all()
    raw = data.tobytes()
    for i, text in enumerate(texts):
        mine = [(a, b) for a, b, o in zip(start, end, owner) if o == i]
        seen = np.zeros(len(raw) + 1, int)
        for a, b in mine:
            assert offsets[i] <= a < b <= offsets[i + 1]
            seen[a:b] += 1
        inside = [k for k in range(offsets[i], offsets[i + 1]) if raw[k:k + 1] != b" "]
        assert all(seen[k] == 1 for k in inside)
    # The same words are cut alike wherever they stand.
    a, b = (toxicity._flat(pa.array([t])) for t in (prose(5, 60), "one more two more " + prose(5, 60)))
    cut = [[d[0].tobytes()[s:e] for s, e, _ in zip(*toxicity.windows(*d))] for d in (a, b)]
    assert cut[0][-3:] == cut[1][-3:]


def test_odd_rows_and_tables(spark, labelled, nothing):
    docs, labels = _tables(spark, labelled + [(600, None, 1), (601, "", None), (None, "dimwit! " * 50, None), (602, "ka " * 100_000, None), (5, "again", 0)])
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(labelled) + 5 and not any(r.score is None for r in got)
    by = {r.doc_id: r for r in got}
    assert by[600].n_windows == by[601].n_windows == 0 and by[600].score == by[601].score and not by[None].held_out
    assert by[602].n_windows > 5000 and by[None].predicted == 1 and by[602].predicted == 0
    assert toxicity.classify(nothing, labels).count() == 0


@pytest.mark.parametrize("toxic", [0, 1])
def test_one_class_or_none(spark, labelled, toxic):
    docs, labels = _tables(spark, labelled[:40])
    got = toxicity.classify(docs, labels.withColumn("toxic", F.lit(toxic))).collect()
    assert {r.predicted for r in got} == {toxic} and len({r.score for r in got}) == 1
    assert {r.score for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0.1}


def test_score_of_a_row_does_not_depend_on_its_batch(spark, labelled):
    docs, labels = _tables(spark, labelled)
    model = toxicity.train(docs.filter(~toxicity.held_out()), labels.filter(~toxicity.held_out()))
    want = {r.doc_id: r.score for r in toxicity.score(docs.coalesce(1), model).collect()}
    assert {r.doc_id: r.score for r in toxicity.score(docs.repartition(7), model).collect()} == want
