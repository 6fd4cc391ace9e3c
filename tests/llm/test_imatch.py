"""I-Match fingerprints and the order of documents."""

import pytest

from storyloom.llm import imatch
from tests.llm import plain


def test_next_document_and_edits(docs, corpus):
    texts = {i: t or "" for i, t, *_ in corpus}
    ids = sorted(texts, reverse=True)
    after = {i: texts[ids[(k + 1) % len(ids)]] for k, i in enumerate(ids)}
    rows = imatch.compare_edited(docs).collect()
    assert len(rows) == len(corpus)
    prints = {}
    for r in rows:
        t = texts[r.doc_id]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[r.doc_id][:half]
        assert (r.n_chars, r.edited_sha256) == (len(t), plain.sha(edited))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        if edited == t:
            assert r.near_edited == 1 and r.edited_fingerprint == r.fingerprint


@pytest.mark.parametrize("rows,cells", [(1, 3), (4, 2), (1000, 200)])
def test_order_does_not_depend_on_cells(spark, rows, cells):
    ids = [5, 6, 7, 8, 9, 10, 500, 10 ** 12, -3, 11]
    frame = spark.createDataFrame([(i, f"t{i}") for i in ids] + [(None, None)], "doc_id long, text string")
    got = {r.text: r.next for r in imatch.with_next(frame, rows, cells).collect()}
    order = [f"t{i}" for i in sorted(ids, reverse=True)] + [""]
    assert got == {a: b for a, b in zip(order, order[1:] + order[:1])}


def test_likeness_follows_the_change(spark, prose):
    base = [prose(i, 150) for i in range(40)]
    near = [t.rsplit(" ", 8)[0] + " a b c d e f g h" for t in base]
    frame = spark.createDataFrame([(2 * i, t) for i, t in enumerate(base)] + [(2 * i + 1, t) for i, t in enumerate(near)], "doc_id long, text string")
    rows = {r.doc_id: r for r in imatch.compare_edited(frame, high=0.2).collect()}
    like = [rows[2 * i + 1].near_next for i in range(40)]
    other = [rows[2 * i].near_next for i in range(40)]
    assert sum(like) / 40 > 0.4 and sum(other) / 40 < 0.1


def test_odd_rows(spark, docs, nothing):
    assert imatch.compare_edited(nothing).count() == 0
    rows = [(1, None), (1, ""), (1, "a b"), (1, "a b")]
    got = imatch.compare_edited(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS next", "1 AS cell")).collect()
    assert len(got) == 4 and {r.n_chars for r in got} == {0, 3}
    assert imatch.compare_edited(spark.createDataFrame([(3, "only one")], "doc_id long, text string")).first().near_next == 1
    plan = imatch.compare_edited(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
