"""The stored index against exact search."""

import numpy as np
import pytest

from storyloom.operators import neighbors
from storyloom.session import scratch_path
from storyloom.sources import inverted


def _frame(spark, x, start=0):
    rows = [(f"v{start + i:04d}", f"e{(start + i) % 7}", [float(a) for a in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id string, label string, embedding array<double>")


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8)) * 3
    return centres[rng.integers(0, 12, 600)] + rng.normal(size=(600, 8))


def _queries(rows):
    return rows.selectExpr("id AS query_id", "embedding")


def _pairs(found):
    return {(r.query_id, r.neighbour_id, r.label, round(r.distance, 9), r.rank) for r in found.collect()}


def test_all_lists_are_exact_and_the_measured_number_finds_nine_tenths(spark, clustered):
    rows = _frame(spark, clustered)
    root = scratch_path(spark, "index")
    probes = inverted.build(rows, root, lists=12)
    asked = _queries(rows.where("id < 'v0100'"))
    exact = neighbors.knn_exact(asked, rows)
    assert _pairs(inverted.search(asked, root, probes=12, block_rows=40)) == _pairs(exact)
    assert 1 <= probes < 12
    assert neighbors.recall(inverted.search(asked, root), exact).first().recall >= 0.9
    few = neighbors.recall(inverted.search(asked, root, probes=1), exact).first().recall
    assert 0.3 < few < 1.0


def test_inserts_are_found_without_a_new_fit(spark, clustered):
    first, more = _frame(spark, clustered[:400]), _frame(spark, clustered[400:], 400)
    root = scratch_path(spark, "index")
    inverted.build(first, root, lists=10)
    before = inverted._centres(spark, root)
    # Rows that are there already and rows that repeat count once.
    assert inverted.insert(spark, root, more.union(first.limit(50)).union(more.limit(20))) == 200
    assert inverted.insert(spark, root, more) == 0
    assert (inverted._centres(spark, root) == before).all()
    both = _frame(spark, clustered)
    asked = _queries(both.where("id >= 'v0380' AND id < 'v0440'"))
    assert _pairs(inverted.search(asked, root, probes=10)) == _pairs(neighbors.knn_exact(asked, both))
    assert _pairs(inverted.search(asked, root, probes=10, skip_self=True, max_distance=2.0)) == _pairs(
        neighbors.knn_exact(asked, both, max_distance=2.0, skip_self=True))


def test_only_visited_lists_are_read(spark, clustered):
    root = scratch_path(spark, "index")
    rows = _frame(spark, clustered)
    inverted.build(rows, root, lists=12)
    found = inverted.search(_queries(rows.where("id = 'v0007'")), root, probes=1)
    files = {f.split("cell=")[1].split("/")[0] for f in found.inputFiles() if "cell=" in f}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan, plan
    assert len(files) <= 12 and found.count() == 5


def test_a_failed_insert_is_not_seen(spark, clustered, monkeypatch):
    root = scratch_path(spark, "index")
    inverted.build(_frame(spark, clustered[:300]), root, lists=8)
    more = _frame(spark, clustered[300:], 300)
    monkeypatch.setattr(inverted, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        inverted.insert(spark, root, more)
    monkeypatch.undo()
    asked = _queries(more.limit(5))
    assert not any(n >= "v0300" for _, n, *_ in _pairs(inverted.search(asked, root, probes=8)))
    assert inverted.insert(spark, root, more) == 300
    assert any(n >= "v0300" for _, n, *_ in _pairs(inverted.search(asked, root, probes=8)))


def test_odd_tables(spark, clustered):
    rows = _frame(spark, clustered)
    root = scratch_path(spark, "index")
    assert inverted.build(rows.limit(0), root) == 0 and inverted.search(_queries(rows), root).isEmpty()
    root = scratch_path(spark, "index")
    same = _frame(spark, np.ones((20, 4)))
    inverted.build(same, root)
    found = inverted.search(_queries(same.limit(2)), root).collect()
    assert [r.distance for r in found] == [0.0] * 10
    assert inverted.search(_queries(same.limit(0)), root).isEmpty()


def test_many_queries_are_not_copied_into_their_lists(spark, clustered):
    """Queries of several blocks meet the stored blocks, and find what queries of one block do: rows of visited lists only."""
    rows = _frame(spark, clustered)
    root = scratch_path(spark, "index")
    inverted.build(rows, root, lists=12)
    asked = _queries(rows.where("id < 'v0200'"))
    many = inverted.search(asked, root, probes=2, block_rows=40)
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" in plan and "CoGroup" not in plan
    assert _pairs(many) == _pairs(inverted.search(asked, root, probes=2))
