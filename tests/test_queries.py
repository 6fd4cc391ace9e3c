"""Every registered query against its SQL, and the plans of the core operators."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from storyloom.operators import clean, merge, neighbors, reads
from storyloom.plans import adapters, catalog

TABLES = ("documents", "embeddings", "pages", "labels", "events", "benchmark", "conversations")
QUERIES = {k: f for k, f in contract.queries().items() if k in catalog.QUERIES}
ORACLES = {k: q for k, q in contract.oracle_sql().items() if k in catalog.QUERIES}
# Queries without SQL: approximate search (``ivf_recall`` has it for what that finds).
ROWS_ONLY = {"knn_ivf"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(rows):
    return sorted((tuple(_value(v) for v in row) for row in rows), key=str)


def test_only_these_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_its_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = [[row[names.index(c)] for c in columns] for row in result.fetchall()]
    assert _rows(df.select(columns).collect()) == _rows(expected)


def test_inverted_lists_run(spark, sf):
    assert not QUERIES["knn_ivf"](spark, sf).isEmpty()


def test_flagship(spark):
    assert contract.entry(spark).count() > 100


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf):
    docs = adapters.table(spark, sf, "documents").withColumnRenamed("lang", "language")
    plan = _plan(clean.language_filter(docs, ["en", "de"]).select("doc_id"))
    assert "PushedFilters: [In(lang, [de,en])]" in plan or "PushedFilters: [In(lang, [en,de])]" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan
    stored = adapters.table(spark, sf, "embeddings").selectExpr("vec_id AS article_id", "label AS event_id", "embedding")
    plan = _plan(neighbors.corpus_embedded(stored).select("id"))
    assert "IsNotNull(embedding)" in plan and "IsNotNull(label)" in plan


def test_newest_articles_are_a_bounded_sort(spark, sf):
    assert "TakeOrderedAndProject" in _plan(reads.latest_articles(adapters.articles(spark, sf), 5))


def test_neighbours_are_cut_before_the_shuffle(spark, sf):
    v = adapters.vectors(spark, sf)
    plan = _plan(neighbors.knn_exact(neighbors.as_queries(v), neighbors.corpus_embedded(v)))
    assert plan.index("row_number(), 5, Final") < plan.index("Exchange") < plan.index("row_number(), 5, Partial")


def test_merges_join_once(spark, sf):
    stored = adapters.stored_articles(spark, sf)
    plan = _plan(merge.upsert_articles(stored, stored))
    assert plan.count("FullOuter") == 1


def test_raw_stage_writers_follow_the_shuffle_partitions(spark, sf):
    """A fixed count of writers would give each a growing share of a growing input."""
    import glob

    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        root = catalog._raw_folder(spark, sf)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(glob.glob(f"{root.removeprefix('file:')}/raw/**/part-*", recursive=True)) == 8
