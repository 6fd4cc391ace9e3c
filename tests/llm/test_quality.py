"""Host-level quality rules against plain measures."""

from storyloom.llm import quality
from tests.llm import plain


def test_measures_equal_plain_ones(docs, corpus):
    rows = {r.doc_id: r for r in quality.measure(docs).collect()}
    for doc_id, text, *_ in corpus:
        r = rows[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain.measures(text), text


def test_strict_hosts_reject_only_documents_that_fail_their_rule(spark, prose):
    rows = [(i, prose(i, 100) + " #" * 30 * (i % 2 if i < 40 else i == 41), "bad" if i < 40 else "good") for i in range(200)]
    out = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [i for i in out if not out[i].kept] == [i for i in range(40) if i % 2]
    assert out[0].rate_symbols > 0.3 > out[41].rate_symbols > 0


def test_rates_are_shrunk_towards_the_common_rate(spark):
    rows = [("a", k < 1) for k in range(1)] + [("b", k < 90) for k in range(100)] + [("c", k < 10) for k in range(100)]
    rates = quality.host_rates(spark.createDataFrame(rows, "host string, bad boolean"), {"bad": "bad"}).collect()
    rate = {r.host: r.rate_bad for r in rates}
    assert 0.5 < rate["a"] < 0.95 and 0.85 < rate["b"] < 0.9 and 0.1 < rate["c"] < 0.12


def test_odd_rows(docs, nothing, corpus):
    assert quality.judge(nothing).count() == 0
    extra = docs.selectExpr("*", "1 AS host", "2 AS h", "3 AS kept", "4 AS n_words")
    twice = quality.judge(extra.union(extra))
    assert twice.count() == 2 * len(corpus)
    none = quality.judge(docs.selectExpr("CAST(NULL AS LONG) doc_id", "CAST(NULL AS STRING) text", "CAST(NULL AS STRING) source"))
    assert {(r.n_words, r.kept) for r in none.collect()} == {(0, False)}


def test_no_python_in_the_plan(docs):
    plan = quality.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
