"""The pipeline against its definition, and the registered queries."""

from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from storyloom.llm import queries
from tests.llm import plain
from tests.llm.conftest import SCHEMA
from tests.llm.test_packing import _check


def _strict(measured, limit=0.3):
    """Which rows fail a rule that their host fails too often: the mean of the host's beta posterior, with a
    prior of the moments of all hosts."""
    rules = {"symbols": lambda n, c, s, d, r, k: 100 * s > 10 * n, "lines": lambda n, c, s, d, r, k: 100 * d > 30 * k,
             "repeats": lambda n, c, s, d, r, k: 100 * r > 30 * n, "words": lambda n, c, s, d, r, k: c < 3 * n or c > 12 * n}
    out = set()
    for fails in rules.values():
        bad = {row: fails(*m) for row, (_, m) in measured.items()}
        hosts = defaultdict(list)
        for row, (host, _) in measured.items():
            hosts[host].append(bad[row])
        total = len(measured)
        mean = sum(bad.values()) / total
        var = max(0, sum(len(h) * (sum(h) / len(h)) ** 2 for h in hosts.values()) / total - mean ** 2)
        weight = 1e6 if var <= 1e-12 else min(1e6, max(1, mean * (1 - mean) / var - 1))
        rates = {h: (sum(x) + weight * mean) / (len(x) + weight) for h, x in hosts.items()}
        out |= {row for row, (host, _) in measured.items() if bad[row] and rates[host] > limit}
    return out


def _plain(rows):
    """Quality rules, one of each class, repeated passages cut; rows are told apart by their place."""
    measured = {}
    for at, (_, text, _, host, *_) in enumerate(rows):
        n, chars, symbols, lines, again = plain.measures(text)
        measured[at] = (host, (n, chars, symbols, lines, again, len([x for x in (text or "").split("\n") if plain.words(x)])))
    strict = _strict(measured)
    good = {at: rows[at][1] for at, (_, (n, _, _, _, again, _)) in measured.items() if n >= 50 and 100 * again <= 50 * n and at not in strict}
    alone = Counter(rows[at][0] for at in good)
    # Of a class the smallest id stays that is its row's own.
    number = {at: (rows[at][0] is None or alone[rows[at][0]] > 1, rows[at][0] or 0, at) for at in good}
    order = sorted(good, key=number.get)
    kind = plain.classes({k: good[at] for k, at in enumerate(order)})
    keep = [order[k] for k in range(len(order)) if kind[k] == k]
    cut = dict(zip(keep, (k for k, _ in plain.cut_repeats([good[at] for at in keep], corpus_pipeline.PASSAGE_BYTES))))
    return {rows[at][0]: b.decode(errors="ignore") for at, b in cut.items() if b}


def test_stages_keep_the_columns(spark, docs, corpus, nothing):
    frame = docs.withColumn("extra", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, "")
        assert frame.columns == corpus_pipeline.COLUMNS, name
        assert stage(spark, nothing, "").count() == 0
    texts = {r.doc_id: r.text for r in frame.collect()}
    assert texts == _plain(corpus)
    pieces = corpus_pipeline.STAGES[-1][1](spark, frame, "").collect()
    _check(pieces, texts, 1024)


def test_rows_without_an_id_of_their_own_stay(spark, prose):
    rows = [(None, prose(1, 90), "en", "s", 0), (None, prose(2, 90), "en", "s", 0), (5, prose(3, 90), "en", "s", 0), (5, prose(4, 90), "fr", "s", 0),
            (5, prose(3, 90), "en", "s", 0), (7, prose(4, 90) + " end", "en", "s", 0), (None, prose(6, 90), None, None, None), (9, None, "en", "s", 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.quality_stage(spark, frame, "")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(rows[:-1], key=str)
    left = sorted((tuple(r) for r in corpus_pipeline.near_duplicate_stage(spark, kept, "").collect()), key=str)
    # One of the equal rows, and the row with an id of its own instead of its near copy.
    assert left == sorted([rows[0], rows[1], rows[2], rows[5], rows[6]], key=str)


def test_passages_of_over_fifty_words_go_and_short_phrases_stay(spark, prose):
    """By words and by bytes, in documents that share a few short phrases as well."""
    rows, planted = [], {}
    for k, n in enumerate((51, 60, 80)):
        passage = " ".join((w + "aeiou")[:6] for w in prose(500 + k, n).split())
        for copy in range(3):
            i = 10 * k + copy
            planted[i] = passage
            rows.append((i, prose(600 + i, 70) + " " + passage + " " + prose(700 + i, 70), "en", "s", 0))
    phrase = " ".join(prose(900, 30).split())[:corpus_pipeline.PASSAGE_BYTES - 10]
    rows += [(100 + i, f"é{prose(800 + i, 60)}\ufffd {phrase} {prose(850 + i, 60)}", "en", "s", 0) for i in range(4)]
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passage_stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    for i, text, *_ in rows:
        if i in planted:
            assert planted[i] not in got[i] and len(got[i]) <= len(text) - len(planted[i])
            # What two copies have in common beside the passage goes with it: the spaces, by chance some letters.
            assert got[i].startswith(prose(600 + i, 70)[:-6]) and got[i].endswith(prose(700 + i, 70)[6:])
        else:
            assert got[i] == text


def test_passage_stage_keeps_repeated_ids_and_nulls_apart(spark, prose):
    passage = prose(50, 120)
    rows = [(1, prose(1, 80) + " " + passage, "en", "s", 5), (1, prose(2, 80) + " " + passage, "fr", "s", 6),
            (None, prose(3, 80), "en", None, 7), (2, None, "en", "s", 0), (3, "", None, "s", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.repeated_passage_stage(spark, frame.selectExpr("*", "1 AS kept", "2 AS gone", "3 AS start"), "").collect()
    assert len(got) == 5 and {(r.doc_id, r.lang) for r in got} == {(1, "en"), (1, "fr"), (None, "en"), (2, "en"), (3, None)}
    assert {(r.text, r.n_chars) for r in got if r.doc_id in (None, 2, 3)} == {(rows[2][1], 7), (None, 0), ("", 0)}
    assert all(passage not in r.text and r.n_chars == len(r.text) for r in got if r.doc_id == 1)


def test_run_equals_stage_by_stage(spark, tmp_path, prose):
    passage = prose(50, 120)
    rows = [(i, prose(i, 120), "en", "s", 0) for i in range(20)]
    rows += [(20 + i, prose(i, 120) + " end", "en", "s", 0) for i in range(5)]
    rows += [(30 + i, prose(40 + i, 60) + " " + passage + " " + prose(60 + i, 60), "en", "s", 0) for i in range(4)]
    rows += [(40, "too short", "en", "s", 0), (41, "spam words here " * 60, "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    want = _plain(rows)
    assert set(want) == {*range(20), *range(30, 34)}
    assert all(passage not in want[i] for i in range(30, 34))
    _check(corpus_pipeline.run(spark, str(tmp_path)).collect(), want, 1024)


def test_every_operator_is_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_queries_equal_their_sql(spark, sf, name):
    got = queries.QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    rows = sorted(map(tuple, got.select(columns).collect()), key=str)
    assert rows
    if name in queries.ORACLES:
        con = duckdb.connect()
        for t in ("documents", "conversations", "pages", "labels", "events"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        assert rows == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall(), key=str)
