import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storyloom.functions import text
from storyloom.operators import clean

from . import brute

SCHEMA = "article_id string, title string, body string, pos bigint"


def _articles(spark, rows):
    return spark.createDataFrame([(r["article_id"], "t", r["body"], r["pos"]) for r in rows], SCHEMA)


def _normalized(spark, values):
    df = spark.createDataFrame([(i, "", v) for i, v in enumerate(values)], "pos bigint, title string, body string")
    return [r.body for r in clean.normalize_text(df).orderBy("pos").collect()]


def test_white_space_collapses(spark):
    assert _normalized(spark, ["\t north\r\n  wind\n\n\nrose "]) == ["north wind rose"]


def test_normalisation_edge_cases(spark):
    values = [
        "état", "ශ්‍රී ලංකාව", "a⁡b﻿c", "&amp;lt;", "&amp;nbsp;x",
        "a&nbsp;&nbsp;b", "a\u0085b c\u001cd e　f", "ො ෝ", "Å 가", "", "   ",
        "q̣̇ q̣̇", "&quot;&#39;&apos;&gt;", "  ",
    ]
    assert _normalized(spark, values) == [brute.normalize(v) for v in values]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", min_codepoint=9, max_codepoint=0x3100), max_size=40),
                min_size=100, max_size=200))
def test_normalisation_matches_plain_model(spark, values):
    # Code points that the JVM's Unicode tables do not know yet are left out.
    assert _normalized(spark, values) == [brute.normalize(v) for v in values]


def test_cleaning_matches_the_sequential_rule(spark):
    rng = random.Random(3)
    words = ["trade", "policy", "Washington", "sports", "event!", "tonight", "---", "ලංකා"]
    rows = [{
        "article_id": f"a{rng.randrange(60)}",
        "body": " ".join(rng.choice(words) for _ in range(rng.choice([3, 8, 8, 9]))) if i % 5 else "!" * 60 + str(i) * (i % 2),
        "pos": i,
    } for i in range(300)]
    found = clean.clean_articles(_articles(spark, rows).repartition(5)).select("pos").collect()
    assert sorted(r.pos for r in found) == brute.clean(rows)


def test_prefix_ignores_case_punctuation_and_the_rest(spark):
    base = "Nine barges of gravel passed the lower lock " * 10
    rows = [{"article_id": "a", "body": base, "pos": 0}, {"article_id": "b", "body": base.upper().replace(" ", ", "), "pos": 1},
            {"article_id": "c", "body": base[:300] + "different", "pos": 2}]
    assert [r.article_id for r in clean.dedup_prefix(_articles(spark, rows)).collect() if r.article_id != "b"] == ["a"]


def test_near_duplicate_ids(spark):
    same = "Nine barges of gravel passed the lower lock before the keeper had rung his bell."
    rows = [{"article_id": "a1", "body": same, "pos": 0}, {"article_id": "a2", "body": same, "pos": 1},
            {"article_id": "a3", "body": "Snow closed the pass, and the mail went round by the valley.", "pos": 2}]
    assert {r.article_id for r in clean.near_duplicate_ids(_articles(spark, rows)).collect()} == {"a2"}


def test_first_row_is_picked_before_the_shuffle(spark):
    rows = _articles(spark, [{"article_id": "a", "body": "b", "pos": 0}])
    plan = clean.dedup_exact(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_text_is_computed_once(spark):
    rows = _articles(spark, [{"article_id": "a", "body": "b", "pos": 0}])
    plan = clean.clean_articles(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(text.SPACE) == 2  # one title, one body
    assert plan.count("ArrowEvalPython") == 1


def test_report_counts_invisible_characters(spark):
    rows = [{"article_id": "a", "body": "x​" * 60, "pos": 0}, {"article_id": "b", "body": "short‍", "pos": 1},
            {"article_id": "a", "body": "y" * 60, "pos": 2}]
    raw = _articles(spark, rows)
    assert clean.cleaning_report(raw).first().asDict() == {
        "rows_in": 3, "rows_short": 1, "rows_repeated": 1, "rows_out": 1, "invisible_chars": 61, "invisible_rows": 2}


def test_word_shingles(spark):
    df = spark.createDataFrame([("a b c d",), ("one two",), ("a b c a b c",), ("--",)], "t string")
    sizes = [r.n for r in df.select(F.size(text.word_shingles(F.col("t"))).alias("n")).collect()]
    assert sizes == [2, 1, 3, 0]
