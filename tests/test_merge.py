import random

from pyspark.sql import functions as F

from storyloom.operators import corpus, digest, merge

ARTICLE = ("article_id string, source_name string, url string, title string, body string, bias_label string, "
           "bias_confidence double, bias_scores string, embedding array<double>, event_id string, created_at string")


def test_article_merge_matches_row_by_row(spark):
    rng = random.Random(7)

    def value(options):
        return rng.choice([None, *options])

    def rows(ids, tag):
        return [(i, "s", f"u{i}", f"{tag} {i}", "b", value(["left", "right"]), value([0.1, 0.9]), value(['{"left":1.0}']),
                 value([[1.0], [2.0]]), value(["e1", "e2"]), value(["t0"])) for i in ids]

    names = [c.split()[0] for c in ARTICLE.split(", ")]
    old = rows([f"a{i:02d}" for i in range(20)], "old")
    new = rows([f"a{i:02d}" for i in range(10, 30)], "new")
    expected = {r[0]: dict(zip(names, r)) for r in old}
    for r in new:
        row = dict(zip(names, r))
        if row["article_id"] in expected:
            for c in merge.FILLED_COLUMNS:
                if row[c] is not None:
                    expected[row["article_id"]][c] = row[c]
        else:
            expected[row["article_id"]] = row
    found = merge.upsert_articles(spark.createDataFrame(old, ARTICLE), spark.createDataFrame(new, ARTICLE)).collect()
    assert {r.article_id: r.asDict() for r in found} == expected


def test_event_merge_adds_and_keeps_the_larger(spark):
    schema = "event_id string, article_count bigint, source_count bigint, topic string"
    old = spark.createDataFrame([("a", 3, 2, "world"), ("b", 1, 1, None)], schema)
    new = spark.createDataFrame([("a", 2, 1), ("c", 4, 3)], "event_id string, article_count bigint, source_count bigint")
    found = {r.event_id: (r.article_count, r.source_count, r.topic) for r in merge.upsert_events(old, new).collect()}
    assert found == {"a": (5, 2, "world"), "b": (1, 1, None), "c": (4, 3, None)}


def test_recomputed_counts_are_repeatable(spark):
    events = spark.createDataFrame([("a", 9, 9, "world")], "event_id string, article_count bigint, source_count bigint, topic string")
    articles = spark.createDataFrame([("a", "s1"), ("a", "s2"), ("b", "s1"), (None, "s3")], "event_id string, source_name string")
    once = merge.recompute_events(events, articles)
    twice = merge.recompute_events(once, articles)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.event_id: (r.article_count, r.source_count, r.topic) for r in once.collect()} == {
        "a": (2, 2, "world"), "b": (1, 1, None)}


def test_join_defaults_and_misses(spark):
    cleaned = spark.createDataFrame(
        [("a", "s", "u", "t", "b", None, None, None), ("b", "s", "v", "t", "b", "en", "2024-01-01T00:00:00", "x")],
        "article_id string, source string, url string, title string, body string, language string, published_at string, scraped_at string")
    vectors = spark.createDataFrame([("a", []), ("b", [1.0])], "article_id string, embedding array<double>")
    bias = spark.createDataFrame([("b", "left", 0.9, {"left": 0.9})],
                                 "article_id string, bias_label string, bias_confidence double, bias_scores map<string,double>")
    clusters = spark.createDataFrame([("b", "e")], "article_id string, event_id string")
    a, b = merge.join_outputs(cleaned, vectors, bias, clusters, "now").orderBy("article_id").collect()
    assert (a.language, a.scraped_at, a.embedding, a.bias_scores, a.event_id) == ("si", "now", None, None, None)
    assert (b.language, b.scraped_at, b.embedding, b.bias_scores, b.event_id) == ("en", "x", [1.0], '{"left":0.9}', "e")


def test_event_stats_count_unknown_articles(spark):
    clusters = spark.createDataFrame([("e", "a"), ("e", "b"), ("e", "x"), ("f", "y")], "event_id string, article_id string")
    articles = spark.createDataFrame([("a", "s1"), ("b", "s1")], "article_id string, source string")
    found = {r.event_id: (r.article_count, r.source_count) for r in merge.event_stats(clusters, articles).collect()}
    assert found == {"e": (3, 1), "f": (1, 0)}


def test_last_row_wins_and_vectors_are_checked(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 3, 2)], "article_id string, v int, pos bigint")
    assert {r.article_id: r.v for r in merge.last_wins(rows, "article_id").collect()} == {"a": 2, "b": 3}
    schema = "article_id string, embedding array<double>"
    stored = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], schema)
    merged = merge.upsert_vectors(stored, spark.createDataFrame([("a", [0.5, 0.5])], schema), 2)
    assert {r.article_id: r.embedding for r in merged.collect()} == {"a": [0.5, 0.5], "b": [0.0, 1.0]}
    try:
        merge.upsert_vectors(stored, spark.createDataFrame([("a", [0.5])], schema), 2).collect()
    except Exception as error:
        assert "expected 2 dimensions" in str(error)
    else:
        raise AssertionError("a vector of another dimension was accepted")


def test_corpus_noise(spark):
    rows = [("a", None, "u1", "2024-01-01", -1), ("b", "p", "u2", "never", -1), ("c", "p", "u3", "2024-01-02", 4),
            ("d", None, "u4", "never", 4)]
    df = spark.createDataFrame(rows, "article_id string, publisher string, url string, published_at string, cluster_id int")
    placed = corpus.corpus_events(df.withColumn("published_at", F.col("published_at").try_cast("timestamp")))
    events = {r.event_id: r for r in corpus.corpus_event_stats(placed).collect()}
    ids = {r.article_id: r.event_id for r in placed.collect()}
    assert len(events) == 3 and ids["c"] == ids["d"]
    assert [(events[ids[i]].article_count, events[ids[i]].source_count) for i in "abc"] == [(1, 1), (1, 1), (2, 1)]
    assert events[ids["b"]].window_start is None
    assert str(events[ids["c"]].window_end) == "2024-01-02 00:00:00"


def test_digest_takes_ten_and_counts_all(spark):
    rows = [("e", f"a{i:02d}", i, "s", f"t{i}", "x" * 2000) for i in range(12)]
    members = spark.createDataFrame(rows, "event_id string, article_id string, pos bigint, source string, title string, body string")
    row = digest.event_digest(members.repartition(3)).first()
    assert row.article_count == 12
    assert row.articles_block == "\n\n".join(f"[Source: s]\nt{i}\n" + "x" * 1500 for i in range(10))


def test_topics(spark):
    df = spark.createDataFrame([("a", " Politics "), ("b", "weather"), ("c", None)], "event_id string, topic string")
    assert {r.event_id: r.topic for r in digest.topic_validate(df).collect()} == {"a": "politics", "b": "other", "c": "other"}
    summaries = spark.createDataFrame([("a",), ("z",)], "event_id string")
    assert {r.event_id: r.topic for r in digest.event_topics(summaries, df).collect()} == {"a": " Politics ", "z": "other"}


def test_repeated_incoming_keys(spark):
    rows = lambda data, schema: spark.createDataFrame(data, schema)
    stored = rows([("a", 1)], "k string, v int")
    new = rows([("b", 2, 1), ("b", 3, 2), ("a", 9, 3)], "k string, v int, pos int")
    assert sorted(merge.insert_if_absent(stored, new, "k").collect()) == [("a", 1), ("b", 2)]
    assert sorted(merge.load_full_replace(stored, new, "k").collect()) == [("a", 9), ("b", 3)]
    # Without a position one row is chosen, the same in whatever order rows come.
    loose = [("b", 2), ("b", 3)]
    found = [merge.insert_if_absent(stored, rows(order, "k string, v int"), "k").where("k = 'b'").collect()
             for order in (loose, loose[::-1])]
    assert len(found[0]) == 1 and found[0] == found[1]
    vectors = rows([("b", [1.0], 1), ("b", [2.0], 2)], "article_id string, embedding array<double>, pos int")
    assert merge.upsert_vectors(vectors.drop("pos").limit(0), vectors, 1).collect() == [("b", [2.0])]
    clusters = rows([("b", "e")], "article_id string, event_id string")
    articles = rows([("b", "s", 1), ("b", "t", 2)], "article_id string, source string, pos int")
    assert merge.event_stats(clusters, articles).collect() == [("e", 1, 1)]


def test_joined_sides_count_once(spark):
    cleaned = spark.createDataFrame(
        [("a", "s", "u", "t", "b", "en", None, None)],
        "article_id string, source string, url string, title string, body string, language string, published_at string, scraped_at string")
    vectors = spark.createDataFrame([("a", [1.0], 1), ("a", [2.0], 2)], "article_id string, embedding array<double>, pos int")
    bias = spark.createDataFrame([("a", "left", 0.5, {"left": 0.5}), ("a", "left", 0.5, {"left": 0.5})],
                                 "article_id string, bias_label string, bias_confidence double, bias_scores map<string,double>")
    clusters = spark.createDataFrame([("a", "e1", 1), ("a", "e2", 2)], "article_id string, event_id string, pos int")
    row, = merge.join_outputs(cleaned, vectors, bias, clusters, "now").collect()
    assert (row.embedding, row.event_id) == ([2.0], "e2")


def test_event_windows_span_both_sides(spark):
    shape = "event_id string, article_count bigint, source_count bigint, window_start timestamp, window_end timestamp"
    rows = spark.createDataFrame([("e", 1, 1, "03", "04"), ("f", 1, 1, None, None)], "event_id string, article_count bigint, source_count bigint, a string, b string")
    more = spark.createDataFrame([("e", 1, 1, "02", "03"), ("f", 1, 1, "05", "06")], rows.schema)

    def timed(df):
        return df.selectExpr("event_id", "article_count", "source_count", *[f"CAST('2024-01-' || {c} AS TIMESTAMP) AS {n}" for c, n in (("a", "window_start"), ("b", "window_end"))]).to(spark.createDataFrame([], shape).schema)

    found = {r.event_id: (r.article_count, r.window_start.day, r.window_end.day) for r in merge.upsert_events(timed(rows), timed(more)).collect()}
    assert found == {"e": (2, 2, 4), "f": (2, 5, 6)}
