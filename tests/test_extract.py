from pyspark.sql import functions as F

from storyloom.operators import extract

PAGE = """<!DOCTYPE html><title>Harbour Post</title><main><h1 id="t">Ferry returns to the river</h1>
<div><p class="lead">Boats left at dawn.</p><p>Crowds waited on both banks.</p></div></main>"""


def _page(spark, html, url="https://x.example/a/1"):
    return spark.createDataFrame([(1, url, html)], "page_id bigint, url string, html string")


def test_title_and_paragraphs(spark):
    row = extract.extract_article(_page(spark, PAGE)).first()
    assert row.title == "Ferry returns to the river"
    assert row.body_lines == ["Boats left at dawn.", "Crowds waited on both banks."]


def test_traps(spark):
    html = ("<script>var t='<p>no</p>';</script><!-- <h1>no</h1> --><H1 class=x>A &amp;amp; <b>B</b></H1>"
            "<p>open<p class='y'>two <i>in</i>\nlines</p><p> </p><pre>not</pre><p>last<div>out</div>")
    row = extract.extract_article(_page(spark, html)).first()
    assert row.title == "A &amp; B"
    assert row.body_lines == ["open", "two in\nlines", "last"]
    empty = extract.extract_article(_page(spark, "<html></html>")).first()
    assert (empty.title, empty.body_lines) == ("", [])


def test_own_parser(spark):
    row = extract.extract_with(_page(spark, PAGE), lambda page: (page[:5], page.split()[:2])).first()
    assert (row.title, row.body_lines) == (PAGE[:5], PAGE.split()[:2])


def test_links_are_resolved_once_each(spark):
    html = '<a href="/b">1</a><A class="z" HREF=\'http://y.example/c\'>2</A><a href="/b">3</a>'
    rows = extract.extract_links(_page(spark, html)).collect()
    assert [r.link for r in rows] == ["https://x.example/b", "http://y.example/c"]


def test_links_of_every_kind(spark):
    base = "https://x.example/news/day.html?n=1#top"
    kinds = {
        "//cdn.example/i": "https://cdn.example/i", "other.html": "https://x.example/news/other.html", "#end": None,
        "mailto:a@x.example": None, "javascript:void(0)": None, "?p=2&amp;q=3": "https://x.example/news/day.html?p=2&q=3",
        "/k#part": "https://x.example/k", "../up/./z": "https://x.example/up/z", "../../../far/..": "https://x.example/",
        "HTTPS://Y.example/q?u=/../r": "HTTPS://Y.example/q?u=/../r"}
    for link, wanted in kinds.items():
        page = spark.createDataFrame([(base, f'<a href="{link}">x</a>')], "url string, html string")
        assert [r.link for r in extract.extract_links(page).collect()] == [wanted] * (wanted is not None), link
    same = '<a href="/a">1</a><a href="https://x.example/a">2</a><a href="/a#b">3</a>'
    page = spark.createDataFrame([(base, same), (None, same), (base, None)], "url string, html string")
    assert [r.link for r in extract.extract_links(page).collect() if r.url] == ["https://x.example/a"]
    bare = spark.createDataFrame([("https://x.example", '<a href="c">1</a>')], "url string, html string")
    assert extract.extract_links(bare).first().link == "https://x.example/c"


def test_references_become_characters_once(spark):
    html = "<h1>It&rsquo;s &#8212; &#x41;</h1><p>a &amp;lt; b &#60;i&#62; &amp;mdash; &nosuch; &#38;lt;</p>"
    row = extract.extract_article(_page(spark, html)).first()
    assert row.title == "It\u2019s \u2014 A"
    assert row.body_lines == ["a &lt; b <i> &mdash; &nosuch; &lt;"]


def test_records(spark):
    pages = extract.extract_article(_page(spark, PAGE.replace("Boats", "Boats " * 10)))
    base = pages.withColumn("source", F.lit("s"))
    for time_ut, expected in ((0, None), (None, None), (1704067200, "2024-01-01T00:00:00")):
        row = extract.make_articles(base.withColumn("time_ut", F.lit(time_ut).cast("long")), "2024-01-05T00:00:00").first()
        assert row.published_at == expected
    assert len(row.article_id) == 24 and row.language == "si"
    assert row.body == "Boats " * 10 + " left at dawn.\n\nCrowds waited on both banks."
    assert extract.make_articles(base.withColumn("time_ut", F.lit(0)), "now", min_chars=500).isEmpty()
