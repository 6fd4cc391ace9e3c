"""Test tables in the shapes the operators expect, as DataFrames and as SQL.

documents play the raw articles, embeddings the vectors with their label as event,
pages the fetched pages, events the publication times and labels the articles the
warehouse holds already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import ids
from storyloom.functions.labels import BIAS_LABELS
from storyloom.session import spread

URL = "https://example.org/articles/"
RUN_DATE = "2024-01-05"
LOADED_AT = "2024-01-05T08:00:00"
STORED_AT = "2024-01-01T00:00:00"

# Marks put into the prose, which has none: a decomposed letter, invisible characters,
# entities (also escaped ones) and unusual white space.
MARKS = [
    ("\u00e9", "e\u0301"),
    (", ", ",\u200b&nbsp; "),
    (". ", ".\u200d &amp;lt; "),
    (" th", "\u3000&quot;th"),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "pages"), "page_id")


def url_of(number: Column) -> Column:
    return F.concat(F.lit(URL), number.cast("string"))


def first_line(text: Column) -> Column:
    return F.split_part(text, F.lit("\n"), F.lit(1))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Raw articles in document order."""
    times = table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").alias("published_at"))
    docs = spread(table(spark, sf, "documents"), "doc_id").join(times, "doc_id", "left")
    url = url_of(F.col("doc_id"))
    return docs.select(
        ids.article_id(url).alias("article_id"), "source", url.alias("url"), first_line(F.col("text")).alias("title"),
        F.col("text").alias("body"), F.col("lang").alias("language"), "published_at",
        F.lit(LOADED_AT).alias("scraped_at"), F.col("doc_id").alias("pos"))


ARTICLES = f"""articles AS (
  SELECT substr(sha256('{URL}' || d.doc_id), 1, 24) AS article_id, d.source, '{URL}' || d.doc_id AS url,
         split_part(d.text, chr(10), 1) AS title, d.text AS body, d.lang AS language, e.ts AS published_at,
         '{LOADED_AT}' AS scraped_at, d.doc_id AS pos
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id)"""


def marked(df: DataFrame) -> DataFrame:
    """Articles with marks that normalisation has to remove."""
    def mark(text: Column) -> Column:
        for plain, odd in MARKS:
            text = F.replace(text, F.lit(plain), F.lit(odd))
        return text

    return df.withColumns({c: mark(F.col(c)) for c in ("title", "body")})


def _mark(column: str) -> str:
    for plain, odd in MARKS:
        column = f"replace({column}, '{plain}', '{odd}')"
    return column


MARKED = f"marked AS (SELECT * REPLACE ({_mark('title')} AS title, {_mark('body')} AS body) FROM articles)"


def revisions(df: DataFrame) -> DataFrame:
    """Articles whose id repeats: all of one language and length count as one article."""
    return df.withColumn("article_id", ids.article_id(F.concat_ws("-", "language", F.length("body").cast("string"))))


REVISIONS = """revisions AS (
  SELECT * REPLACE (substr(sha256(language || '-' || length(body)), 1, 24) AS article_id) FROM articles)"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Stored or new vectors with their event, ids as in :func:`articles`."""
    return table(spark, sf, "embeddings").select(
        ids.article_id(url_of(F.col("vec_id"))).alias("article_id"),
        "embedding",
        ids.uuid_from(F.lit("cluster"), F.col("label").cast("string")).alias("event_id"),
        "label",
        F.col("vec_id").alias("pos"))


def uuid_sql(text: str) -> str:
    h = f"sha256({text})"
    return " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)])


VECTORS = f"""vectors AS (
  SELECT substr(sha256('{URL}' || vec_id), 1, 24) AS article_id, embedding::DOUBLE[] AS embedding,
         {uuid_sql("'cluster:' || label")} AS event_id, label, vec_id AS pos
  FROM embeddings)"""


def logits(df: DataFrame) -> DataFrame:
    """Five logits per vector: the sums of five spans that cover it."""
    def span(i: int) -> Column:
        part = F.slice(F.col("embedding").cast("array<double>"), 13 * i + 1, 13)
        return F.aggregate(part, F.lit(0.0), lambda a, x: a + x)

    return df.withColumn("logits", F.array(*[span(i) for i in range(5)]))


LOGITS = "logits AS (SELECT *, [" + ", ".join(
    f"list_sum(embedding[{13 * i + 1}:{13 * i + 13}])" for i in range(5)) + "] AS logits FROM vectors)"
SCORES = """exps AS (SELECT *, list_transform(logits, lambda z: exp(z - list_max(logits))) AS e FROM logits),
scores AS (SELECT *, list_transform(e, lambda x: x / list_sum(e)) AS p FROM exps)"""
NAMES = "[" + ", ".join(f"'{n}'" for n in BIAS_LABELS) + "]"
BIAS = f"""bias AS (
  SELECT article_id, {NAMES}[list_position(p, list_max(p))] AS bias_label, list_max(p) AS bias_confidence, p
  FROM scores)"""


def stored_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Warehouse articles: the labelled documents, with what an earlier run knew."""
    known = table(spark, sf, "labels").select(F.col("doc_id").alias("pos"), "quality", "toxic")
    rows = articles(spark, sf).join(known, "pos")
    return rows.select(
        "article_id", F.col("source").alias("source_name"), "url", F.concat(F.lit("Stored: "), "title").alias("title"),
        "body", "language", "published_at",
        F.when(F.col("quality") == 1, F.lit("center")).alias("bias_label"),
        F.when(F.col("quality") == 1, F.lit(0.5)).alias("bias_confidence"),
        F.when(F.col("toxic") == 0, ids.uuid_from(F.lit("stored"), F.col("quality").cast("string"))).alias("event_id"))


STORED = f"""stored AS (
  SELECT a.article_id, a.source AS source_name, a.url, 'Stored: ' || a.title AS title, a.body, a.language,
         a.published_at, CASE WHEN l.quality = 1 THEN 'center' END AS bias_label,
         CASE WHEN l.quality = 1 THEN 0.5::DOUBLE END AS bias_confidence,
         CASE WHEN l.toxic = 0 THEN {uuid_sql("'stored:' || l.quality")} END AS event_id
  FROM articles a JOIN labels l ON l.doc_id = a.pos)"""


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """An annotated corpus as found: display labels, text embeddings, dates of which
    some cannot be read, label 9 as noise, some publishers unknown."""
    v = vectors(spark, sf).select("article_id", "embedding", "label")
    joined = v.join(articles(spark, sf), "article_id", "left")
    shown = [name.replace("_", " ").title() for name in BIAS_LABELS]
    date = F.date_format(F.col("published_at"), "yyyy-MM-dd HH:mm:ss")
    return joined.select(
        "article_id",
        F.when(F.col("language") != "es", F.col("source")).alias("publisher"),
        "url", "title", F.col("body").alias("text"),
        F.when(F.col("label") == 3, F.lit("not a date")).otherwise(date).alias("published_at"),
        F.element_at(F.array(*[F.lit(s) for s in shown]), (F.col("label") % 5 + 1).cast("int")).alias("bias_label"),
        F.when(F.col("label") == 9, -1).otherwise(F.col("label")).alias("cluster_id"),
        F.to_json(F.col("embedding").cast("array<double>")).alias("embedding"))


CORPUS = f"""corpus AS (
  SELECT v.article_id, CASE WHEN a.language <> 'es' THEN a.source END AS publisher, a.url, a.title, a.body AS text,
         CASE WHEN v.label = 3 THEN NULL ELSE date_trunc('second', a.published_at) END AS published_at,
         {NAMES}[v.label % 5 + 1] AS bias_label, CASE WHEN v.label = 9 THEN -1 ELSE v.label END AS cluster_id,
         v.embedding
  FROM vectors v LEFT JOIN articles a ON a.article_id = v.article_id),
corpus_events AS (
  SELECT *, CASE WHEN cluster_id = -1 THEN {uuid_sql("'noise:' || article_id")}
            ELSE {uuid_sql("'cluster:' || cluster_id")} END AS event_id
  FROM corpus)"""
