"""Every operator as a query over the test tables, with equivalent SQL where SQL can
say it. Each query runs over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import ids, labels, text, vectors
from storyloom.operators import (
    assign, classify, clean, corpus, density, digest, embed, extract, linkage, merge, neighbors, reads, similar,
)
from storyloom.plans import adapters as A
from storyloom.plans import clusters
from storyloom.session import durable, scratch_path, spread
from storyloom.sources import corpus as corpus_source
from storyloom.sources import inverted, stage, warehouse
from storyloom.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Distances between the test vectors start near 0.9, so queries use wider thresholds
# than the defaults.
THRESHOLD = 1.15
COSINE = 0.5


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def with_(*parts: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- SQL shared by several queries -------------------------------------------------

SPACE = text.SPACE


def normalize_sql(column: str) -> str:
    out = f"regexp_replace(nfc_normalize({column}), '[{text.INVISIBLE}]', '', 'g')"
    for entity, char in text.ENTITIES:
        quoted = char.replace("'", "''")
        out = f"replace({out}, '{entity}', '{quoted}')"
    return f"trim(regexp_replace({out}, '{SPACE}+', ' ', 'g'))"


def shingle_sql(column: str) -> str:
    return f"regexp_replace(lower(substr({column}, 1, 300)), '{text.NON_WORD}', '', 'g')"


def cleaned_sql(source: str) -> str:
    """normal, cleaned: the sequential rule as two window passes."""
    return f"""normal AS (
  SELECT * REPLACE ({normalize_sql('title')} AS title, {normalize_sql('body')} AS body) FROM {source}),
by_id AS (
  SELECT * FROM normal WHERE length(body) >= 50
  QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY pos) = 1),
cleaned AS (
  SELECT * FROM by_id QUALIFY row_number() OVER (PARTITION BY {shingle_sql('body')} ORDER BY pos) = 1)"""


CLEANED = cleaned_sql("articles")
NEIGHBOURS = """pairs AS (
  SELECT a.article_id AS query_id, b.article_id AS neighbour_id, b.event_id AS label,
         list_distance(a.embedding, b.embedding) AS distance
  FROM vectors a, vectors b),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM pairs),
neighbours AS (SELECT * FROM ranked WHERE rank <= 5)"""
VOTED = f"""votes AS (
  SELECT query_id, label, count(*) AS n, min(distance) AS distance, min(rank) AS first
  FROM neighbours WHERE distance <= {THRESHOLD} GROUP BY ALL),
best AS (
  SELECT *, sum(n) OVER (PARTITION BY query_id) AS kept,
         row_number() OVER (PARTITION BY query_id ORDER BY n DESC, first) AS place FROM votes),
voted AS (
  SELECT query_id AS article_id, label AS event_id, distance FROM best WHERE place = 1 AND n / kept >= 0.6)"""


def _neighbour_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    v = A.vectors(spark, sf)
    return neighbors.as_queries(v), neighbors.corpus_embedded(v)


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_articles(A.articles(spark, sf))


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    return A.vectors(spark, sf).select(
        "article_id", "event_id", F.lit("knn").alias("cluster_method"), F.lit(0.0).alias("distance"), "pos")


def _bias(spark: SparkSession, sf: str) -> DataFrame:
    return classify.label_scores(classify.softmax_scores(A.logits(A.vectors(spark, sf))))


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    return merge.join_outputs(
        _cleaned(spark, sf), A.vectors(spark, sf), _bias(spark, sf), _assigned(spark, sf), A.LOADED_AT)


JOINED = f"""joined AS (
  SELECT c.article_id, c.source AS source_name, c.url, c.title, c.body, coalesce(c.language, 'si') AS language,
         c.published_at, coalesce(c.scraped_at, '{A.LOADED_AT}') AS scraped_at,
         b.bias_label, b.bias_confidence, b.p, v.embedding, v.event_id
  FROM cleaned c LEFT JOIN vectors v ON v.article_id = c.article_id LEFT JOIN bias b ON b.article_id = c.article_id)"""
ALL_JOINED = (A.ARTICLES, CLEANED, A.VECTORS, A.LOGITS, A.SCORES, A.BIAS, JOINED)
ASSIGNED_EVENTS = """new_events AS (
  SELECT v.event_id, count(*) AS article_count, count(DISTINCT c.source) AS source_count
  FROM vectors v LEFT JOIN cleaned c ON c.article_id = v.article_id GROUP BY v.event_id)"""
STORED_EVENTS = """stored_events AS (
  SELECT event_id, count(*) AS article_count, count(DISTINCT source_name) AS source_count,
         min(published_at) AS window_start FROM (
    SELECT s.source_name, s.published_at, v.event_id FROM stored s JOIN vectors v ON v.article_id = s.article_id
    UNION ALL SELECT source_name, published_at, event_id FROM stored WHERE event_id IS NOT NULL) GROUP BY event_id)"""


def _stored_events(spark: SparkSession, sf: str) -> DataFrame:
    stored = A.stored_articles(spark, sf)
    known = stored.drop("event_id").join(A.vectors(spark, sf).select("article_id", "event_id"), "article_id")
    columns = ["source_name", "published_at", "event_id"]
    rows = known.select(columns).unionByName(stored.where("event_id IS NOT NULL").select(columns))
    return rows.groupBy("event_id").agg(
        F.count("*").alias("article_count"), F.count_distinct("source_name").alias("source_count"),
        F.min("published_at").alias("window_start"))


def _times(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as text, so that engines print them alike."""
    return df.withColumns({n: F.date_format(F.col(n).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss") for n in names})


def time_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


# --- Sources and sinks -------------------------------------------------------------


def _raw_folder(spark: SparkSession, sf: str) -> str:
    """Raw articles written as stage files in document order. The ranges follow the
    session's shuffle partitions, so that a writer's share stays bounded as the input grows."""
    root = scratch_path(spark, "stages")
    rows = A.articles(spark, sf).withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss"))
    stage.write_stage(rows.repartitionByRange("pos").sortWithinPartitions("pos"), root, "raw", A.RUN_DATE)
    return root


STAGE_SQL = with_(A.ARTICLES, select=f"""SELECT article_id, source, title, body, language,
  strftime(published_at, '%Y-%m-%dT%H:%M:%S') AS published_at FROM articles""")
STAGE_COLUMNS = ("article_id", "source", "title", "body", "language", "published_at")


@query(STAGE_SQL)
def read_stage(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = stage.split_corrupt(stage.read_stage(spark, _raw_folder(spark, sf), "raw", A.RUN_DATE))
    return good.select(*STAGE_COLUMNS)


@query(with_(A.VECTORS, select="""SELECT article_id, len(embedding) AS dims, round(list_sum(embedding), 6) AS total
  FROM vectors"""))
def write_stage(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "stages")
    out = A.vectors(spark, sf).select("article_id", F.col("embedding").cast("array<double>").alias("embedding"))
    stage.write_stage(out, root, "embeddings", A.RUN_DATE)
    stage.write_stage(out, root, "embeddings", A.RUN_DATE)
    back = stage.read_stage(spark, root, "embeddings", A.RUN_DATE)
    return back.select("article_id", F.size("embedding").cast("long").alias("dims"),
                       F.round(vectors.total(F.col("embedding")), 6).alias("total"))


@query(with_(A.ARTICLES, A.VECTORS, A.CORPUS, select=f"""SELECT article_id, publisher, bias_label, cluster_id,
  {time_sql('published_at')} AS published_at, round(list_sum(embedding), 6) AS total FROM corpus"""))
def read_corpus(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "corpus")
    A.corpus(spark, sf).write.parquet(path)
    read = corpus_source.read_corpus(spark, path)
    return _times(read, "published_at").select(
        "article_id", "publisher", "bias_label", "cluster_id", "published_at",
        F.round(vectors.total(F.col("embedding")), 6).alias("total"))


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.corpus_events(corpus_source.corpus_columns(A.corpus(spark, sf)))


@query(with_(*ALL_JOINED, select="""SELECT article_id AS id, event_id AS label, round(list_sum(embedding), 6) AS total
  FROM joined WHERE embedding IS NOT NULL AND event_id IS NOT NULL"""))
def corpus_embedded(spark: SparkSession, sf: str) -> DataFrame:
    found = neighbors.corpus_embedded(_joined(spark, sf))
    return found.select("id", "label", F.round(vectors.total(F.col("embedding")), 6).alias("total"))


@query(with_(A.ARTICLES, A.VECTORS, A.STORED, """counted AS (
  SELECT 'articles' AS table_name, count(*) AS row_count FROM articles
  UNION ALL SELECT 'sources', count(DISTINCT source) FROM articles
  UNION ALL SELECT 'events', count(DISTINCT event_id) FROM vectors)""", select="SELECT * FROM counted"))
def commit_warehouse(spark: SparkSession, sf: str) -> DataFrame:
    """Two commits; readers see the second, whole."""
    root = scratch_path(spark, "warehouse")
    rows = A.articles(spark, sf)
    stored = A.stored_articles(spark, sf)
    found = merge.event_stats(_assigned(spark, sf), rows)
    for run, held in (("first", stored), ("second", rows.withColumnRenamed("source", "source_name"))):
        names = held.select("source_name").distinct().withColumn("source_type", F.lit("html"))
        warehouse.commit_warehouse(spark, root, {"sources": names, "events": found, "articles": held}, run)
    return reads.row_counts({n: warehouse.read_table(spark, root, n) for n in ("articles", "sources", "events")})


def _two_commits(spark: SparkSession, sf: str) -> str:
    """Stored articles, then English ones as changes."""
    root = scratch_path(spark, "warehouse")
    rows = A.articles(spark, sf).withColumnRenamed("source", "source_name")
    for run, held in (("first", A.stored_articles(spark, sf)), ("second", rows.where("language = 'en'"))):
        names = held.select("source_name").distinct().withColumn("source_type", F.lit("html"))
        warehouse.commit_warehouse(spark, root, {"sources": names, "articles": held}, run, changes=True)
    return root


@query(with_(A.ARTICLES, A.STORED, select="""SELECT 'articles' AS table_name, 0 AS part, count(*) AS rows, min(article_id) AS low, max(article_id) AS high FROM stored
  UNION ALL SELECT 'articles', 1, count(*), min(article_id), max(article_id) FROM articles WHERE language = 'en'
  UNION ALL SELECT 'sources', 0, count(DISTINCT source_name), min(source_name), max(source_name) FROM stored
  UNION ALL SELECT 'sources', 1, count(DISTINCT source), min(source), max(source) FROM articles WHERE language = 'en'"""))
def warehouse_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and ranges of keys of each folder, as the commits keep them."""
    found = warehouse.folder_stats(spark, _two_commits(spark, sf))
    return found.select("table_name", F.substring_index("folder", "-", 1).cast("int").alias("part"), "rows", "low", "high")


@query(with_(A.ARTICLES, A.STORED, select="""SELECT article_id, title FROM articles WHERE language = 'en' AND article_id BETWEEN '4' AND '8'
  UNION ALL SELECT article_id, title FROM stored WHERE article_id BETWEEN '4' AND '8'
    AND article_id NOT IN (SELECT article_id FROM articles WHERE language = 'en')"""))
def read_key_range(spark: SparkSession, sf: str) -> DataFrame:
    """The current rows of a range of keys, over both commits."""
    return warehouse.read_table(spark, _two_commits(spark, sf), "articles", keys=("4", "8")).select("article_id", "title")


@query(with_(A.VECTORS, A.ARTICLES, select="""SELECT article_id, 'new' AS payload, round(list_sum(embedding), 6) AS total
  FROM vectors WHERE label < 5
  UNION ALL SELECT v.article_id, 'old', round(list_sum(v.embedding), 6)
  FROM vectors v JOIN articles a ON a.article_id = v.article_id WHERE label >= 5"""))
def upsert_vectors(spark: SparkSession, sf: str) -> DataFrame:
    v = A.vectors(spark, sf).select("article_id", "embedding", "label")
    stored = v.join(A.articles(spark, sf).select("article_id"), "article_id").withColumn("payload", F.lit("old"))
    incoming = v.where("label < 5").withColumn("payload", F.lit("new"))
    merged = merge.upsert_vectors(stored, incoming, 64)
    return merged.select("article_id", "payload", F.round(vectors.total(F.col("embedding")), 6).alias("total"))


@query("SELECT count(*) AS row_count FROM documents")
def refresh_stats(spark: SparkSession, sf: str) -> DataFrame:
    name = "storyloom_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    A.articles(spark, sf).write.option("path", scratch_path(spark, "table")).saveAsTable(name)
    return warehouse.refresh_stats(spark, name)


# --- Pages to articles -------------------------------------------------------------

UNSEEN = extract._UNSEEN


def decode_sql(fragment: str) -> str:
    out = f"regexp_replace({fragment}, '{extract._TAG}', '', 'g')"
    further = [("&middot;", "\u00b7"), ("&copy;", "\u00a9")]  # the others that the pages hold
    for entity, char in further + [e for e in text.ENTITIES if e[1] != "&"] + [("&amp;", "&")]:
        quoted = char.replace("'", "''")
        out = f"replace({out}, '{entity}', '{quoted}')"
    return rf"regexp_replace({out}, '\A{SPACE}+|{SPACE}+\z', '', 'g')"


EXTRACTED = f"""seen AS (SELECT page_id, url, regexp_replace(html, '{UNSEEN}', '', 'g') AS html FROM pages),
pieces AS (SELECT page_id, url, html, regexp_split_to_array(html, '{extract._PARAGRAPH}')[2:] AS parts FROM seen),
extracted AS (
  SELECT page_id, url, {decode_sql(f"regexp_extract(html, '{extract._HEADING}', 1)")} AS title,
         list_filter(list_transform(parts, lambda p:
           {decode_sql(f"regexp_extract(p, '{extract._PARAGRAPH_END}', 1)")}), lambda l: l <> '') AS lines
  FROM pieces)"""


@query(with_(EXTRACTED, select="""SELECT page_id, url, title, len(lines) AS line_count,
  coalesce(array_to_string(lines, chr(10) || chr(10)), '') AS body FROM extracted"""))
def extract_article(spark: SparkSession, sf: str) -> DataFrame:
    found = extract.extract_article(A.pages(spark, sf))
    return found.select("page_id", "url", "title", F.size("body_lines").cast("long").alias("line_count"),
                        F.array_join("body_lines", "\n\n").alias("body"))


@query(with_(f"seen AS (SELECT page_id, url, regexp_replace(html, '{UNSEEN}', '', 'g') AS html FROM pages)",
             """hrefs AS (SELECT page_id, url, unnest(regexp_extract_all(html,
               '<[aA]\\s[^>]*?[hH][rR][eE][fF]\\s*=\\s*["'']([^"'']+)["'']', 1)) AS href FROM seen)""",
             """made AS (SELECT page_id, url, split_part(url, '://', 1) AS scheme, split_part(split_part(url, '://', 2), '/', 1) AS host,
               split_part(split_part(url, '?', 1), '#', 1) AS page, href, page_id % 7 AS trap FROM hrefs)""",
             select="""SELECT DISTINCT page_id, url, CASE trap
               WHEN 1 THEN scheme || ':/' || href
               WHEN 2 THEN left(page, length(page) - length(split_part(page, '/', -1))) || substr(href, 2)
               WHEN 3 THEN page || '?q=' || substr(href, 2) || '&r=1'
               ELSE scheme || '://' || host || href END AS link
             FROM made WHERE trap NOT IN (4, 5)"""))
def extract_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links of all pages. By page, they are turned into other kinds: of another host, relative,
    queries, addresses of mail, fragments, and paths with a fragment and a way up."""
    kinds = {1: "href=\"/$1", 2: "href=\"./$1", 3: "href=\"?q=$1&amp;r=1", 4: "href=\"mailto:$1", 5: "href=\"#$1", 6: "href=\"/up/../$1#part"}
    pages = A.pages(spark, sf)
    html = F.col("html")
    for kind, written in kinds.items():
        target = r'href="/([^"]+)' if kind != 1 else r'href="(?=/)([^"]+)'
        html = F.when(F.col("page_id") % 7 == kind, F.regexp_replace("html", target, written)).otherwise(html)
    return extract.extract_links(pages.withColumn("html", html))


@query(with_(EXTRACTED, f"""records AS (
  SELECT substr(sha256(url), 1, 24) AS article_id, regexp_extract(url, '{extract._SITE}', 1) AS source, url, title,
         coalesce(array_to_string(lines, chr(10) || chr(10)), '') AS body, 'si' AS language,
         CASE WHEN page_id <> 0 THEN strftime(make_timestamp((1704067200 + page_id * 60) * 1000000),
              '%Y-%m-%dT%H:%M:%S') END AS published_at, '{A.LOADED_AT}' AS scraped_at FROM extracted)""",
             select=rf"""SELECT * FROM records
               WHERE length(regexp_replace(body, '\A{SPACE}+|{SPACE}+\z', '', 'g')) >= 50"""))
def make_articles(spark: SparkSession, sf: str) -> DataFrame:
    found = extract.extract_article(A.pages(spark, sf)).withColumns({
        "source": F.regexp_extract("url", extract._SITE, 1),
        "time_ut": F.when(F.col("page_id") == 0, 0).otherwise(1704067200 + F.col("page_id") * 60)})
    return extract.make_articles(found, A.LOADED_AT)


# --- Cleaning and duplicates -------------------------------------------------------


@query(with_(A.ARTICLES, A.MARKED, select=f"""SELECT article_id, {normalize_sql('title')} AS title,
  {normalize_sql('body')} AS body FROM marked"""))
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return clean.normalize_text(A.marked(A.articles(spark, sf))).select("article_id", "title", "body")


@query(with_(A.ARTICLES, A.MARKED, cleaned_sql("marked"), select="""SELECT article_id, length(body) AS chars FROM normal
  WHERE length(body) >= 200"""))
def min_body_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.min_body_filter(clean.normalize_text(A.marked(A.articles(spark, sf))), 200)
    return rows.select("article_id", F.length("body").cast("long").alias("chars"))


@query(with_(A.ARTICLES, A.REVISIONS, select="""SELECT article_id, url, body FROM revisions
  QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY pos) = 1"""))
def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    return clean.dedup_exact(A.revisions(A.articles(spark, sf))).select("article_id", "url", "body")


@query(with_(A.ARTICLES, select=f"""SELECT article_id, url, body FROM articles
  QUALIFY row_number() OVER (PARTITION BY {shingle_sql('body')} ORDER BY pos) = 1"""))
def dedup_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return clean.dedup_prefix(A.articles(spark, sf)).select("article_id", "url", "body")


CLEAN_SQL = with_(A.ARTICLES, A.REVISIONS, A.MARKED.replace("FROM articles", "FROM revisions"), cleaned_sql("marked"),
                  select="SELECT article_id, source, url, title, body, language, pos FROM cleaned")


@query(CLEAN_SQL)
def clean_articles(spark: SparkSession, sf: str) -> DataFrame:
    raw = A.marked(A.revisions(A.articles(spark, sf)))
    return clean.clean_articles(raw).select("article_id", "source", "url", "title", "body", "language", "pos")


@query(with_(A.ARTICLES, select=f"""SELECT DISTINCT article_id FROM (SELECT article_id,
  row_number() OVER (PARTITION BY {shingle_sql('body')} ORDER BY pos) AS n FROM articles) WHERE n > 1"""))
def near_duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return clean.near_duplicate_ids(A.articles(spark, sf))


@query(with_(A.ARTICLES, select="SELECT article_id, language FROM articles WHERE language IN ('en', 'de')"))
def language_filter(spark: SparkSession, sf: str) -> DataFrame:
    return clean.language_filter(A.articles(spark, sf), ["en", "de"]).select("article_id", "language")


@query(with_(f"""words AS (SELECT doc_id::VARCHAR AS id, list_filter(
    regexp_split_to_array(lower(text), '{text.NON_WORD}'), lambda w: w <> '') AS w FROM documents)""",
             """sets AS (SELECT id, list_distinct(list_transform(range(1, greatest(len(w) - 1, 2)),
    lambda i: array_to_string(w[i:i + 2], ' '))) AS s FROM words WHERE len(w) > 0)""",
             "tokens AS (SELECT id, len(s) AS n, unnest(s) AS t FROM sets)",
             """common AS (SELECT a.id AS a, b.id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
    FROM tokens a JOIN tokens b ON a.t = b.t AND a.id <> b.id GROUP BY 1, 2)""",
             "edges AS (SELECT a, b FROM common WHERE c >= 0.92 * (na + nb - c))",
             "reach AS (SELECT id, id AS r FROM words UNION SELECT reach.id, edges.b FROM reach JOIN edges ON edges.a = reach.r)",
             select="SELECT id, min(r) AS keeper FROM reach GROUP BY id"))
def near_dup_minhash(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(A.table(spark, sf, "documents"), "doc_id")
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    return similar.near_dup_minhash(rows)


@query(with_("v AS (SELECT vec_id::VARCHAR AS id, embedding::DOUBLE[] AS e FROM embeddings)",
             f"""edges AS (SELECT a.id AS a, b.id AS b FROM v a, v b
    WHERE a.id <> b.id AND list_cosine_similarity(a.e, b.e) >= {COSINE})""",
             "reach AS (SELECT id, id AS r FROM v UNION SELECT reach.id, edges.b FROM reach JOIN edges ON edges.a = reach.r)",
             select="SELECT id, min(r) AS keeper FROM reach GROUP BY id"))
def near_dup_cosine(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "embedding")
    return similar.near_dup_cosine(rows, COSINE)


def _count_invisible(column: str) -> str:
    return f"length({column}) - length(regexp_replace({column}, '[{text.INVISIBLE}]', '', 'g'))"


@query(with_(A.ARTICLES, A.MARKED, cleaned_sql("marked"),
             f"inv AS (SELECT {_count_invisible('title')} + {_count_invisible('body')} AS n FROM marked)",
             select="""SELECT (SELECT count(*) FROM marked) AS rows_in,
  (SELECT count(*) FROM normal WHERE length(body) < 50) AS rows_short,
  (SELECT count(*) FROM normal WHERE length(body) >= 50) - (SELECT count(*) FROM cleaned) AS rows_repeated,
  (SELECT count(*) FROM cleaned) AS rows_out, (SELECT sum(n)::BIGINT FROM inv) AS invisible_chars,
  (SELECT count(*) FROM inv WHERE n > 0) AS invisible_rows"""))
def cleaning_report(spark: SparkSession, sf: str) -> DataFrame:
    return clean.cleaning_report(A.marked(A.articles(spark, sf)))


# --- Vectors -----------------------------------------------------------------------


@query(with_(A.ARTICLES, select="""SELECT article_id, 'passage: ' || title || body AS passage,
  title || '. ' || body AS sentence FROM articles"""))
def model_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.articles(spark, sf)
    passage = embed.model_text(rows).withColumnRenamed("text", "passage")
    return passage.join(embed.model_text(rows, sentence=True).withColumnRenamed("text", "sentence"), "article_id")


@query(with_(A.ARTICLES, select="SELECT article_id, 1024::INT AS dimension, 1.0::DOUBLE AS norm FROM articles"))
def embed_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The contract of any encoder: a unit vector of the warehouse's dimension per text."""
    found = embed.embed_batches(embed.model_text(A.articles(spark, sf)))
    return found.select("article_id", F.size("embedding").alias("dimension"), F.round(vectors.norm(F.col("embedding")), 5).alias("norm"))


@query("""WITH t AS (SELECT label::VARCHAR AS id, CASE WHEN embedding[1] > 0 THEN 1 ELSE 0 END AS mask,
    unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
  SELECT id, dim, round(sum(x * mask) / greatest(sum(mask), 1e-9), 6) AS mean FROM t GROUP BY id, dim""")
def mean_pool(spark: SparkSession, sf: str) -> DataFrame:
    tokens = A.table(spark, sf, "embeddings").select(
        F.col("label").cast("string").alias("id"), F.when(F.col("embedding")[0] > 0, 1).otherwise(0).alias("mask"),
        F.col("embedding").cast("array<double>").alias("vec"))
    pooled = embed.mean_pool(tokens).select("id", F.posexplode("embedding").alias("dim", "mean"))
    return rounded(pooled.withColumn("dim", F.col("dim").cast("long")), "mean")


@query("""WITH v AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * (vec_id + 2)) AS e FROM embeddings),
  n AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v)
  SELECT vec_id, generate_subscripts(e, 1) - 1 AS dim, round(unnest(e) / greatest(norm, 1e-12), 6) AS value FROM n""")
def l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    scaled = A.table(spark, sf, "embeddings").withColumn(
        "embedding", F.transform(F.col("embedding").cast("array<double>"), lambda x: x * (F.col("vec_id") + 2)))
    out = embed.l2_normalize(scaled).select("vec_id", F.posexplode("embedding").alias("dim", "value"))
    return rounded(out.withColumn("dim", F.col("dim").cast("long")), "value")


@query("""WITH v AS (SELECT len(embedding) AS d,
    sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm FROM embeddings)
  SELECT count(*) AS vectors, min(d)::INT AS min_dim, max(d)::INT AS max_dim, round(min(norm), 6) AS min_norm,
         round(max(norm), 6) AS max_norm FROM v""")
def vector_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(embed.vector_profile(A.table(spark, sf, "embeddings")), "min_norm", "max_norm")


# --- Classification ----------------------------------------------------------------


LABEL_LIST = ", ".join(f"'{x}'" for x in labels.BIAS_LABELS)


def _score_facts(found: DataFrame) -> list[Column]:
    """The sum of the scores, and whether label and confidence are those of the best one."""
    scores = F.map_values("bias_scores")
    return [F.round(F.aggregate(scores, F.lit(0.0), lambda a, x: a + x), 6).alias("score_sum"),
            (F.col("bias_confidence") == F.array_max(scores)).alias("is_best"),
            (F.col("bias_confidence") == F.element_at("bias_scores", F.col("bias_label"))).alias("is_labelled")]


@query(with_(A.VECTORS, select=f"""SELECT article_id, ([{LABEL_LIST}])[label % 5 + 1] AS bias_label,
  1.0::DOUBLE AS score_sum, true AS is_best, true AS is_labelled FROM vectors"""))
def score_bias(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors with a far offset for their class, so that a fitted model must find it."""
    v = A.vectors(spark, sf).withColumn("label", F.col("label") % 5)
    offset = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.when(i == F.col("label"), 10.0).otherwise(0.0))
    v = v.withColumn("embedding", F.concat(F.col("embedding").cast("array<double>"), offset))
    found = classify.score_bias(v, classify.fit_bias_model(v))
    return found.select("article_id", "bias_label", *_score_facts(found))


@query(with_(A.VECTORS, A.LOGITS, A.SCORES, select="""SELECT article_id, round(p[1], 6) AS p1, round(p[2], 6) AS p2,
  round(p[3], 6) AS p3, round(p[4], 6) AS p4, round(p[5], 6) AS p5 FROM scores"""))
def softmax_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = classify.softmax_scores(A.logits(A.vectors(spark, sf)))
    return scored.select("article_id", *[F.round(F.col("probabilities")[i], 6).alias(f"p{i + 1}") for i in range(5)])


@query(with_(A.VECTORS, A.LOGITS, A.SCORES, A.BIAS, select="""SELECT article_id, bias_label,
  round(bias_confidence, 6) AS bias_confidence, round(p[1], 6) AS far_left, round(p[5], 6) AS far_right FROM bias"""))
def label_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_bias(spark, sf).select(
        "article_id", "bias_label", "bias_confidence", F.element_at("bias_scores", "far_left").alias("far_left"),
        F.element_at("bias_scores", "far_right").alias("far_right")), "bias_confidence", "far_left", "far_right")


@query(with_(A.ARTICLES, select="""SELECT article_id, 1.0::DOUBLE AS score_sum, true AS is_best, true AS is_labelled
  FROM articles"""))
def classify_text(spark: SparkSession, sf: str) -> DataFrame:
    """The contract of any classifier; which label wins is up to the weights."""
    found = classify.classify_text(embed.model_text(A.articles(spark, sf), sentence=True))
    return found.select("article_id", *_score_facts(found))


def _held_out(df: DataFrame) -> DataFrame:
    """Articles with the position of their language as label; a fourth is not learnt from."""
    position = F.array_position(F.array(*[F.lit(x) for x in LANGUAGES]), F.col("language")) - 1
    return df.where(F.col("language").isin(LANGUAGES)).withColumns({"label": position, "held": F.pmod("pos", F.lit(4)) == 0})


def _found_share(found: DataFrame, held: DataFrame) -> DataFrame:
    """How many articles were held out, and whether nine tenths of their languages were found."""
    return held.select("article_id", "language").join(found.select("article_id", "bias_label"), "article_id").agg(
        F.count("*").alias("held_out"), (F.count_if(F.col("language") == F.col("bias_label")) >= 0.9 * F.count("*")).alias("found"))


LANGUAGES = ["de", "en", "es", "fr"]
HELD_OUT = f"""SELECT count(*) AS held_out, true AS found FROM articles
  WHERE language IN ({", ".join(f"'{x}'" for x in LANGUAGES)}) AND pos % 4 = 0 AND length(body) > 40"""


@query(with_(A.ARTICLES, select=HELD_OUT))
def score_bias_trees(spark: SparkSession, sf: str) -> DataFrame:
    """A tree ensemble over encoded articles, saved and loaded, asked for the language of articles
    that it has not seen; the language is no part of the vector."""
    rows = durable(_held_out(A.articles(spark, sf)).where(F.length("body") > 40))
    encoded = embed.embed_batches(embed.model_text(rows), embed.hashed_encoder(128))
    vectors_ = durable(encoded.join(rows.select("article_id", "label", "held"), "article_id"))
    path = scratch_path(spark, "trees")
    classify.fit_tree_model(vectors_.where("NOT held")).save(path)
    found = classify.score_bias(vectors_.where("held"), PipelineModel.load(path), LANGUAGES)
    return _found_share(found, rows.where("held"))


@query(with_(A.ARTICLES, select=HELD_OUT))
def classify_text_fitted(spark: SparkSession, sf: str) -> DataFrame:
    """A text model, saved and loaded, asked for the language of articles that it has not seen."""
    rows = durable(_held_out(A.articles(spark, sf)).where(F.length("body") > 40))
    texts = rows.select("article_id", F.col("body").alias("text"), "label", "held")
    path = scratch_path(spark, "text-model")
    classify.fit_text_model(texts.where("NOT held")).save(path)
    found = classify.classify_fitted(texts.where("held"), PipelineModel.load(path), LANGUAGES)
    return _found_share(found, rows.where("held"))


# --- Neighbours and events ---------------------------------------------------------

MEANS = """flat AS (SELECT generate_subscripts(embedding, 1) AS d, unnest(embedding) AS x FROM vectors),
means AS (SELECT d, round(avg(x), 9) AS m FROM flat GROUP BY d),
centroid AS (SELECT list(m ORDER BY d) AS c FROM means)"""


def _centroid(spark: SparkSession, sf: str) -> list[float]:
    """The mean vector: as many values as there are dimensions."""
    entries = A.vectors(spark, sf).select(F.posexplode("embedding").alias("d", "x"))
    means = entries.groupBy("d").agg(F.round(F.avg(F.col("x").cast("double")), 9).alias("m"))
    return [row.m for row in means.orderBy("d").collect()]


@query(with_(A.VECTORS, MEANS, select="""SELECT article_id, round(list_distance(embedding, c), 6) AS distance
  FROM vectors, centroid"""))
def l2_distance(spark: SparkSession, sf: str) -> DataFrame:
    target = F.array(*[F.lit(x) for x in _centroid(spark, sf)])
    return A.vectors(spark, sf).select(
        "article_id", F.round(vectors.l2_distance(F.col("embedding"), target), 6).alias("distance"))


@query(with_(A.VECTORS, """pairs AS (
  SELECT a.article_id AS query_id, b.article_id AS neighbour_id, b.event_id AS label,
         list_cosine_distance(a.embedding, b.embedding) AS distance
  FROM vectors a, vectors b WHERE a.article_id <> b.article_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM pairs)""",
             select="SELECT query_id, neighbour_id, label, round(distance, 6) AS distance, rank FROM ranked WHERE rank <= 5"))
def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    queries, stored = _neighbour_inputs(spark, sf)
    found = neighbors.cosine_topk(queries, stored, skip_self=True)
    return rounded(found.withColumn("rank", F.col("rank").cast("long")), "distance")


@query(with_(A.VECTORS, NEIGHBOURS, select="""SELECT query_id, neighbour_id, label, round(distance, 6) AS distance, rank
  FROM neighbours"""))
def knn_exact(spark: SparkSession, sf: str) -> DataFrame:
    queries, stored = _neighbour_inputs(spark, sf)
    found = neighbors.knn_exact(queries, stored)
    return rounded(found.withColumn("rank", F.col("rank").cast("long")), "distance")


def _index(spark: SparkSession, stored: DataFrame) -> str:
    root = scratch_path(spark, "index")
    inverted.build(stored, root)
    return root


@query()
def knn_ivf(spark: SparkSession, sf: str) -> DataFrame:
    """Search of a stored index that visits as many lists as were measured."""
    queries, stored = _neighbour_inputs(spark, sf)
    return rounded(inverted.search(queries, _index(spark, stored)), "distance")


@query(with_(A.VECTORS, NEIGHBOURS, select="""SELECT count(DISTINCT query_id) AS queries, count(*) AS neighbours, true AS recall_reached
  FROM neighbours"""))
def ivf_recall(spark: SparkSession, sf: str) -> DataFrame:
    """All rows as queries: whether nine tenths of the exact neighbours are found."""
    queries, stored = _neighbour_inputs(spark, sf)
    exact = neighbors.knn_exact(queries, stored).select("query_id", "neighbour_id")
    found = inverted.search(queries, _index(spark, stored)).select("query_id", "neighbour_id", F.lit(1).alias("hit"))
    return exact.join(found, ["query_id", "neighbour_id"], "left").agg(
        F.count_distinct("query_id").alias("queries"), F.count("*").alias("neighbours"),
        (F.count("hit") >= 0.9 * F.count("*")).alias("recall_reached"))


@query(with_(A.VECTORS, NEIGHBOURS, select="""SELECT query_id, neighbour_id, label, round(distance, 6) AS distance, rank
  FROM neighbours"""))
def ivf_insert(spark: SparkSession, sf: str) -> DataFrame:
    """An index of a third of the rows that takes the others later, searched in all its lists."""
    queries, stored = _neighbour_inputs(spark, sf)
    root = _index(spark, stored.where(F.pmod(F.xxhash64("id"), F.lit(3)) == 0))
    inverted.insert(spark, root, stored)
    found = inverted.search(queries, root, probes=inverted.LISTS)
    return rounded(found.withColumn("rank", F.col("rank").cast("long")), "distance")


@query(with_(A.VECTORS, NEIGHBOURS, VOTED, select="SELECT article_id, event_id, round(distance, 6) AS distance FROM voted"))
def knn_assign(spark: SparkSession, sf: str) -> DataFrame:
    queries, stored = _neighbour_inputs(spark, sf)
    return rounded(neighbors.knn_assign(queries, stored, threshold=THRESHOLD), "distance")


POINTS = "SELECT article_id AS id, embedding FROM vectors"
REST = POINTS + " WHERE article_id NOT IN (SELECT article_id FROM voted)"


def event_sql(cluster: str) -> str:
    return A.uuid_sql(f"'event:' || {cluster} || ':{A.RUN_DATE}'")


ASSIGNED = [A.VECTORS, NEIGHBOURS, VOTED, *clusters.density(REST, 2, 1), f"""assigned AS (
  SELECT article_id, event_id, 'knn' AS cluster_method, distance FROM voted
  UNION ALL SELECT id, {event_sql("coalesce(label, id)")}, CASE WHEN label IS NULL THEN 'single' ELSE 'hdbscan_new' END, 0.0 FROM found)"""]


@query(with_(A.VECTORS, *clusters.spanning_tree(POINTS, 1), select="""SELECT p.id AS lo, q.id AS hi, round(w, 6) AS w
  FROM mst JOIN pts p ON p.i = mst.a JOIN pts q ON q.i = mst.b"""))
def spanning_forest(spark: SparkSession, sf: str) -> DataFrame:
    """The edges that single linkage of all vectors merges by."""
    points = A.vectors(spark, sf).select(F.col("article_id").alias("id"), "embedding", F.lit(0.0).alias("core"))
    return rounded(linkage.spanning_forest(density.mst_edges(points, 128), 256), "w")


@query(with_(A.VECTORS, *clusters.density(POINTS, 2, 1), select=f"""SELECT id AS article_id, {event_sql("label")} AS event_id
  FROM found WHERE label IS NOT NULL"""))
def hdbscan_new(spark: SparkSession, sf: str) -> DataFrame:
    return density.hdbscan_new(A.vectors(spark, sf).select("article_id", "embedding"), A.RUN_DATE)


@query(with_(A.VECTORS, *clusters.density(POINTS, 3, 2), select=f"""SELECT id AS article_id,
  CASE WHEN label IS NOT NULL THEN {event_sql("label")} END AS event_id,
  CASE WHEN label IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY label NULLS LAST) - 1 END::INT AS cluster_label,
  round(share, 6) AS cluster_probability FROM found"""))
def hdbscan_soft(spark: SparkSession, sf: str) -> DataFrame:
    found = density.hdbscan_soft(A.vectors(spark, sf).select("article_id", "embedding"), A.RUN_DATE)
    return rounded(found, "cluster_probability")


@query(with_(A.VECTORS, A.ARTICLES, select=f"""SELECT v.article_id,
  {A.uuid_sql(f"'event:' || v.article_id || ':{A.RUN_DATE}'")} AS event_id
  FROM vectors v WHERE v.article_id NOT IN (SELECT article_id FROM articles WHERE language = 'en')"""))
def single_events(spark: SparkSession, sf: str) -> DataFrame:
    return assign.single_events(A.vectors(spark, sf), A.articles(spark, sf).where("language = 'en'"), A.RUN_DATE)


def _assignments(spark: SparkSession, sf: str) -> DataFrame:
    v = A.vectors(spark, sf)
    return assign.cluster_assignments(v.select("article_id", "embedding"), v, A.RUN_DATE, THRESHOLD)


@query(with_(*ASSIGNED, select="SELECT article_id, event_id, cluster_method, round(distance, 6) AS distance FROM assigned"))
def cluster_assignments(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_assignments(spark, sf), "distance")


@query(f"""WITH batch AS (SELECT ts FROM events WHERE event_type = 'error')
  SELECT e.event_id FROM events e WHERE EXISTS (
    SELECT 1 FROM batch b WHERE b.ts BETWEEN e.ts - INTERVAL 180 SECOND AND e.ts + INTERVAL 180 SECOND)""")
def window_candidates(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.table(spark, sf, "events").withColumnRenamed("ts", "published_at")
    found = neighbors.window_candidates(rows, rows.where("event_type = 'error'"), hours=0.05)
    return found.select("event_id")


@query(with_(A.VECTORS, """nearest AS (
  SELECT a.article_id, min(list_distance(a.embedding, b.embedding)) AS d
  FROM vectors a JOIN vectors b ON a.event_id = b.event_id AND a.article_id <> b.article_id GROUP BY 1)""",
             select="""SELECT count(*) AS article_count, round(avg(d), 6) AS mean_distance,
  round(quantile_cont(d, 0.5), 6) AS median, round(quantile_cont(d, 0.9), 6) AS p90,
  round(quantile_cont(d, 0.95), 6) AS p95 FROM nearest"""))
def cluster_nn_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(neighbors.cluster_nn_stats(A.vectors(spark, sf)), "mean_distance", "median", "p90", "p95")


@query(with_(*ASSIGNED, select="""SELECT cluster_method, count(*) AS article_count, count(DISTINCT event_id) AS event_count
  FROM assigned GROUP BY 1"""))
def cluster_report(spark: SparkSession, sf: str) -> DataFrame:
    return assign.cluster_report(_assignments(spark, sf))


# --- Joins and merges --------------------------------------------------------------


@query(with_(A.ARTICLES, A.REVISIONS, select="""SELECT article_id, url, body FROM revisions
  QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY pos DESC) = 1"""))
def last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return merge.last_wins(A.revisions(A.articles(spark, sf)), "article_id").select("article_id", "url", "body")


@query(with_(*ALL_JOINED, select=f"""SELECT article_id, source_name, url, title, body, language,
  {time_sql('published_at')} AS published_at, scraped_at, bias_label, round(bias_confidence, 6) AS bias_confidence,
  round(p[3], 6) AS center, round(list_sum(embedding), 6) AS total, event_id FROM joined"""))
def join_outputs(spark: SparkSession, sf: str) -> DataFrame:
    center = F.get_json_object("bias_scores", "$.center").cast("double")
    rows = _times(_joined(spark, sf), "published_at").withColumns({
        "center": center, "total": F.when(F.col("embedding").isNotNull(), vectors.total(F.col("embedding")))})
    return rounded(rows.drop("bias_scores", "embedding"), "bias_confidence", "center", "total")


@query(with_(A.ARTICLES, CLEANED, A.VECTORS, ASSIGNED_EVENTS, select="SELECT * FROM new_events"))
def event_stats(spark: SparkSession, sf: str) -> DataFrame:
    return merge.event_stats(_assigned(spark, sf), _cleaned(spark, sf))


@query(with_(A.ARTICLES, A.STORED, """held AS (
  SELECT source_name, 'rss' AS source_type FROM stored WHERE language = 'fr' GROUP BY 1)""",
             select="""SELECT source_name, source_type FROM held
  UNION ALL SELECT DISTINCT source, 'html' FROM articles WHERE source NOT IN (SELECT source_name FROM held)"""))
def upsert_sources(spark: SparkSession, sf: str) -> DataFrame:
    held = A.stored_articles(spark, sf).where("language = 'fr'").select("source_name").distinct()
    return merge.upsert_sources(held.withColumn("source_type", F.lit("rss")), A.articles(spark, sf))


@query(with_(A.ARTICLES, CLEANED, A.VECTORS, A.STORED, ASSIGNED_EVENTS, STORED_EVENTS, select=f"""SELECT
  coalesce(o.event_id, n.event_id) AS event_id,
  coalesce(o.article_count, 0) + coalesce(n.article_count, 0) AS article_count,
  greatest(o.source_count, n.source_count) AS source_count, {time_sql('o.window_start')} AS window_start
  FROM stored_events o FULL JOIN new_events n ON n.event_id = o.event_id"""))
def upsert_events(spark: SparkSession, sf: str) -> DataFrame:
    new = merge.event_stats(_assigned(spark, sf), _cleaned(spark, sf))
    return _times(merge.upsert_events(_stored_events(spark, sf), new), "window_start")


@query(with_(*ALL_JOINED, A.STORED, select=f"""SELECT coalesce(o.article_id, n.article_id) AS article_id,
  CASE WHEN o.article_id IS NULL THEN n.source_name ELSE o.source_name END AS source_name,
  CASE WHEN o.article_id IS NULL THEN n.title ELSE o.title END AS title,
  CASE WHEN o.article_id IS NULL THEN n.body ELSE o.body END AS body,
  {time_sql('CASE WHEN o.article_id IS NULL THEN n.published_at ELSE o.published_at END')} AS published_at,
  coalesce(n.bias_label, o.bias_label) AS bias_label,
  round(coalesce(n.bias_confidence, o.bias_confidence), 6) AS bias_confidence,
  coalesce(n.event_id, o.event_id) AS event_id
  FROM stored o FULL JOIN joined n ON n.article_id = o.article_id"""))
def upsert_articles(spark: SparkSession, sf: str) -> DataFrame:
    merged = _times(merge.upsert_articles(A.stored_articles(spark, sf), _joined(spark, sf)), "published_at")
    return rounded(merged.select("article_id", "source_name", "title", "body", "published_at", "bias_label",
                                 "bias_confidence", "event_id"), "bias_confidence")


@query(with_(*ALL_JOINED, A.STORED, select=f"""SELECT coalesce(o.article_id, n.article_id) AS article_id,
  CASE WHEN n.article_id IS NULL THEN o.title ELSE n.title END AS title,
  CASE WHEN n.article_id IS NULL THEN o.bias_label ELSE n.bias_label END AS bias_label,
  CASE WHEN n.article_id IS NULL THEN o.event_id ELSE n.event_id END AS event_id,
  {time_sql('o.published_at')} AS created_at
  FROM stored o FULL JOIN joined n ON n.article_id = o.article_id"""))
def load_full_replace(spark: SparkSession, sf: str) -> DataFrame:
    stored = A.stored_articles(spark, sf).withColumnRenamed("published_at", "created_at")
    incoming = _joined(spark, sf).select("article_id", "title", "bias_label", "event_id")
    held = stored.select("article_id", "title", "bias_label", "event_id", "created_at")
    return _times(merge.load_full_replace(held, incoming, "article_id"), "created_at")


@query(with_(*ALL_JOINED, ASSIGNED_EVENTS, """broken AS (SELECT * REPLACE (
  CASE WHEN language = 'fr' THEN NULL ELSE title END AS title, source_name || bias_label AS event_id) FROM joined),
kept AS (SELECT DISTINCT source AS source_name FROM articles WHERE language = 'en')""",
             select="""SELECT 'sources_primary_key' AS check_name, 0::BIGINT AS violations
  UNION ALL SELECT 'events_primary_key', 0
  UNION ALL SELECT 'articles_primary_key', count(*) FROM (SELECT article_id FROM broken GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'articles_unique_url', count(*) FROM (SELECT url FROM broken GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'sources_not_null', 0 UNION ALL SELECT 'events_not_null', 0
  UNION ALL SELECT 'articles_not_null', count(*) FROM broken WHERE title IS NULL
  UNION ALL SELECT 'articles_source_exists', count(*) FROM broken
    WHERE source_name NOT IN (SELECT source_name FROM kept)
  UNION ALL SELECT 'articles_event_exists', count(*) FROM broken
    WHERE event_id IS NOT NULL AND event_id NOT IN (SELECT event_id FROM new_events)
  UNION ALL SELECT 'articles_embedding_dim', count(*) FROM broken WHERE len(embedding) <> 32"""))
def integrity_checks(spark: SparkSession, sf: str) -> DataFrame:
    # Stands for the stored table, which every check reads.
    rows = durable(_joined(spark, sf)).withColumns({
        "title": F.when(F.col("language") != "fr", F.col("title")),
        "event_id": F.concat("source_name", "bias_label")})
    known = A.articles(spark, sf).where("language = 'en'").select(F.col("source").alias("source_name")).distinct()
    found = merge.event_stats(_assigned(spark, sf), _cleaned(spark, sf))
    return merge.integrity_checks(known.withColumn("source_type", F.lit("html")), found, rows, 32)


# --- Corpus load -------------------------------------------------------------------


@query(with_(A.ARTICLES, A.VECTORS, A.CORPUS, select="SELECT article_id, cluster_id, event_id FROM corpus_events"))
def corpus_events(spark: SparkSession, sf: str) -> DataFrame:
    return _corpus(spark, sf).select("article_id", "cluster_id", "event_id")


CORPUS_STATS = """stats AS (
  SELECT event_id, NULL::VARCHAR AS summary, NULL::VARCHAR AS topic,
         CASE WHEN cluster_id = -1 THEN 1 ELSE count(*) END AS article_count,
         CASE WHEN cluster_id = -1 THEN 1 ELSE count(DISTINCT publisher) END AS source_count,
         strftime(min(published_at), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(max(published_at), '%Y-%m-%d %H:%M:%S') AS window_end
  FROM corpus_events GROUP BY event_id, cluster_id)"""


@query(with_(A.ARTICLES, A.VECTORS, A.CORPUS, CORPUS_STATS, select="SELECT * FROM stats"))
def corpus_event_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _times(corpus.corpus_event_stats(_corpus(spark, sf)), "window_start", "window_end")


@query(with_(A.ARTICLES, A.VECTORS, A.CORPUS, A.STORED, select="""SELECT article_id, source_name, title FROM stored
  UNION ALL SELECT article_id, publisher, title FROM corpus
  WHERE article_id NOT IN (SELECT article_id FROM stored)"""))
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    held = A.stored_articles(spark, sf).select("article_id", "source_name", "title")
    incoming = corpus.corpus_articles(_corpus(spark, sf)).select("article_id", "source_name", "title")
    return merge.insert_if_absent(held, incoming, "article_id")


@query(with_(A.ARTICLES, A.VECTORS, A.CORPUS, select=f"""SELECT article_id, publisher AS source_name, url, title,
  text AS body, 'si' AS language, {time_sql('published_at')} AS published_at, bias_label, event_id,
  round(list_sum(embedding), 6) AS total FROM corpus_events"""))
def corpus_articles(spark: SparkSession, sf: str) -> DataFrame:
    rows = _times(corpus.corpus_articles(_corpus(spark, sf)), "published_at")
    return rounded(rows.withColumn("total", vectors.total(F.col("embedding"))).select(
        "article_id", "source_name", "url", "title", "body", "language", "published_at", "bias_label", "event_id",
        "total"), "total")


# --- Digests and topics ------------------------------------------------------------

MEMBERS = """members AS (
  SELECT v.event_id, v.article_id, v.pos, a.source, a.title, a.body
  FROM vectors v JOIN articles a ON a.article_id = v.article_id WHERE v.event_id IS NOT NULL)"""


def _members(spark: SparkSession, sf: str) -> DataFrame:
    return digest.event_members(_assigned(spark, sf), A.articles(spark, sf))


@query(with_(A.ARTICLES, A.VECTORS, MEMBERS, select="SELECT event_id, article_id, pos, source, title, body FROM members"))
def event_members(spark: SparkSession, sf: str) -> DataFrame:
    return _members(spark, sf).select("event_id", "article_id", "pos", "source", "title", "body")


@query(with_(A.ARTICLES, A.VECTORS, MEMBERS, """first AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY pos) AS n, count(*) OVER (PARTITION BY event_id) AS c
  FROM members)""", select="""SELECT event_id, any_value(c) AS article_count,
  string_agg('[Source: ' || source || ']' || chr(10) || title || chr(10) || substr(body, 1, 1500), chr(10) || chr(10)
             ORDER BY n) AS articles_block
  FROM first WHERE n <= 10 GROUP BY event_id"""))
def event_digest(spark: SparkSession, sf: str) -> DataFrame:
    return digest.event_digest(_members(spark, sf))


SUMMARY_COUNTS = """counts AS (
  SELECT event_id, count(*) AS article_count, count(DISTINCT source) AS source_count FROM members GROUP BY event_id)"""


@query(with_(A.ARTICLES, A.VECTORS, MEMBERS, SUMMARY_COUNTS, select="SELECT * FROM counts"))
def event_summary_counts(spark: SparkSession, sf: str) -> DataFrame:
    return digest.event_summary_counts(_members(spark, sf))


TOPIC_LIST = ", ".join(f"'{t}'" for t in labels.TOPICS)
PROPOSED = [" Politics ", "SPORTS\n", "weather", "climate"]
PROPOSED_SQL = "[' Politics ', 'SPORTS' || chr(10), 'weather', 'climate']"
# A proposal per article, picked by the last hex digit of its id.
PICK_SQL = f"({PROPOSED_SQL})[strpos('0123456789abcdef', substr(article_id, 24, 1)) % 4 + 1]"
TOPICS = f"""proposed AS (SELECT article_id AS event_id, {PICK_SQL} AS topic FROM articles),
valid AS (SELECT event_id, CASE WHEN t IN ({TOPIC_LIST}) THEN t ELSE 'other' END AS topic
  FROM (SELECT event_id, lower(regexp_replace(topic, '\\A{SPACE}+|{SPACE}+\\z', '', 'g')) AS t FROM proposed))"""


def _proposed(spark: SparkSession, sf: str) -> DataFrame:
    digit = F.conv(F.substring("article_id", 24, 1), 16, 10).cast("int") + 1
    return A.articles(spark, sf).select(
        F.col("article_id").alias("event_id"),
        F.element_at(F.array(*[F.lit(p) for p in PROPOSED]), (digit % 4 + 1).cast("int")).alias("topic"))


@query(with_(A.ARTICLES, TOPICS, select="SELECT event_id, topic FROM valid"))
def topic_validate(spark: SparkSession, sf: str) -> DataFrame:
    return digest.topic_validate(_proposed(spark, sf))


@query(with_(A.ARTICLES, A.VECTORS, TOPICS, select="""SELECT v.article_id AS event_id, v.pos,
  coalesce(t.topic, 'other') AS topic FROM vectors v LEFT JOIN valid t ON t.event_id = v.article_id"""))
def event_topics(spark: SparkSession, sf: str) -> DataFrame:
    summaries = A.vectors(spark, sf).select(F.col("article_id").alias("event_id"), "pos")
    return digest.event_topics(summaries, digest.topic_validate(_proposed(spark, sf)))


# --- Reads -------------------------------------------------------------------------


def _event_of(label: int) -> Column:
    return ids.uuid_from(F.lit("cluster"), F.lit(str(label)))


@query(with_(*ALL_JOINED, select=f"""SELECT article_id, source_name, title FROM joined
  WHERE event_id = {A.uuid_sql("'cluster:3'")}"""))
def articles_for_event(spark: SparkSession, sf: str) -> DataFrame:
    event = spark.range(1).select(_event_of(3)).first()[0]
    return reads.articles_for_event(_joined(spark, sf), event).select("article_id", "source_name", "title")


@query(with_(A.ARTICLES, select=f"""SELECT article_id, title, {time_sql('published_at')} AS published_at FROM articles
  ORDER BY articles.published_at DESC NULLS LAST, article_id LIMIT 20"""))
def latest_articles(spark: SparkSession, sf: str) -> DataFrame:
    return _times(reads.latest_articles(A.articles(spark, sf), 20), "published_at").select(
        "article_id", "title", "published_at")


@query("SELECT source AS source_name, count(*) AS article_count FROM documents GROUP BY source")
def articles_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return reads.articles_by_source(A.articles(spark, sf).withColumnRenamed("source", "source_name"))


@query(with_(*ALL_JOINED, select="""SELECT event_id, count(DISTINCT source_name) AS source_count FROM joined
  WHERE event_id IS NOT NULL GROUP BY event_id"""))
def event_source_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return reads.event_source_coverage(_joined(spark, sf))


@query(with_(A.VECTORS, MEANS, select="""SELECT article_id, round(list_distance(embedding, c), 6) AS distance
  FROM vectors, centroid ORDER BY list_distance(embedding, c), article_id LIMIT 10"""))
def similar_articles(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reads.similar_articles(A.vectors(spark, sf), _centroid(spark, sf), 10), "distance")


@query(with_(A.ARTICLES, TOPICS, select="SELECT event_id, topic FROM valid WHERE topic = 'sports'"))
def events_by_topic(spark: SparkSession, sf: str) -> DataFrame:
    return reads.events_by_topic(digest.topic_validate(_proposed(spark, sf)), "sports")


@query(with_(A.ARTICLES, A.VECTORS, A.CORPUS, CORPUS_STATS, select="""SELECT event_id, window_start, window_end FROM stats
  WHERE window_start <= '2024-01-01 20:00:00' AND window_end >= '2024-01-01 06:00:00'"""))
def events_in_window(spark: SparkSession, sf: str) -> DataFrame:
    stats = corpus.corpus_event_stats(_corpus(spark, sf))
    found = reads.events_in_window(stats, "2024-01-01 06:00:00", "2024-01-01 20:00:00")
    return _times(found, "window_start", "window_end").select("event_id", "window_start", "window_end")


@query(with_(A.VECTORS, A.LOGITS, A.SCORES, A.BIAS, select="""SELECT article_id, round(p[2], 6) AS score FROM bias
  WHERE p[2] > 0.25"""))
def bias_score_filter(spark: SparkSession, sf: str) -> DataFrame:
    found = reads.bias_score_filter(_bias(spark, sf), "left", 0.25)
    return found.select("article_id", F.round(F.element_at("bias_scores", "left"), 6).alias("score"))


COUNTED = ("documents", "embeddings", "pages", "labels", "events", "conversations")


@query("\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED))
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reads.row_counts({name: A.table(spark, sf, name) for name in COUNTED})


@query("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, count({c}) AS non_null,"
    f" count(DISTINCT {c}) AS distinct_values FROM documents"
    for c, t in [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                 ("n_chars", "bigint")]))
def profile_table(spark: SparkSession, sf: str) -> DataFrame:
    return reads.profile_table(A.table(spark, sf, "documents"))


# --- Incremental -------------------------------------------------------------------


@query(with_(A.ARTICLES, CLEANED, select="SELECT article_id, source AS source_name, title, body FROM cleaned"))
def incremental_run(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files through the whole run; the second call finds nothing new."""
    raw, root, checkpoint = _raw_folder(spark, sf), scratch_path(spark, "warehouse"), scratch_path(spark, "stream")
    for _ in range(2):
        incremental.incremental_run(spark, f"{raw}/raw", root, checkpoint, A.RUN_DATE, A.LOADED_AT)
    return warehouse.read_table(spark, root, "articles").select("article_id", "source_name", "title", "body")


@query(with_(A.ARTICLES, A.REVISIONS, select="SELECT DISTINCT article_id FROM revisions"))
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    root, out, checkpoint = (scratch_path(spark, n) for n in ("stages", "deduped", "stream"))
    rows = A.revisions(A.articles(spark, sf)).drop("published_at")
    stage.write_stage(rows.repartition(4), root, "raw", A.RUN_DATE)
    unique = incremental.stream_dedup(incremental.raw_stream(spark, f"{root}/raw", max_files=2))
    run = unique.select("article_id").writeStream.format("parquet").option("checkpointLocation", checkpoint)
    run.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema("article_id string").parquet(out)
