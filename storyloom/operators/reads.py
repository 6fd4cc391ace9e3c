"""Queries over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.functions import vectors


def articles_for_event(articles: DataFrame, event_id: str) -> DataFrame:
    return articles.where(F.col("event_id") == event_id)


def latest_articles(articles: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest articles; unknown dates come last, ties go by id."""
    return articles.orderBy(F.desc_nulls_last("published_at"), "article_id").limit(n)


def articles_by_source(articles: DataFrame) -> DataFrame:
    return articles.groupBy("source_name").agg(F.count("*").alias("article_count"))


def event_source_coverage(articles: DataFrame) -> DataFrame:
    known = articles.where("event_id IS NOT NULL")
    return known.groupBy("event_id").agg(F.count_distinct("source_name").alias("source_count"))


def similar_articles(articles: DataFrame, query: list[float], k: int) -> DataFrame:
    """The ``k`` stored articles nearest to one vector."""
    target = F.array(*[F.lit(float(x)) for x in query])
    distance = vectors.l2_distance(F.col("embedding"), target)
    scored = articles.where("embedding IS NOT NULL").select("article_id", distance.alias("distance"))
    return scored.orderBy("distance", "article_id").limit(k)


def events_by_topic(events: DataFrame, topic: str) -> DataFrame:
    return events.where(F.col("topic") == topic)


def events_in_window(events: DataFrame, start: str, end: str) -> DataFrame:
    """Events whose window meets [start, end]; an unknown window meets nothing."""
    return events.where(
        (F.col("window_start") <= F.lit(end).cast("timestamp")) & (F.col("window_end") >= F.lit(start).cast("timestamp")))


def bias_score_filter(articles: DataFrame, label: str, above: float) -> DataFrame:
    return articles.where(F.element_at("bias_scores", label) > above)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def profile_table(df: DataFrame) -> DataFrame:
    """Per column: type, rows, non-null rows, distinct values. Each column is counted
    on its own, so no job expands the rows once per column."""
    total = []
    for name, kind in df.dtypes:
        per_value = df.groupBy(F.col(name).alias("v")).count()
        total.append(per_value.agg(
            F.coalesce(F.sum("count"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("count"))), F.lit(0)).alias("non_null"),
            F.count("v").alias("distinct_values"),
        ).select(F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"), "row_count", "non_null",
                 "distinct_values"))
    result = total[0]
    for part in total[1:]:
        result = result.unionByName(part)
    return result


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, as rows."""
    return df.select(column).distinct()
