"""One-time load of an annotated corpus (cluster_id -1 marks noise)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.functions import ids

NOISE = -1


def corpus_events(corpus: DataFrame) -> DataFrame:
    """Add the event id: one per cluster, and one per noise article."""
    noise = ids.uuid_from(F.lit("noise"), F.col("article_id"))
    cluster = ids.uuid_from(F.lit("cluster"), F.col("cluster_id").cast("string"))
    return corpus.withColumn("event_id", F.when(F.col("cluster_id") == NOISE, noise).otherwise(cluster))


def corpus_event_stats(with_events: DataFrame) -> DataFrame:
    """Events with counts and publication span. A noise event has one article and one
    source even if its publisher is unknown."""
    noise = F.col("cluster_id") == NOISE
    stats = with_events.groupBy("event_id", noise.alias("noise")).agg(
        F.count("*").alias("article_count"),
        F.count_distinct("publisher").alias("publishers"),
        F.min("published_at").alias("window_start"),
        F.max("published_at").alias("window_end"),
    )
    return stats.select(
        "event_id",
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("string").alias("topic"),
        F.when(F.col("noise"), F.lit(1)).otherwise(F.col("article_count")).alias("article_count"),
        F.when(F.col("noise"), F.lit(1)).otherwise(F.col("publishers")).alias("source_count"),
        "window_start",
        "window_end",
    )


def corpus_articles(with_events: DataFrame, language: str = "si") -> DataFrame:
    """Articles in warehouse shape; scores and scrape time are unknown."""
    return with_events.select(
        "article_id",
        F.col("publisher").alias("source_name"),
        "url",
        "title",
        F.col("text").alias("body"),
        F.lit(language).alias("language"),
        "published_at",
        F.lit(None).cast("timestamp").alias("scraped_at"),
        "bias_label",
        F.lit(None).cast("double").alias("bias_confidence"),
        F.lit(None).cast("map<string,double>").alias("bias_scores"),
        "embedding",
        "event_id",
    )
