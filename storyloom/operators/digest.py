"""Inputs and checked outputs of event summaries and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions.labels import TOPICS, label_array
from storyloom.functions.text import strip

DIGEST_ARTICLES = 10
DIGEST_CHARS = 1500


def event_members(assignments: DataFrame, articles: DataFrame) -> DataFrame:
    """Articles with their event. ``pos`` is the order of the assignments."""
    known = articles.select("article_id", "source", "title", "body")
    return assignments.where("event_id IS NOT NULL").select("event_id", "article_id", "pos").join(known, "article_id")


def unknown_members(assignments: DataFrame, articles: DataFrame) -> DataFrame:
    """Assignments whose article does not exist."""
    return assignments.where("event_id IS NOT NULL").join(articles.select("article_id"), "article_id", "left_anti")


def event_digest(members: DataFrame, articles: int = DIGEST_ARTICLES, chars: int = DIGEST_CHARS) -> DataFrame:
    """The text handed to a summariser: the excerpts of the first articles of an event
    and the number of all its articles. The rank filter is applied before the shuffle,
    so a task holds at most ``articles`` rows of an event."""
    excerpt = F.concat(
        F.lit("[Source: "), F.col("source"), F.lit("]\n"), F.col("title"), F.lit("\n"), F.substring("body", 1, chars))
    order = Window.partitionBy("event_id").orderBy("pos")
    first = members.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= articles)
    blocks = first.groupBy("event_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", excerpt.alias("text")))),
                                 lambda row: row["text"]), "\n\n").alias("articles_block"))
    counts = members.groupBy("event_id").agg(F.count("*").alias("article_count"))
    return blocks.join(counts, "event_id").select("event_id", "article_count", "articles_block")


def event_summary_counts(members: DataFrame) -> DataFrame:
    return members.groupBy("event_id").agg(
        F.count("*").alias("article_count"), F.count_distinct("source").alias("source_count"))


def topic_validate(proposed: DataFrame, taxonomy: list[str] = TOPICS) -> DataFrame:
    """Trimmed lower-case topics; one outside the taxonomy becomes ``other``."""
    topic = F.lower(strip(F.col("topic")))
    valid = F.array_contains(label_array(taxonomy), topic)
    return proposed.withColumn("topic", F.when(valid, topic).otherwise("other"))


def event_topics(summaries: DataFrame, topics: DataFrame) -> DataFrame:
    """Summaries with their topic, ``other`` where none was assigned."""
    joined = summaries.join(topics.select("event_id", "topic"), "event_id", "left")
    return joined.withColumn("topic", F.coalesce("topic", F.lit("other")))
