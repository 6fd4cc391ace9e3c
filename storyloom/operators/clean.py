"""Cleaning and duplicate removal over articles with an explicit order ``pos``.

The first-row windows filter on ``row_number() = 1``. Spark plans that as a
``WindowGroupLimit`` before the shuffle, so a map task sends at most one row per key
and a key that holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions import text
from storyloom.session import durable

MIN_BODY_CHARS = 50
SHINGLE_CHARS = 300


def pick_one(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def normalize_text(df: DataFrame) -> DataFrame:
    """Normalised title and body. inline() computes each text once: without it a filter
    on the result is pushed down and repeats the work."""
    names = ("title", "body")
    composed = df.withColumns({name: text.nfc(F.col(name)) for name in names})
    tidied = F.struct(*[text.tidy(F.col(name)).alias(name) for name in names])
    rest = [c for c in df.columns if c not in names]
    return composed.select(*rest, F.inline(F.array(tidied))).select(*df.columns)


def min_body_filter(df: DataFrame, min_chars: int = MIN_BODY_CHARS) -> DataFrame:
    return df.where(F.length("body") >= min_chars)


def dedup_exact(df: DataFrame) -> DataFrame:
    """The first row of each article id."""
    return pick_one(df, F.col("article_id"), F.col("pos"))


def dedup_prefix(df: DataFrame, chars: int = SHINGLE_CHARS) -> DataFrame:
    """The first row of each prefix shingle."""
    return pick_one(df, text.prefix_shingle(F.col("body"), chars), F.col("pos"))


def clean_articles(df: DataFrame, min_chars: int = MIN_BODY_CHARS) -> DataFrame:
    """Normalise, drop short bodies, then remove repeats of an id and of a prefix.
    Short rows go first, so they never claim an id; a row removed for its id never
    claims a prefix."""
    return dedup_prefix(dedup_exact(min_body_filter(normalize_text(df), min_chars)))


def near_duplicate_ids(df: DataFrame, chars: int = SHINGLE_CHARS) -> DataFrame:
    """Ids whose prefix occurs in an earlier row. Only (id, pos, shingle) is shuffled;
    the first row of each shingle comes from an aggregate with a map-side part."""
    rows = df.select("article_id", "pos", text.prefix_shingle(F.col("body"), chars).alias("shingle"))
    first = rows.groupBy("shingle").agg(F.min("pos").alias("pos")).select("pos")
    return rows.join(first, "pos", "left_anti").select("article_id").distinct()


def language_filter(df: DataFrame, allowed: list[str]) -> DataFrame:
    return df.where(F.col("language").isin(*allowed))


def cleaning_report(raw: DataFrame, min_chars: int = MIN_BODY_CHARS) -> DataFrame:
    """Rows in and out, rows removed as short or repeated, invisible characters. The
    texts are read once; the duplicate rules then run over what they need of them: id,
    position, length and the characters that form the shingle."""
    invisible = text.invisible_count(F.col("title")) + text.invisible_count(F.col("body"))
    normal = normalize_text(raw.select("article_id", "pos", "title", "body", invisible.alias("invisible")))
    narrow = durable(normal.select(
        "article_id", "pos", "invisible", F.length("body").alias("chars"),
        F.substring("body", 1, SHINGLE_CHARS).alias("body")))
    kept = dedup_prefix(dedup_exact(narrow.where(F.col("chars") >= min_chars)))
    marks = narrow.select(
        F.lit(1).alias("row"), F.when(F.col("chars") < min_chars, 1).otherwise(0).alias("short"), F.lit(0).alias("kept"),
        "invisible").unionByName(kept.select(
            F.lit(0).alias("row"), F.lit(0).alias("short"), F.lit(1).alias("kept"), F.lit(0).alias("invisible")))
    totals = marks.agg(
        F.coalesce(F.sum("row"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("short"), F.lit(0)).alias("rows_short"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("rows_out"),
        F.coalesce(F.sum("invisible"), F.lit(0)).alias("invisible_chars"),
        F.count_if(F.col("invisible") > 0).alias("invisible_rows"),
    )
    repeated = F.col("rows_in") - F.col("rows_short") - F.col("rows_out")
    return totals.withColumn("rows_repeated", repeated)
