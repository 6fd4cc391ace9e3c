"""Curating the documents table: quality, near duplicates, repeated passages, packing.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of
``documents``; ``run`` writes every stage's result as Parquet to the shared folder and reads
it again as the next stage's documents.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import neardup, packing, quality, substrings
from storyloom.llm.queries import VOCABULARY
from storyloom.session import durable, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level quality rules keep; each row is judged by itself,
    also without an id or with one that others have."""
    row = F.xxhash64("doc_id", "text", "source")
    kept = quality.judge(docs.withColumn("row", row), id_column="row").filter("kept").select(F.col("doc_id").alias("row")).distinct()
    return docs.withColumn("row", row).join(kept, "row", "left_semi").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id, and one row of
    those that repeat it. Rows without an id, and rows that share one, are told apart by
    their texts; against a row with an id of its own they give way."""
    docs = docs.select(*COLUMNS)
    odd = durable(docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL").select("doc_id", F.lit(True).alias("odd")))
    if odd.isEmpty():
        drop = neardup.near_duplicates(docs).filter("NOT keeper").select("doc_id")
        return docs.join(drop, "doc_id", "left_anti").select(*COLUMNS)
    # Such a row is numbered by its text, above any usual id; the rows are read several times, so that is
    # written once.
    number = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).bitwiseOR(F.lit(1 << 62))
    path = scratch_path(spark, "rows")
    marked = docs.join(odd, "doc_id", "left").withColumn("row", F.when(F.col("doc_id").isNull() | F.col("odd"), number).otherwise(F.col("doc_id")))
    marked.write.parquet(path)
    marked = spark.read.parquet(path)
    drop = neardup.near_duplicates(marked.select(F.col("row").alias("doc_id"), "text")).filter("NOT keeper").select(F.col("doc_id").alias("row"))
    return marked.join(drop, "row", "left_anti").dropDuplicates(["row"]).select(*COLUMNS)


# Passages of over 50 words are what this stage is for. They can be short of the 400 bytes of
# ``repeated_spans`` (51 words of four letters are 255), so it cuts shorter strings.
PASSAGE_BYTES, PASSAGE_SPAN = 250, 100


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages of ``PASSAGE_BYTES`` or more. A character that
    loses some of its bytes goes whole; a document that loses every byte goes. Rows that repeat
    an id are cut one by one; a null text stays null."""
    given = docs.withColumn("no_text", F.col("text").isNull())
    cut = substrings.repeated_spans(given, PASSAGE_BYTES, PASSAGE_SPAN, ("lang", "source", "n_chars", "no_text"), characters=True)
    cut = cut.filter("n_bytes = 0 OR length(kept) > 0")
    text = F.when(F.col("no_text"), F.lit(None)).otherwise(F.col("kept").cast("string"))
    shorter = F.size("spans") > 0
    return cut.withColumn("text", text).withColumn("n_chars", F.when(shorter, F.length("text")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 1024 tokens."""
    return packing.digest(packing.pack(docs, VOCABULARY))


STAGES = [("quality rules", quality_stage), ("MinHash near-dedup", near_duplicate_stage),
          ("suffix-array dedup", repeated_passage_stage), ("packing", packing_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
