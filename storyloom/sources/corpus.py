"""The annotated corpus: a parquet file with loosely typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyloom.functions.labels import slug


def corpus_columns(df: DataFrame) -> DataFrame:
    """Embeddings stored as text become arrays, labels lower case with underscores,
    and dates that cannot be read become NULL."""
    if isinstance(df.schema["embedding"].dataType, T.StringType):
        df = df.withColumn("embedding", F.from_json("embedding", "array<double>"))
    return df.withColumns({
        "bias_label": slug(F.col("bias_label")),
        "published_at": F.col("published_at").try_cast("timestamp"),
    })


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return corpus_columns(spark.read.parquet(path))
