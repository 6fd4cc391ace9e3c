"""Connected components by alternating star contractions, all in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.session import durable


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links to ``(id, component)``: every linked id with the smallest id of
    its component. Rows with a null end, loops and repeated links count for nothing.

    A round turns every neighbour of a node towards the smallest one, first the larger
    neighbours, then the smaller ones; rounds grow with the logarithm of the longest path.
    Minima are aggregated before the shuffle, so a hub costs one row per task. Each round
    is checkpointed, and the loop ends when a round changes no link."""
    links = durable(
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _digest(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = durable(large.filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = durable(small.filter("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct())
        last, state = state, _digest(links)
        if state == last:
            break
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]
