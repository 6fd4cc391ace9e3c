"""A stored index of inverted lists over vectors.

``build`` fits the centres of the lists on a bounded sample, writes them under ``centres`` and the rows
under ``lists``, partitioned by list. ``insert`` deals new rows to the same centres and adds a
folder; nothing is fitted again and no row is moved. ``search`` reads only the lists that some
query visits, by partition pruning, and ranks their rows exactly.

How many lists a query visits is measured when the index is built: for a sample of stored rows the
exact neighbours are found, and ``probes`` is the smallest number of nearest lists that holds the
wanted share of them. A folder counts once its entry under ``_entries`` is there, so a failed insert is
not seen, and its retry may write the rows again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.operators import blocks, neighbors
from storyloom.session import durable
from storyloom.sources.warehouse import publish

LISTS = 100
FIT_ROWS = 256  # rows of a list, on average, that its centre is fitted on
TUNE_QUERIES, RECALL = 256, 0.95
_ROWS = "id string, label string, embedding array<double>, cell int"
_ENTRY = "entry bigint, folder string, probes int, rows array<struct<cell: int, n: bigint>>"


def _entries(spark: SparkSession, root: str) -> list:
    return spark.read.schema(_ENTRY).json(f"{root}/_entries/*.json").orderBy("entry").collect()


def _centres(spark: SparkSession, root: str) -> np.ndarray:
    """At most ``blocks.MAX_CELLS`` rows."""
    return np.array([r.centre for r in spark.read.parquet(f"{root}/centres").orderBy("cell").collect()], np.float64)


def _some(df: DataFrame, rows: int, total: int) -> DataFrame:
    """About ``rows`` rows by the hash of their id."""
    share = min(1.0, rows / max(1, total))
    return df.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)


def _add(spark: SparkSession, root: str, number: int, rows: DataFrame, centres: np.ndarray) -> str:
    """Write a folder of rows without an entry; returns its name."""
    folder = f"{number:012d}"
    placed = blocks.Cells(centres).assign(rows.select("id", "label", "embedding")).drop("gap")
    # One task a list, or several for a large one: files follow the lists.
    placed.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(8))).write.mode("overwrite").partitionBy("cell").parquet(f"{root}/lists/{folder}")
    return folder


def _count(spark: SparkSession, root: str, folder: str) -> list[dict]:
    counts = spark.read.schema(_ROWS).parquet(f"{root}/lists/{folder}").groupBy("cell").count().collect()
    return [{"cell": r["cell"], "n": r["count"]} for r in sorted(counts)]


def _read(spark: SparkSession, root: str, entries: list) -> DataFrame:
    parts = [spark.read.schema(_ROWS).parquet(f"{root}/lists/{e.folder}") for e in entries if e.rows]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _ROWS)


def tune(corpus: DataFrame, centres: np.ndarray, k: int, total: int, recall: float = RECALL, queries: int = TUNE_QUERIES) -> int:
    """The number of nearest lists that hold ``recall`` of the exact neighbours of sampled rows.
    At most ``queries * k`` pairs, give or take the sample's chance, reach the driver."""
    asked = durable(_some(corpus, queries, total).select(F.col("id").alias("query_id"), "embedding"))
    exact = neighbors.knn_exact(asked, corpus, k, skip_self=True).select("query_id", F.col("neighbour_id").alias("id"))
    cells = blocks.Cells(centres)
    pairs = exact.join(corpus.select("id", F.col("embedding").alias("other")), "id").join(asked, "query_id")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = blocks.distance_matrix(blocks.matrix(batch.column("other")), cells.centres).argmin(axis=1)
                near = blocks.distance_matrix(blocks.matrix(batch.column("embedding")), cells.centres)
                place = (near < near[np.arange(len(own)), own][:, None]).sum(axis=1) + 1
                yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32))], ["place"])

    counts = pairs.select("other", "embedding").mapInArrow(rank, "place int").groupBy("place").count().orderBy("place").collect()
    wanted, seen = recall * sum(r["count"] for r in counts), 0
    for r in counts:
        seen += r["count"]
        if seen >= wanted:
            return r["place"]
    return len(centres)


def build(corpus: DataFrame, root: str, k: int = neighbors.K_NEIGHBOURS, lists: int = LISTS, recall: float = RECALL, seed: int = 7) -> int:
    """Store an index of ``corpus`` (id, label, embedding) in the new folder ``root``. Returns the number of
    lists that searches visit. A corpus without rows gives an index without lists, which
    finds nothing."""
    spark = corpus.sparkSession
    rows = corpus.select("id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    total = rows.count()
    lists = min(lists, total, blocks.MAX_CELLS)
    if lists:
        fitted = KMeans(k=max(2, lists), seed=seed, maxIter=10).fit(
            _some(rows, lists * FIT_ROWS, total).select(array_to_vector("embedding").alias("features")))
        centres = np.array(fitted.clusterCenters())
    else:
        centres = np.zeros((0, 0))
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>").coalesce(1).write.parquet(f"{root}/centres")
    probes = tune(rows, centres, k, total, recall) if lists else 0
    folder = _add(spark, root, 0, rows, centres) if lists else ""
    publish(spark, f"{root}/_entries/{0:012d}.json", {"entry": 0, "folder": folder, "probes": probes, "rows": _count(spark, root, folder) if lists else []})
    return probes


def insert(spark: SparkSession, root: str, rows: DataFrame) -> int:
    """Add the rows whose id is not in the index; returns how many these are. Of rows that share an
    id one is added."""
    entries = _entries(spark, root)
    centres = _centres(spark, root)
    if not len(centres):
        raise ValueError("an index without lists takes no rows; build it from some")
    known = _read(spark, root, entries).select("id")
    fresh = rows.select("id", "label", F.col("embedding").cast("array<double>").alias("embedding")).dropDuplicates(["id"]).join(known, "id", "left_anti")
    number = entries[-1].entry + 1
    folder = _add(spark, root, number, fresh, centres)
    counts = _count(spark, root, folder)
    publish(spark, f"{root}/_entries/{number:012d}.json", {"entry": number, "folder": folder, "probes": entries[-1].probes, "rows": counts})
    return sum(c["n"] for c in counts)


def search(queries: DataFrame, root: str, k: int = neighbors.K_NEIGHBOURS, probes: int | None = None, max_distance: float = float("inf"),
           skip_self: bool = False, block_rows: int = blocks.BLOCK_ROWS) -> DataFrame:
    """The k nearest rows of ``queries(query_id, embedding)`` among those of the ``probes`` nearest lists
    (query_id, neighbour_id, label, distance, rank); by default as many as ``build`` measured. With as
    many as there are lists the search is exact."""
    spark = queries.sparkSession
    entries = _entries(spark, root)
    centres = _centres(spark, root)
    n = queries.count()
    if not len(centres) or not n:
        return neighbors.keep_nearest_empty(queries)
    probes = entries[-1].probes if probes is None else probes
    held = np.zeros(len(centres), np.int64)
    for e in entries:
        for r in e.rows or []:
            held[r.cell] += r.n
    parts = np.ceil(held / block_rows).astype(int)
    chunks = max(1, ceil(n / block_rows))

    def nearest(dist: np.ndarray, _: pa.RecordBatch | None = None) -> np.ndarray:
        dist = np.where((held > 0)[None, :], dist, np.inf)
        last = min(probes, dist.shape[1]) - 1
        return (dist <= np.partition(dist, last, axis=1)[:, last][:, None]) & np.isfinite(dist)

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(centres), bool)
        for batch in batches:
            if batch.num_rows:
                seen |= nearest(blocks.distance_matrix(blocks.matrix(batch.column("embedding")), centres), batch).any(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen).astype(np.int32))], ["cell"])

    asked = queries.select("query_id", "embedding")
    # At most one number a list; the lists that no query visits are not read.
    wanted = [r.cell for r in asked.select("embedding").mapInArrow(visited, "cell int").distinct().collect()]
    lists = _read(spark, root, entries).where(F.col("cell").isin(wanted))
    if chunks > 1:
        # Queries of several blocks are not copied into their lists; they meet the stored blocks.
        found = blocks.search_pairs(
            asked, lists, centres, (n, int(held[wanted].sum())), centres.shape[1], k, nearest, max_distance, skip_self, block_rows,
            visited_only=True)
        return blocks.keep_nearest(found, k)
    stored = blocks.split_cells(lists, parts, chunks)
    placed = blocks.probe_cells(asked, centres, parts, chunks, nearest)
    key = F.lit("")
    found = blocks.search_blocks(placed.withColumn("key", key), stored.withColumn("key", key), k, max_distance, skip_self)
    return blocks.keep_nearest(found, k)
