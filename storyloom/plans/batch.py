"""The whole run over one batch of raw articles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.operators import assign, classify, clean, embed, merge, neighbors
from storyloom.session import durable
from storyloom.sources import stage, warehouse


# Commits of changes that a reader merges before the next compaction.
MAX_FOLDERS = 16


@dataclass
class Options:
    """Models and thresholds of a run. ``model`` scores vectors, ``classifier`` texts; with
    neither, the bias columns of new articles stay NULL and those of stored ones stay as
    they are. ``window_hours`` bounds in time which articles can share an event."""

    encoder: Callable | None = None
    model: Transformer | None = None
    classifier: Callable | Transformer | None = None
    min_body_chars: int = clean.MIN_BODY_CHARS
    languages: list[str] | None = None
    k: int = neighbors.K_NEIGHBOURS
    threshold: float = neighbors.DISTANCE_THRESHOLD
    majority: float = neighbors.MAJORITY_RATIO
    density: dict[str, int] = field(default_factory=dict)
    window_hours: float | None = None


def _bias(cleaned: DataFrame, vectors: DataFrame, options: Options) -> DataFrame:
    if options.model is not None:
        return classify.score_bias(vectors, options.model)
    if isinstance(options.classifier, Transformer):
        return classify.classify_fitted(embed.model_text(cleaned, sentence=True), options.classifier)
    if options.classifier is not None:
        return classify.classify_text(embed.model_text(cleaned, sentence=True), options.classifier)
    return cleaned.selectExpr(
        "article_id", "CAST(NULL AS STRING) AS bias_label", "CAST(NULL AS DOUBLE) AS bias_confidence",
        "CAST(NULL AS MAP<STRING, DOUBLE>) AS bias_scores")


def curate(
    raw: DataFrame, stored: dict[str, DataFrame], run_date: str, loaded_at: str, options: Options | None = None,
) -> dict[str, DataFrame]:
    """New and changed rows of sources, events and articles. Cleaned text and vectors
    are needed by several branches and are checkpointed once. Of the stored tables only
    the rows with incoming keys are merged."""
    options = options or Options()
    present, _ = stage.require_text(raw)
    if options.languages:
        present = clean.language_filter(present, options.languages)
    cleaned = durable(clean.clean_articles(present, options.min_body_chars))
    vectors = durable(embed.embed_batches(embed.model_text(cleaned), options.encoder))
    bias = _bias(cleaned, vectors, options)
    placed = vectors
    if options.window_hours is not None:
        placed = vectors.join(stage.article_times(cleaned).select("article_id", "published_at"), "article_id", "left")
    clusters = durable(assign.cluster_assignments(
        placed, stored["articles"], run_date, options.threshold, options.k, options.majority, options.window_hours, **options.density))

    joined = stage.article_times(merge.join_outputs(cleaned, vectors, bias, clusters, loaded_at)).withColumn(
        "bias_scores", F.from_json("bias_scores", "map<string,double>"))
    created = F.lit(loaded_at).cast("timestamp")
    counted = durable(merge.event_stats(clusters, stage.article_times(cleaned), with_window=True))

    def touched(table: str, incoming: DataFrame, key: str) -> DataFrame:
        return stored[table].join(incoming.select(key), key, "left_semi")

    names = cleaned.select(F.col("source").alias("source_name")).distinct()
    sources = merge.upsert_sources(touched("sources", names, "source_name"), cleaned)
    events = merge.upsert_events(touched("events", counted, "event_id"), counted)
    articles = merge.upsert_articles(touched("articles", cleaned, "article_id"), joined)
    tables = {"sources": sources, "events": events, "articles": articles}
    return {name: df.withColumn("created_at", F.coalesce("created_at", created)) for name, df in tables.items()}


def load_batch(
    spark: SparkSession, raw: DataFrame, root: str, run_id: str, run_date: str, loaded_at: str,
    options: Options | None = None,
) -> bool:
    """Curate a batch and commit it; False when the run is in the warehouse already or
    the batch is empty. Lines that cannot be read and rows without a title or body go to
    ``quarantine/{run_id}`` before the commit, with reason and origin."""
    if warehouse.is_committed(spark, root, run_id) or raw.isEmpty():
        return False
    usable, bad = stage.split_usable(raw)
    # The folder is the run's own, so a run repeated after a failure replaces it.
    bad.write.mode("overwrite").json(warehouse.quarantine_path(root, run_id))
    stored = {name: warehouse.read_table(spark, root, name) for name in warehouse.WAREHOUSE}
    changed = curate(usable, stored, run_date, loaded_at, options)
    warehouse.commit_warehouse(spark, root, changed, run_id, changes=True)
    if len(warehouse.folders(spark, root)) > MAX_FOLDERS:
        warehouse.compact(spark, root, f"{run_id}-compact")
    return True


def load_corpus(spark: SparkSession, corpus: DataFrame, root: str, run_id: str) -> int:
    """One-time load of an annotated corpus; stored rows win."""
    from storyloom.operators import corpus as annotated

    placed = durable(annotated.corpus_events(corpus))
    stored = {name: warehouse.read_table(spark, root, name) for name in warehouse.WAREHOUSE}
    names = placed.select(F.col("publisher").alias("source_name")).distinct().withColumn("source_type", F.lit("html"))
    incoming = {
        "sources": (names, "source_name"),
        "events": (annotated.corpus_event_stats(placed), "event_id"),
        "articles": (annotated.corpus_articles(placed), "article_id"),
    }
    tables = {name: merge.insert_if_absent(stored[name], warehouse.to_table(df, name), key)
              for name, (df, key) in incoming.items()}
    return warehouse.commit_warehouse(spark, root, tables, run_id)
