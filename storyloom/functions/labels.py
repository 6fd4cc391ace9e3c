"""Class labels and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Classes in score order; ties go to the earlier one.
BIAS_LABELS = ["far_left", "left", "center", "right", "far_right"]
# The three-class variant.
BIAS_LABELS_SHORT = ["left", "center", "right"]

# Event topics.
TOPICS = [
    "politics",
    "world",
    "business",
    "technology",
    "science",
    "health",
    "sports",
    "entertainment",
    "climate",
    "other",
]


def label_array(labels: list[str]) -> Column:
    return F.array(*[F.lit(name) for name in labels])


def score_map(probabilities: Column, labels: list[str] = BIAS_LABELS) -> Column:
    return F.map_from_arrays(label_array(labels), probabilities)


def top_label(probabilities: Column, labels: list[str] = BIAS_LABELS) -> Column:
    """The class of the largest probability; ``array_position`` finds the first."""
    first = F.array_position(probabilities, F.array_max(probabilities)).cast("int")
    return F.element_at(label_array(labels), first)


def slug(label: Column) -> Column:
    return F.translate(F.lower(label), " ", "_")
