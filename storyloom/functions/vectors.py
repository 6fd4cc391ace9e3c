"""Vector columns (``array<float>`` or ``array<double>``).

These expressions suit one vector per row or a single query vector. Searches over
many vectors use :mod:`storyloom.operators.blocks` instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(as_double(v), F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - dot(a, b) / (norm(a) * norm(b))


def l2_normalize(v: Column, eps: float = 1e-12) -> Column:
    """Scale to unit length; a vector of zeros stays as it is."""
    packed = F.transform(F.array(F.struct(as_double(v).alias("v"), F.greatest(norm(v), F.lit(eps)).alias("n"))),
                         lambda s: F.transform(s["v"], lambda x: x / s["n"]))
    return packed[0]


def softmax(logits: Column) -> Column:
    """Probabilities from logits, shifted by the maximum so none overflows."""
    packed = F.array(F.struct(as_double(logits).alias("z"), F.array_max(as_double(logits)).alias("top")))
    powers = F.transform(packed, lambda s: F.transform(s["z"], lambda z: F.exp(z - s["top"])))
    return F.transform(
        F.transform(powers, lambda e: F.struct(e.alias("e"), total(e).alias("sum"))),
        lambda s: F.transform(s["e"], lambda x: x / s["sum"]),
    )[0]
