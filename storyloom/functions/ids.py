"""Deterministic identifiers: the same input gives the same id on every retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def article_id(url: Column) -> Column:
    """First 24 hex characters of the url's SHA-256."""
    return F.substring(F.sha2(url, 256), 1, 24)


def uuid_from(*parts: Column) -> Column:
    """UUID-shaped text from the SHA-256 of the parts."""
    digest = F.sha2(F.concat_ws(":", *parts), 256)
    spans = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in spans])


def event_id(first_article: Column, run_date: str = "") -> Column:
    return uuid_from(F.lit("event"), first_article, F.lit(run_date))
