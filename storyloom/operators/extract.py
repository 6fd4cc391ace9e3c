"""Fetched pages to raw article records."""

from __future__ import annotations

import html as markup
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyloom.functions import ids, text
from storyloom.operators.blocks import with_fields

_UNSEEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
_HEADING = r"(?is)<h1\b[^>]*>(.*?)</h1>"
_PARAGRAPH = r"(?i)<p(?:\s[^>]*)?>"
# A paragraph ends at its end tag or where one of these blocks starts or ends.
_PARAGRAPH_END = (
    r"(?is)\A(.*?)(?:</?(?:p|div|article|section|main|header|footer|nav|aside|ul|ol|table|h[1-6]"
    r"|blockquote|pre|form|body|html)\b|\z)"
)
_TAG = r"<[^>]*>"
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']+)["']"""
_SITE = r"\A([a-zA-Z]+://[^/?#]+)"
_SCHEME = r"\A[a-zA-Z][a-zA-Z0-9+.-]*:"
# Character references but the named ones of ``text.ENTITIES``.
_REFERENCE = r"&(?!(?:nbsp|amp|lt|gt|quot|apos|#39);)(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"
_REFERENCES = re.compile(_REFERENCE)


def _spell(match: re.Match) -> str:
    """A reference as its characters; those of markup as references that are decoded last."""
    return markup.escape(markup.unescape(match[0])) if markup.unescape(match[0]) != match[0] else match[0]


def _spell_out(pages: pd.Series) -> pd.Series:
    return pages.map(lambda page: None if page is None else _REFERENCES.sub(_spell, page))


def spell_references(page: Column) -> Column:
    """Numeric and further named references of a page as characters. Only pages that hold
    any go through Arrow; all others are sent as NULL and keep their value."""
    spell_out = F.pandas_udf(_spell_out, "string")
    return F.coalesce(spell_out(F.when(page.rlike(_REFERENCE), page)), page)


def decode(fragment: Column) -> Column:
    """Markup without tags and with named entities decoded; ``&amp;`` comes last so
    that an escaped entity stays text."""
    plain = F.regexp_replace(fragment, _TAG, "")
    ampersand = [pair for pair in text.ENTITIES if pair[1] == "&"]
    for entity, char in [pair for pair in text.ENTITIES if pair[1] != "&"] + ampersand:
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return text.strip(plain)


def extract_article(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``title`` (first heading) and ``body_lines`` (paragraphs in order; one that
    is never closed ends at the next block). All in the JVM."""

    def parse(seen: Column) -> Column:
        pieces = F.slice(F.split(seen, _PARAGRAPH), F.lit(2), F.length(seen))
        lines = F.transform(pieces, lambda piece: decode(F.regexp_extract(piece, _PARAGRAPH_END, 1)))
        return F.struct(
            decode(F.regexp_extract(seen, _HEADING, 1)).alias("title"),
            F.filter(lines, lambda line: line != "").alias("body_lines"),
        )

    # inline() parses each page once: a later filter on the body cannot be pushed
    # below a generator and repeat the work.
    seen = spell_references(F.regexp_replace(F.col(html), _UNSEEN, ""))
    return pages.select("*", F.inline(F.transform(F.array(seen), parse)))


def extract_with(
    pages: DataFrame, parser: Callable[[str], tuple[str, list[str]]], html: str = "html",
) -> DataFrame:
    """As :func:`extract_article`, with a site's own parser: html to (title, lines)."""
    schema = with_fields(pages.drop(html), title=T.StringType(), body_lines=T.ArrayType(T.StringType()))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parsed = [parser(page) for page in batch[html]]
            yield batch.drop(columns=[html]).assign(
                title=[title for title, _ in parsed], body_lines=[lines for _, lines in parsed])

    return pages.mapInPandas(parse, schema)


def extract_links(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One row per page and distinct address that its links lead to: resolved against the
    page's address, without fragments. Links within the page and those that are not
    http or https (``mailto:``, ``javascript:``) are left out."""
    seen = F.regexp_replace(F.col(html), _UNSEEN, "")
    links = F.transform(F.regexp_extract_all(seen, F.lit(_LINK), F.lit(1)), lambda link: resolve(link, F.col(url)))
    keys = [c for c in pages.columns if c != html]
    return pages.select(*keys, F.explode(F.array_distinct(F.filter(links, lambda link: link.isNotNull()))).alias("link"))


def resolve(link: Column, base: Column) -> Column:
    """The http address that a link on the page ``base`` leads to; NULL if it leads nowhere else."""
    target = F.regexp_replace(text.strip(F.replace(link, F.lit("&amp;"), F.lit("&"))), r"#.*\z", "")
    site, page = F.regexp_extract(base, _SITE, 1), F.regexp_replace(base, r"(?s)[?#].*\z", "")
    folder = F.when(page == site, F.concat(page, F.lit("/"))).otherwise(F.regexp_replace(page, r"[^/]*\z", ""))
    full = (
        F.when(target == "", None)
        .when(target.rlike(r"(?i)\Ahttps?://[^/]"), target)
        .when(target.rlike(_SCHEME), None)
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 0), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(page, target))
        .otherwise(F.concat(folder, target))
    )
    return F.when(full.rlike(r"\A[^?]*/\.\.?(?:[/?]|\z)"), _without_dots(full)).otherwise(full)


def _without_dots(address: Column) -> Column:
    """An address whose path goes neither up nor in place."""
    site = F.regexp_extract(address, _SITE, 1)
    path, query = F.regexp_extract(address, r"\A[a-zA-Z]+://[^/?]+([^?]*)", 1), F.regexp_extract(address, r"\?.*\z", 0)
    # A path that ends with a dot segment names a folder.
    parts = F.split(F.regexp_replace(path, r"(/\.\.?)\z", "$1/"), "/")
    start = F.slice(parts, 1, 1)
    kept = F.aggregate(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), start,
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(part))))
    return F.concat(site, F.array_join(kept, "/"), query)


def make_articles(
    extracted: DataFrame, scraped_at: str, language: str = "si", min_chars: int = 50,
) -> DataFrame:
    """Raw article records from url, source, title, body_lines, time_ut (epoch seconds,
    0 or NULL for unknown) and optionally language and pos. Short bodies are dropped."""
    body = F.array_join("body_lines", "\n\n")
    moment = F.to_utc_timestamp(F.timestamp_seconds("time_ut"), F.current_timezone())
    known = F.when(F.col("time_ut") != 0, moment)
    records = extracted.select(
        ids.article_id(F.col("url")).alias("article_id"),
        "source",
        "url",
        "title",
        body.alias("body"),
        (F.col("language") if "language" in extracted.columns else F.lit(language)).alias("language"),
        F.date_format(known, "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"),
        F.lit(scraped_at).alias("scraped_at"),
        *([F.col("pos")] if "pos" in extracted.columns else []),
    )
    return records.where(F.length(text.strip(F.col("body"))) >= min_chars)
