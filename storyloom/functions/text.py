"""Text columns: normalisation, shingles and model inputs."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that are deleted from titles and bodies.
INVISIBLE = "\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff"

# Entity replacements, applied in this order.
ENTITIES = [
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
]

# Unicode white space as one class that Java and RE2 read alike.
SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}]"
NON_WORD = r"[^\p{L}\p{N}_]+"

# Below U+0300 every code point is already composed and never reorders. In the
# Sinhala block only these pairs compose, and only one sign carries a class.
_OUTSIDE = r"[^\x{0}-\x{2ff}\x{d80}-\x{dff}\x{2002}-\x{206f}]"
_SINHALA_PAIRS = ["\u0dd9\u0dca", "\u0dd9\u0dcf", "\u0dd9\u0ddf", "\u0ddc\u0dca"]


def _compose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def nfc(text: Column) -> Column:
    """Canonical composition. Spark has no built-in for it, so the texts that could
    change (found in the JVM) go through Arrow; all others are sent as NULL and keep
    their value."""
    compose = F.pandas_udf(_compose, "string")
    may_change = text.rlike(_OUTSIDE)
    for pair in _SINHALA_PAIRS:
        may_change = may_change | text.contains(pair)
    not_ascii = F.octet_length(text) > F.length(text)
    return F.coalesce(compose(F.when(not_ascii & may_change, text)), text)


def remove_invisible(text: Column) -> Column:
    """Byte searches: faster than one regular expression or ``translate``."""
    for char in INVISIBLE:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def squeeze(text: Column) -> Column:
    """Runs of white space to one space, none at either end."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends only."""
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def replace_entities(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def tidy(composed: Column) -> Column:
    """The steps after composition: delete invisible characters, replace entities,
    squeeze."""
    return squeeze(replace_entities(remove_invisible(composed)))


def normalize(text: Column) -> Column:
    return tidy(nfc(text))


def invisible_count(text: Column) -> Column:
    return F.length(text) - F.length(remove_invisible(text))


def prefix_shingle(body: Column, chars: int = 300) -> Column:
    """The letters, digits and underscores of the first ``chars`` characters."""
    return F.regexp_replace(F.lower(F.substring(body, 1, chars)), NON_WORD, "")


# What the encoder wants before a text, and what joins title and body.
PASSAGE, SENTENCE_END = "passage: ", ". "


def passage_text(title: Column, body: Column) -> Column:
    """Encoder input: a prefix, then title and body with nothing between them."""
    return F.concat(F.lit(PASSAGE), title, body)


def sentence_text(title: Column, body: Column) -> Column:
    """Classifier input: title and body joined as two sentences."""
    return F.concat(title, F.lit(SENTENCE_END), body)


def word_shingles(text: Column, width: int = 3) -> Column:
    """Distinct 64-bit hashes of the runs of ``width`` words in the whole text.

    Texts with fewer words form one shingle of all of them; texts without any
    word have none."""
    words = F.filter(F.split(F.lower(text), NON_WORD), lambda w: w != "")

    def runs(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(1)))
        # get() reads one word, where slice() would copy the whole array per run.
        run = lambda i: F.concat_ws(" ", *[F.get(w, i + (k - 1)) for k in range(width)])
        hashed = F.transform(starts, lambda i: F.xxhash64(run(i)))
        return F.when(F.size(w) > 0, F.array_distinct(hashed)).otherwise(F.array().cast("array<bigint>"))

    # Bound as a lambda variable, the words are split once and not once per run.
    return F.transform(F.array(words), runs)[0]
