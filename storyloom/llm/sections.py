"""Token counts of sections by character offsets.

A document is encoded once, as a whole; each token stands for a span of characters. The
spans are joined with the spans of sections (any ``array<struct<start, end>>`` column, by default
the pieces between the matches of a pattern, such as sentences), and a token that crosses a boundary is allocated by a rule:

* ``first``: to the section that holds its first character,
* ``most``: to the section that holds most of its characters, the earlier one of equals,
* ``share``: to each section it touches, by its share of characters (a fraction).

Characters outside all sections are section -1, so that counts add up to the document's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.llm.textbytes import chunks
from storyloom.llm.tokens import tokenizer

RULES = ("first", "most", "share")


LINES, SENTENCES = r"\n", r"[.!?]\s+|\n"


def cut(text: str, boundary: re.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the sections that end after each match of a pattern."""
    ends = np.fromiter((m.end() for m in boundary.finditer(text)), np.int64)
    if not len(ends) or ends[-1] < len(text):
        ends = np.append(ends, len(text))
    return np.concatenate([[0], ends[:-1]]), ends


def allocate(first: np.ndarray, last: np.ndarray, start: np.ndarray, end: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each of the disjoint, ordered sections ``start`` to ``end``, and of what lies
    outside of them (the last entry), for tokens of characters ``first`` to ``last``."""
    # Pieces of the text between all boundaries; even ones lie outside, odd ones are sections.
    cuts = np.stack([start, end], axis=1).ravel()
    if rule == "first":
        piece = np.searchsorted(cuts, first, side="right")
        weight = np.ones(len(first))
    else:
        # A token of no character (part of one) lies where it begins.
        upto = np.maximum(last, first + 1)
        low = np.searchsorted(cuts, first, side="right")
        high = np.searchsorted(cuts, upto, side="left")
        token = np.repeat(np.arange(len(first)), high - low + 1)
        piece = low[token] + np.arange(len(token)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
        edges = np.concatenate([[-1], cuts, [np.iinfo(np.int64).max]])
        chars = np.minimum(upto[token], edges[piece + 1]) - np.maximum(first[token], edges[piece])
        weight = chars / (upto - first)[token]
        if rule == "most":
            order = np.lexsort((piece, -chars, token))
            keep = order[np.concatenate([[True], token[order][1:] != token[order][:-1]])] if len(order) else order
            piece, weight = piece[keep], np.ones(len(keep))
    where = np.where(piece % 2 == 1, piece // 2, len(start))
    return np.bincount(where, weights=weight, minlength=len(start) + 1).astype(float)


def section_tokens(docs: DataFrame, tokenizer_path: str, sections: Column | None = None, rule: str = "most",
                   boundary: str = SENTENCES) -> DataFrame:
    """``doc_id, section, start, end, n_tokens, doc_tokens, crossing``: one row per section of
    each row, and one of section -1 if any token lies outside. ``crossing`` counts the
    section's tokens that reach beyond it.

    Sections must be disjoint and in order. A null or empty text has no tokens; a row with
    null sections or none has one row, of section -1. Repeated rows come back as often as
    they are there."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    pattern = re.compile(boundary)
    given = sections is not None
    extra = [sections.alias("sections")] if given else []
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *extra)

    def spans(batch: pa.RecordBatch, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        if not given:
            return [cut(t, pattern) for t in texts]
        lists = batch.column("sections")
        at = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))[:-1]
        both = lists.flatten()
        sides = [np.split(both.field(c).to_numpy(zero_copy_only=False).astype(np.int64), at) for c in ("start", "end")]
        return list(zip(*sides))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_path)
        for batch in chunks(batches):
            doc, out = [], []
            texts = batch.column("text").to_pylist()
            for i, (text, (start, end)) in enumerate(zip(texts, spans(batch, texts))):
                first, last = encode.spans(text)
                got = allocate(first, last, start, end, rule)
                inside = np.searchsorted(start, first, side="right") - 1
                over = last > end[inside] if len(end) else np.zeros(len(first), bool)
                over &= inside >= 0
                crossing = np.append(np.bincount(inside[over], minlength=len(start)), 0)
                some = np.arange(len(start) + (got[-1] > 0 or not len(start)))
                number = np.append(np.arange(len(start)), -1)[some]
                doc.append(np.full(len(some), i))
                out.append(np.stack([number, np.append(start, 0)[some], np.append(end, len(text))[some], got[some],
                                     np.full(len(some), len(first)), crossing[some]]))
            rows_ = np.concatenate(out, axis=1)
            whole = [pa.array(rows_[k].astype(np.int64)) for k in (0, 1, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(np.concatenate(doc))), *whole, pa.array(rows_[3]),
                 pa.array(rows_[4].astype(np.int64)), pa.array(rows_[5].astype(np.int64))],
                ["doc_id", "section", "start", "end", "n_tokens", "doc_tokens", "crossing"])

    return rows.mapInArrow(count, "doc_id long, section long, start long, end long, n_tokens double, doc_tokens long, crossing long")
