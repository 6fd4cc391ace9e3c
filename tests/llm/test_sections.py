"""Token counts of sections against the tokenizer library's own offsets."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storyloom.llm import sections
from storyloom.llm.tokens import tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "\n\n a  b\t", "a b \x1c c", "don't we'll  x1 22é\r\n", "<|endoftext|> ok", "日本語 テスト", "  lead", "trail   ",
       "\U0001f600 hi", "á x", "Ünïcödé space", "a" * 3000, "x y", "Straße ½ ² ʼn ɐ"]


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def test_ids_and_spans_are_the_library_s(library, corpus):
    encode = tokenizer(PATH)
    for text in ODD + [t or "" for _, t, *_ in corpus]:
        want = library.encode(text, add_special_tokens=False)
        assert encode(text)[0].tolist() == want.ids, text
        first, last = encode.spans(text)
        if text.isascii():
            assert list(zip(first, last)) == want.offsets
        covered = np.zeros(len(text), bool)
        for a, b in zip(first, last):
            assert a < b
            covered[a:b] = True
        assert covered.all()


def _plain(spans, start, end, rule):
    """Sections and the gaps between them as pieces in order; -1 is a gap."""
    pieces, at = [], 0
    for k, (s, e) in enumerate(zip(start, end)):
        pieces += [(at, s, -1), (s, e, k)]
        at = e
    pieces.append((at, 10 ** 6, -1))
    out = np.zeros(len(start) + 1)
    for a, b in spans:
        share = [max(0, min(b, e) - max(a, s)) for s, e, _ in pieces]
        if rule == "share":
            for n, (*_, k) in zip(share, pieces):
                out[k] += n / (b - a)
        elif rule == "first":
            out[next(k for s, e, k in pieces if s <= a < e)] += 1
        else:
            out[pieces[share.index(max(share))][2]] += 1
    return out


@pytest.mark.parametrize("rule", sections.RULES)
def test_allocation_equals_a_plain_join(rule):
    rng = np.random.default_rng(4)
    for _ in range(200):
        cuts = np.sort(rng.choice(60, 8, replace=False))
        start, end = cuts[::2], cuts[1::2]
        edges = np.unique(np.concatenate([[0, 60], rng.choice(60, 15)]))
        spans = list(zip(edges[:-1], edges[1:]))
        got = sections.allocate(edges[:-1], edges[1:], start, end, rule)
        assert np.allclose(got, _plain(spans, list(start), list(end), rule))
        assert np.isclose(got.sum(), len(spans))


def test_lines(spark, docs, library, corpus):
    rows = sections.section_tokens(docs, PATH, boundary=sections.LINES).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for doc_id, text, *_ in corpus:
        text = text or ""
        got = sorted(by[doc_id], key=lambda r: r.section)
        assert sum(r.n_tokens for r in got) == got[0].doc_tokens == len(library.encode(text, add_special_tokens=False).ids)
        assert [text[r.start:r.end] for r in got] == (text.splitlines(True) if "\n" in text else [text])


def test_tokens_that_cross_sentences(spark):
    frame = spark.createDataFrame([(1, "One is. Two are! three")], "doc_id long, text string")
    got = {rule: {r.section: (r.n_tokens, r.crossing) for r in sections.section_tokens(frame, PATH, rule=rule).collect()} for rule in sections.RULES}
    assert got["first"] == {0: (4, 1), 1: (3, 1), 2: (0, 0)}
    assert got["most"] == {0: (3, 1), 1: (3, 1), 2: (1, 0)}
    assert {k: round(n, 3) for k, (n, _) in got["share"].items()} == {0: 3.25, 1: 2.917, 2: 0.833}


def test_other_sections_and_odd_rows(spark, nothing):
    assert sections.section_tokens(nothing, PATH).count() == 0
    spans = "array<struct<start: long, end: long>>"
    rows = [(1, "hello wonderful world", [(6, 9)]), (1, "hello", None), (None, None, []), (3, "hello", [(0, 2), (2, 5)])]
    frame = spark.createDataFrame(rows, f"doc_id long, text string, cut {spans}").withColumn("sections", F.lit(1))
    got = {(r.doc_id, r.doc_tokens, r.section): (r.n_tokens, r.crossing)
           for r in sections.section_tokens(frame, PATH, F.col("cut"), "share").collect()}
    assert got[1, 3, 0] == (0.3, 1) and got[1, 3, -1] == (2.7, 0)
    assert got[1, 1, -1] == (1, 0) and got[None, 0, -1] == (0, 0)
    assert got[3, 1, 0] == (0.4, 1) and got[3, 1, 1] == (0.6, 0)
    with pytest.raises(ValueError):
        sections.section_tokens(frame, PATH, rule="none")
