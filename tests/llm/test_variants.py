"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from storyloom.llm import variants


def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1:] == b[i + 1:] or a[i:] == b[i + 1:] or a[i + 1:] == b[i:]


def _plain(rows, least_chars=6, least_count=5, ratio=5, every=199):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: k for w, k in count.items() if len(w) >= least_chars and k >= least_count}
    near = {w: [v for v in n if _near(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


@pytest.fixture(scope="module")
def texts():
    """Words with variants by one edit at every kind of place, steps from form to form, ties, capitals and accents."""
    rng = random.Random(6)
    rows = []
    for k in range(40):
        word = "".join(rng.choices("abcdeé", k=rng.randint(6, 11)))
        line = [word] * rng.choice([5, 30, 160])
        for _ in range(5):
            at = rng.randrange(len(word) + 1)
            other = rng.choice([word[:at] + "x" + word[at:], word[:at] + word[at + 1:], word[:at] + "y" + word[at + 1:]])
            line += [other] * rng.choice([1, 5, 6, 30])
        rng.shuffle(line)
        rows.append((k, " ".join(w.upper() if rng.random() < 0.2 and w.isascii() else w for w in line)))
    rows += [(100, None), (101, ""), (None, "banana " * 9 + "bananas " * 50), (102, "12 -- 3"), (103, "aaaaaaa " * 7 + "aaaaaaaa " * 40),
             (104, "listen silent " * 6), (105, ("q" * 3000 + " ") * 5 + ("q" * 2999 + " ") * 30), (104, "Éclairs éclairs " * 6), (107, "chainon " * 5 + "chainons " * 40 + "chaisons " * 900), (106, "zzzzzz" * 4 + "x×y÷z " * 5)]
    return rows


def test_equals_all_pairs(spark, texts):
    frame = spark.createDataFrame([(i, t, 1, "n") for i, t in texts], "doc_id long, text string, n int, word string").repartition(4)
    got = {tuple(r) for r in variants.spelling_variants(frame, drop_every=7).collect()}
    want = _plain(texts, every=7)
    assert got == want
    assert any(f for _, f, *_ in want) and any(root != f and f for _, f, root, *_ in want)


def test_signatures_meet_whatever_is_edited(spark):
    rng = random.Random(9)
    words = {"".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(150)}
    frame = spark.createDataFrame([(w, 1) for w in sorted(words)], "word string, n long")
    got = {(r.a, r.b) for r in variants.near_pairs(frame).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and _near(a, b)}


def test_ties_go_to_the_first_word(spark):
    rows = [("mainly", 2), ("mainlz", 10), ("mainla", 10), ("nainly", 9)]
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in variants.group(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["mainly"] == ("mainla", "mainla", 3, 10) and got["mainla"] == (None, "mainla", 2, None)


def test_no_words(spark, nothing):
    assert variants.spelling_variants(nothing).count() == 0
    assert variants.spelling_variants(spark.createDataFrame([(1, None), (2, "...")], "doc_id long, text string")).count() == 0
