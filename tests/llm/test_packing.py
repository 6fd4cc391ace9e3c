"""Packing by lexical retrieval: whole documents in gapless sequences, BM25 by definition."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storyloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _check(rows, texts, window):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(by) == set(texts)
    for i, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    short = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        short += at < window
    return short


@pytest.mark.parametrize("shard_bytes", [1 << 30, 6000])
def test_pieces_hold_every_document_once(docs, corpus, shard_bytes):
    rows = packing.digest(packing.pack(docs, PATH, 256, shard_bytes)).collect()
    short = _check(rows, {i: t for i, t, *_ in corpus}, 256)
    assert short <= len({r.sequence_id >> 32 for r in rows})


@pytest.mark.parametrize("dense", [0, 4096])
def test_scores_are_bm25(monkeypatch, dense):
    """Of every word that two documents share, common ones too, by postings or by a product."""
    monkeypatch.setattr(packing, "DENSE_DOCUMENTS", dense)
    rng = np.random.default_rng(0)
    words = [rng.integers(0, 40, rng.integers(1, 30)) for _ in range(60)]
    index = packing.Index(words)
    df = Counter(w for d in words for w in set(d.tolist()))
    mean = sum(map(len, words)) / 60
    for seed in (0, 7, 33):
        got = index.scores(seed)
        for d in range(60):
            want = 0.0
            for w in set(words[seed].tolist()):
                tf = int((words[d] == w).sum())
                if tf and df[w] > 1:
                    want += math.log1p((60 - df[w] + 0.5) / (df[w] + 0.5)) * tf * (packing.K1 + 1) / (
                        tf + packing.K1 * (1 - packing.B + packing.B * len(words[d]) / mean))
            assert abs(got[d] - want) < (1e-4 if dense else 1e-9)


def test_shards_have_a_bound(spark, prose):
    """Long and short texts, a subject that makes up a third and texts of no subject: a shard holds its
    bytes and one part, which is half a shard and what its rows vary by, or one long text."""
    rng = np.random.default_rng(5)
    rows = [prose(i, int(rng.integers(5, 60))) for i in range(900)]
    rows += [f"hotword{k % 3} " + prose(5000 + k, 30) for k in range(500)] + ["copy of a text " * 10] * 200 + [prose(9, 3000)]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").withColumn("row", F.xxhash64("doc_id", "text"))
    size = {i: len(t.encode()) + 16 for i, t in enumerate(rows)}
    least = 16_000
    placed = frame.join(packing.place(frame, sum(size.values()), least), "row").select("doc_id", "shard").collect()
    assert sorted(r.doc_id for r in placed) == list(range(len(rows)))
    held = Counter()
    for r in placed:
        held[r.shard] += size[r.doc_id]
    assert max(held.values()) <= 1.8 * least + max(size.values())
    assert len(held) <= 2 + sum(size.values()) / least


def test_neighbours_follow_their_seed():
    """Documents of one subject come one after another."""
    rng = np.random.default_rng(1)
    subject = rng.permutation(np.repeat(np.arange(40), 5))
    words = [rng.integers(50 * s, 50 * s + 50, 40) for s in subject]
    turn = packing.order(words, [40] * 200, 200)
    assert sorted(turn) == list(range(200))
    assert np.mean(subject[turn][1:] == subject[turn][:-1]) > 0.6


def test_related_documents_share_windows_with_many_shards(spark, prose):
    """Documents of one subject in ids and rows far from each other, one hot subject and copies."""
    rng = np.random.default_rng(2)
    general = prose(0, 300).split()
    rows = []
    for s in range(60):
        own = [f"{w}{s}" for w in prose(s + 1, 40).split()]
        for _ in range(8 if s else 160):
            text = [*rng.choice(own, 30), *rng.choice(general, 30)]
            rng.shuffle(text)
            rows.append((s, " ".join(text)))
    at = rng.permutation(len(rows))
    frame = spark.createDataFrame([(i, rows[k][1]) for i, k in enumerate(at)], "doc_id long, text string")
    got = packing.digest(packing.pack(frame, PATH, 1024, sum(len(t) for _, t in rows) // 30)).collect()
    _check(got, {i: rows[k][1] for i, k in enumerate(at)}, 1024)
    assert len({r.sequence_id >> 32 for r in got}) > 20
    windows = defaultdict(set)
    for r in got:
        windows[r.sequence_id].add(r.doc_id)
    met = {i for ids in windows.values() for i in ids for j in ids if i != j and rows[at[i]][0] == rows[at[j]][0]}
    few = [i for i in range(len(rows)) if rows[at[i]][0]]
    assert len(met.intersection(few)) > 0.8 * len(few)
    assert len(met) > 0.8 * len(rows)


def test_odd_rows(spark, nothing):
    assert packing.pack(nothing, PATH).count() == 0
    frame = spark.createDataFrame([(None, "a b"), (1, None), (1, None), (2, "")], "doc_id long, text string").selectExpr("*", "1 AS shard", "2 AS ids")
    rows = packing.digest(packing.pack(frame, PATH)).collect()
    assert sorted(r.length for r in rows) == [1, 1, 1, 3] and len({r.sequence_id for r in rows}) == 1
