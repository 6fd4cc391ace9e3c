"""Packing of whole documents into windows of tokens by lexical retrieval.

Documents are dealt into shards by content: each document has a few
keys, its words with the smallest weighted hashes (``-ln(u) / weight``; rarer words weigh more,
and equal words have equal hashes everywhere), and goes with the key that most documents
have in common among those whose documents fit half a shard. Keys with more documents than that
are split by a hash of the row. So related documents meet however many shards there are. The parts
are counted and laid one after another, and a shard takes those that begin in its share of the bytes, so
it holds ``shard_bytes`` and one part at most. Each shard has an inverted index over its
documents' words, scored by BM25. A window starts with a seed document; the unused
documents that score best against the seed follow until the window is full. The last one is
cut at the window's end, and what is left of it starts the next window and is its seed. So
only the last window of a shard is padded. A word of one document only carries no weight; a seed without
scored neighbours takes the next unused document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.llm.textbytes import byte_ranges, chunks, mix, utf8
from storyloom.llm.textbytes import words as word_ranges
from storyloom.llm.tokens import tokenizer
from storyloom.session import durable

SLOTS, KEYS = 1 << 20, 16  # counters of words for their weights; keys of a document
END, K1, B = 0, 1.2, 0.75
# Words in more than this share of a small shard's documents are scored by a matrix product and
# the others by their postings; it is the same sum.
DENSE, DENSE_DOCUMENTS = 0.05, 4096
BAND, SALT = 64, 32  # shards whose parts are laid out together; pieces of a join with a key that is split


class Index:
    """BM25 over documents given as arrays of word numbers."""

    def __init__(self, words: list[np.ndarray]):
        n = len(words)
        size = np.array([len(w) for w in words], np.int64)
        flat = np.concatenate([np.zeros(0, np.int32), *words]).astype(np.int64)
        top = int(flat.max(initial=-1)) + 1
        pairs, count = np.unique(np.repeat(np.arange(n), size) * max(1, top) + flat, return_counts=True)
        del flat
        doc, term = (pairs // max(1, top)).astype(np.int32), (pairs % max(1, top)).astype(np.int32)
        del pairs
        df = np.bincount(term, minlength=top)
        use = df[term] > 1
        doc, term, count = doc[use], term[use], count[use]
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * size / max(1.0, size.mean() if n else 1.0))
        gain = idf[term] * count * (K1 + 1) / (count + norm[doc])
        self.n, self.common = n, None
        heavy = df > max(10, DENSE * n)
        if n <= DENSE_DOCUMENTS and heavy.any():
            column = np.cumsum(heavy) - 1
            dense = heavy[term]
            has, weight = (np.zeros((n, int(heavy.sum())), np.float32) for _ in range(2))
            at = doc[dense], column[term[dense]]
            has[at], weight[at] = 1, gain[dense]
            self.common = has @ weight.T
            doc, term, gain = doc[~dense], term[~dense], gain[~dense]
        self.terms, self.at = term, np.searchsorted(doc, np.arange(n + 1))
        order = np.argsort(term, kind="stable")
        self.doc, self.gain = doc[order], gain[order]
        self.first = np.searchsorted(term[order], np.arange(top + 1))

    def scores(self, seed: int) -> np.ndarray:
        """Score of every document against the words of one."""
        terms = self.terms[self.at[seed]:self.at[seed + 1]]
        begin, size = self.first[terms], self.first[terms + 1] - self.first[terms]
        where = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        found = np.bincount(self.doc[where], weights=self.gain[where], minlength=self.n)
        return found if self.common is None else found + self.common[seed]


def order(words: list[np.ndarray], sizes: list[int], window: int) -> list[int]:
    """The order in which the documents fill windows."""
    index, used, out, later, at = Index(words), np.zeros(len(words), bool), [], 0, 0
    scores = None
    for _ in range(len(words)):
        best = int(scores.argmax()) if scores is not None else 0
        if scores is None or scores[best] <= 0:
            while used[later]:
                later += 1
            best = later
        used[best] = True
        out.append(best)
        room = window - at % window
        at += sizes[best]
        if scores is None or sizes[best] >= room:
            scores = index.scores(best)
            scores[used] = 0
        else:
            scores[best] = 0
    return out


def word_counts(rows: DataFrame) -> np.ndarray:
    """Occurrences of the words of ``text`` in ``SLOTS`` counters, dealt by hash."""
    slice_ = 1 << 14

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(SLOTS, np.int64)
        for batch in chunks(batches):
            found += np.bincount((_hashes(batch)[1] % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        if found.any():
            parts = [found[i:i + slice_].tobytes() for i in range(0, SLOTS, slice_)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array(parts, pa.binary())], ["part", "n"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_py(), np.int64) for b in group["n"])
        return pa.table({"part": group["part"][:1], "n": pa.array([total.tobytes()], pa.binary())})

    kinds = "part long, n binary"
    parts = rows.select("text").mapInArrow(count, kinds).groupBy("part").applyInArrow(add, kinds).orderBy("part").collect()
    return np.frombuffer(b"".join(r["n"] for r in parts), np.int64) if parts else np.zeros(SLOTS, np.int64)


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word."""
    data, offsets = utf8(batch.column("text"))
    start, end, owner = word_ranges(data, offsets)
    return owner, mix(byte_ranges(data).hash(start, end))


def smallest(owner: np.ndarray, word: np.ndarray, weight: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of the ``most`` distinct words of each text with the smallest
    weighted hashes; words without weight are none of them."""
    use = weight > 0
    owner, word = owner[use], word[use]
    value = -np.log(((mix(word) >> np.uint64(11)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -53)) / weight[use]
    # The bits of positive numbers are in their order, and so are those of owner and value together.
    joint = (owner.astype(np.uint64) << np.uint64(32)) | value.astype(np.float32).view(np.uint32)
    by = np.argsort(joint)
    joint, word = joint[by], word[by]
    owner = (joint >> np.uint64(32)).astype(np.int64)
    new = np.ones(len(owner), bool)
    new[1:] = (joint[1:] != joint[:-1]) | (word[1:] != word[:-1])
    owner, word = owner[new], word[new]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    return owner[rank < most], word[rank < most]


def place(rows: DataFrame, total: int, shard_bytes: int) -> DataFrame:
    """``row, shard`` of every distinct row of ``row, text``, whose texts have ``total`` bytes."""
    counts = word_counts(rows)
    share = counts / max(1, counts.sum())
    weights = np.where(counts > 1, np.log1p(1 / np.maximum(share, 1e-12)) ** 2, 0).astype(np.float32)
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            owner, word = _hashes(batch)
            owner, word = smallest(owner, word, sent.value[(word % np.uint64(SLOTS)).astype(np.int64)], KEYS)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays([batch.column("row").take(at), pa.array(word.view(np.int64)), batch.column("size").take(at)], ["row", "key", "size"])

    sized = rows.select("row", "text", (F.octet_length("text") + 16).cast("long").alias("size"))
    keys = durable(sized.mapInArrow(find, "row long, key long, size long"))
    known = keys.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).filter("n > 1")
    fits = F.col("bytes") <= shard_bytes // 2
    rank = F.struct(fits.alias("fits"), F.when(fits, F.col("n")).otherwise(-F.col("n")).alias("by"), "key")
    best = keys.join(known, "key").groupBy("row").agg(F.max(rank).alias("best")).select("row", "best.key")
    # A row without a key that others have goes with the others of that kind.
    every = sized.groupBy("row").agg(F.sum("size").alias("size"))
    salt = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(SALT))
    chosen = durable(every.join(best, "row", "left").select("row", "size", F.coalesce("key", F.lit(0)).alias("key"), salt.alias("salt")))
    split = chosen.groupBy("key").agg(F.ceil(F.sum("size") * 2 / shard_bytes).alias("parts")).filter("parts > 1")
    split = split.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    part = F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(1)))
    dealt = durable(chosen.join(split, ["key", "salt"], "left").select("row", "size", F.xxhash64("key", part).alias("part")))
    parts = dealt.groupBy("part").agg(F.sum("size").alias("bytes"))
    bands = max(1, math.ceil(total / (BAND * shard_bytes)))
    parts = parts.withColumn("band", F.pmod("part", F.lit(bands)))
    before = F.sum("bytes").over(Window.partitionBy("band").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = F.floor(F.coalesce(before, F.lit(0)) / shard_bytes)
    shards = parts.select("part", (F.col("band") * (1 << 12) + first).cast("long").alias("shard"))
    return dealt.join(shards, "part").select("row", "shard")


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, shard_bytes: int = 8 << 20) -> DataFrame:
    """Pieces ``doc_id, start, ids, doc_tokens, sequence_id, offset``: ``ids`` are the
    little-endian 32-bit ids of a piece, ``start`` the document's ids before it, ``offset``
    its place in its sequence. A document is its token ids and one id 0.

    A null or empty text is the one id 0. Rows that repeat an id are packed one by one. An
    empty table has no pieces. A shard holds ``shard_bytes`` of text and one part at most, which is about half
    as much, or one longer text; so a task's memory is bounded by a small multiple of it and by the longest
    text. A table that fits one shard is one."""
    total = docs.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if total > shard_bytes:
        placed = placed.withColumn("row", F.xxhash64("doc_id", "text"))
        placed = placed.join(place(placed, total, shard_bytes), "row").drop("row")
    else:
        placed = placed.withColumn("shard", F.lit(0).cast("long"))

    def fill(group: pa.Table) -> pa.Table:
        turn = pc.sort_indices(group, sort_keys=[("doc_id", "ascending"), ("text", "ascending")]).to_numpy()
        names, texts = group["doc_id"].combine_chunks().take(pa.array(turn)), group["text"]
        encode = tokenizer(tokenizer_path)
        ids, words = [], []
        for i in turn:
            found, pieces = encode(texts[int(i)].as_py())
            ids.append(np.append(found, np.uint32(END)).astype("<u4"))
            words.append(pieces.astype(np.int32))
        sizes = np.array([len(i) for i in ids], np.int64)
        # The index is gone before the pieces are made.
        turn = np.array(order(words, sizes.tolist(), window), np.int64)
        del words
        # Documents stand one after another; a piece ends with its document or its window.
        end = np.cumsum(sizes[turn])
        begin = end - sizes[turn]
        pieces = (end - 1) // window - begin // window + 1
        place = np.repeat(np.arange(len(turn)), pieces)
        number = begin[place] // window + np.arange(len(place)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, last = np.maximum(begin[place], number * window), np.minimum(end[place], (number + 1) * window)
        size = last - first
        text = np.concatenate([np.zeros(0, "<u4"), *(ids[d] for d in turn)])
        del ids
        shard = group["shard"][0].as_py() << 32 if group.num_rows else 0
        marks = np.concatenate([[0], np.cumsum(4 * size)]).astype(np.int32)
        data = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(marks), pa.py_buffer(text)])
        return pa.table({"doc_id": names.take(pa.array(turn[place])), "start": first - begin[place], "ids": data,
                         "doc_tokens": sizes[turn][place], "sequence_id": shard + number, "offset": first - number * window})

    schema = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"
    return placed.groupBy("shard").applyInArrow(fill, schema)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the length and checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
