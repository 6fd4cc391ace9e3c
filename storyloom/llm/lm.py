"""Scoring of documents by a recurrent language model trained on the corpus.

1. Words of all training texts are counted (tasks count first, Spark adds up).
2. The most frequent words are the vocabulary of ``recurrent.Model``; their number, and so
   the model's size, is a parameter. Every training text takes part in one of ``rounds``
   rounds of training: each task trains a replica on its share, and the replicas are
   averaged place by place, weighted by their words. A replica learns from every window of its
   share once, so every training token gives a loss and a gradient.
3. Every document is scored whole. The probability of a word outside the vocabulary needs
   its training count, which a join brings by word; frequent words were looked up from a
   table of fixed size (``head``) before.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm import recurrent
from storyloom.llm.textbytes import CHUNK, chunks
from storyloom.session import scratch_path

END_WORD = b"\n"  # no word holds a line feed
GROUP = 12 << 20  # bytes of text that a task reads in lockstep
SCORED = CHUNK  # bytes of text scored at once; every document is scored alone, so this bounds only a task's memory


def held_out(doc_id) -> bool:
    """Whether a document is kept from training."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 1


def tokens(text: bytes) -> list[bytes]:
    """Words of a text with A-Z in lower case (no other letter changes)."""
    return text.lower().split()


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()


def count_words(docs: DataFrame, most: int = 200_000) -> DataFrame:
    """``word, c``: how often each word and the end of text occur in the training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in chunks(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), _texts(batch)):
                if not held_out(doc_id):
                    found.update(tokens(text))
                    found[END_WORD] += 1
            if len(found) > most:
                yield _counts(found)
                found = Counter()
        yield _counts(found)

    return docs.select("doc_id", "text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _counts(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])


class Numbers(dict):
    """Word numbers: of the vocabulary, or beyond it by shape. Remembers a bounded number."""

    def __init__(self, vocabulary: list[bytes], most: int = 300_000):
        super().__init__(zip(vocabulary, range(len(vocabulary))))
        self.vocabulary, self.most = len(vocabulary), most

    def __missing__(self, word: bytes) -> int:
        number = self.vocabulary + recurrent.shape(word)
        if len(self) < self.most:
            self[word] = number
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.append(out, recurrent.END)


class Places(dict):
    """Places of frequent words in their table, or beyond it by shape. Remembers a bounded number."""

    def __init__(self, frequent: list[bytes], most: int = 300_000):
        super().__init__(zip(frequent, range(len(frequent))))
        self.size, self.most = len(frequent), most

    def __missing__(self, word: bytes) -> int:
        place = self.size + recurrent.shape(word)
        if len(self) < self.most:
            self[word] = place
        return place


def train(docs: DataFrame, model: recurrent.Model, vocabulary: list[bytes], rounds: int, replicas: int, learn_every: int, rate: float) -> recurrent.Model:
    """Train on every training text of ``docs``. A replica's texts are read as a stream in
    groups; its parameters return in slices, which Spark averages first by lots of about
    the square root of ``replicas``, so that no group holds all of them."""
    spark, slice_, lots = docs.sparkSession, 1 << 14, max(1, int(replicas ** 0.5))
    words, classes, hidden = model.words, model.classes, model.hidden
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((model.flat, vocabulary))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flat, known = sent.value
            own = recurrent.Model(words, classes, hidden, flat.copy())
            numbers, memory, seen = Numbers(known), np.full(len(flat), 1e-8, np.float32), 0
            for batch in chunks(batches, size=GROUP):
                group = [numbers.of(tokens(t)) for i, t in zip(batch.column("doc_id").to_pylist(), _texts(batch)) if not held_out(i)]
                recurrent.run(own, group, rate=rate, memory=memory, learn_every=learn_every)
                seen += sum(map(len, group))
            if seen:
                parts = [own.flat[i:i + slice_].tobytes() for i in range(0, len(flat), slice_)]
                lot = np.full(len(parts), TaskContext.get().partitionId() % lots)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array(lot), pa.array(parts, pa.binary()),
                                                  pa.array(np.full(len(parts), seen))], ["part", "lot", "flat", "seen"])

        def mean(group: pa.Table) -> pa.Table:
            seen = group["seen"].to_numpy().astype(np.float64)
            total = sum(w * np.frombuffer(b.as_py(), np.float32) for w, b in zip(seen / seen.sum(), group["flat"]))
            return pa.table({"part": group["part"][:1], "lot": group["lot"][:1], "flat": pa.array([total.astype(np.float32).tobytes()], pa.binary()),
                             "seen": pa.array([int(seen.sum())], pa.int64())})

        share = docs.select("doc_id", "text").filter(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == turn)
        kinds = "part long, lot long, flat binary, seen long"
        found = share.coalesce(replicas).mapInArrow(learn, kinds).groupBy("part", "lot").applyInArrow(mean, kinds)
        parts = found.groupBy("part").applyInArrow(mean, kinds).select("part", "flat").orderBy("part").collect()
        if parts:
            model = recurrent.Model(words, classes, hidden, np.frombuffer(b"".join(r["flat"] for r in parts), np.float32).copy())
        sent.unpersist()
    return model


def score_documents(docs: DataFrame, vocabulary: int = 2048, head: int = 50_000, hidden: int = 16, rounds: int = 3, replicas: int = 64,
                    learn_every: int = 1, rate: float = 0.1, replica_tokens: int = 50_000_000) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``base_score`` is the log10 probability under smoothed word counts, ``score`` under the recurrent
    model. There is one replica for every ``replica_tokens`` training tokens, ``replicas`` at
    least where the table has as many splits. A null or empty text is its end token alone. Rows without an id are training
    rows (the text of a null id is ``None``); repeated rows count and return as often as they are
    there. Without any training row all counts are zero and the model is its start."""
    spark = docs.sparkSession
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    path = scratch_path(spark, "counts")
    count_words(base).write.parquet(path)
    counts = spark.read.parquet(path)
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = total["n"] or 0, total["v"]
    # A histogram of counts tells how frequent the words of the head are; without it every task would
    # send as many words as the head has.
    others = counts.filter(F.col("word") != F.lit(bytearray(END_WORD)))
    level, least, held = F.floor(F.log2("c") * 16), None, 0
    for r in sorted(others.groupBy(level.alias("level")).count().collect(), reverse=True):
        least, held = r["level"], held + r["count"]
        if held >= head:
            break
    wanted = others if least is None else others.filter(level >= least)
    top = wanted.orderBy(F.col("c").desc(), "word").limit(head).collect()
    frequent = {bytes(r["word"]): r["c"] for r in top}
    ends = counts.filter(F.col("word") == F.lit(bytearray(END_WORD))).first()
    known = [END_WORD, *list(frequent)[:vocabulary - 1]]
    frequent[END_WORD] = ends["c"] if ends else 0
    words = len(known)
    classes = max(1, int(words ** 0.5))

    # Training tokens and distinct words outside the vocabulary by shape.
    sizes = np.zeros((2, recurrent.SHAPES))
    inside = set(known)

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((2, recurrent.SHAPES), np.int64)
        for batch in batches:
            for word, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist()):
                if word not in inside:
                    k = recurrent.shape(word)
                    out[0, k] += c
                    out[1, k] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(recurrent.SHAPES)), pa.array(out[0]), pa.array(out[1])], ["k", "n", "v"])

    for r in counts.mapInArrow(shapes, "k long, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        sizes[:, r["k"]] = r["n"], r["v"]

    model = recurrent.Model(words, classes, hidden)
    word_counts = np.array([frequent[w] for w in known], float)
    by_class = np.bincount(np.arange(words) % classes, weights=word_counts, minlength=classes)
    model.start(np.concatenate([by_class, sizes[0]]), word_counts)
    if n:
        model = train(base, model, known, rounds, max(replicas, -(-n // replica_tokens)), learn_every, rate)

    sent = spark.sparkContext.broadcast((model.flat, known, frequent))
    whole = n + 0.5 * (v + 1)
    shaped = np.log10(sizes[0] + 0.5 * (sizes[1] + 1))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, listed, often = sent.value
        own, size = recurrent.Model(words, classes, hidden, flat), len(listed)
        # The vocabulary first, then other frequent words; then a place for each shape.
        inside = set(listed)
        placed = [*listed, *[w for w in often if w not in inside]]
        places, many = Places(placed), len(placed)
        number_of = np.concatenate([np.arange(size), [size + recurrent.shape(w) for w in placed[size:]],
                                    size + np.arange(recurrent.SHAPES)]).astype(np.int64)
        # log10 of (c + 0.5) of frequent words; other words come with their counts later.
        gain = np.append(np.log10(np.array([often[w] for w in placed]) + 0.5), np.zeros(recurrent.SHAPES))
        for batch in chunks(batches, size=SCORED):
            split = [tokens(t) for t in _texts(batch)]
            at = [np.fromiter(map(places.__getitem__, w), np.int64, len(w)) for w in split]
            group = [np.append(number_of[a], recurrent.END) for a in at]
            score = recurrent.run(own, group) / np.log(10)
            rows = []
            for i, (w, a, number) in enumerate(zip(split, at, group)):
                got = gain[a]
                rare = np.flatnonzero(a >= many)
                tail = Counter([w[r] for r in rare])
                beyond = number[:-1] >= size
                within = got[beyond].sum() - shaped[number[:-1][beyond] - size].sum()
                gained = got.sum() + gain[recurrent.END] - len(number) * np.log10(whole)
                seen = len(w) - len(rare) + int(often[END_WORD] > 0)
                rows.append((len(number), seen, gained, score[i] + within, list(tail), list(tail.values())))
            cols = list(zip(*rows))
            cut = pa.array(np.cumsum([0, *map(len, cols[4])]).astype(np.int32))
            flat_words = pa.array([x for t in cols[4] for x in t], pa.binary())
            flat_times = pa.array([x for t in cols[5] for x in t], pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([held_out(x) for x in batch.column("doc_id").to_pylist()]),
                *[pa.array(c, k) for c, k in zip(cols[:4], (pa.int64(), pa.int64(), pa.float64(), pa.float64()))],
                pa.ListArray.from_arrays(cut, flat_words), pa.ListArray.from_arrays(cut, flat_times)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "words", "times"])

    path = scratch_path(spark, "scored")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, words array<binary>, times array<long>"
    base.mapInArrow(measure, schema).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    scored = spark.read.parquet(path)
    pairs = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    gained = pairs.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    tails = gained.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("tail"), F.sum(F.when(F.col("c") > 0, F.col("times"))).alias("more"))
    out = scored.drop("words", "times").join(tails, "row", "left")
    tail = F.coalesce("tail", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                      (F.col("base_score") + tail).alias("base_score"), (F.col("score") + tail).alias("score"))
