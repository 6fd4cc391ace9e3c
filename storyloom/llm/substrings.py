"""Removal of long repeated byte strings, in all documents at once.

A byte goes if a string of ``length`` bytes covers it that starts anywhere else too. Deciding
this for every suffix needs no order of all suffixes, only equality classes of their first
``length`` bytes, and a sample of the suffixes keeps those that are compared few:

1. Samples. Every window of ``length`` bytes has one sample: the position with the smallest
   hash of 16 bytes among its first ``span``. Equal windows have equal samples, so a repeated
   window shows in the core that follows its sample: the ``length - span + 1`` bytes that all
   windows of that sample share. Cores are compared across the corpus.
2. Buckets. The suffixes of one repeated core form a bucket. Their long tie, the core, is
   settled by its rank alone; what is left to compare are the bytes before and after it. Equal
   surroundings settle all their windows at once, and one of them stays for the others; the
   rest is compared window by window, one or some buckets at a time. A bucket with more than
   ``MOST`` different surroundings is taken apart into single windows, which Spark groups.
3. The covered bytes are the union of all repeated windows.

Strings are equal if their 64-bit fingerprints are. Within a chunk of texts equal cores are
told at once and sent as one, so a passage that a third of all documents share costs one row
per chunk. See the README for what became of the difference cover.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.llm.textbytes import byte_ranges, chunks, mix, signed, utf8
from storyloom.session import durable, scratch_path

SPAN, GRAM, MOST = 160, 16, 2048
_POSITION = np.uint64((1 << 28) - 1)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from minima of blocks read both ways."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


class Windows:
    """The windows of a chunk of texts: ``start``, the text ``owner`` of each, and its ``sample``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, span: int):
        self.length, self.core, self.offsets = length, length - span + 1, offsets
        self.hashes = byte_ranges(data)
        n = len(data) - length + 1
        if n <= 0:
            self.start = self.owner = self.sample = np.zeros(0, np.int64)
            return
        at = np.arange(n + span - 1)
        gram = self.hashes.hash(at, at + min(GRAM, self.core))
        least = _sliding_min((gram & ~_POSITION) | at.astype(np.uint64), span)
        size = np.diff(offsets)
        fits = np.repeat(offsets[1:], size)[:n] - np.arange(n) >= length
        self.start = np.flatnonzero(fits)
        self.owner = np.repeat(np.arange(len(size)), size)[self.start]
        self.sample = (least[self.start] & _POSITION).astype(np.int64)

    def cores(self, at: np.ndarray) -> np.ndarray:
        return self.hashes.hash(at, at + self.core, 2)


def _rows(h: np.ndarray, key: np.ndarray, slot: np.ndarray) -> pa.RecordBatch:
    """Rows ``h, key, slot, again``. Of equal fingerprints one row keeps its ``h``, to be
    compared with other chunks; the others are known to repeat and get one of their own."""
    order = np.argsort(h, kind="stable")
    h, key, slot = h[order], key[order], slot[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    more = np.zeros(len(h), bool)
    more[:-1] = ~new[1:]
    own = mix(key.view(np.uint64) ^ mix(slot.view(np.uint64) + h))
    return pa.RecordBatch.from_arrays(
        [signed(np.where(new, h, own)), pa.array(key), pa.array(slot), pa.array(~new | more)], ["h", "key", "slot", "again"])


_ROWS = "h long, key long, slot long, again boolean"


def _repeated(rows: DataFrame) -> DataFrame:
    """``key, slots`` of the rows that are known to repeat or share ``h`` with another."""
    n = F.count("*").over(Window.partitionBy("h"))
    return rows.withColumn("n", n).filter("again OR n > 1").groupBy("key").agg(F.collect_list("slot").alias("slots"))


def _ranges(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row number and value of each entry of a list column."""
    size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), size), lists.flatten()


def _covered(size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``size`` bytes the ranges cover."""
    return np.cumsum(np.bincount(start, minlength=size + 1) - np.bincount(end, minlength=size + 1))[:-1] > 0


def _padded(texts: pa.Array, width: int, from_end: bool) -> np.ndarray:
    """Rows of ``width`` bytes, the text read forwards or from its end, zeros after it."""
    data, offsets = utf8(texts)
    size = np.diff(offsets)
    out = np.zeros((len(size), width), np.uint8)
    row = np.repeat(np.arange(len(size)), size)
    col = np.arange(len(data)) - offsets[row]
    out[row, size[row] - 1 - col if from_end else col] = data
    return out


def _compare(rows: pa.RecordBatch, multi: np.ndarray, slack: int, length: int, single: bool) -> pa.RecordBatch:
    """Ranges ``key, start, end`` of the repeated windows of surroundings, complete buckets
    at a time. ``multi`` are surroundings that occur twice themselves. With ``single``, the
    other windows are not judged here but come back one by one with a mark ``w``."""
    core = rows.column("core").to_numpy().view(np.uint64)
    number = np.arange(slack + 1)
    step = mix(np.arange(1, slack + 2, dtype=np.uint64))
    sides = []
    for name, from_end in (("left", True), ("right", False)):
        given = _padded(rows.column(name), slack, from_end).astype(np.uint64) + np.uint64(1)
        sums = np.zeros((len(core), slack + 1), np.uint64)
        np.cumsum(mix(given * step[:slack]), axis=1, out=sums[:, 1:])
        sides.append(sums)
    mark = mix(sides[0] + mix(sides[1][:, ::-1] + step) + core[:, None] * np.uint64(2 * slack + 1))
    there = (number >= rows.column("lo").to_numpy()[:, None]) & (number <= rows.column("hi").to_numpy()[:, None])
    twice = np.zeros(there.shape, np.int8)
    if not single:
        _, back, count = np.unique(mark[there], return_inverse=True, return_counts=True)
        twice[there] = count[back] > 1
    twice[multi] = there[multi]
    edge = np.diff(twice, axis=1, prepend=0, append=0)
    row, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    w = pa.nulls(len(row), pa.int64())
    if single:
        more, at = np.nonzero(there)
        row, first, last = np.append(row, more), np.append(first, at), np.append(last, at)
        w = pa.concat_arrays([w, signed(mark[more, at])])
    key, at = rows.column("key").take(pa.array(row)), rows.column("at").to_numpy()[row]
    return pa.RecordBatch.from_arrays([key, pa.array(at - last), pa.array(at - first + length), w], ["key", "start", "end", "w"])


def _judge(batches: Iterator[pa.RecordBatch], slack: int, length: int) -> Iterator[pa.RecordBatch]:
    """``_compare`` over rows sorted by core and surroundings. Only the first of equal
    surroundings is held; the last row held waits for its equals."""
    held, multi, large = None, np.zeros(0, bool), None

    def flush(n: int, single: bool) -> pa.RecordBatch:
        nonlocal held, multi
        done, counts = held.slice(0, n), multi[:n]
        held, multi = held.slice(n), multi[n:]
        return _compare(done, counts, slack, length, single)

    for batch in batches:
        if not batch.num_rows:
            continue
        both = np.stack([batch.column(c).to_numpy() for c in ("core", "ctx")], axis=1)
        last = both[:1] - 1 if held is None else [[held.column(c)[-1].as_py() for c in ("core", "ctx")]]
        new = (both != np.concatenate([last, both[:-1]])).any(axis=1)
        more = batch.filter(pa.array(~new))
        at = more.column("at").to_numpy()
        yield pa.RecordBatch.from_arrays([
            more.column("key"), pa.array(at - more.column("hi").to_numpy()), pa.array(at - more.column("lo").to_numpy() + length),
            pa.nulls(len(at), pa.int64())], ["key", "start", "end", "w"])
        owner = np.cumsum(new)[~new] + len(multi) - 1
        reps = batch.filter(pa.array(new))
        held = reps if held is None else pa.concat_batches([held, reps])
        multi = np.append(multi, reps.column("multi").to_numpy(zero_copy_only=False))
        multi[owner] = True
        while held.num_rows > MOST:
            core = held.column("core").to_numpy()
            group = np.flatnonzero(core[1:] != core[:-1]) + 1
            first = group[0] if len(group) else held.num_rows - 1
            if large is not None and core[0] == large or not len(group) or first > MOST:
                large = core[0]
                yield flush(first, True)
            else:
                yield flush(group[group <= MOST][-1], False)
    while held is not None and held.num_rows:
        core = held.column("core").to_numpy()
        n = int((core == core[0]).sum())
        yield flush(n, True) if core[0] == large else flush(held.num_rows, False)


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Removed bytes with the other bytes of their characters."""
    number = np.cumsum((data & 0xC0) != 0x80)
    hit = np.bincount(number, weights=gone) > 0 if len(data) else gone
    return hit[number] if len(data) else gone


def repeated_spans(docs: DataFrame, length: int = 400, span: int = SPAN, carry: tuple[str, ...] = (), characters: bool = False) -> DataFrame:
    """``doc_id, kept, n_bytes, spans`` for each row: the bytes that stay, the size of the
    whole text and the maximal removed runs (``start, length``), in order. The columns that
    ``carry`` names follow as they are in the row.

    A null or empty text has no bytes and no spans, a text shorter than ``length`` stays
    whole. Rows are told apart by id and text; a row that is there twice repeats itself.
    Strings are judged on the input, so every copy of a repeated string goes. With ``characters``,
    a UTF-8 character that loses one of its bytes goes whole."""
    if not 1 < span <= length:
        raise ValueError("span must lie between 2 and length")
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *[F.col(c).alias(f"with_{c}") for c in carry])
    keyed = keyed.withColumn("key", F.xxhash64("doc_id", "text"))

    slack = span - 1

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = utf8(batch.column("text"))
            w = Windows(data, offsets, length, span)
            at, first = np.unique(w.sample, return_index=True)
            owner = w.owner[first]
            yield _rows(w.cores(at), batch.column("key").to_numpy()[owner], at - offsets[owner])

    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = utf8(batch.column("text"))
            w = Windows(data, offsets, length, span)
            row, slot = _ranges(batch.column("slots"))
            hot = np.zeros(len(data) + 1, bool)
            hot[offsets[row] + slot.to_numpy()] = True
            ask = np.flatnonzero(hot[w.sample])
            at, first = np.unique(w.sample[ask], return_index=True)
            begin = w.start[ask[first]]
            end = w.start[ask[np.append(first[1:], len(ask)) - 1]] if len(at) else begin
            owner, text = w.owner[ask[first]], data.tobytes()
            # Of equal surroundings in this chunk one is sent with its bytes; the others are
            # settled and go wherever a number of their own sends them.
            core, key = w.cores(at), batch.column("key").to_numpy()[owner]
            whole = mix(w.hashes.hash(begin, end + length, 3) ^ mix((at - begin).astype(np.uint64)))
            _, index, back, count = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
            sent = np.zeros(len(at), bool)
            sent[index] = True
            core = np.where(sent, core, mix(key.view(np.uint64) ^ mix(core + at.astype(np.uint64))))
            left = pa.array([text[a:b] if s else b"" for a, b, s in zip(begin, at, sent)], pa.binary())
            right = pa.array([text[a:b] if s else b"" for a, b, s in zip(at + w.core, end + length, sent)], pa.binary())
            yield pa.RecordBatch.from_arrays([
                signed(core), pa.array(key), pa.array(at - offsets[owner]), pa.array((at - end).astype(np.int32)),
                pa.array((at - begin).astype(np.int32)), pa.array(count[back] > 1), left, right,
            ], ["core", "key", "at", "lo", "hi", "multi", "left", "right"])

    known = durable(_repeated(keyed.select("key", "text").mapInArrow(sample, _ROWS)))
    found = keyed.select("key", "text").join(known, "key").mapInArrow(
        surround, "core long, key long, at long, lo int, hi int, multi boolean, left binary, right binary")
    found = found.withColumn("ctx", F.xxhash64("lo", "hi", "left", "right"))
    found = found.repartition("core").sortWithinPartitions("core", "ctx")
    path = scratch_path(docs.sparkSession, "windows")
    found.mapInArrow(lambda x: _judge(x, slack, length), "key long, start long, end long, w long").write.parquet(path)
    judged = docs.sparkSession.read.parquet(path)
    single = judged.filter("w IS NOT NULL")
    again = single.groupBy("w").agg(F.count("*").alias("m")).filter("m > 1")
    ranges = judged.filter("w IS NULL").drop("w").union(single.join(again, "w", "left_semi").drop("w"))
    starts = ranges.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = utf8(batch.column("text"))
            row, runs = _ranges(batch.column("gone"))
            gone = _covered(len(data), *[offsets[row] + runs.field(x).to_numpy() for x in ("start", "end")])
            if characters:
                gone = _whole_characters(data, gone)
            edge = np.zeros(len(data) + 1, bool)
            edge[offsets] = True
            begin = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate([[False], gone[:-1]])))
            end = np.flatnonzero(gone & (edge[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
            owner = np.searchsorted(offsets, begin, side="right") - 1
            count = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))]).astype(np.int32)
            spans = pa.ListArray.from_arrays(pa.array(count), pa.StructArray.from_arrays(
                [pa.array(begin - offsets[owner]), pa.array(end - begin)], ["start", "length"]))
            left = np.concatenate([[0], np.cumsum(~gone)])[offsets]
            kept = data[~gone].tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([kept[a:b] for a, b in zip(left, left[1:])], pa.binary()),
                pa.array(np.diff(offsets)), spans, *[batch.column(f"with_{c}") for c in carry]], ["doc_id", "kept", "n_bytes", "spans", *carry])

    kinds = [f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]
    schema = "doc_id long, kept binary, n_bytes long, spans array<struct<start: long, length: long>>" + "".join(kinds)
    return keyed.join(starts, "key", "left").select("doc_id", "text", "gone", *[f"with_{c}" for c in carry]).mapInArrow(cut, schema)
