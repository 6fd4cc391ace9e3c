"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. A text is cut into
windows of a few words; each is compressed once with the ordinary dictionary alone and once
with the toxic one in front of it, and the bytes that the toxic one saves are the window's
gain. How many windows reach each of a few gains is turned into a probability by a logistic
regression, which weighs those thresholds on labelled texts that their own dictionary has not seen.

* The trainer of zstandard keeps what is frequent. Words that both kinds of text share are
  far more frequent than those that tell them apart, so two dictionaries of whole texts come out
  alike, and differ by passages that one class happens to repeat. The toxic dictionary is therefore
  trained on the stretches of toxic texts that stand out against ordinary ones: runs of
  ``GRAM`` bytes that significantly more toxic than ordinary texts hold. The share of texts
  is counted, so a word that one text repeats weighs no more than its first place.
* Windows end at words chosen by their hash, so a passage is cut alike wherever it stands.
* Both compressors search with binary trees, because a quick search finds other matches
  as soon as the dictionary grows, which is more noise than a word is worth.

The classifier is fitted in one task on a bounded sample of labelled texts: about ``sample_bytes`` of
each class, of texts of at most ``sample_text_bytes``, picked by a hash of the text, however many
labels there are. The task takes about 50 times the sample in memory. Everything is scored, whole, where
it lies; the fitted model is about ``ORDINARY + TOXIC`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.textbytes import CHUNK, byte_ranges, chunks, utf8
from storyloom.llm.textbytes import words as word_ranges
from storyloom.session import durable

GRAM, Z, FOLDS = 7, 6.0, 4  # bytes of a run, deviations beyond which it stands out, folds for calibration
LEAST, PASSES = 3, 4  # texts that hold a run that can stand out, passes over the runs
WORDS, MOST_WORDS, MOST_BYTES = 5, 16, 256  # words of a window on average, and at most; bytes at most
ORDINARY, TOXIC = 16 << 10, 4 << 10  # bytes of the dictionaries
GAINS = (1, 2, 3, 4, 6)
BROADCAST_ROWS = 200_000  # ids of the sample, 25 bytes each
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[9, 10, 11, 12, 13]] = 32


@dataclass
class Model:
    """What scoring needs. Without a toxic dictionary every text scores ``rate``."""

    ordinary: bytes = b""
    toxic: bytes = b""
    weights: np.ndarray | None = None
    rate: float = 0.0


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, A to Z in lower case and white space as spaces."""
    data, offsets = utf8(column)
    return _PLAIN[data], offsets


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of the windows: runs of words with the space before and after.
    A window ends after a word whose hash says so, after ``MOST_WORDS`` words and with the text;
    a longer one than ``MOST_BYTES`` is cut."""
    start, end, owner = word_ranges(data, offsets)
    n = len(start)
    if not n:
        return start, end, owner
    last = np.ones(n, bool)
    last[:-1] = owner[1:] != owner[:-1]
    cut = last | (byte_ranges(data).hash(start, end) % np.uint64(WORDS) == 0)
    opens = np.concatenate([[True], cut[:-1]])
    run = np.arange(n) - np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    opens |= run % MOST_WORDS == 0
    first = np.flatnonzero(opens)
    final = np.append(first[1:], n) - 1
    own = owner[first]
    a = np.maximum(start[first] - 1, offsets[own])
    b = np.minimum(end[final] + 1, offsets[own + 1])
    parts = -(-(b - a) // MOST_BYTES)
    k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    a, b, own = np.repeat(a, parts) + k * MOST_BYTES, np.repeat(b, parts), np.repeat(own, parts)
    return a, np.minimum(a + MOST_BYTES, b), own


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    kinds = zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=17, hash_log=17, search_log=6, min_match=3, target_length=16, strategy=zstandard.STRATEGY_BTLAZY2,
        write_content_size=0, write_dict_id=0, write_checksum=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=kinds)


def _sizes(compressor: zstandard.ZstdCompressor, data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Compressed bytes of each window."""
    out = np.zeros(len(start), np.int64)
    step = 1 << 14
    for s in range(0, len(start), step):
        at = np.stack([start[s:s + step], (end - start)[s:s + step]], axis=1).astype(np.uint64)
        done = compressor.multi_compress_to_buffer(zstandard.BufferWithSegments(data, at.tobytes()))
        out[s:s + step] = np.fromiter(map(len, done), np.int64, len(done))
    return out


class Scorer:
    """The two compressors of a model."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.alone, self.both = _compressor(ordinary), _compressor(toxic + ordinary)

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text: for each gain the number and the share of windows that reach it, as
        logarithms, and the mean gain. The counts come first: windows, and those with a gain."""
        start, end, owner = windows(data, offsets)
        n = len(offsets) - 1
        raw = data.tobytes()
        gain = _sizes(self.alone, raw, start, end) - _sizes(self.both, raw, start, end)
        total = np.bincount(owner, minlength=n)
        columns = [total, np.bincount(owner, weights=gain >= GAINS[1], minlength=n)]
        for least in GAINS:
            reach = np.bincount(owner, weights=gain >= least, minlength=n)
            columns += [np.log1p(reach), np.log1p(100 * reach / (total + 5))]
        columns.append(np.bincount(owner, weights=np.maximum(gain, 0), minlength=n) / (total + 5))
        return np.stack(columns, axis=1)


def _train(samples: list[bytes], size: int, segment: int) -> bytes:
    """A dictionary by the library's trainer, taken as plain content. Samples that are too few
    for it are the dictionary themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``GRAM`` bytes from each position on, and whether they end in the text."""
    n = max(0, len(data) - GRAM + 1)
    inside, out = np.ones(n, bool), np.zeros(n, np.uint64)
    over = (offsets[1:, None] - np.arange(1, GRAM)).ravel()
    inside[over[(over >= 0) & (over < n)]] = False
    for s in range(0, n, CHUNK):
        at = np.arange(min(CHUNK, n - s))
        out[s:s + CHUNK] = byte_ranges(data[s:s + CHUNK + GRAM - 1]).hash(at, at + GRAM)
    return out, inside


def _pieces(text: bytes, hit: np.ndarray) -> list[bytes]:
    """Stretches of a text that the runs from the positions ``hit`` on cover."""
    first = np.flatnonzero(np.diff(hit, prepend=-GRAM) > GRAM)
    last = np.append(first[1:], len(hit)) - 1
    # The trainer takes samples of eight bytes or more.
    return [text[a:b + GRAM].ljust(8) for a, b in zip(hit[first], hit[last])]


def _regress(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Means, deviations and weights (the last for 1) of a logistic regression, by Newton steps."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.stack([np.append(mean, 0), np.append(spread, 1), w])


def fit(texts: list[str], toxic: list[int], rate: float | None = None) -> Model:
    """A model from labelled texts. ``rate`` is the share of toxic ones where these are a sample
    that has another share. Texts of one class only give a model without dictionaries, and so
    does a toxic class of which nothing stands out."""
    y = np.array(toxic, bool)
    rate = (y.sum() + 0.1) / (len(y) + 1) if rate is None else rate
    if y.all() or not y.any():
        return Model(rate=rate)
    data, offsets = _flat(pa.array(texts, pa.string()))
    grams, inside = _grams(data, offsets)
    owner = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(offsets))[:len(grams)]
    fold = (np.arange(len(y)) * 0x9E37 >> 4) % FOLDS
    group = (2 * fold + y).astype(np.int8)
    # How many texts of each fold and class hold each run; runs of fewer than LEAST texts stand out
    # nowhere. A share of the runs at a time bounds the memory.
    place, held, known_runs = np.full(len(grams), -1, np.int32), [], 0
    turn_of = (grams % np.uint64(PASSES)).astype(np.uint8)
    for part in range(PASSES):
        at = np.flatnonzero(inside & (turn_of == part)).astype(np.int32)
        at = at[np.argsort(grams[at], kind="stable")]
        g, o = grams[at], owner[at]
        new = np.ones(len(at), bool)
        new[1:] = g[1:] != g[:-1]
        once = new.copy()
        once[1:] |= o[1:] != o[:-1]
        number = np.cumsum(new, dtype=np.int32) - np.int32(1)
        often = np.bincount(number[once], minlength=int(new.sum())) >= LEAST
        renumbered = np.where(often, np.cumsum(often) - 1, -1)[number].astype(np.int32)
        place[at] = np.where(renumbered < 0, -1, renumbered + known_runs)
        count = int(often.sum())
        use = once & (renumbered >= 0)
        held.append(np.bincount(renumbered[use].astype(np.int64) * 2 * FOLDS + group[o[use]], minlength=2 * FOLDS * count).reshape(count, FOLDS, 2))
        known_runs += count
    del grams, owner, inside, turn_of
    raw = data.tobytes()
    del data
    held = np.concatenate(held).transpose(1, 2, 0)
    texts_in = np.array([[((fold == f) & (y == c)).sum() for c in (False, True)] for f in range(FOLDS)])

    plain: list[bytes] = []
    for part in chunks([pa.record_batch({"text": pa.array([t for t, c in zip(texts, y) if not c], pa.string())})]):
        some, ends = _flat(part.column("text"))
        start, end, _ = windows(some, ends)
        piece = some.tobytes()
        plain += [piece[a:b] for a, b in zip(start, end)]
    ordinary = _train(plain, ORDINARY, 64)
    del plain

    def toxic_dictionary(out: int | None) -> bytes:
        """From all texts but those of a fold."""
        use = [f for f in range(FOLDS) if f != out]
        count, total = held[use].sum(axis=0), texts_in[use].sum(axis=0)
        share, whole = count / np.maximum(total, 1)[:, None], count.sum(axis=0) / total.sum()
        spread = np.sqrt(whole * (1 - whole) * (1 / np.maximum(total, 1)).sum()) + 1e-12
        known = np.append((share[1] - share[0]) / spread >= Z, False)  # no number: none
        samples = []
        for i in np.flatnonzero(y & (fold != (-1 if out is None else out))):
            a, b = offsets[i], offsets[i + 1]
            hit = np.flatnonzero(known[place[a:max(a, b - GRAM + 1)]])
            samples += _pieces(raw[a:b], hit) if len(hit) else []
        return _train(samples, TOXIC, 16) if samples else b""

    x = np.zeros((len(y), 2 * len(GAINS) + 1))
    for f in range(FOLDS):
        mine = np.flatnonzero(fold == f)
        scorer, done = Scorer(ordinary, toxic_dictionary(f)), 0
        for part in chunks([pa.record_batch({"text": pa.array([texts[i] for i in mine], pa.string())})]):
            x[mine[done:done + part.num_rows]] = scorer.features(*_flat(part.column("text")))[:, 2:]
            done += part.num_rows
    whole = toxic_dictionary(None)
    if not whole:
        return Model(rate=rate)
    weights = _regress(x, y)
    # The sample's share of toxic texts is not that of the texts it was drawn from.
    weights[2, -1] += np.log(rate / (1 - rate)) - np.log(y.mean() / (1 - y.mean()))
    return Model(ordinary, whole, weights, rate)


def sample(docs: DataFrame, labels: DataFrame, sample_bytes: int, sample_text_bytes: int) -> tuple[DataFrame, float]:
    """Labelled texts of both classes (``text, toxic``), about ``sample_bytes`` of each, by the hash of
    the text, and the share of toxic ones among all. Texts that repeat count once in the sample;
    a text with both labels counts as toxic."""
    marked = labels.groupBy("doc_id").agg((F.max("toxic") != 0).alias("toxic")).filter("toxic IS NOT NULL")
    size, h = F.octet_length("text"), F.shiftrightunsigned(F.xxhash64("text"), 1)
    able = docs.filter(F.col("text").isNotNull() & (size > 0) & (size <= sample_text_bytes))
    # Labels meet hashes of texts; only the rows that are picked are read with their text.
    given = durable(able.select("doc_id", size.cast("long").alias("size"), h.alias("h")).join(marked, "doc_id"))
    sums = {r["toxic"]: r for r in given.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()}
    picked = F.lit(False)
    for c, whole in sums.items():
        most = min((1 << 63) - 1, int(sample_bytes / whole["bytes"] * (1 << 63)))
        picked = picked | ((F.col("toxic") == c) & (F.col("h") <= most))
    chosen = given.filter(picked).select("doc_id", "h", "toxic").distinct()
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    n = {c: sums[c]["n"] if c in sums else 0 for c in (False, True)}
    texts = able.select("doc_id", "text", h.alias("h")).join(chosen, ["doc_id", "h"])
    return texts.groupBy("text").agg(F.max("toxic").alias("toxic")), (n[True] + 0.1) / (n[False] + n[True] + 1)


def train(docs: DataFrame, labels: DataFrame, sample_bytes: int = 6 << 20, sample_text_bytes: int = 1 << 16) -> Model:
    """A model from a bounded sample of the labelled rows of ``docs``. Texts are put in order
    first, so the model does not depend on how the rows were dealt."""
    chosen, rate = sample(docs, labels, sample_bytes, sample_text_bytes)

    def one(group: pa.Table) -> pa.Table:
        group = group.sort_by("text")
        made = fit(group["text"].to_pylist(), group["toxic"].to_pylist(), rate)
        weights = b"" if made.weights is None else made.weights.tobytes()
        return pa.table({c: pa.array([v], pa.binary()) for c, v in (("ordinary", made.ordinary), ("toxic", made.toxic), ("weights", weights))})

    rows = chosen.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(one, "ordinary binary, toxic binary, weights binary").collect()
    if not rows or not rows[0]["weights"]:
        return Model(rate=rate)
    return Model(bytes(rows[0]["ordinary"]), bytes(rows[0]["toxic"]), np.frombuffer(rows[0]["weights"]).reshape(3, -1), rate)


def score(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted, n_windows, n_gaining`` of every whole text: the probability that
    it is toxic, whether that is ``least`` or more, its windows, and those that the toxic dictionary
    shortens by two bytes or more. A null or empty text has no windows and is scored as such. Rows
    that repeat an id are scored one by one; an empty table gives an empty result."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.ordinary, model.toxic) if model.toxic else None
        for batch in chunks(batches):
            data, offsets = _flat(batch.column("text"))
            if scorer:
                x = scorer.features(data, offsets)
                mean, spread, w = model.weights
                # Row by row, not a matrix product, whose sums depend on the rows beside them.
                p = 1 / (1 + np.exp(-np.clip(((x[:, 2:] - mean[:-1]) / spread[:-1] * w[:-1]).sum(axis=1) + w[-1], -30, 30)))
            else:
                x, p = np.zeros((batch.num_rows, 2)), np.full(batch.num_rows, model.rate)
                x[:, 0] = np.bincount(windows(data, offsets)[2], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p), pa.array((p >= least).astype(np.int32)), pa.array(x[:, 0].astype(np.int64)),
                 pa.array(x[:, 1].astype(np.int64))], ["doc_id", "score", "predicted", "n_windows", "n_gaining"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, score double, predicted int, n_windows long, n_gaining long")


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2):
    """Whether a row is kept from learning: the crc32 of its id as text. A null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, **sizes: int) -> DataFrame:
    """Scores of all rows by a model of those that are not held out."""
    model = train(docs.filter(~held_out()), labels.filter(~held_out()), **sizes)
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "n_windows", "n_gaining")
