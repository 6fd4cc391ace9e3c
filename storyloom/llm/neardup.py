"""Near duplicates of texts by ProbMinHash.

Method. The distinct shingles of five words of a text, each weighted by
``1 + ln(count)``, arrive as Poisson processes whose rates are their weights. Every
arrival picks one of 128 signature places at random; a place holds the shingle that
arrived there first. A shingle is done as soon as its next arrival comes later than the
last of the text's places (early termination). Two places of two texts agree with the
probability Jaccard similarity of the weighted sets, which a repeated line can make much
smaller than the plain one. So each text has a second signature with weight 1 for every
shingle, whose places agree with the plain Jaccard similarity itself (the two are the same
where no shingle repeats). Thirty-two bands of four places of each give candidates (a pair
at a plain 0.8 is missed once in 20 million), and every candidate is verified by the exact
Jaccard similarity of the distinct shingles.

Large groups. Texts with the same words are one text from the start. A band bucket is
compared with its most widely shared member only, so a group of k near copies costs k
comparisons. The members of buckets that still hold several components form families (texts
that buckets connect), which are compared in blocks of bounded size, across components only:
if the shingles that each text has in common with any other could suffice and the signatures
agree, the pair is compared exactly, and two components of a block send one link. So no link
between different texts is lost and no group emits all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.graph import components
from storyloom.llm.textbytes import Ranges, byte_ranges, chunks, mix, signed, utf8, words
from storyloom.session import durable, scratch_path

PLACES, BAND = 128, 4
_FACTORS = [np.uint64(0x9E3779B97F4A7C15 * (2 * j + 1) & (2 ** 64 - 1)) for j in range(64)]


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and hash of every run of ``width`` words, and two digests of each
    text's words. A text of fewer words has one shingle of them all, one without words none."""
    start, end, owner = words(data, offsets)
    h = byte_ranges(data).hash(start, end)
    first = np.searchsorted(owner, np.arange(len(offsets) - 1))
    last = np.searchsorted(owner, np.arange(len(offsets) - 1), side="right")
    digests = np.stack([Ranges(mix(h ^ np.uint64(s))).hash(first, last, s) for s in (11, 29)], axis=1)
    count = last - first
    at = np.arange(len(h))
    whole = at + width <= last[owner] if len(h) else np.zeros(0, bool)
    at = np.concatenate([at[whole], first[(count > 0) & (count < width)]])
    total = np.zeros(len(at), np.uint64)
    for j in range(width):
        here = at + j < last[owner[at]]
        total[here] += h[at[here] + j] * _FACTORS[j]
    return owner[at], mix(total), digests


def distinct(owner: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles by text with their counts, sorted by text and hash."""
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return owner[at], shingle[at], np.diff(np.append(at, len(owner)))


def prob_minhash(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, places: int) -> np.ndarray:
    """Signatures (texts x places) of weighted sets; all zero for an empty set."""
    best = np.full(texts * places, np.inf)
    taken = np.zeros(texts * places, np.uint32)
    name = (mix(shingle ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    time, step = np.zeros(len(shingle)), 0
    while len(owner):
        step += 1
        draw = mix(shingle + np.uint64(step * 0x9E3779B97F4A7C15 & (2 ** 64 - 1)))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        place = owner * places + (mix(draw) % np.uint64(places)).astype(np.int64)
        early = time < best[place]
        np.minimum.at(best, place[early], time[early])
        won = time == best[place]
        taken[place[won]] = name[won]
        go_on = time < best.reshape(texts, places).max(axis=1)[owner]
        owner, shingle, weight, time, name = (x[go_on] for x in (owner, shingle, weight, time, name))
    return taken.reshape(texts, places)


def signatures(docs: DataFrame, width: int = 5, places: int = PLACES) -> DataFrame:
    """``doc_id, n_shingles, h1, h2`` (digests of the words), ``sig`` (the places as 32-bit
    numbers, every shingle of weight 1) and ``weighted`` (those by counts, null where no shingle
    repeats and both are the same) of every text with a word; null ids and texts without words have none."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = utf8(batch.column("text"))
            owner, shingle, digests = shingles(data, offsets, width)
            owner, shingle, count = distinct(owner, shingle)
            sig = prob_minhash(owner, shingle, np.ones(len(count)), batch.num_rows, places)
            again = np.bincount(owner, weights=count > 1, minlength=batch.num_rows) > 0
            some = again[owner]
            weighted = prob_minhash(owner[some], shingle[some], 1 + np.log(count[some]), batch.num_rows, places)
            size = np.bincount(owner, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(size.astype(np.int32)), signed(digests[:, 0]), signed(digests[:, 1]),
                pa.array([x.tobytes() for x in sig], pa.binary()), pa.array([x.tobytes() if a else None for x, a in zip(weighted, again)], pa.binary()),
            ], ["doc_id", "n_shingles", "h1", "h2", "sig", "weighted"]).filter(pa.array(size > 0))

    narrow = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    return narrow.mapInArrow(sign, "doc_id long, n_shingles int, h1 long, h2 long, sig binary, weighted binary")


def verify(docs: DataFrame, pairs: DataFrame, width: int, threshold: float, block: int = 64) -> DataFrame:
    """The pairs ``(a, b)`` whose distinct shingles have a Jaccard similarity of at least
    ``threshold``. ``b`` should be the side that repeats: its text is sent once per
    ``block`` partners."""
    times = pairs.groupBy("b").agg(F.ceil(F.count("*") / block).alias("blocks"))
    salted = pairs.join(times, "b").select("a", "b", F.pmod(F.xxhash64("a"), "blocks").cast("int").alias("salt"))
    wanted = salted.select("b", "salt", F.col("a").alias("doc_id"), F.lit(1).alias("part")).union(
        salted.select("b", "salt", F.col("b").alias("doc_id"), F.lit(0).alias("part")).distinct())
    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", "text").join(wanted, "doc_id")
    rows = rows.repartition("b", "salt").sortWithinPartitions("b", "salt", "part", "doc_id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = np.zeros(0, np.uint64)
        for batch in chunks(batches):
            data, offsets = utf8(batch.column("text"))
            owner, shingle, _ = distinct(*shingles(data, offsets, width)[:2])
            cut = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            part = batch.column("part").to_numpy()
            like = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                own = shingle[cut[i]:cut[i + 1]]
                if part[i] == 0:
                    lead = own
                elif min(len(own), len(lead)) >= threshold * max(len(own), len(lead), 1):
                    both = len(np.intersect1d(own, lead, assume_unique=True))
                    like[i] = both >= threshold * (len(own) + len(lead) - both)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("b")], ["a", "b"]).filter(pa.array(like))

    return rows.mapInArrow(compare, "a long, b long")


def shingle_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``doc_id, shingles``: the distinct shingles of the documents with these ids."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = utf8(batch.column("text"))
            owner, shingle, _ = distinct(*shingles(data, offsets, width)[:2])
            cut = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(cut), signed(shingle))], ["doc_id", "shingles"])

    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", "text").join(ids, "doc_id", "left_semi")
    return rows.mapInArrow(collect, "doc_id long, shingles array<long>")


def _buckets(unique: DataFrame, places: int, band: int) -> DataFrame:
    """``bucket, doc_id`` for each band of each signature, once per document."""
    plain, weighted = (F.array(*[F.xxhash64(F.lit(i), F.substring(c, i * band * 4 + 1, band * 4)) for i in range(places // band)]) for c in ("sig", "weighted"))
    keys = F.when(F.col("weighted").isNull(), plain).otherwise(F.array_union(plain, weighted))
    return unique.select("doc_id", F.explode(keys).alias("bucket"))


def _across(members: DataFrame, threshold: float, least: float, block: int = 256) -> DataFrame:
    """Alike pairs ``(a, b)`` of one family but different components, one for each two
    components of a block. A pair is compared exactly if the shingles that each has in
    ``common`` with any other member suffice and its signatures agree in at least the share
    ``least`` of places. Families (of ``n`` members) are compared in blocks of about
    ``block`` members, each pair of blocks in one group."""
    cells = members.withColumn("n", F.ceil(F.col("n") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("n")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    cells = cells.select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         "doc_id", "component", "sig", "common", "shingles")
    cells = cells.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "doc_id")

    def flush(group: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(group).combine_chunks()
        ids, comp, common = (t[c].to_numpy() for c in ("doc_id", "component", "common"))
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint32).reshape(len(ids), -1)
        lists = t["shingles"].chunk(0)
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), size)
        ends = np.cumsum(size)
        links, seen = [], set()
        for k in range(len(ids) - 1):
            could = (comp != comp[k]) & (np.minimum(common, common[k]) * (1 + threshold) >= threshold * (size + size[k]))
            could[:k + 1] = False
            rest = np.flatnonzero(could)
            rest = rest[(sig[rest] == sig[k]).mean(axis=1) >= least]
            if not len(rest):
                continue
            own = np.sort(flat[ends[k] - size[k]:ends[k]])
            begin = ends[rest[0]] - size[rest[0]]
            other, whose = flat[begin:ends[rest[-1]]], owner[begin:ends[rest[-1]]]
            hit = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
            both = np.bincount(whose[hit], minlength=len(ids))[rest]
            for r in rest[both >= threshold * (size[rest] + size[k] - both)]:
                if (comp[k], comp[r]) not in seen:
                    seen.add((comp[k], comp[r]))
                    links.append((ids[k], ids[r]))
        return pa.RecordBatch.from_arrays([pa.array([x[n] for x in links], pa.int64()) for n in (0, 1)], ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []
        for batch in batches:
            cols = np.stack([batch.column(c).to_numpy() for c in ("family", "i", "j")], axis=1)
            cuts = np.flatnonzero((cols[1:] != cols[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(cols)]):
                if a == b:
                    continue
                if (now := tuple(cols[a])) != key:
                    if group:
                        yield flush(group)
                    key, group = now, []
                group.append(batch.slice(a, b - a))
        if group:
            yield flush(group)

    return cells.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8, places: int = PLACES, band: int = BAND) -> DataFrame:
    """``doc_id, class_id, n_shingles, keeper``: one row per document id. ``class_id`` is the
    smallest id among the documents that a chain of pairs with a Jaccard similarity of at
    least ``threshold`` links; ``keeper`` marks that document.

    A null or wordless text is alone in its class; two texts with the same words are alike
    whatever their white space; rows without an id are left out; rows that repeat an id
    count as one document, whose texts all link to it. An empty table gives an empty result."""
    spark = docs.sparkSession
    path = scratch_path(spark, "signatures")
    signatures(docs, width, places).write.parquet(path)
    signed_docs = spark.read.parquet(path)
    same = signed_docs.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"))
    copies = signed_docs.join(same.select("h1", "h2", F.col("doc_id").alias("b")), ["h1", "h2"]).select(F.col("doc_id").alias("a"), "b")
    unique = signed_docs.join(same.select("h1", "h2", "doc_id"), ["h1", "h2", "doc_id"], "left_semi").dropDuplicates(["h1", "h2"])

    all_buckets = _buckets(unique.select("doc_id", "sig", "weighted"), places, band)
    sizes = all_buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = durable(all_buckets.join(sizes, "bucket"))
    spread = shared.groupBy("doc_id").agg(F.sum("n").alias("spread"))
    ranked = shared.join(spread, "doc_id")
    leads = ranked.groupBy("bucket").agg(F.min(F.struct(-F.col("spread"), "doc_id")).getField("doc_id").alias("b"))
    pairs = durable(shared.join(leads, "bucket").filter("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct())
    links = durable(verify(docs, pairs, width, threshold))

    found = components(links)
    labelled = shared.select("bucket", "doc_id").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    labelled = durable(labelled.withColumn("component", F.coalesce("component", "doc_id")))
    several = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
    loose = labelled.join(several.filter("lo < hi AND n > 2").select("bucket"), "bucket", "left_semi").select("doc_id", "component").distinct()
    families = components(pairs).withColumnsRenamed({"id": "doc_id", "component": "family"})
    loose = durable(loose.join(families, "doc_id"))
    members = loose.join(loose.groupBy("family").agg(F.count("*").alias("n")), "family")
    path = scratch_path(spark, "shingles")
    shingle_sets(docs, loose.select("doc_id"), width).write.parquet(path)
    sets = spark.read.parquet(path)
    alone = sets.select("doc_id", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
    alone = alone.filter("n = 1").groupBy("doc_id").agg(F.count("*").alias("alone"))
    common = (F.size("shingles") - F.coalesce("alone", F.lit(0))).cast("int")
    facts = sets.dropDuplicates(["doc_id"]).join(alone, "doc_id", "left").withColumn("common", common).drop("alone")
    facts = facts.join(unique.select("doc_id", "sig"), "doc_id")
    links = links.union(_across(members.join(facts, "doc_id"), threshold, threshold - 0.2)).union(copies)

    final = components(links).withColumnRenamed("id", "doc_id")
    every = docs.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    size = signed_docs.groupBy("doc_id").agg(F.max("n_shingles").cast("long").alias("n_shingles"))
    out = every.join(size, "doc_id", "left").join(final, "doc_id", "left")
    label = F.coalesce("component", "doc_id")
    return out.select("doc_id", label.alias("class_id"), F.coalesce("n_shingles", F.lit(0)).alias("n_shingles"),
                      (label == F.col("doc_id")).alias("keeper"))
