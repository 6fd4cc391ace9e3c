"""Spelling variants: words that differ by one character, found by PartEnum signatures.

A word is taken as the multiset of its letters, a binary vector with a place for each letter
and count of it (the first ``a``, the second ``a``, ...). One inserted or deleted character
changes one place of the vector, a replaced one changes two, so near words have a Hamming
distance of two at most. The places are dealt into ``PARTS`` parts; two changes spoil at most
two of them, so near words agree on all places of some ``PARTS - 2`` parts. Every subset of so
many parts makes a signature (Arasu, Ganti and Kaushik 2006), and words with an equal signature
are joined and verified by their edit distance.

Letters come in few combinations, so many words share a signature. The join key therefore
also holds half a word: one edit leaves the first half or the rest of the shorter word as it
is. A word takes part as the shorter one and as one that is longer by one character. Both are
necessary conditions, so no near pair is lost.

Everything is DataFrame functions. Words are counted with partial aggregation, so a word that
makes up a third of a corpus costs one row per task, and only distinct words are joined.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.session import durable

PARTS, CHANGED = 4, 2
RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))


def count_words(docs: DataFrame, drop_every: int = 0) -> DataFrame:
    """``word, n``: the runs of Latin letters of every whole text, A to Z in lower case.

    With ``drop_every``, runs lose a character where that number divides the crc32 of
    ``<doc_id>:<run>`` (a null id counts as an empty one): the character at that checksum
    modulo their length. A null text has no words; a run that loses its only character is
    none."""
    text = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(f"({RUN})"), F.lit(1))).alias("word"))
    if drop_every:
        # The second explode of one row computes the checksum once.
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word"))
        runs = runs.withColumn("h", F.explode(F.array(h)))
        at = F.pmod("h", F.length("word")).cast("int")
        less = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))
        runs = runs.select(F.when(F.col("h") % drop_every == 0, less).otherwise(F.col("word")).alias("word"))
    return runs.groupBy("word").agg(F.count("*").alias("n")).filter("word <> ''")


def _signature(word: Column, parts: tuple[int, ...]) -> Column:
    """Hash of the places of the letter multiset that lie in ``parts``: how many places of
    each letter do. Place ``k`` of a letter is in part ``(code + k) % PARTS``."""
    def places(x: Column, part: int) -> Column:
        count = F.length(word) - F.length(F.replace(word, x, F.lit("")))
        first = F.pmod(F.lit(part) - F.ascii(x), F.lit(PARTS))
        return F.floor((count - first + PARTS - 1) / PARTS).cast("int")

    letters = F.array_sort(F.array_distinct(F.split(word, "")))
    held = F.transform(letters, lambda x: F.struct(x.alias("x"), *[places(x, p).alias(f"p{p}") for p in parts]))
    any_place = lambda s: sum((s[f"p{p}"] for p in parts), F.lit(0)) > 0
    return F.xxhash64(F.lit(str(parts)), F.to_json(F.filter(held, any_place)))


def signatures(words: DataFrame) -> DataFrame:
    """``word, n, key``: every signature of every word with each half that has to agree."""
    subsets = [_signature(F.col("word"), s) for s in combinations(range(PARTS), PARTS - CHANGED)]
    size = F.length("word")
    whole = words.withColumn("s", F.explode(F.array(*subsets)))
    shorter = whole.withColumn("m", F.explode(F.array(size, size - 1)))
    half = F.floor(F.col("m") / 2).cast("int")
    rest = (F.col("m") - half).cast("int")
    ends = F.array(F.xxhash64("s", "m", F.lit("front"), F.col("word").substr(F.lit(1), half)),
                   F.xxhash64("s", "m", F.lit("back"), F.col("word").substr(size - rest + 1, rest)))
    return shorter.select("word", "n", F.explode(ends).alias("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b``: every pair of words that differ by exactly one inserted, deleted or
    replaced code point, once, the smaller word first. Keys that one word has alone are left
    out of the join. Words are distinct in ``words``."""
    keyed = durable(signatures(words))
    shared = keyed.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key")
    keyed = keyed.join(shared, "key", "left_semi")
    left = keyed.select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = keyed.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
    close = left.join(right, "key").filter("a < b AND abs(length(a) - length(b)) <= 1 AND levenshtein(a, b, 1) = 1")
    return close.select("a", "b", "n_a", "n_b").distinct()


def group(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ``word, n``: the near word of largest ``n``
    (ties: the smallest) if it occurs at least ``ratio`` times as often as the word, else null;
    the last word on the way from form to form; and the number of near words.

    Counts grow by ``ratio`` from form to form, so a way has few steps; it is followed in
    rounds that double the step. An empty table gives an empty one."""
    pairs = durable(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select("b", "a", "n_a"))
    # Of equal counts the word that comes first wins: max over (n) and min over the word.
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.max("near_n").alias("form_n"))
    top = both.join(best, "word").filter("near_n = form_n").groupBy("word").agg(
        F.min("near").alias("form"), F.first("n_near").alias("n_near"), F.first("form_n").alias("form_n"))
    joined = words.join(top, "word", "left")
    strong = F.col("form_n") >= ratio * F.col("n")
    found = durable(joined.select(
        "word", F.when(strong, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("form_n")).alias("form_n")))
    ways = durable(found.filter("form IS NOT NULL").select("word", F.col("form").alias("up")))
    while True:
        higher = ways.select(F.col("word").alias("up"), F.col("up").alias("next"))
        step = durable(ways.join(higher, "up", "left").select("word", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")))
        if step.filter("moved").isEmpty():
            break
        ways = step.select("word", "up")
    return found.join(ways, "word", "left").select(
        "word", "form", F.coalesce("up", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, least_chars: int = 6, least_count: int = 5, ratio: int = 5, drop_every: int = 199) -> DataFrame:
    """``group`` of the words of ``docs`` with at least ``least_chars`` code points and
    ``least_count`` occurrences."""
    words = count_words(docs, drop_every).filter((F.length("word") >= least_chars) & (F.col("n") >= least_count))
    return group(durable(words), ratio)
