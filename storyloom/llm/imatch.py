"""I-Match fingerprints with randomised lexicons: native DataFrame functions only.

The lexicon holds the terms whose document frequency lies in a band of inverse document
frequency. A document's distinct lexicon terms are sorted and, for each of several random
subsets of the lexicon, those of the subset are hashed. The subsets have different
densities, so that long documents agree on the sparse ones and short documents
on the dense ones after the same relative change. The likeness of two fingerprints is the share of
equal hashes among the subsets of which either document has a term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.session import durable

SPACE = r"[\x20\x09-\x0D]+"
# Beside the whole lexicon, each of so many random orders of its terms has one subset with
# one term in 2**k for each of these k. An order takes 10 bits of a hash, a hash four orders.
DENSITIES, EACH = (4, 5, 6, 7, 8, 9), 8
LOW, HIGH, BITS = 1e-4, 0.02, 20


def terms(text: Column) -> Column:
    """Hashes of the distinct words of a text, without those of white space only."""
    return F.transform(F.array_distinct(F.array_remove(F.split(text, SPACE, -1), "")), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH, bits: int = BITS) -> Column:
    """The lexicon as a literal array of ``2**bits`` bits, 64 to a number: the bit of a term
    is set if a term with that many low bits of its hash is in more than one and at least
    the share ``low``, and at most the share ``high`` (and any two), of all documents.

    Frequencies are counted over all texts. As each document has few distinct terms and
    every lexicon term is in at least the share ``low`` of documents, the lexicon stays
    bounded while the corpus grows, and so does the array (2**bits bits)."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    total = texts.count()
    df = texts.select(F.explode(terms(F.col("text"))).alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    band = df.filter((F.col("df") >= max(2.0, low * total)) & (F.col("df") <= max(2.0, high * total)))
    place = F.col("t").bitwiseAND((1 << bits) - 1)
    cells = band.select(F.shiftright(place, 6).alias("cell"), F.expr("shiftleft(1L, cast(t & 63 AS int))").alias("bit"))
    found = {r["cell"]: r["bits"] for r in cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).collect()}
    numbers = ",".join(str(found.get(i, 0)) for i in range(1 << bits - 6))
    return F.split(F.lit(numbers), ",").cast("array<bigint>")


def of_lexicon(found: Column, chosen: Column, bits: int = BITS) -> Column:
    """The terms whose bit is set in a lexicon."""

    def inside(t: Column) -> Column:
        cell = F.shiftright(t.bitwiseAND((1 << bits) - 1), 6) + 1
        return F.getbit(F.element_at(chosen, cell.cast("int")), t.bitwiseAND(63).cast("int")) == 1

    return F.filter(found, inside)


def _hashes(kept: Column) -> Column:
    """Hash of the sorted terms in each subset, null where there are none: of all of them,
    and for each random order of halvings of those that are left after 4, 5, ... 9."""

    def print_of(k: int, j: int, member: Column) -> Column:
        return F.when(F.size(member) > 0, F.xxhash64(F.lit(k), F.lit(j), member))

    def thinned(member: Column, level: int, j: int) -> Column:
        k, last = DENSITIES[level], DENSITIES[level - 1] if level else 0
        mask = (1 << (k - last)) - 1
        left = F.filter(member, lambda t: F.shiftright(t if j < 4 else F.xxhash64(t), 24 + 10 * (j % 4) + last).bitwiseAND(F.lit(mask)) == 0)
        if level + 1 == len(DENSITIES):
            more = lambda m: F.array(print_of(k, j, m))
        else:
            more = lambda m: F.concat(F.array(print_of(k, j, m)), thinned(m, level + 1, j))
        return F.element_at(F.transform(F.array(left), more), 1)

    return F.concat(F.array(print_of(0, 0, kept)), *[thinned(kept, 0, j) for j in range(EACH)])


def fingerprints(texts: DataFrame, columns: list[str], chosen: Column) -> DataFrame:
    """Replace each text column by an array of hashes, one per subset. A text without any
    lexicon term is known by all its terms."""
    others = [c for c in texts.columns if c not in columns]

    def once(df: DataFrame, made: dict[str, Column], keep: list[str]) -> DataFrame:
        row = F.struct(*[c.alias(n) for n, c in made.items()])
        return df.withColumn("_made", F.explode(F.array(row))).select(*keep, "_made.*")

    df = once(texts, {c: terms(F.coalesce(F.col(c), F.lit(""))) for c in columns}, others)
    df = once(df, {c: of_lexicon(F.col(c), chosen) for c in columns} | {f"{c}_all": F.col(c) for c in columns}, others)
    df = once(df, {c: F.sort_array(F.when(F.size(c) > 0, F.col(c)).otherwise(F.col(f"{c}_all"))) for c in columns}, others)
    return once(df, {c: _hashes(F.col(c)) for c in columns}, others)


def likeness(a: Column, b: Column) -> Column:
    """Share of subsets with equal hashes among those where either side has one; 1 for two
    texts without terms."""
    both = F.arrays_zip(a.alias("a"), b.alias("b"))
    some = F.filter(both, lambda x: x.getField("a").isNotNull() | x.getField("b").isNotNull())
    same = F.filter(some, lambda x: x.getField("a") == x.getField("b"))
    return F.when(F.size(some) == 0, F.lit(1.0)).otherwise(F.size(same) / F.size(some))


def printed(a: Column) -> Column:
    """A fingerprint as text."""
    return F.array_join(F.transform(a, lambda h: F.coalesce(F.hex(h), F.lit("-"))), " ")


def with_next(docs: DataFrame, rows: int = 1000, cells: int = 200, carry: list[str] = ()) -> DataFrame:
    """``doc_id, text, next`` and for each column of ``carry`` itself and ``next_<column>``: each document with the text of the next one in descending
    order of id (ties by text hash); after the last comes the first. Null ids come last, null
    texts are empty.

    Ids are dealt into ordered cells: quantiles of the ids, split evenly into pieces of
    about ``rows`` rows. Texts are shuffled once, to their cells; only the first text of
    each cell also goes to the cell before."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *carry)
    sent = ["text", *carry]
    names = {"text": "next"} | {c: f"next_{c}" for c in carry}
    known = base.filter("doc_id IS NOT NULL")
    row = known.agg(F.percentile_approx("doc_id", [i / cells for i in range(1, cells)], 10000).alias("q"),
                    F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).first()
    bounds = sorted({row["lo"], *row["q"], row["hi"] + 1}) if row["n"] else [0, 1]
    pieces = max(1, row["n"] // (rows * max(1, len(bounds) - 1)))
    low, width = F.array(*[F.lit(b).cast("long") for b in bounds[:-1]]), [b - a for a, b in zip(bounds, bounds[1:])]
    coarse = F.size(F.filter(low, lambda b: b <= F.col("doc_id")))
    fine = F.floor((F.col("doc_id") - F.element_at(low, coarse)) / F.element_at(F.array(*[F.lit(float(max(1, w))) for w in width]), coarse) * pieces)
    cell = F.when(F.col("doc_id").isNull(), F.lit(-1).cast("long")).otherwise(coarse.cast("long") * pieces + F.least(fine, F.lit(pieces - 1)))
    placed = base.withColumn("cell", cell)
    order = Window.partitionBy("cell").orderBy(F.col("doc_id").desc(), F.xxhash64("text"))
    listed = placed.withColumns({names[c]: F.lead(c).over(order) for c in sent} | {"place": F.row_number().over(order)})
    used = durable(base.select("doc_id").withColumn("cell", cell).groupBy("cell").count())
    after = durable(_before(used.select("cell")))
    heads = listed.filter("place = 1").select(F.col("cell").alias("low"), *[F.col(c).alias(f"head_{c}") for c in sent])
    heads = after.join(heads, "low").drop("low")
    ends = listed.filter("next IS NULL").drop(*names.values()).join(heads, "cell").withColumnsRenamed({f"head_{c}": names[c] for c in sent})
    out = ["doc_id", *sent, *names.values()]
    return listed.filter("next IS NOT NULL").select(*out).union(ends.select(*out))


def _before(cells: DataFrame, width: int = 4096) -> DataFrame:
    """``cell, low``: each cell with the next smaller one, the smallest with the largest.
    Cells are compared within groups of ``width`` numbers, then the groups' ends."""
    group = F.floor(F.col("cell") / width)
    own = cells.withColumn("group", group).withColumn("low", F.lag("cell").over(Window.partitionBy(group).orderBy("cell")))
    ends = own.groupBy("group").agg(F.max("cell").alias("top"))
    ends = ends.withColumn("low_group", F.lag("top").over(Window.orderBy("group")))
    ends = ends.withColumn("low_group", F.coalesce("low_group", F.max("top").over(Window.partitionBy())))
    return own.join(ends.select("group", "low_group"), "group").select("cell", F.coalesce("low", "low_group").alias("low"))


def compare_edited(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.
    The edited text is the text with its last ``floor(n_chars / 2)`` code points replaced by the
    first as many of the next document. A null or empty text has an empty fingerprint of
    dashes and likeness 1 to another such; an empty table gives an empty result."""
    chosen = lexicon(docs, low, high)
    own = docs.select("doc_id", "text", F.col("text").alias("print"))
    df = with_next(fingerprints(own, ["print"], chosen), carry=["print"]).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next", F.lit(1), half))
    df = df.select("doc_id", "n_chars", "print", "next_print", edited.alias("edited"))
    df = df.withColumn("edited_sha256", F.sha2("edited", 256))
    df = fingerprints(df, ["edited"], chosen)
    return df.select("doc_id", "n_chars", "edited_sha256", printed(F.col("print")).alias("fingerprint"),
                     printed(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("print"), F.col("edited")).alias("near_edited"),
                     likeness(F.col("print"), F.col("next_print")).alias("near_next"))
