"""Quality rules whose verdict depends on the host: native DataFrame functions only.

Every document is measured by itself. A document is out if it fails a base rule. Of the
finer rules, a document that fails one is out only where its host fails that rule too
often: the failures of each host and rule are counted, the rate is shrunk towards the rate
of all hosts by a beta prior fitted to the hosts' rates (method of moments), and a host
whose shrunken rate passes the limit is strict on that rule. A document that fails no
rule stays, whatever its host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.session import durable

SPACE = r"[\x20\x09-\x0D]+"
# Limits of the finer rules, in hundredths, and the rate beyond which a host is strict.
RULES = {"symbols": "100 * n_symbols > 10 * n_words", "lines": "100 * n_dup_lines > 30 * n_lines",
         "repeats": "100 * n_repeat_words > 30 * n_words", "wordlength": "word_chars < 3 * n_words OR word_chars > 12 * n_words"}
HOST_RATE = 0.3
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def _fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns once: an explode of one row keeps later steps from repeating them."""
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.withColumn("_made", F.explode(F.array(row))).select(*df.columns, "_made.*")


def measure(docs: DataFrame, id_column: str = "doc_id", host: str = "source") -> DataFrame:
    """``doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words``
    of every whole text; a null text has no words.

    Words of a three-word window that occurs twice count once each. Windows are compared by
    64-bit hashes; only a text with two equal hashes is searched for where they stand."""
    text = F.coalesce("text", F.lit(""))
    df = docs.select(F.col(id_column).alias("doc_id"), F.col(host).alias("host"), text.alias("text"))
    df = _fixed(df, w=F.array_remove(F.split("text", SPACE, -1), ""),
                lines=F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                n_symbols=F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long")).drop("text")
    n = F.size("w")
    # Words are hashed one by one, then each three neighbours.
    df = _fixed(df.withColumn("h", F.transform("w", lambda x: F.xxhash64(x))),
                n_words=n.cast("long"), word_chars=F.length(F.array_join("w", "")).cast("long"),
                n_lines=F.size("lines").cast("long"),
                n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
                g=F.when(n < 3, F.array().cast("array<bigint>")).otherwise(F.zip_with(
                    F.zip_with(F.slice("h", 1, F.greatest(n - 2, F.lit(0))), F.slice("h", 2, F.greatest(n - 2, F.lit(0))),
                               lambda a, b: F.xxhash64(a, b)),
                    F.slice("h", 3, F.greatest(n - 2, F.lit(0))), lambda a, b: F.xxhash64(a, b)))).drop("w", "h", "lines")
    df = _fixed(df, s=F.when(F.size(F.array_distinct("g")) < F.size("g"), F.sort_array(
        F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("g")
    twice = F.filter("s", lambda x, i: (F.get("s", i - 1).getField("h").eqNullSafe(x.getField("h")))
                     | (F.get("s", i + 1).getField("h").eqNullSafe(x.getField("h"))))
    df = _fixed(df, q=F.sort_array(F.transform(twice, lambda x: x.getField("i")))).drop("s")
    covers = F.aggregate(F.transform("q", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("q", i + 1) - p, F.lit(3)))),
                         F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covers, F.lit(0)).cast("long")).drop("q")


def host_rates(measured: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``host, n_docs`` and for each rule ``rate_<rule>``: the mean of the host's beta
    posterior. The prior has the mean of all documents and the variance of the hosts' rates,
    weighted by documents; hosts that do not vary take the common rate."""
    hosts = measured.groupBy("host").agg(
        F.count("*").alias("n_docs"), *[F.count_if(F.expr(rule)).alias(f"k_{name}") for name, rule in rules.items()])
    rate = {name: F.col(f"k_{name}") / F.col("n_docs") for name in rules}
    prior = hosts.agg(*[F.sum(f"k_{r}").alias(f"k_{r}") for r in rules], F.sum("n_docs").alias("n"),
                      *[F.sum(F.col("n_docs") * rate[r] * rate[r]).alias(f"q_{r}") for r in rules]).first()
    out = []
    for r in rules:
        n = prior["n"] or 1
        mean = (prior[f"k_{r}"] or 0) / n
        var = max(0.0, (prior[f"q_{r}"] or 0.0) / n - mean * mean)
        weight = 1e6 if var <= 1e-12 else min(1e6, max(1.0, mean * (1 - mean) / var - 1))
        out.append(((F.col(f"k_{r}") + weight * mean) / (F.col("n_docs") + weight)).alias(f"rate_{r}"))
    return hosts.select("host", "n_docs", *out)


def judge(docs: DataFrame, rules: dict[str, str] | None = None, host_rate: float = HOST_RATE, id_column: str = "doc_id",
          host: str = "source") -> DataFrame:
    """The measures of every row with ``base_failed`` and ``kept``.

    Rows without a host are judged as the documents of one host. Repeated rows count and
    return as often as they are there; an empty table gives an empty result. The measures
    are checkpointed, so texts are read once."""
    rules = RULES if rules is None else rules
    measured = durable(measure(docs, id_column, host).withColumn("base_failed", F.expr(BASE)))
    rates = host_rates(measured, rules).withColumnRenamed("host", "rated")
    joined = measured.join(rates, F.col("host").eqNullSafe(F.col("rated")), "left")
    strict = [F.expr(rule) & (F.col(f"rate_{name}") > host_rate) for name, rule in rules.items()]
    bad = F.col("base_failed")
    for each in strict:
        bad = bad | each
    return joined.select(*measured.columns, *[F.round(f"rate_{r}", 6).alias(f"rate_{r}") for r in rules], (~bad).alias("kept"))
