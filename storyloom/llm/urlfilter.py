"""URL filters whose lists change over time: native DataFrame functions only.

A list is a table of dated entries: from ``at`` on, the entry's ``listed`` verdict (``block``,
``allow`` or null for taken off) holds for its key, until the next entry of the same kind and
key. The entries become validity intervals, and every capture is joined as of its fetch
time with the intervals of its keys. Kinds of keys: ``url`` (one address), ``host`` (one
host) and ``domain`` (a host and all below it). Of the entries active at fetch time the most
specific decides: url, then host, then the longest domain; of equals ``block`` wins.

Intervals are cut at the borders of time buckets and joined by kind, key and bucket, so a
capture meets only the intervals of its bucket, however long the history of its key is. A host
with a third of all captures is a skewed join, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("domain", "host", "url")


def normalized(url: Column) -> Column:
    """Address without scheme, user, default port, fragment and trailing slash, its host in
    lower case; null for a text that has no host."""
    rest = F.regexp_extract(F.trim(url), r"(?i)^(?:https?:)?//(?:[^/?#@]*@)?([^#]*)", 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r"(?::(?:80|443))?$", "")
    host = F.regexp_replace(host, r"\.+$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*(.*)$", 1), r"/+$", "")
    return F.when(host != "", F.concat(host, path))


def host_of(address: Column) -> Column:
    """Host of a normalised address, without its port."""
    return F.regexp_replace(F.regexp_extract(address, r"^[^/?]*", 0), r":\d+$", "")


def keys(address: Column) -> Column:
    """``kind, key`` of every entry that could decide about an address: itself, its host, and
    its host's domains down to one label. A name over 253 characters is no host and has no
    domains."""
    host = host_of(address)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("key")))
    own = F.array(F.struct(F.lit("url").alias("kind"), address.alias("key")), F.struct(F.lit("host").alias("kind"), host.alias("key")))
    return F.when(F.length(host) <= 253, F.concat(own, domains)).otherwise(own)


def intervals(entries: DataFrame) -> DataFrame:
    """``kind, key, listed, start, end``: when each entry holds, ``end`` null for ever. Entries
    without kind, key or time count for nothing; of entries with one time the last one in
    the order null, allow, block holds."""
    known = entries.filter("kind IS NOT NULL AND key IS NOT NULL AND at IS NOT NULL")
    one = known.groupBy("kind", "key", "at").agg(F.max(F.when(F.col("listed").isin("allow", "block"), F.col("listed"))).alias("listed"))
    later = F.lead("at").over(Window.partitionBy("kind", "key").orderBy("at"))
    return one.select("kind", "key", "listed", F.col("at").alias("start"), later.alias("end")).filter("listed IS NOT NULL")


def judge(captures: DataFrame, entries: DataFrame, bucket_days: int = 30) -> DataFrame:
    """``page_id, url, fetched, verdict, decided_by, n_active, kept`` for every row of ``captures``
    (``page_id, url, fetched``).

    ``verdict`` is ``block``, ``allow``, ``none`` (no active entry), ``undated`` (no fetch time) or
    ``invalid`` (no host); ``decided_by`` is kind and key of the deciding entry. Pages stay unless
    blocked or invalid. Repeated rows are judged once and come back as often as they are
    there; empty tables are fine on either side."""
    address = normalized(F.col("url"))
    asked = captures.select("page_id", "url", "fetched").withColumn("address", address)
    day = lambda c: F.datediff(c, F.lit("1970-01-01"))
    bucket = lambda c: F.floor(day(c) / bucket_days)
    probes = asked.filter("fetched IS NOT NULL AND address IS NOT NULL").select("address", "fetched").distinct()
    probes = probes.withColumn("bucket", bucket(F.col("fetched"))).select("*", F.inline(keys(F.col("address"))))
    # Nothing is asked before the first or after the last fetch, so intervals end there.
    span = captures.agg(F.min("fetched").alias("lo"), F.max("fetched").alias("hi")).first()
    lo, hi = (F.lit(span[c]).cast("timestamp_ntz") for c in ("lo", "hi"))
    held = intervals(entries).withColumn("last", F.least(F.coalesce("end", hi), hi)).filter((F.col("last") >= lo) & (F.col("start") <= hi))
    cells = held.withColumn("bucket", F.explode(F.sequence(bucket(F.greatest("start", lo)), bucket(F.col("last"))))).drop("last")
    active = probes.join(cells, ["kind", "key", "bucket"]).filter("start <= fetched AND (`end` IS NULL OR fetched < `end`)")
    rank = F.struct(F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).alias("kind"),
                    F.length("key").alias("length"), (F.col("listed") == "block").alias("block"), "key")
    decided = active.groupBy("address", "fetched").agg(
        F.max_by("listed", rank).alias("listed"), F.max_by(F.concat_ws(" ", "kind", "key"), rank).alias("decided_by"), F.count("*").alias("n_active"))
    verdict = (F.when(F.col("address").isNull(), "invalid").when(F.col("fetched").isNull(), "undated")
               .otherwise(F.coalesce("listed", F.lit("none"))))
    out = asked.join(decided, ["address", "fetched"], "left").withColumn("verdict", verdict)
    return out.select("page_id", "url", "fetched", "verdict", "decided_by", F.coalesce("n_active", F.lit(0)).alias("n_active"),
                      (~F.col("verdict").isin("block", "invalid")).alias("kept"))


def sample_lists(pages: DataFrame) -> DataFrame:
    """Dated entries made from the pages' own hosts and addresses, for tests and queries: a
    checksum of each key decides whether, when and how it is listed, taken off and listed again."""
    address = pages.select(normalized(F.col("url")).alias("address")).filter("address IS NOT NULL")
    named = address.select(F.inline(keys(F.col("address")))).distinct().withColumn("c", F.crc32(F.concat_ws(" ", "kind", "key")))
    start = F.timestamp_seconds(F.lit(1704067200) + F.col("c") % 21600).cast("timestamp_ntz")
    entries = F.array(*[F.struct((start + F.expr(f"make_dt_interval(0, {hours})")).alias("at"), verdict.alias("listed")) for hours, verdict in (
        (0, F.when(F.col("c") % 3 == 0, "allow").otherwise("block")), (3, F.lit(None).cast("string")),
        (7, F.when(F.col("c") % 2 == 0, "block").otherwise("allow")))])
    return named.filter("c % 4 = 0").select("kind", "key", F.inline(entries))
