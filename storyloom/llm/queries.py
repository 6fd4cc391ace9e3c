"""Each operator as a query over the test tables, with SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import (
    chat, imatch, lm, neardup, packing, quality, repair, sections, sql, substrings, toxicity, urlfilter, variants, viterbi)

VOCABULARY = os.environ.get("STORYLOOM_VOCABULARY") or public_tokenizers.path("byte_bpe_50k.json")


PIECES = os.environ.get("STORYLOOM_PIECES") or public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every sentence of every document, by most characters."""
    return sections.section_tokens(table(spark, sf_dir, "documents"), VOCABULARY)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they read back as its text."""
    docs = table(spark, sf_dir, "documents")
    back = viterbi.decode(viterbi.encode(docs, PIECES), PIECES)
    return back.select("doc_id", "n_ids", F.crc32("ids").alias("ids_crc32"), F.length("text").cast("long").alias("decoded_chars"),
                       F.sha2("text", 256).alias("decoded_sha256"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page as of its fetch time, the time of the event of its number."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("page_id"), F.col("ts").alias("fetched"))
    return urlfilter.judge(pages.join(events, "page_id", "left"), urlfilter.sample_lists(pages))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents")).drop("host", "n_lines")


CONFLICT = "</s>[INST] ok [/INST]"


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of nothing but marks, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-1).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(CONFLICT))
    return chat.read_back(chat.format_chats(turns.union(hard)), ordered=True)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024 tokens."""
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), VOCABULARY))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, its edited text, and their likeness."""
    return imatch.compare_edited(table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under word counts and under the recurrent model."""
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 400 bytes."""
    cut = substrings.repeated_spans(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labelled ones that are not held out."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of six letters or more, some with a letter taken out."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_counts, op2_sentencepiece, op3_url_filters, op4_quality_rules, op5_chat_formatting, op6_packing, op7_fingerprints, op8_lm_scoring,
        op9_minhash, op10_suffix_dedup, op11_toxicity, op12_spelling_variants, op13_conversation_repair)
}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_RATES = ", ".join(f"""(sum(({rule})::INT) OVER h + {n}_w * {n}_m) / (count(*) OVER h + {n}_w) AS rate_{n}"""
                   for n, rule in quality.RULES.items())
_PRIOR = ", ".join(f"{n}_m, CASE WHEN {n}_v <= 1e-12 THEN 1e6 ELSE least(1e6, greatest(1.0, {n}_m * (1 - {n}_m) / {n}_v - 1)) END AS {n}_w"
                   for n in quality.RULES)
_MOMENTS = ", ".join(f"sum({n}_k) / sum(n) AS {n}_m, greatest(0, sum(n * ({n}_k / n) * ({n}_k / n)) / sum(n) - (sum({n}_k) / sum(n)) ** 2) AS {n}_v"
                     for n in quality.RULES)
_COUNTS = ", ".join(f"sum(({rule})::INT) AS {n}_k" for n, rule in quality.RULES.items())
_STRICT = " AND ".join(f"NOT (({rule}) AND rate_{n} > {quality.HOST_RATE})" for n, rule in quality.RULES.items())
_SHOWN = ", ".join(f"round(rate_{n}, 6) AS rate_{n}" for n in quality.RULES)

_LOOKS = r"(\[/?INST|</?s|<</?(?:SYS|ROLE)>)(~*)([>\]])"
_MARK = r"\[/?INST\]|</?s>|<</?(?:SYS|ROLE)>>"
# A body is escaped if it holds a mark, or an escaped one that would be read as less.
_WRITTEN = f"""CASE WHEN regexp_matches({{0}}, '{_LOOKS}') THEN regexp_replace({{0}}, '{_LOOKS}', '\\1\\2~\\3', 'g') ELSE {{0}} END"""

ORACLES: dict[str, str] = {
    "op12_spelling_variants": sql.VARIANTS,
    "op13_conversation_repair": sql.REPAIR,
    "op5_chat_formatting": f"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{CONFLICT}' UNION ALL SELECT -1, 1, 'assistant', '{CONFLICT}'),
        f AS (SELECT *, length({_WRITTEN.format("text")}) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17
            ELSE 36 + length({_WRITTEN.format("role")}) END AS n FROM t)
        SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(n)::BIGINT AS formatted_chars FROM f GROUP BY 1""",
    "op4_quality_rules": f"""
        WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
        g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d),
        t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM g),
        r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM t WHERE n > 1) GROUP BY 1),
        l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
        m AS (SELECT d.doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
            len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
            FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
        h AS (SELECT source, count(*) AS n, {_COUNTS} FROM m GROUP BY 1),
        v AS (SELECT {_MOMENTS} FROM h), p AS (SELECT {_PRIOR} FROM v),
        s AS (SELECT m.*, {_RATES} FROM m, p WINDOW h AS (PARTITION BY source))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {_SHOWN},
            ({quality.BASE}) AS base_failed, NOT ({quality.BASE}) AND {_STRICT} AS kept FROM s""",
}
