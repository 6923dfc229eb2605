"""The operators over whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    bpe,
    collocations,
    conversations,
    decontaminate,
    html_text,
    langid,
    line_dedup,
    near_dup,
    secret_scan,
    sharding,
    spot_signatures,
    token_counts,
    url_filter,
)
from tripmill.llm.common import table

# Which vocabularies the registered queries use.
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512

# Shards of the registered query, and what a record costs besides its text.
SHARDS = 40
RECORD_BYTES = 16

# The registered query's rules on URLs.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _joined(spans: Column) -> Column:
    """Spans as ``kind:start:end,...``."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        of_kind = F.filter("spans", lambda s: s.kind == kind)
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, secret_scan.KINDS),
        _sha256(_joined(F.filter("spans", lambda s: s.kind != "named"))).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), "text"
    )


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train_language_model(docs.filter(~langid.is_held_out()))
    return langid.identify_language(docs, model).select(
        "doc_id",
        langid.is_held_out().alias("held_out"),
        F.col("__lang_pred").alias("lang_pred"),
        F.col("__score").alias("score"),
        F.col("__ambiguous").alias("ambiguous"),
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.edited_fingerprints(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.bpe_encode(table(spark, sf_dir, "documents"), WORD_VOCABULARY)
    return tokens.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        _sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    records = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = sharding.assign_shards(
        records, [1.0] * SHARDS, added=1.0, order=["text_crc32", "size"]
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select("page_id", "judged.*")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(
        table(spark, sf_dir, "documents"), BYTE_VOCABULARY, budgets=[TOKEN_LIMIT]
    )
    return counts.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
        f"fits_{TOKEN_LIMIT}",
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return leaks.select(
        "doc_id", "item_id", F.col("same").alias("same_words"), F.col("at").alias("at_word")
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations")
    return conversations.repair_conversations(conversations.damage(chats), every=chats)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(table(spark, sf_dir, "documents"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html_text.extract_text(table(spark, sf_dir, "pages"))
    return extracted.select("page_id", "url", "text", "n_chars")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_line_dedup": op2_line_dedup,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_language_id": op4_language_id,
    "op5_fingerprints": op5_fingerprints,
    "op6_bpe": op6_bpe,
    "op7_sharding": op7_sharding,
    "op8_url_filter": op8_url_filter,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_collocations": op12_collocations,
    "op13_html_text": op13_html_text,
}
