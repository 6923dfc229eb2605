"""From raw documents to tokens: language, lines, near copies, benchmark passages, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``docs``. Nulls, empty and repeated rows, and extra columns are treated as the operators'
docstrings say; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import bpe, decontaminate, langid, line_dedup, near_dup
from tripmill.llm.common import column, remove_tables, scratch_scope, table, written
from tripmill.sources.scratch import scratch_dir

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

# The languages to keep, by what the text is written in; None keeps all that are learned.
LANGUAGES: tuple[str, ...] | None = None


def language_id(
    spark: SparkSession, docs: DataFrame, sf_dir: str, languages: tuple[str, ...] | None = None
) -> DataFrame:
    """Learn the languages from the labelled rows that are not held out, and go by what
    the texts are written in: ``lang`` becomes the language predicted.

    Dropped are documents in no language (without text or any letter), those not in
    ``languages`` (or LANGUAGES, if set), and those whose language is ambiguous, unless their
    label says that it is the one predicted.
    """
    kept = LANGUAGES if languages is None else languages
    model = langid.train_language_model(docs.filter(~langid.is_held_out()))
    judged = langid.identify_language(docs, model, keep=docs.columns)
    predicted = F.col("__lang_pred")
    stays = (predicted != langid.UNKNOWN) & (
        ~F.col("__ambiguous") | F.coalesce(column("lang") == predicted, F.lit(False))
    )
    if kept is not None:
        stays = stays & predicted.isin(list(kept))
    columns = [predicted.alias("lang") if name == "lang" else column(name) for name in docs.columns]
    return judged.filter(stays).select(*columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that many sites share, except where each comes first. A document that
    consisted of nothing else is dropped."""
    cleaned = line_dedup.dedup_lines(docs)
    emptied = (F.col("__removed") > 0) & (F.col("__removed") == F.col("__lines"))
    return cleaned.filter(~emptied).select(*map(column, docs.columns))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, that with the smallest doc_id."""
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the language found, n_tokens, the tokens' ids, and what they decode to."""
    given = docs.select(F.struct(column("doc_id"), column("lang")).alias("row"), column("text"))
    tokens = bpe.bpe_encode(given, VOCABULARY, key="row", packed=False)
    return tokens.select("row.doc_id", "row.lang", "n_tokens", "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("minhash_dedup", minhash_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

# Language models, sketches and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result but the last is written to the
    shared scratch folder. What a stage wrote for itself, and its input, are removed when
    its result is there; the last input stays, for the result is read from it."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            docs = written(stage(spark, docs, sf_dir), name, path)
        remove_tables(spark, before)
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
