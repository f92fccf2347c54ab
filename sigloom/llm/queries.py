"""The queries of the text operators: ``opN_<name>`` over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, kenlm, linededup, mixing, quality, secrets, simhash, tokens, toxicity
from .common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents within 3 bits of each other."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, changed parameters included."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "item_windows", "first_word", "last_word", "n_changed")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with the weak parts that complementary parts confirm."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by the grammar that the labelled rows weigh."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, written as bit-packed shards, and read back from them."""
    return tokens.pack_documents(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    v = quality.verdicts(table(spark, sf_dir, "documents"))
    return v.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_maximal_repeats", "longest_repeat_chars", F.round("covered_share", 6).alias("covered_share"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with the roles that its text and place tell, and its rendered turns by digest. The
    tables are counted over the conversations that are not held out; all are parsed."""
    messages = table(spark, sf_dir, "conversations")
    found = chat.parse(messages, chat.train(messages.where(~chat.is_held_out(F.col("conv_id")))))
    text = F.col("rendered")
    return found.select("conv_id", "turn", chat.is_held_out(F.col("conv_id")).alias("held_out"), "n_parts", "roles", F.length(text).cast("long").alias("rendered_chars"), F.md5(text.cast("binary")).alias("rendered_md5"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page without its site's boilerplate lines, by digest."""
    kept = linededup.drop_boilerplate(table(spark, sf_dir, "pages"))
    text = F.col("kept_text")
    return kept.select("page_id", "host", "n_lines", "n_dropped", F.length(text).cast("long").alias("kept_chars"), F.md5(text.cast("binary")).alias("kept_md5"))


def op9_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    return kenlm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents in training order."""
    return mixing.plan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_decontamination": op2_decontamination,
    "op3_secrets": op3_secrets,
    "op4_toxicity": op4_toxicity,
    "op5_token_ids": op5_token_ids,
    "op6_quality_rules": op6_quality_rules,
    "op7_chat": op7_chat,
    "op8_line_dedup": op8_line_dedup,
    "op9_perplexity": op9_perplexity,
    "op10_mixing": op10_mixing,
}

ORACLE_SQL: dict[str, str] = {"op8_line_dedup": linededup.ORACLE, "op10_mixing": mixing.ORACLE}
