"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, token shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last keep the columns
of ``documents``. ``run`` writes what each returns below the shared folder and reads it as the next
one's input, so a lost executor costs a stage's tasks and no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sigloom.llm import decontaminate, mixing, nearcopies, quality, tokens
from sigloom.llm.common import discard, share_code, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, each judged by its own text.

    A null text is the empty one and goes with empty and short texts; null ids stay, repeated rows stay
    apart, long texts are measured whole, ties do not occur; an empty table gives none; extra columns
    of any name are carried along."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more.

    Of a group the smallest doc_id stays (null last), then the smallest hash of the text; of rows that
    repeat both, one. A null text is the empty one, empty texts are copies of one another, long
    texts are compared whole; an empty table gives none; extra columns of any name are carried along."""
    return nearcopies.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Null and empty texts hold none and stay, null ids and repeated rows are judged by their own texts,
    long texts are searched whole, ties do not occur; an empty table gives none, an empty benchmark
    keeps all; extra columns of any name are carried along."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a row for each copy of a document that is taken.

    Null and empty texts have no words and are never taken; a null source is one more; null ids are
    spread by their texts' hashes; rows that repeat id and text are taken one after the other; a very
    long text is cut like any other if the target ends in it; an empty table gives none; extra columns
    of any name are carried along."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as bit-packed token shards, read back: a row for each document written.

    A null text is the empty one, which is the end id alone; null ids come first; rows of one id stand
    in the order of their texts' hashes; long texts are encoded whole; an empty table gives none; other
    columns are left out."""
    return tokens.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", source_mixing),
    ("token output", token_output),
]

#: The stages hash n-grams and call a tokenizer, which SQL cannot express; tests hold the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, one after the other; what a stage has read is removed."""
    share_code(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        now = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            now = stored(now)
            if k:
                discard(spark, docs)
        docs = now
    return docs
