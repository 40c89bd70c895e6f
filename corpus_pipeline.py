"""The corpus pipeline: documents to token ids in stages, each written before the next reads it.

Each stage takes all that the one before kept. Rejected, duplicate and contaminated documents and
repeated lines are gone from its result; all stages but the last return the columns of ``documents``.
Null texts count as empty and stay null; null ids keep their lines, and of rows that share an id and a
text the near-duplicate stage keeps one. Without a label nothing is rejected; an empty table passes empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import bpe, decontam, line_dedup, quality, simhash
from tidemart.llm.queries import RANKS
from tidemart.llm.tables import freed_at_end
from tidemart.session import Folder, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds go; the length follows the text."""
    return line_dedup.without_repeated_lines(docs, chars_col="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, with digests of the ids and of the bytes decoded from them."""
    ranks = bpe.vocabulary(spark, public_tokenizers.path(RANKS))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]

# Only the removal of lines can be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is stored and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with freed_at_end(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            Folder(spark, before).remove()
        before = path
    return docs
