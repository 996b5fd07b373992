"""A corpus from documents to pieces: quality rules, line dedup, near-dedup, source mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on every row that its predecessor kept; all but the last return
the columns of ``documents``. Between stages rows lie as Parquet on the storage that all executors share, so a lost executor
never repeats an earlier stage and each stage reads only the columns it needs.

Null texts fail the quality rules; null sources count as '' in the mix and stay null. Rows with one id and text are one
document until the near-dedup stage leaves one of them; ties go to the least id. Further columns pass all stages but the last unchanged,
whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import bag_minhash, line_runs, mixing, pieces, repetition, shared

#: No source is repeated more often in the mix; every source is in it at least once, whole. Low on purpose: the stages before
#: have just taken copies out, and encoding, the costliest stage, does at most a quarter more.
MAX_REPEATS = 1.25


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that are short or repeat themselves (operator 4)."""
    return repetition.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later copies of repeated line runs, and without documents of which nothing is left (operator 10)."""
    left = line_runs.dedup_lines(docs, min_words=line_runs.MIN_WORDS).filter("n_lines = 0 OR n_deleted < n_lines")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return left.select(*shared.names(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates (operator 6)."""
    return bag_minhash.keep_first(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources nearer to equal weights: the largest once, smaller ones in more epochs (operator 2)."""
    mixed = mixing.mix(docs, entropy=None, max_repeats=MAX_REPEATS, budget=None)
    return mixed.select(*shared.names(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids, scores of the best segmentations, and how the others differ (operator 5)."""
    return pieces.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("encoding", encoding),
]

#: The signatures and the search of two stages can't be put in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = shared.written(docs)
    return docs
