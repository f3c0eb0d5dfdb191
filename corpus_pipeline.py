"""Documents to packed training windows: five stages, each an operator of dayledger.llm.

Stages are applied to what the one before kept, written as Parquet and read again. All but
the last return the columns of documents, also columns beyond the usual ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.line_dedup import without_shared_lines
from dayledger.llm.near_dedup import without_near_duplicates
from dayledger.llm.packing import packed
from dayledger.llm.quality_rules import well_written
from dayledger.llm.queries import table, tokenizer_file
from dayledger.llm.shared import stored
from dayledger.llm.tiling import decontaminated


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule; null, empty and blank texts go."""
    return well_written(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that it shares with larger ones; n_chars follows."""
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    columns = [new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    return without_shared_lines(docs).select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the smallest."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their windows; columns as of op7_packing."""
    return packed(docs, tokenizer_file("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SimHash classes, tiles, token ids and best fit are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
