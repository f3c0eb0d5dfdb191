"""Token counts with a cache by content digest: only distinct texts never seen are encoded."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.shared import ship
from dayledger.llm.text_ids import counter
from dayledger.sources.layers import read_if_present

LIMIT = 4096
COUNTS = "digest binary, n_tokens long"


def null_as_empty(text: Column) -> Column:
    """The normalisation that no tokenizer can tell from none."""
    return F.coalesce(text, F.lit(""))


def version_of(tokenizer: str) -> str:
    """Digest of the tokenizer's file: another file, another set of counts in the cache."""
    return hashlib.sha256(Path(tokenizer).read_bytes()).hexdigest()[:32]


def _digest(content: Column) -> Column:
    return F.unhex(F.sha2(F.encode(content, "UTF-8"), 256))


def _cached(docs: DataFrame, cache: str, version: str) -> DataFrame | None:
    """What the cache holds for this tokenizer, once for each digest."""
    known = read_if_present(docs.sparkSession, f"{cache}/tokenizer={version}")
    return None if known is None else known.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def add_misses(
    docs: DataFrame, tokenizer: str, cache: str, normalise: Callable[[Column], Column] = null_as_empty
) -> None:
    """Encode each distinct content of docs that the cache lacks, and append its count.

    Copies are dropped before texts move, so a text that a third of all rows share moves
    once from each task. Two runs at a time may both append a count; it is read once.
    """
    ship(docs.sparkSession)
    version = version_of(tokenizer)
    contents = docs.select(normalise(F.col("text")).alias("content"))
    distinct = contents.groupBy(_digest(F.col("content")).alias("digest")).agg(F.first("content").alias("content"))
    known = _cached(docs, cache, version)
    if known is not None:
        distinct = distinct.join(known, "digest", "left_anti")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(tokenizer)
        for batch in batches:
            numbers = tokens(batch.column("content").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(numbers, pa.int64())], ["digest", "n_tokens"]
            )

    counts = distinct.mapInArrow(count, COUNTS)
    counts.write.mode("append").parquet(f"{cache}/tokenizer={version}")


def counted(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    limit: int = LIMIT,
    normalise: Callable[[Column], Column] = null_as_empty,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of docs.

    Counts are those of the tokenizer's own library over whole texts, without special
    tokens; cache is a folder that all executors share, and misses are appended to it
    first. A null text counts as empty. Repeated rows are counted each, rows without doc_id
    too. normalise must not change a text's count; it may let more texts share one.
    """
    add_misses(docs, tokenizer, cache, normalise)
    counts = _cached(docs, cache, version_of(tokenizer))
    keyed = docs.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        _digest(normalise(F.col("text"))).alias("digest"),
    )
    return keyed.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
