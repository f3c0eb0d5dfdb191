"""Removal of lines that many documents share, decided on hashes, applied from compact bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.shared import NO_ID, SPACES, ascii_lower, stored

MIN_CHARS = 20
MIN_DOCS = 3
#: The documents of a line are dealt into so many parts before any of its runs is streamed.
PARTS = 4096


def lines_of(text: Column) -> Column:
    """The text split at line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _row_key() -> list[Column]:
    """id and version; version tells rows with one doc_id and different texts apart."""
    return [F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("version")]


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(k1, k2, id, version, place) of every line whose key counts; the key is a 128-bit hash."""
    lines = docs.select(*_row_key(), F.posexplode(lines_of(F.col("text"))).alias("place", "line"))
    stripped = F.btrim("line", F.lit(SPACES))
    return (
        lines.where(F.length(stripped) >= min_chars)
        .withColumn("line", ascii_lower(stripped))
        .select(F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"), "id", "version", "place")
    )


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, version, place) of each line that goes: min_docs documents or more have its key,
    and its document is not the largest of them.

    Hashes are range-partitioned and sorted by document, largest first; the first document
    of a run keeps its lines. So that a line found everywhere is no single run, documents
    are dealt into PARTS first. Where a part alone has min_docs documents, all but its
    first lose the line. What is left, fewer than min_docs documents from each part, makes
    the run over all parts, which decides the same way.
    """
    part = F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int")
    found = stored(_occurrences(docs, min_chars).withColumn("part", part), "line-occurrences")
    run = Window.partitionBy("k1", "k2", "part")
    parts = (
        found.repartitionByRange("k1", "k2", "part")
        .withColumn("rank", F.dense_rank().over(run.orderBy(F.desc("id"))))
        .withColumn("docs", F.max("rank").over(run))
    )
    run = Window.partitionBy("k1", "k2")
    whole = (
        parts.where((F.col("docs") < min_docs) | (F.col("rank") == 1))
        .repartitionByRange("k1", "k2")
        .withColumn("rank", F.dense_rank().over(run.orderBy(F.desc("id"))))
        .withColumn("docs", F.greatest(F.max("rank").over(run), F.max("docs").over(run)))
    )
    loses = (F.col("docs") >= min_docs) & (F.col("rank") > 1)
    return parts.where(loses).select("id", "version", "place").unionByName(
        whole.where(loses).select("id", "version", "place")
    )


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """(id, version, drops): the dropped places of a row as a run-compressed bitmap.

    drops holds the first and last place of each run of dropped lines, in order. Rows that
    keep every line have no bitmap.
    """
    places = dropped.groupBy("id", "version").agg(F.sort_array(F.collect_set("place")).alias("places"))
    p = F.col("places")
    firsts = F.filter(p, lambda x, i: F.coalesce(F.get(p, i - 1) < x - 1, F.lit(True)))
    lasts = F.filter(p, lambda x, i: F.coalesce(F.get(p, i + 1) > x + 1, F.lit(True)))
    return places.select("id", "version", F.arrays_zip(firsts.alias("first"), lasts.alias("last")).alias("drops"))


def without_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """`row` (all columns of docs), n_lines before dropping, n_dropped, and kept_text.

    A line's key is the line stripped of white space with A-Z lower-cased; keys of at least
    min_chars characters in at least min_docs documents stay in the largest doc_id only,
    there with all their lines. A row without doc_id counts as the smallest document. Rows
    that repeat a doc_id are one document. Texts move once, to meet their bitmaps.
    """
    bitmaps = drop_bitmaps(dropped_lines(docs, min_chars, min_docs))
    rows = docs.select(*_row_key(), F.struct("*").alias("row"))
    joined = rows.join(bitmaps.hint("shuffle_hash"), ["id", "version"], "left")
    split = joined.select("row", "drops", lines_of(F.col("row.text")).alias("lines"))
    gone = F.flatten(F.transform("drops", lambda r: F.sequence(r["first"], r["last"])))
    split = split.withColumn("gone", F.coalesce(gone, F.array().cast("array<int>")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n")
    return split.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.when(F.size("gone") == 0, F.coalesce("row.text", F.lit(""))).otherwise(text).alias("kept_text"),
    )
