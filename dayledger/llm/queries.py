"""The registered queries of this package: operators over whole tables, with production parameters."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm import (
    html_text,
    language_id,
    line_dedup,
    packing,
    periodic_runs,
    pii,
    planes,
    quality_rules,
    simhash,
    spelling_variants,
    tiling,
    token_counts,
    url_filters,
)
from dayledger.llm.oracle import ORACLES  # noqa: F401
from dayledger.sources.layers import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judged(table(spark, sf_dir, "pages"))


@query
def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), key="registered query")
    return found.select("row.doc_id", F.col("clean_text").alias("text"), "n_mentions")


@query
def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.without_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    return lines.select("row.doc_id", "n_lines", "n_dropped", digest)


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = shared_folder(spark, "token-counts")
    return token_counts.counted(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), cache)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)


@query
def op8_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-planes")
    planes.write_ids(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), end_id=1)
    return planes.read_ids(spark, path)


@query
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def misspelt(doc_id: int | None, words: Counter) -> Counter:
    """Words of op11: of some words of a text all occurrences lack one letter."""
    if doc_id is None:
        return words
    start = zlib.crc32(f"{doc_id}:".encode())
    out: Counter = Counter()
    for word, n in words.items():
        h = zlib.crc32(word.encode(), start)
        k = h % len(word)
        out[word if h % 97 else word[:k] + word[k + 1 :]] += n
    return out


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"), misspelt)


@query
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "lang", "text")
    model = language_id.learned(docs.where("NOT held_out"))
    return language_id.identified(docs.drop("lang"), model)


def repeated_from_somewhere(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of op13: every tenth text goes on with copies of some words from a place on."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), prepare=repeated_from_somewhere)
    line = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
