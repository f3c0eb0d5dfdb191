"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.shared import ship

#: Tokens of the shortest match.
MIN_MATCH = 5
#: Share of a benchmark item's tokens that matches must cover.
COVERAGE = 0.5
#: UTF-8 bytes of benchmark text that are sent to the executors at a time.
BLOCK_BYTES = 8 << 20
FOUND = "doc_id long, item_id long, item_tokens long, matched_tokens long, n_tiles long, longest_tile long"

_TOKEN = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 20


def tokens(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores; none for a null text."""
    return _TOKEN.findall((text or "").lower())


def _rolled(codes: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash, modulo 2^64, of each window of `length` codes."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out = out * _BASE + codes[i : i + n]
    return out


class BenchmarkBlock:
    """Items as codes, and the seeds (windows of min_match tokens) with where they stand."""

    def __init__(self, items: list[tuple[int, str]], min_match: int):
        self.min_match = min_match
        split = [(item, tokens(text)) for item, text in items]
        split = [(item, words) for item, words in split if len(words) >= min_match]
        vocabulary = sorted({word for _, words in split for word in words})
        # Fixed odd numbers that look random; 0 stands for a token that no item has.
        codes = np.random.default_rng(20260101).integers(1, 2**63, len(vocabulary), np.int64)
        self.code = dict(zip(vocabulary, codes.tolist(), strict=True))
        self.ids = [item for item, _ in split]
        self.items = [np.array([self.code[w] for w in words], np.uint64) for _, words in split]
        seeds = [(_rolled(codes, min_match), n) for n, codes in enumerate(self.items)]
        order_hash = np.concatenate([h for h, _ in seeds]) if seeds else np.zeros(0, np.uint64)
        item = np.concatenate([np.full(len(h), n) for h, n in seeds]) if seeds else np.zeros(0, int)
        place = np.concatenate([np.arange(len(h)) for h, _ in seeds]) if seeds else np.zeros(0, int)
        order = np.argsort(order_hash, kind="stable")
        self.hash, self.item, self.place = order_hash[order], item[order], place[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.hash >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def seeds_in(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, item, place in the item) of every shared seed."""
        hashes = _rolled(codes, self.min_match)
        at = np.flatnonzero(self.filter[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        low = np.searchsorted(self.hash, hashes[at], "left")
        many = np.searchsorted(self.hash, hashes[at], "right") - low
        steps = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        which = np.repeat(low, many) + steps
        return np.repeat(at, many), self.item[which], self.place[which]

    def found_in(self, text: str | None) -> Iterator[tuple[int, int, int, int, int]]:
        """(item_id, tokens, matched tokens, tiles, longest tile) of each item that shares a seed."""
        words = tokens(text)
        codes = np.fromiter(map(self.code.get, words, repeat(0)), np.uint64, len(words))
        places, item, at = self.seeds_in(codes)
        for n in np.unique(item):
            mine = item == n
            tiles = tile(codes, self.items[n], places[mine], at[mine], self.min_match)
            if tiles:
                lengths = [length for _, _, length in tiles]
                yield self.ids[n], len(self.items[n]), sum(lengths), len(tiles), max(lengths)


def tile(
    text: np.ndarray, item: np.ndarray, places: np.ndarray, at: np.ndarray, min_match: int
) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in the text, place in the item, length) of each tile.

    Again and again the longest match between tokens not yet marked is marked; of equal
    ones the first in the text, then in the item. A match is a run of shared seeds on one
    diagonal. Equal hashes are checked against the codes themselves.
    """
    same = np.ones(len(places), bool)
    for i in range(min_match):
        same &= text[places + i] == item[at + i]
    order = np.lexsort((places[same], places[same] - at[same]))
    places, at = places[same][order], at[same][order]
    free_text, free_item = np.ones(len(text) + 1, bool), np.ones(len(item) + 1, bool)
    tiles = []
    while len(places):
        breaks = np.flatnonzero((np.diff(places) != 1) | (np.diff(at) != 1)) + 1
        starts = np.concatenate([[0], breaks])
        lengths = np.diff(np.concatenate([starts, [len(places)]])) + min_match - 1
        best = int(np.lexsort((at[starts], places[starts], -lengths))[0])
        i, j, length = int(places[starts[best]]), int(at[starts[best]]), int(lengths[best])
        tiles.append((i, j, length))
        free_text[i : i + length] = False
        free_item[j : j + length] = False
        left = np.ones(len(places), bool)
        for k in range(min_match):
            left &= free_text[places + k] & free_item[at + k]
        places, at = places[left], at[left]
    return tiles


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's rows in lists of at most block_bytes of text, or one row."""
    block, held = [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        size = len(row.text.encode())
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((row.item_id, row.text))
        held += size
    yield block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, item_id, item_tokens, matched_tokens, n_tiles, longest_tile, coverage) of each
    document and benchmark item whose tiles cover `coverage` of the item's tokens or more.

    Passages may be reordered: tiles are matches of min_match tokens or more, anywhere and
    in any order, that don't overlap. Documents are read once for each block of the
    benchmark; a block is bounded in bytes, so what is sent to the executors is, too,
    whatever the benchmark's size. No document moves.

    Items of fewer than min_match tokens, null texts and empty ones match nothing. Rows
    without an id are matched and returned with a null id; repeated rows give repeated
    results; without documents or benchmark the result is empty.
    """
    spark = docs.sparkSession
    ship(spark)
    found = None
    for items in _blocks(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast(BenchmarkBlock(items, min_match))

        def rows(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in batches:
                out = [
                    (doc_id, *match)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for match in block.found_in(text)
                    if match[2] >= coverage * match[1]
                ]
                columns = zip(*out, strict=True) if out else [[]] * 6
                names = [part.split()[0] for part in FOUND.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        part = docs.select("doc_id", "text").mapInArrow(rows, FOUND)
        found = part if found is None else found.unionByName(part)
    return found.withColumn("coverage", F.col("matched_tokens") / F.col("item_tokens"))


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of docs that hold no benchmark item, with their own columns.

    Each row is judged on its own text, where it stands; only texts go to Python.
    """
    spark = docs.sparkSession
    ship(spark)
    for items in _blocks(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast(BenchmarkBlock(items, min_match))
        docs = docs.where(~_holds_any(sent, coverage)("text"))
    return docs


def _holds_any(sent: Broadcast, coverage: float):
    @F.pandas_udf("boolean")
    def holds_any(texts: pd.Series) -> pd.Series:
        hits = [any(m[2] >= coverage * m[1] for m in sent.value.found_in(text)) for text in texts]
        return pd.Series(hits, dtype=bool)

    return holds_any
