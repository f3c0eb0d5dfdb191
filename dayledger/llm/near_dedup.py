"""Removal of near duplicates: SimHash groups first, then an exact similarity join of the rest.

Texts whose fingerprints link by pigeonring filtering (`simhash.py`) are compared and grouped
first. What similar texts these groups leave apart is found by their shingles. The shingles
of a text are put in one order for all texts: those that a sample shows to be common last,
the others by their hash. Two texts that are similar enough share a shingle within the first
few of both (prefix filter), at places and with sizes that still allow it. So texts meet only
under shingles of their prefixes, and no similar pair is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.components import components
from dayledger.llm.shared import LOWER_BYTES, NO_ID, discard, ship, shuffles_end_with_their_query, stored
from dayledger.llm.simhash import fingerprint, links

WORDS = 5
SIMILARITY = 0.8
#: Words of a shingle of the fingerprints, as in op4.
SIGN_WORDS = 4
#: Texts under one shingle up to which all shingles are paired in one go.
BLOCK = 16
#: One text in so many is looked at for common shingles, and so often a shingle must be seen
#: there. Both only set the order of the shingles, and so the time, not the result.
SAMPLE = 16
COMMON = 4
MOST_COMMON = 500_000
#: Pairs that are written at once.
_AT_ONCE = 1 << 18
_SLACK = 1e-6


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(LOWER_BYTES).split()


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles, mixed from XXH64 of the words in turn."""
    import xxhash

    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), np.uint64, len(words))
    size = min(size, len(words))
    found = np.full(len(words) - size + 1 if size else 0, size, np.uint64)
    for i in range(size):
        found = _mixed(found ^ hashes[i : i + len(found)])
    return np.unique(found.view(np.int64))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("version"), "text")


def _marks(docs: DataFrame) -> DataFrame:
    """(id, version, d1, d2, fp) of each row: a digest of its words and their fingerprint."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            halves = np.frombuffer(b"".join(_digest(_words(t)) for t in texts), "<i8").reshape(-1, 2)
            fps = pa.array([fingerprint(t, SIGN_WORDS) for t in texts], pa.int64())
            columns = [*batch.columns[:2], *(pa.array(halves[:, i]) for i in (0, 1)), fps]
            yield pa.RecordBatch.from_arrays(columns, ["id", "version", "d1", "d2", "fp"])

    return _keyed(docs).mapInArrow(rows, "id long, version long, d1 long, d2 long, fp long")


def _signed(texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts that connect what links of their fingerprints connect.

    Texts of one fingerprint are tied to the smallest of them, and these as their fingerprints.
    """
    heads = texts.groupBy("fp").agg(F.min("node").alias("head"))
    same = texts.join(heads, "fp").select(F.col("node").alias("a"), F.col("head").alias("b"))
    pairs = links(heads.select("fp"))
    for side in ("a", "b"):
        ends = heads.select(F.col("fp").alias(side), F.col("head").alias(f"head_{side}"))
        pairs = pairs.join(ends, side)
    linked = pairs.select(F.col("head_a").alias("a"), F.col("head_b").alias("b"))
    both = same.unionByName(linked).where("a <> b")
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _common(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are common in a sample, sorted, with their counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(_shingles(_words(text), words))], ["shingle"])

    sample = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counts = sample.mapInArrow(rows, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
    top = counts.where(F.col("n") >= COMMON).orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).toArrow()
    shingles, n = top.column("shingle").to_numpy(), top.column("n").to_numpy()
    order = np.argsort(shingles)
    return shingles[order], n[order]


def _prefixes(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """(shingle, node, size, place) for the prefix of each text; size is of its whole set."""
    common = docs.sparkSession.sparkContext.broadcast(_common(docs, words))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = common.value
        seen = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = _words(text)
                node = int.from_bytes(_digest(found)[:8], "little", signed=True)
                if node in seen or not found:
                    continue
                seen.add(node)
                own = _shingles(found, words)
                if len(shingles):
                    at = np.minimum(np.searchsorted(shingles, own), len(shingles) - 1)
                    often = np.where(shingles[at] == own, counts[at], 0)
                    order = np.argsort(often, kind="stable")
                else:
                    order = slice(None)
                n = len(own)
                kept = own[order][: n - int(np.ceil(similarity * n - _SLACK)) + 1]
                columns = [
                    pa.array(kept),
                    pa.array(np.full(len(kept), node)),
                    pa.array(np.full(len(kept), n, np.int32)),
                    pa.array(np.arange(len(kept), dtype=np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["shingle", "node", "size", "place"])

    return docs.select("text").mapInArrow(rows, "shingle long, node long, size int, place int")


def _by_run(work: Callable[[list[np.ndarray]], Iterator[pa.RecordBatch]]):
    """Rows sorted by their first column are handed over in parts that end with a run of it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if not len(columns[0]):
                continue
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            if cut or (waiting and waiting[-1][0][-1] != columns[0][0]):
                waiting.append([c[:cut] for c in columns])
                yield from work([np.concatenate(c) for c in zip(*waiting, strict=True)])
                waiting = []
            waiting.append([c[cut:] for c in columns])
        if waiting:
            yield from work([np.concatenate(c) for c in zip(*waiting, strict=True)])

    return rows


def _shared(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Only shingles that more than one text has; a text once for each."""
    key, node = columns[:2]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    columns = [c[new] for c in columns]
    _, of, often = np.unique(columns[0], return_inverse=True, return_counts=True)
    kept = often[of] > 1
    yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in columns], ["shingle", "node", "size", "place"])


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return pa.RecordBatch.from_arrays([pa.array(low[new]), pa.array(high[new])], ["a", "b"])


def _possible(similarity: float, sizes, places, x, y) -> np.ndarray:
    """Whether texts whose first common shingle stands at these places can be similar."""
    need = np.ceil(similarity / (1 + similarity) * (sizes[x].astype(float) + sizes[y]) - _SLACK)
    return np.minimum(sizes[x] - places[x], sizes[y] - places[y]) >= need


def _chains(similarity: float):
    """Each text with the next one under a shingle, in one of four orders, if of another root."""

    def work(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, node, size, place, root = columns
        turn = np.mod(key, 4)
        drawn = _mixed(node.view(np.uint64) ^ turn.astype(np.uint64)) >> np.uint64(2)
        order = np.lexsort((node, np.where(turn == 0, size, drawn.view(np.int64)), key))
        key, node, size, place, root = (c[order] for c in (key, node, size, place, root))
        x = np.flatnonzero((key[1:] == key[:-1]) & (root[1:] != root[:-1]))
        x = x[_possible(similarity, size, place, x, x + 1)]
        yield _pairs(node[x], node[x + 1])

    return work


def _rest(similarity: float):
    """All possible pairs of texts of different roots under a shingle; two alone are chained."""

    def work(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, node, size, place, root = columns
        _, starts, often = np.unique(key, return_index=True, return_counts=True)
        of = np.repeat(often, often)
        few = np.flatnonzero((of > 2) & (of <= BLOCK))
        for step in range(1, BLOCK):
            x, y = few[:-step], few[step:]
            met = (key[x] == key[y]) & (root[x] != root[y])
            x, y = x[met], y[met]
            ok = _possible(similarity, size, place, x, y)
            yield _pairs(node[x[ok]], node[y[ok]])
        for start, n in zip(starts[often > BLOCK], often[often > BLOCK], strict=True):
            yield from long_run(*(c[start : start + n] for c in (node, size, place, root)))

    def long_run(node, size, place, root) -> Iterator[pa.RecordBatch]:
        """Sorted by size. Texts of the run's largest group meet only those beyond it."""
        _, of, often = np.unique(root, return_inverse=True, return_counts=True)
        outer = of != np.argmax(often)
        lows = np.searchsorted(size, np.ceil(similarity * size - _SLACK))
        highs = np.searchsorted(size, np.floor(size / similarity + _SLACK), "right")
        left, right, held = [], [], 0
        for x in np.flatnonzero(outer):
            y = np.arange(lows[x], highs[x])
            y = y[(of[y] != of[x]) & (~outer[y] | (y > x))]
            y = y[_possible(similarity, size, place, x, y)]
            left.append(np.full(len(y), node[x]))
            right.append(node[y])
            held += len(y)
            if held > _AT_ONCE:
                yield _pairs(np.concatenate(left), np.concatenate(right))
                left, right, held = [], [], 0
        if held:
            yield _pairs(np.concatenate(left), np.concatenate(right))

    return work


def _sets(words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_shingles(_words(t), words) for t in batch.column("text").to_pylist()]
            columns = [batch.column("node"), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "shingles"])

    return rows


def _similar(docs: DataFrame, texts: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, stored."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    members = texts.join(nodes, "node").select("node", "id", "version")
    wanted = _keyed(docs).join(members.hint("shuffle_hash"), ["id", "version"]).select("node", "text")
    sets = stored(wanted.mapInArrow(_sets(words), "node long, shingles array<long>").dropDuplicates(["node"]), "sets")
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"of_{side}")), side)
    common = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - common
    found = stored(pairs.where(common >= similarity * either - _SLACK).select("a", "b"), "similar-pairs")
    discard(sets)
    return found


def _groups(docs: DataFrame, words: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Texts (node, id, version of the row that stays for it), and the roots of those that link."""
    marked = stored(_marks(docs), "marks")
    texts = marked.groupBy("d1", "d2").agg(F.min(F.struct("id", "version")).alias("first"), F.first("fp").alias("fp"))
    texts = stored(texts.select(F.col("d1").alias("node"), "first.*", "fp"), "texts")
    discard(marked)
    signed = stored(_signed(texts), "signed-pairs")
    similar = _similar(docs, texts, signed, words, similarity)
    roots = stored(components(similar), "signed-groups")

    met = _prefixes(docs, words, similarity).repartition("shingle").sortWithinPartitions("shingle", "node")
    columns = "shingle long, node long, size int, place int"
    shared = stored(met.mapInArrow(_by_run(_shared), columns), "shared-shingles")

    def rooted() -> DataFrame:
        root = F.coalesce("root", "node").alias("root")
        return shared.join(roots, "node", "left").select("shingle", "node", "size", "place", root).repartition("shingle")

    runs = rooted().sortWithinPartitions("shingle", "node")
    chained = runs.mapInArrow(_by_run(_chains(similarity)), "a long, b long").distinct()
    chained = stored(chained.join(signed, ["a", "b"], "left_anti"), "chained-pairs")
    similar = similar.unionByName(_similar(docs, texts, chained, words, similarity))
    roots = stored(components(similar), "chained-groups")
    runs = rooted().sortWithinPartitions("shingle", "size", "node")
    rest = runs.mapInArrow(_by_run(_rest(similarity)), "a long, b long").distinct()
    compared = signed.unionByName(chained)
    rest = stored(rest.join(compared, ["a", "b"], "left_anti"), "other-pairs")
    discard(shared)
    discard(signed)
    discard(chained)
    if not rest.isEmpty():
        roots = components(similar.unionByName(_similar(docs, texts, rest, words, similarity)))
    discard(rest)
    return texts.drop("fp"), roots


def without_near_duplicates(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row of docs for each group of near duplicates, with its own columns.

    Two texts link if the Jaccard similarity of their sets of `words`-word shingles, A-Z
    lower-cased, is `similarity` or more; groups are what links connect; the row of the
    smallest doc_id stays, of rows that repeat it one. Texts of the same words are one text
    from the start and carry its digest as key; rows of one doc_id with different texts stay
    or go each by its text. Shorter texts are one shingle; texts without words are copies of
    each other. A row without doc_id counts as the smallest.

    No link is lost. Texts that op4's fingerprints link are compared first and grouped where
    they are similar. Then, under each shingle of the prefixes, texts are compared along a
    chain, in proportion to their number, which joins most of what is similar; then every
    possible pair that is still in different groups is compared.
    """
    ship(docs.sparkSession)
    with shuffles_end_with_their_query(docs.sparkSession):
        texts, roots = _groups(docs, words, similarity)
    grouped = texts.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root"))
    staying = grouped.agg(F.min(F.struct("id", "version")).alias("first")).select("first.*")
    rows = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("version"), F.struct("*").alias("row")
    )
    once = rows.join(staying.hint("shuffle_hash"), ["id", "version"], "left_semi")
    return once.groupBy("id", "version").agg(F.first("row").alias("row")).select("row.*")
