"""SimHash fingerprints, links by pigeonring filtering, and near-duplicate groups.

A 64-bit fingerprint is a ring of 16 segments of 4 bits. If two fingerprints differ in at
most 4 bits, then from some segment on every chain of consecutive segments stays within
its proportional budget: a chain of n segments has at most n / 4 differing bits, rounded
down. So the chain's first 3 segments are equal, and of the next 4 at most one differs.
Each of the 16 starts and each choice of the segment that may differ makes a key of 24
equal bits: two fingerprints that are linked share one of the 64 keys at least, and those
that share one by chance are few. Among the fingerprints of a key the longer chains and
then the full distance are checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.components import components
from dayledger.llm.shared import LOWER_BYTES, NO_ID, ship, stored

SEGMENT = 4
SEGMENTS = 16
EQUAL_AT_START = 3
ONE_MAY_DIFFER = 4
BUDGET = 4
#: More fingerprints under one key than this are linked by midpoints and not compared.
COMPARED = 8192
#: Up to so many fingerprints under a key, all keys of a batch are compared in one go.
SMALL = 16
_HASHED_AT_ONCE = 1 << 16


def shingles_of(words: list[bytes], size: int) -> list[bytes]:
    if size == 1:
        return words
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set, highest first.

    Eight bits are counted at once in the bytes of a 64-bit word, 255 rows at most.
    """
    lanes = np.unpackbits(hashes.astype(">u8").view(np.uint8)).view(np.uint64).reshape(-1, 8)
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    return sums.view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, words: int, distinct: bool = False) -> int:
    """Bit i is 1 if it is set in more than half of the shingles' XXH64 (seed 42)."""
    import xxhash

    found = shingles_of((text or "").encode("utf-8", "replace").translate(LOWER_BYTES).split(), words)
    if distinct:
        found = list(set(found))
    if not found:
        return 0
    counts = np.zeros(64, np.int64)
    for start in range(0, len(found), _HASHED_AT_ONCE):
        part = found[start : start + _HASHED_AT_ONCE]
        hashes = map(xxhash.xxh64_intdigest, part, repeat(42))
        counts += _bit_counts(np.fromiter(hashes, np.uint64, len(part)))
    return int.from_bytes(np.packbits(2 * counts > len(found)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int, distinct: bool = False) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row of docs.

    A-Z are lower-cased; shingles are `words` words, space-joined. A text of fewer words is
    one shingle, a null text or one without words has fingerprint zero. distinct counts
    each shingle once. Texts are hashed in bounded parts, whatever their length.
    """
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, words, distinct) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, fp long")


def chain_keys(fp: Column) -> Column:
    """The 64 keys of a fingerprint: start, segment that may differ, and 24 bits."""
    width = SEGMENT * (EQUAL_AT_START + ONE_MAY_DIFFER)
    keys = []
    for start in range(SEGMENTS):
        turn = SEGMENT * start
        ring = fp if not turn else F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn))
        chain = F.shiftrightunsigned(ring, 64 - width)
        for free in range(ONE_MAY_DIFFER):
            mask = (1 << width) - 1 - (((1 << SEGMENT) - 1) << (SEGMENT * free))
            number = (start * ONE_MAY_DIFFER + free) << width
            keys.append(chain.bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(number)))
    return F.array(*keys)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _within_ring_budget(key: np.ndarray, a: np.ndarray, b: np.ndarray, budget: int) -> np.ndarray:
    """Whether the chain from the key's start keeps to the budget, segment after segment."""
    turn = ((key >> (SEGMENT * (EQUAL_AT_START + ONE_MAY_DIFFER))) // ONE_MAY_DIFFER * SEGMENT).astype(np.uint64)
    differ = a ^ b
    ring = np.where(turn > 0, (differ << turn) | (differ >> ((np.uint64(64) - turn) % np.uint64(64))), differ)
    kept = np.ones(len(a), bool)
    for length in range(EQUAL_AT_START + 1, SEGMENTS):
        within = length * budget // SEGMENTS
        kept &= np.bitwise_count(ring >> np.uint64(64 - SEGMENT * length)) <= within
    return kept


def _forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links of at most `distance` bits connect: one per node at most."""
    left, right = [], []
    rest = fps
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            node = reached.pop()
            near = _apart(rest, node) <= distance
            found = rest[near]
            if len(found):
                left.append(np.full(len(found), node, np.uint64))
                right.append(found)
                reached += list(found)
                rest = rest[~near]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _link_runs(distance: int):
    """Rows (key, fp) sorted by both -> edges (a, b); b is null for a key beyond COMPARED."""

    def edges(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        first = pa.array(np.ascontiguousarray(a).view(np.int64))
        second = pa.nulls(len(a), pa.int64()) if b is None else pa.array(np.ascontiguousarray(b).view(np.int64))
        return pa.RecordBatch.from_arrays([first, second], ["a", "b"])

    def small(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        for step in range(1, SMALL):
            if len(keys) <= step:
                return
            same = keys[step:] == keys[:-step]
            if not same.any():
                return
            key, a, b = keys[step:][same], fps[:-step][same], fps[step:][same]
            if distance <= BUDGET:
                kept = _within_ring_budget(key, a, b, distance)
                a, b = a[kept], b[kept]
            near = _apart(a, b) <= distance
            if near.any():
                yield edges(a[near], b[near])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        overflown = None
        for batch in _ended(batches):
            if batch is not None:
                keys = np.concatenate([keys, batch.column(0).to_numpy()])
                fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
                done = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            else:
                done = len(keys)
            if overflown is not None and len(keys):
                rest = int(np.searchsorted(keys, overflown, "right"))
                if rest:
                    yield edges(fps[:rest], None)
                    keys, fps, done = keys[rest:], fps[rest:], max(0, done - rest)
                if len(keys):
                    overflown = None
            if done:
                run_keys, starts, sizes = np.unique(keys[:done], return_index=True, return_counts=True)
                of_row = np.repeat(sizes, sizes)
                few = (of_row > 1) & (of_row <= SMALL)
                yield from small(keys[:done][few], fps[:done][few])
                for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
                    run = fps[start : start + size]
                    if size > COMPARED:
                        yield edges(run, None)
                        continue
                    a, b = _forest(run, distance)
                    if len(a):
                        yield edges(a, b)
                keys, fps = keys[done:], fps[done:]
            if len(keys) > COMPARED:  # the last run goes on and is too long already
                overflown = keys[0]
                yield edges(fps, None)
                keys, fps = keys[:0], fps[:0]

    return rows


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _midpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint with every value at most 2 bits away."""
    one = [1 << i for i in range(64)]
    masks = np.array([0, *one, *(x | y for i, x in enumerate(one) for y in one[:i])], np.uint64)
    for batch in batches:
        for fp in batch.column(0).to_numpy().view(np.uint64):
            middle = (fp ^ masks).view(np.int64)
            both = [pa.array(middle), pa.array(np.full(len(masks), fp, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(both, ["middle", "fp"])


def links(fps: DataFrame, distance: int = BUDGET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints fp that connect what the links connect.

    Two fingerprints link if at most `distance` bits differ. Up to 4 bits the result is
    exact: it has the same components as all links. For larger distances the keys still
    hold every pair of up to 4 bits, and most beyond.

    A key's fingerprints are read as a sorted run, and a run gives at most one edge for
    each of them, however dense it is. A run beyond COMPARED is not compared at all: two
    fingerprints 4 bits apart share a value that is 2 bits from both, so all values that
    near are grouped instead, which takes time in proportion to the run; no value has more
    than 2081 fingerprints around it.
    """
    ship(fps.sparkSession)
    keyed = fps.select(F.explode(chain_keys(F.col("fp"))).alias("key"), "fp")
    runs = keyed.repartition("key").sortWithinPartitions("key", "fp")
    found = stored(runs.mapInArrow(_link_runs(distance), "a long, b long"), "links")
    edges = found.where("b is not null").distinct()
    beyond = found.where("b is null").select("a").distinct()
    if beyond.isEmpty():
        return edges
    if distance > BUDGET:  # only candidates are asked for: each long run is one group
        key = F.explode(chain_keys(F.col("a"))).alias("key")
        near = beyond.select(key, F.col("a").alias("fp"))
    else:
        near = beyond.mapInArrow(_midpoints, "middle long, fp long").withColumnRenamed("middle", "key")
    least = near.groupBy("key").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    tied = near.join(least, "key").select(F.col("fp").alias("a"), "b").where("a <> b")
    return edges.unionByName(tied).distinct()


def near_duplicate_groups(docs: DataFrame, words: int = 4, distance: int = BUDGET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of docs.

    Fingerprints within `distance` bits (4 at most) link, that of a text without words
    (zero) like any other. component_id is the smallest doc_id reachable. Rows without a
    doc_id take part; their group has no id if no other row of it has one. Repeated rows
    give repeated results; an empty table gives an empty one. Only the columns doc_id and
    text are read.
    """
    if not 0 <= distance <= BUDGET:
        raise ValueError(f"the keys hold every link up to {BUDGET} bits, not {distance}")
    marked = stored(fingerprints(docs, words), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    distinct = stored(distinct, "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), distance))
    classed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root")
    )
    classed = stored(classed, "fingerprint-classes")
    ids = classed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = classed.join(ids, "root").select("fp", "component_id")
    return marked.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
