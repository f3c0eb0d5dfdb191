"""Packing of documents into windows: best-fit decreasing over a tree of remaining capacities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.shared import NO_ID, ship, stored
from dayledger.llm.text_ids import space_split_ids

WINDOW = 4096
#: Pieces that are packed together; more pieces make more groups, not larger ones.
GROUP = 65536
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree over the capacities.

    A node of the tree counts the open windows below it, so the tightest window that still
    has room for a length is found by climbing to the first subtree on the right that has
    any, and going down its left side.
    """

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]
        self.window, self.made = window, 0

    def _count(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.tree[node] += by
            node >>= 1

    def _tightest(self, length: int) -> int | None:
        node = self.leaves + length
        while not self.tree[node]:
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.tree[2 * node] else 2 * node + 1
        return node - self.leaves

    def place(self, length: int) -> tuple[int, int]:
        """Window number and offset for a piece of this length."""
        capacity = self._tightest(length)
        if capacity is None:
            number, offset = self.made, 0
            self.made += 1
        else:
            number, offset = self.open[capacity].pop()
            self._count(capacity, -1)
        left = self.window - offset - length
        if left:
            self.open[left].append((number, offset + length))
            self._count(left, 1)
        return number, offset


def pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Each document's ids, and end_id after them, cut into full windows and a rest.

    start counts the document's ids before the piece; ids_crc32 is over the piece's ids as
    little-endian unsigned 32-bit integers. A null text is empty: its only id is end_id.
    """
    ship(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = space_split_ids(tokenizer).encode
        for batch in batches:
            out = []
            for doc_id, own in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                ids = own + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    out.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def _pack(window: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, windows = None, OpenWindows(window)
        for batch in batches:
            numbers, offsets = [], []
            for of, length in zip(batch.column("group").to_pylist(), batch.column("length").to_pylist(), strict=True):
                if of != group:
                    group, windows = of, OpenWindows(window)
                number, offset = windows.place(length)
                numbers.append((of << 32) + number)
                offsets.append(offset)
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return pack


def packed(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Every piece with the sequence it goes to and its offset there.

    Overlong documents are cut into full windows first. Pieces are dealt evenly into groups
    of about `group` pieces, and each group is packed by best-fit decreasing: longest piece
    first, into the open window that it leaves least room in. Only a group's last windows
    are not full, a vanishing share. The result depends on the rows alone: pieces are
    ordered by length, doc_id, start and checksum, and sequence_id is the group's number
    times 2^32 plus the window's. Documents without doc_id are packed, too; repeated rows
    are packed each; an empty table gives an empty result.
    """
    cut = stored(pieces(docs, tokenizer, end_id, window), "pieces")
    groups = max(1, -(-cut.count() // group))
    of = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(NO_ID)), "start", "ids_crc32"), F.lit(groups))
    dealt = (
        cut.withColumn("group", of)
        .repartition(groups, "group")
        .sortWithinPartitions("group", F.desc("length"), "doc_id", "start", "ids_crc32")
    )
    return dealt.mapInArrow(_pack(window), PIECES + ", sequence_id long, offset long")
