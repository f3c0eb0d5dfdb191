"""Spelling variants: words one edit apart, by range searches in k-d trees over letter counts.

An inserted or deleted letter changes a word's letter counts by one in all, a replaced one
by two: one letter more and another one less. Words near a given one are therefore found
per pair of lengths in a k-d tree over the counts of the words of the other length. On the
way down a search goes to both sides of a plane only while the letter that the edit adds,
or takes away, can still bring the word across; that letter is spent then. Words of the
leaves it ends in are near only if the order of their letters agrees, too.

A tree of a bounded sample of the words cuts each length into cells, and every word is sent
to its own cell and to those that its searches end in. A task builds a tree of one cell's
words at a time and lets the searches pass through it as they come.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.shared import LOWER_BYTES, ship, stored
from dayledger.operators.lookups import join_by_key

MIN_LETTERS, MIN_COUNT = 5, 3
#: A word's form occurs at least so many times as often as the word.
FORM_RATIO = 2
#: Words of the sample that places the planes of the cells; more words, larger cells.
SAMPLE = 50_000
#: Words that a cell should hold, and words that a task holds at most of one cell: what a
#: cell holds beyond that is dealt into parts, and its searches go to all of them.
CELL, PART = 8_192, 65_536
MOST_PARTS = 1 << 24
#: Words of a leaf inside a cell; pairs that are compared at a time.
LEAF, PAIRS = 192, 1 << 20
#: Counts that a task holds before it passes them on.
HELD = 500_000
#: Counts: one for each letter of a-z and of U+00C0 to U+00FF; all others share the latter.
DIMENSIONS = 26 + 64
#: Longer words have one cell for each length.
LONGEST_IN_TREE = 64

_RUN = re.compile("[a-zÀ-ÿ]+")
Change = Callable[[int | None, Counter], Counter]


def runs_in(text: str | None) -> list[str]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF; only A-Z become small letters."""
    return _RUN.findall((text or "").encode("utf-8", "replace").translate(LOWER_BYTES).decode())


def word_counts(
    docs: DataFrame, change: Change | None = None, letters: int = MIN_LETTERS, times: int = MIN_COUNT
) -> DataFrame:
    """word and n of all words of docs (doc_id, text) with so many letters and occurrences.

    change, if given, may replace the counts of a row's words before they are added up. Tasks
    count before anything is shuffled, so a word that fills a third of the texts moves once
    from each task. Null texts have no words; rows of the same doc_id count each.
    """
    ship(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                own = Counter(runs_in(text.as_py()))
                if change is not None:
                    own = change(doc_id.as_py(), own)
                for word, n in own.items():
                    counts[word] = counts.get(word, 0) + n
                if len(counts) >= HELD:
                    yield _columns(word=list(counts), n=list(counts.values()))
                    counts = {}
        yield _columns(word=list(counts), n=list(counts.values()))

    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(counted, "word string, n long")
    return (
        parts.where(F.length("word") >= letters).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)
    )


def _columns(**columns) -> pa.RecordBatch:
    types = {"word": pa.string(), "best": pa.string()}
    return pa.RecordBatch.from_pydict(
        {c: v if isinstance(v, pa.Array) else pa.array(v, types.get(c, pa.int64())) for c, v in columns.items()}
    )


class Words:
    """Words of one length, as a matrix of code points and one of letter counts."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length = len(words[0])
        joined = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        self.points = joined.reshape(len(words), self.length)
        small, beyond = self.points - np.uint32(ord("a")), self.points - np.uint32(0xC0)
        which = np.where(small < 26, small, 26 + self.points % 64).astype(np.int64)
        cells = (which + DIMENSIONS * np.arange(len(words))[:, None]).ravel()
        counts = np.bincount(cells, minlength=DIMENSIONS * len(words)).reshape(len(words), DIMENSIONS)
        # Their products are whole numbers that these types hold exactly.
        self.counts = counts.astype(np.float32 if self.length < 2048 else np.float64)
        self.size = (self.counts**2).sum(axis=1)
        #: Letters beyond a-z and U+00C0 to U+00FF may share a count with others.
        self.shares = ((small >= 26) & (beyond >= 64)).any(axis=1)

    def __len__(self) -> int:
        return len(self.words)


@dataclass(frozen=True)
class Node:
    """A leaf with its number, or a plane: counts of `axis` up to `top` lie on the left."""

    leaf: int = -1
    axis: int = 0
    top: int = 0
    left: Node | None = None
    right: Node | None = None


def tree_of(counts: np.ndarray, most: int) -> tuple[Node, list[np.ndarray]]:
    """A k-d tree whose leaves hold up to `most` rows, and the rows of each leaf.

    A plane lies at the middle of the letter whose counts differ most; rows that have the
    same counts stay together.
    """
    leaves: list[np.ndarray] = []

    def grow(rows: np.ndarray) -> Node:
        own = counts[rows]
        spread = own.var(axis=0) if len(rows) > most else np.zeros(1)
        axis = int(spread.argmax())
        if not spread[axis]:
            leaves.append(rows)
            return Node(leaf=len(leaves) - 1)
        values = own[:, axis]
        top = int(np.median(values))
        if top >= values.max():
            top = int(values.max()) - 1
        below = values <= top
        return Node(axis=axis, top=top, left=grow(rows[below]), right=grow(rows[~below]))

    return grow(np.arange(len(counts))), leaves


def reached(node: Node, counts: np.ndarray, less: bool, more: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves that may hold the words after an edit that takes a letter away, adds one, or both.

    Yields each such leaf's number with the rows of counts that reach it; without an edit
    that is each row's own leaf.
    """

    def down(node: Node, rows: np.ndarray, less: np.ndarray, more: np.ndarray):
        if not len(rows):
            return
        if node.left is None:
            yield node.leaf, rows
            return
        values = counts[rows, node.axis]
        below = values <= node.top
        taken = less & (values == node.top + 1)  # comes across the plane by the letter taken away
        left = below | taken
        yield from down(node.left, rows[left], (less & ~taken)[left], more[left])
        added = more & (values == node.top)
        right = ~below | added
        yield from down(node.right, rows[right], less[right], (more & ~added)[right])

    yield from down(node, np.arange(len(counts)), np.full(len(counts), less), np.full(len(counts), more))


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_deleted(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Whether the shorter word is the longer one without one of its letters."""
    front = np.logical_and.accumulate(longer[:, :-1] == shorter, axis=1).sum(axis=1)
    back = np.logical_and.accumulate((longer[:, 1:] == shorter)[:, ::-1], axis=1).sum(axis=1)
    return front + back >= shorter.shape[1]


class Index:
    """Words of one length in a k-d tree, and for each what is known to be near it."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words = Words(words)
        self.tree, self.leaves = tree_of(self.words.counts, LEAF)
        self.own = Best(words, counts)

    def near(self, searching: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of searching and rows of the index that are one edit apart.

        Words that search have the length of the index, or one letter more.
        """
        same = searching.length == self.words.length
        agrees = _one_replaced if same else _one_deleted
        for leaf, rows in reached(self.tree, searching.counts, True, same):
            here = self.leaves[leaf]
            step = max(1, PAIRS // len(here))
            for start in range(0, len(rows), step):
                some = rows[start : start + step]
                product = searching.counts[some] @ self.words.counts[here].T
                apart = searching.size[some][:, None] + self.words.size[here][None, :] - 2 * product
                # One letter less, and one more where the lengths are equal.
                fits = apart == (2 if same else 1)
                if same and searching.shares[some].any():
                    fits |= (apart == 0) & searching.shares[some][:, None]
                a, b = np.nonzero(fits)
                x, y = some[a], here[b]
                order = agrees(searching.points[x], self.words.points[y])
                yield x[order], y[order]

    def meet_each_other(self) -> None:
        for x, y in self.near(self.words):
            self.own.add(x, self.own, y)

    def searched_by(self, words: list[str], counts: list[int]) -> pa.RecordBatch:
        """What the index has near these words of one length; they become known to it, too."""
        asked = Best(words, counts)
        for x, y in self.near(Words(words)):
            asked.add(x, self.own, y)
            self.own.add(y, asked, x)
        return asked.found(np.flatnonzero(asked.near))


class Best:
    """For each of some words: how many others are near it, and the most frequent of these."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.n = words, np.asarray(counts, np.int64)
        self.near = np.zeros(len(words), np.int64)
        self.best_n = np.zeros(len(words), np.int64)
        self.best: list[str | None] = [None] * len(words)

    def add(self, rows: np.ndarray, others: Best, places: np.ndarray) -> None:
        """Each row is near the word at its place among the others."""
        np.add.at(self.near, rows, 1)
        n = others.n[places]
        hopeful = n >= self.best_n[rows]
        for row, place, times in zip(rows[hopeful].tolist(), places[hopeful].tolist(), n[hopeful].tolist(), strict=True):
            word, best = others.words[place], self.best[row]
            if best is None or times > self.best_n[row] or (times == self.best_n[row] and word < best):
                self.best_n[row], self.best[row] = times, word

    def found(self, rows: np.ndarray) -> pa.RecordBatch:
        """These rows as they are passed on."""
        return _columns(
            word=[self.words[k] for k in rows.tolist()],
            n=self.n[rows],
            near=self.near[rows],
            best_n=self.best_n[rows],
            best=[self.best[k] for k in rows.tolist()],
        )


@dataclass(frozen=True)
class Cells:
    """The trees that cut each length into cells, and the number of each length's first cell."""

    trees: dict[int, Node]
    first: dict[int, int]

    def own(self, words: Words) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for leaf, rows in reached(self.trees[words.length], words.counts, False, False):
            out[rows] = self.first[words.length] + leaf
        return out

    def searched(self, words: Words, own: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Other cells in which words must be looked for.

        Of two cells of one length, the words of the lower one go to the higher one.
        """
        for shift, more in ((0, True), (1, False)):
            length = words.length - shift
            if length in self.trees:
                for leaf, rows in reached(self.trees[length], words.counts, True, more):
                    cell = self.first[length] + leaf
                    yield cell, rows if shift else rows[own[rows] < cell]


def cells_of(words: DataFrame) -> Cells:
    """Planes from a sample of about SAMPLE words, the same for the same words.

    The sample, the words whose hash is below its share of all, decides where cells are cut
    and nothing else. To the driver come the sample and a row for each length there is.
    """
    lengths = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("words")).collect()
    short = words.where(F.length("word") <= LONGEST_IN_TREE)
    sample: dict[int, list[str]] = {}
    share = min(1.0, SAMPLE / max(1, sum(row.words for row in lengths)))
    drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
    for row in short.where(drawn).select("word").orderBy("word").collect():
        sample.setdefault(len(row.word), []).append(row.word)
    trees, first, number = {}, {}, 0
    for row in sorted(lengths, key=lambda row: row.length):
        some = sample.get(row.length)
        tree, leaves = Node(leaf=0), 1
        if some:
            most = max(16, len(some) * CELL // row.words)
            tree, rows = tree_of(Words(some).counts, most)
            leaves = len(rows)
        trees[row.length], first[row.length] = tree, number
        number += leaves
    return Cells(trees, first)


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        yield np.flatnonzero(lengths == length)


def _placed(words: DataFrame, cells: Cells) -> DataFrame:
    """Each word with the cell it belongs to."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("word").to_pylist()
            own = np.zeros(len(texts), np.int64)
            for rows in _by_length(texts):
                own[rows] = cells.own(Words([texts[k] for k in rows.tolist()]))
            yield _columns(word=texts, n=batch.column("n"), cell=own)

    return words.mapInArrow(place, "word string, n long, cell long")


def _sent(placed: DataFrame, cells: Cells, parts: dict[int, int]) -> DataFrame:
    """Each word once in its own place, and again (`asks`) wherever it must be looked for.

    A cell of too many words consists of several places. In its own cell a word asks the
    places behind its own.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("word").to_pylist()
            n, own = batch.column("n").to_numpy(), batch.column("cell").to_numpy()
            of = [zlib.crc32(word.encode()) % parts.get(cell, 1) for word, cell in zip(texts, own.tolist(), strict=True)]
            mine = np.asarray(of, np.int64)
            rows, places, asks = [np.arange(len(texts))], [own * MOST_PARTS + mine], [0]
            for cell in set(own.tolist()) & parts.keys():
                here = np.flatnonzero(own == cell)
                for part in range(1, parts[cell]):
                    rows.append(here[mine[here] < part])
                    places.append(cell * MOST_PARTS + part)
                    asks.append(1)
            for some in _by_length(texts):
                for cell, found in cells.searched(Words([texts[k] for k in some.tolist()]), own[some]):
                    for part in range(parts.get(cell, 1)):
                        rows.append(some[found])
                        places.append(cell * MOST_PARTS + part)
                        asks.append(1)
            sizes = [len(r) for r in rows]
            every = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.broadcast_to(p, s) for p, s in zip(places, sizes, strict=True)])),
                    pa.array(np.repeat(asks, sizes).astype(np.int32)),
                    batch.column("word").take(pa.array(every)),
                    pa.array(n[every]),
                ],
                ["place", "asks", "word", "n"],
            )

    return placed.mapInArrow(send, "place long, asks int, word string, n long")


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by place, the place's own words first: what each word has near it there."""
    place, index = None, None
    words: list[str] = []
    counts: list[int] = []

    def finished() -> Iterator[pa.RecordBatch]:
        if index is not None:
            yield index.own.found(np.arange(len(index.words)))

    def built() -> Index | None:
        if not words:
            return None
        found = Index(words, counts)
        found.meet_each_other()
        return found

    for batch in batches:
        texts, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
        key = 2 * batch.column("place").to_numpy() + batch.column("asks").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(texts)]
        for first, last in zip(edges[:-1], edges[1:], strict=True):
            if first == last:
                continue
            here, asks = divmod(int(key[first]), 2)
            if here != place:
                index = index or built()
                yield from finished()
                place, index, words, counts = here, None, [], []
            if not asks:
                words += texts[first:last]
                counts += n[first:last]
                continue
            index = index or built()
            if index is not None:  # a place of searches alone has nothing to find
                some = texts[first:last]
                for rows in _by_length(some):
                    asked = rows.tolist()
                    yield index.searched_by([some[k] for k in asked], [n[first + k] for k in asked])
    index = index or built()
    yield from finished()


def near_words(words: DataFrame) -> DataFrame:
    """word, n, n_near, best_n and best for every word: how many words are one edit away, and
    the most frequent one of them (of equal ones the first in code-point order).

    words: word and n, each word once. Pairs are never written down: what leaves a task is
    a row for each word and place, so a word with very many near ones stays one row.
    """
    spark = words.sparkSession
    ship(spark)
    cells = cells_of(words)
    placed = stored(_placed(words, cells), "variant-cells")
    # One row for each cell that one task should not hold alone.
    large = placed.groupBy("cell").agg(
        F.count("*").alias("words"), F.max(F.length("word")).alias("length")
    ).where(F.col("words") * F.greatest(F.col("length"), F.lit(16)) > 16 * PART)
    parts = {r.cell: -(-r.words * max(r.length, 16) // (16 * PART)) for r in large.collect()}
    sent = _sent(placed, cells, parts).repartition("place").sortWithinPartitions("place", "asks")
    met = sent.mapInArrow(_meeting, "word string, n long, near long, best_n long, best string")
    better = F.min(F.when(F.col("best").isNotNull(), F.struct(-F.col("best_n"), "best"))).alias("first")
    return (
        met.groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), better)
        .select("word", "n", "n_near", (-F.col("first.col1")).alias("best_n"), F.col("first.best").alias("best"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form: the word its forms lead to in the end.

    Each round doubles the steps that are taken; a form is at least FORM_RATIO times as
    frequent as its word, so there are few. A form that very many words share is split at
    runtime, since the joins are told apart from the grouping (join_by_key).
    """
    current = stored(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(join_by_key(current, further, "root"), "variant-roots")
        if moved.where("next IS NOT NULL").isEmpty():
            return current
        current = moved.select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of words (word, n; each word once).

    Two words are near if one inserted, deleted or replaced letter makes one the other. A
    word's form is its most frequent near word (the first of equal ones in code-point
    order), if that is at least FORM_RATIO times as frequent; else it is null, as is form_n.
    root is the last word that the forms lead to, the word itself if it has none. An empty
    table gives an empty result. Words with the same letters in another order are never
    compared with each other, however many they are.
    """
    enough = F.col("best_n") >= FORM_RATIO * F.col("n")
    forms = stored(
        near_words(words).select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("best")).alias("form"),
            F.when(enough, F.col("best_n")).alias("form_n"),
        ),
        "variant-forms",
    )
    rooted = forms.join(_roots(forms), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame, change: Change | None = None, letters: int = MIN_LETTERS, times: int = MIN_COUNT
) -> DataFrame:
    """The variants among the words of docs (doc_id, text), as of word_counts and variants."""
    return variants(stored(word_counts(docs, change, letters, times), "variant-words"))
