"""Periodic runs of words, by enumerating maximal pairs over the tree of LCP intervals.

Two places of a text are a maximal pair if the same words follow both, the words behind
these differ and the words before the places differ. A pair at a distance of p whose common
part has c words spans c + p words with period p that no neighbour extends: where that is
long enough, the pair is a run, and nothing needs to be extended. Every run is met in this
way, by its first place and the place one smallest period later.

The pairs come from the suffix array. Suffixes that share c words form an LCP interval, and
intervals form a tree. It is walked bottom-up; each interval carries the list of its places
in the order of the text, each with its left word. Where two children of an interval meet,
each place of the smaller list looks for its nearest places in the larger one: other pairs
at a distance that c allows are multiples of the smallest period and give the same run.
Intervals too short for any run are left out, so most texts need no tree at all.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.shared import ship

#: A run has at least so many words, and as many as this multiple of its smallest period.
MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Words of short texts that are searched together; a longer text is searched alone.
TOGETHER = 1 << 18
RUN = "struct<start:long,length:long,period:long>"
FOUND = f"doc_id long, runs array<{RUN}>, strongest {RUN}, collapsed string"

Run = tuple[int, int, int]
Words = list[bytes]


def _repeated_windows(codes: np.ndarray, width: int) -> np.ndarray:
    """Whether the window of so many codes that starts at a place may occur again elsewhere.

    By a 64-bit hash of the window, so that a few may be named by mistake, and none missed.
    """
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    sums = np.zeros(len(codes), np.uint64)
    done, part, size = 0, mixed, 1
    while width:  # part holds the hashes of windows of `size` codes
        if width & 1:
            sums = sums * np.uint64(0xBF58476D1CE4E5B9) + _shifted(part, done)
            done += size
        part = part * np.uint64(0x94D049BB133111EB) + _shifted(part, size)
        part ^= part >> np.uint64(31)
        width, size = width >> 1, size << 1
    order = np.argsort(sums)
    equal = sums[order[1:]] == sums[order[:-1]]
    again = np.zeros(len(codes), bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    return again


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    if by < len(values):
        out[: len(values) - by] = values[by:]
    return out


def _firsts(new: np.ndarray) -> np.ndarray:
    """For each position the last one up to it at which something new begins."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _shared(ranks: np.ndarray) -> np.ndarray:
    """Which of the ordered ranks stand there more than once."""
    equal = ranks[1:] == ranks[:-1]
    return np.concatenate([[False], equal]) | np.concatenate([equal, [False]])


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the suffixes that start there, and the LCP of each with the one before.

    The last code, and every other one that ends a text, must occur once only. Prefix
    doubling: the rank of a place by its first 2k codes is that of the pair of ranks by k
    codes; only places that still share a rank are sorted again. The ranks of all rounds
    are kept until the LCPs are read from them.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    rank = np.empty(n, np.int32)
    rank[order] = _firsts(np.diff(codes[order], prepend=-1) != 0)
    rounds, k = [rank], 1
    where = np.flatnonzero(_shared(rank[order]))  # positions in the order that are not settled
    while len(where):
        places = order[where]
        old, later = rank[places], rank[places + k]  # a place that shares k codes has k more behind
        again = np.lexsort((later, old))
        places, old, later = places[again], old[again], later[again]
        order[where] = places
        new = np.concatenate([[True], (old[1:] != old[:-1]) | (later[1:] != later[:-1])])
        rank = rank.copy()
        rank[places] = where[_firsts(new)]
        rounds.append(rank)
        where, k = where[_shared(rank[places])], 2 * k
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for level in range(len(rounds) - 1, -1, -1):
        step = np.where(rounds[level][a] == rounds[level][b], 1 << level, 0)
        common, a, b = common + step, a + step, b + step
    return order, np.concatenate([[0], common])


def _meet(
    small: list[int], large: list[int], common: int, left: list[int], least: int, times: int, out: dict
) -> list[int]:
    """Report the runs between two children of an interval; returns the list of both."""
    most = common // (times - 1)
    for place in small:
        k = bisect_left(large, place)
        for other in large[max(0, k - 1) : k + 1]:
            period = abs(place - other)
            if period <= most and common + period >= least and left[place] != left[other]:
                key = (min(place, other), common + period)
                out[key] = min(period, out.get(key, period))
    if len(small) == 1:
        large.insert(bisect_left(large, small[0]), small[0])
    else:
        large += small
        large.sort()  # two ascending parts: merged in linear time
    return large


def _runs_below(order: list[int], common: list[int], left: list[int], least: int, times: int, out: dict) -> None:
    """Runs of one subtree, bottom-up: common[k] words are shared by the suffixes k and k + 1."""
    waiting: list[tuple[int, list[int]]] = []  # intervals on the way up, each with what it holds so far

    def close(current: list[int]) -> list[int]:
        depth, held = waiting.pop()
        small, large = (held, current) if len(held) < len(current) else (current, held)
        return _meet(small, large, depth, left, least, times, out)

    for place, depth in zip(order, [*common, -1], strict=True):
        current = [place]
        while waiting and waiting[-1][0] >= depth:
            same = waiting[-1][0] == depth
            current = close(current)
            if same:
                break
        waiting.append((depth, current))


def runs_of(texts: list[Words], least: int = MIN_LENGTH, times: int = MIN_EXPONENT) -> list[list[Run]]:
    """(start, length, period) of every run of each text, by start, then period.

    A run has a smallest period of q words, at least `least` words, and at least `times` q
    of them (2 or more); none of its neighbours continues the period.
    """
    floor = -(-least * (times - 1) // times)  # words that the two places of a run share at least
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    coded = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts]
    found: list[list[Run]] = [[] for _ in texts]
    # Each text ends in a code of its own, so nothing is common beyond its end.
    ends = np.arange(len(texts)) + len(numbers)
    starts = np.cumsum([0, *(len(c) + 1 for c in coded)])
    again = _repeated_windows(_joined(coded, ends), max(1, floor))
    kept = [k for k in range(len(texts)) if again[starts[k] : starts[k + 1]].any()]
    if not kept:
        return found
    codes = _joined([coded[k] for k in kept], ends[kept])
    starts = np.cumsum([0, *(len(coded[k]) + 1 for k in kept)])
    order, common = suffix_array(codes)
    left = np.concatenate([[-1], codes[:-1]]).tolist()
    deep = np.concatenate([[False], common[1:] >= max(1, floor), [False]])
    edges = np.flatnonzero(deep[1:] != deep[:-1])
    out: dict[tuple[int, int], int] = {}
    for first, last in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        _runs_below(
            order[first : last + 1].tolist(), common[first + 1 : last + 1].tolist(), left, least, times, out
        )
    of = np.searchsorted(starts, [start for start, _ in out], "right") - 1
    for k, ((start, length), period) in zip(of.tolist(), out.items(), strict=True):
        found[kept[k]].append((start - int(starts[k]), length, period))
    for k in kept:
        found[k].sort(key=lambda run: (run[0], run[2]))
    return found


def _joined(coded: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    parts = [part for c, end in zip(coded, ends, strict=True) for part in (c, [end])]
    return np.concatenate([np.empty(0, np.int64), *parts])


def collapsed(words: Words, runs: list[Run]) -> Words:
    """The words, each run cut down to its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest exponent, exactly compared; of equal ones the first, then the shortest period."""
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def _structs(runs: list[Run], missing: list[bool] | None = None) -> pa.StructArray:
    columns = list(zip(*runs, strict=True)) or [(), (), ()]
    mask = None if missing is None else pa.array(missing, pa.bool_())
    return pa.StructArray.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["start", "length", "period"], mask=mask
    )


def periodic_runs(
    docs: DataFrame,
    least: int = MIN_LENGTH,
    times: int = MIN_EXPONENT,
    prepare: Callable[[int | None, Words], Words] | None = None,
) -> DataFrame:
    """doc_id, runs, strongest and collapsed of every row of docs (doc_id, text).

    Words are maximal runs of characters other than the space and U+0009 to U+000D, numbered
    from 0. runs holds every run as start, length and period, by start, then period;
    strongest is the one with the greatest length / period (null without runs); collapsed
    holds the words that no run contains after its first period, joined by one space.
    prepare, if given, may change a row's words before they are searched.

    A null, empty or blank text has no words, no runs and an empty collapsed text. Rows
    with the same or no doc_id are answered each; an empty table gives an empty result,
    and other columns of docs are ignored. There is no shuffle: a text is searched whole by
    one task, which needs some 150 bytes a word of its longest text if that repeats itself.
    """
    if times < 2:
        raise ValueError("the period of a run is well defined from two repetitions on")
    ship(docs.sparkSession)

    def answer(ids: list[int | None], texts: list[Words]) -> pa.RecordBatch:
        runs = runs_of(texts, least, times)
        best = [strongest(r) for r in runs]
        columns = [
            pa.array(ids, pa.int64()),
            pa.ListArray.from_arrays(
                np.cumsum([0, *map(len, runs)]).astype(np.int32), _structs([run for r in runs for run in r])
            ),
            _structs([b or (0, 0, 0) for b in best], [b is None for b in best]),
            pa.array([b" ".join(collapsed(w, r)).decode() for w, r in zip(texts, runs, strict=True)], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "strongest", "collapsed"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                doc_id, text = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                words = (text or "").encode("utf-8", "replace").split()
                if prepare is not None:
                    words = prepare(doc_id, words)
                if texts and size + len(words) > TOGETHER:
                    yield answer(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                size += len(words)
        if texts:
            yield answer(ids, texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, FOUND)
