import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dayledger.llm import periodic_runs, queries
from fixtures import edge_docs, empty_docs, prose


def runs_by_scanning(words, least, times):
    """Every period in turn: stretches whose words equal those one period on."""
    n, found = len(words), {}
    for period in range(1, n // times + 1):
        start = 0
        while start + period < n:
            end = start
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - start + period
            if end > start and length >= max(least, times * period):
                found.setdefault((start, length), period)
            start = end + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda run: (run[0], run[2]))


def collapsed_by_marking(words, runs):
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    return [word for k, word in enumerate(words) if k not in gone]


@st.composite
def repetitive(draw):
    words = draw(st.lists(st.sampled_from([b"a", b"b", b"c", b"\xc3\xa4"]), max_size=40))
    for _ in range(draw(st.integers(0, 3))):
        at = draw(st.integers(0, len(words)))
        part = draw(st.lists(st.sampled_from([b"a", b"b", b"d"]), max_size=7))
        words[at:at] = part * draw(st.integers(1, 9))
    return words


@settings(max_examples=300, deadline=None)
@given(st.lists(repetitive(), max_size=4), st.sampled_from([(24, 3), (6, 3), (2, 2), (1, 2), (5, 4)]))
def test_runs_are_those_of_a_scan_over_all_periods(texts, limits):
    found = periodic_runs.runs_of(texts, *limits)
    assert found == [runs_by_scanning(words, *limits) for words in texts]
    for words, runs in zip(texts, found, strict=True):
        assert periodic_runs.collapsed(words, runs) == collapsed_by_marking(words, runs)


def test_long_texts_of_one_word_or_of_a_repeated_passage_are_searched_whole():
    assert periodic_runs.runs_of([[b"x"] * 100_000]) == [[(0, 100_000, 1)]]
    passage = [b"%d" % random.Random(k).randrange(50) for k in range(3_000)]
    assert periodic_runs.runs_of([passage * 20 + [b"end"]]) == [[(0, 60_000, 3_000)]]


def test_the_strongest_run_is_compared_exactly():
    assert periodic_runs.strongest([]) is None
    assert periodic_runs.strongest([(9, 30, 10), (5, 9, 3), (5, 6, 2), (0, 299_999, 100_000)]) == (5, 6, 2)
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(None, times=1)


def expected(doc_id, text):
    words = (text or "").encode().split()
    words = queries.repeated_from_somewhere(doc_id, words)
    runs = runs_by_scanning(words, 24, 3)
    best = min(runs, key=lambda run: (-run[1] / run[2], run[0], run[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(collapsed_by_marking(words, runs))).hexdigest(),
    )


def key(row):
    return tuple((v is not None, v) if v is not None else (False,) for v in row)


def test_the_query_answers_every_row(spark, tmp_path):
    rows = [(n, prose(n, n % 300)) for n in range(150)]
    rows += [(1000 + n, "la la lo " * n + prose(n, 30) + " na" * (2 * n)) for n in range(40)]
    rows += [(7, None), (7, ""), (None, "x " * 30), (None, None), (8, " \n\t ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()]
    wanted = [expected(*row) for row in rows]
    assert sum(row[1] for row in wanted) > 40
    assert sorted(got, key=key) == sorted(wanted, key=key)


def test_edge_rows_and_an_empty_table(spark):
    docs = edge_docs(spark)
    got = periodic_runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "runs", "strongest", "collapsed"] and got.count() == docs.count()
    texts = {r.collapsed for r in got.where("doc_id IN (1, 2, 3)").collect()}
    assert texts == {""}
    assert periodic_runs.periodic_runs(empty_docs(spark)).collect() == []
