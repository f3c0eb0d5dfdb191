"""Rows that every operator must take: nulls, blanks, ties, repeats, a long text, clashing names."""

from __future__ import annotations

import random

WORDS = "the of and a to in is that it on river stone Cloud light über niño дом paper window seven".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice("abcdefgh") * rng.randint(0, 2) for _ in range(n)]
    return " ".join(words)


LONG = prose(99, 30_000)
EDGE = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, LONG),
    (5, "Two words"),
    (5, "Two words"),
    (6, prose(1, 80)),
    (7, prose(1, 80)),
    (8, prose(1, 79) + " changed"),
    (None, prose(1, 80).upper()),
    (None, None),
    (9, "a b c \x1c d\U0001f600"),
]
#: Names that the operators use inside.
CLASHING = ["id", "row", "words", "lines", "fp", "key", "part", "version", "windows", "kept", "place", "drops", "root"]


def edge_docs(spark):
    rows = [(i, t, *[f"{c}{n}" for c in CLASHING]) for n, (i, t) in enumerate(EDGE)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING))


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")
