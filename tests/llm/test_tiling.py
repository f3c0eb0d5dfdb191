import random

from dayledger.llm import tiling
from fixtures import EDGE, docs_of, edge_docs, empty_docs, prose


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def plain_tiles(text, item, least):
    """Greedy string tiling by trying every pair of places."""
    a, b = tiling.tokens(text), tiling.tokens(item)
    free_a, free_b, tiles = [True] * len(a), [True] * len(b), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles
        tiles.append(n)
        free_a[i : i + n] = [False] * n
        free_b[j : j + n] = [False] * n


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = "a b c d e f".split()
    items = [(n, " ".join(rng.choice(words) for _ in range(rng.randint(3, 14)))) for n in range(12)]
    docs = [(n, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for n in range(40)]
    wanted = set()
    for i, text in docs:
        for j, item in items:
            tiles = plain_tiles(text, item, 3)
            size = len(item.split())
            if tiles and size >= 3 and sum(tiles) >= 0.5 * size:
                wanted.add((i, j, size, sum(tiles), len(tiles), max(tiles)))
    for block_bytes in (1 << 20, 40):
        got = tiling.contaminated(docs_of(spark, docs), items_of(spark, items), min_match=3, block_bytes=block_bytes)
        assert {tuple(r)[:6] for r in got.collect()} == wanted


def test_reordered_passages_are_caught(spark):
    first, second, third = prose(1, 12), prose(2, 12), prose(3, 12)
    docs = [(1, f"{prose(7, 90)} {third}. {prose(8, 30)} {first}! {second}"), (2, prose(9, 200)), (3, f"{prose(5, 40)} {first}")]
    got = tiling.contaminated(docs_of(spark, docs), items_of(spark, [(5, f"{first} {second} {third}")])).collect()
    assert [(r.doc_id, r.item_id, r.matched_tokens >= 30) for r in got] == [(1, 5, True)]


def test_edge_rows(spark):
    docs = edge_docs(spark)
    items = [(1, None), (2, ""), (None, prose(1, 40)), (4, "too short"), (5, "Two words")]
    got = tiling.contaminated(docs, items_of(spark, items)).collect()
    assert {r.doc_id for r in got} == {6, 7, 8, None} and {r.item_id for r in got} == {None}
    kept = tiling.decontaminated(docs, items_of(spark, items))
    assert kept.columns == docs.columns
    assert kept.count() == len(EDGE) - 4
    assert tiling.contaminated(empty_docs(spark), items_of(spark, items)).collect() == []
    assert tiling.contaminated(docs, items_of(spark, [])).collect() == []
    assert tiling.decontaminated(docs, items_of(spark, [])).count() == len(EDGE)
