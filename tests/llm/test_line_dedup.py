import hashlib
import random

from dayledger.llm import line_dedup
from fixtures import EDGE, docs_of, edge_docs, empty_docs, prose

SPACES = " \t\n\x0b\x0c\r"
LOW = -(2**63)


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def plain(rows):
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(LOW if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [len(holders.get(key(x), ())) >= 3 and max(holders[key(x)]) != (LOW if i is None else i) for x in lines]
        text = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((i, len(lines), sum(gone), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    found = df.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    return sorted(((r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in found), key=repr)


def test_edge_rows_against_brute_force(spark):
    assert result(line_dedup.without_shared_lines(edge_docs(spark))) == plain(EDGE)


def test_shared_lines_against_brute_force(spark):
    rng = random.Random(4)
    pool = [prose(n, rng.randint(2, 6)) for n in range(40)] + ["SHORT", "Exactly twenty chars", "exactly TWENTY chars", "ÜBER die Linie hinweg geht"]
    rows = []
    for i in range(120):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 9))] + [f"own line number {i} of its own"]
        rows.append((i % 110 if i % 11 else None, "\n".join("  " * rng.randint(0, 1) + x for x in lines)))
    assert result(line_dedup.without_shared_lines(docs_of(spark, rows))) == plain(rows)


def test_a_line_of_every_document(spark, monkeypatch):
    """More documents than parts: parts decide alone, the rest in the run over all parts."""
    monkeypatch.setattr(line_dedup, "PARTS", 3)
    rows = [(i, f"This line is in every document\nown {i} but also long enough") for i in range(50)]
    rows += [(i, "Twice only, whatever the parts say") for i in (100, 101)]
    assert result(line_dedup.without_shared_lines(docs_of(spark, rows))) == plain(rows)


def test_bitmaps_are_runs(spark):
    dropped = spark.createDataFrame([(1, 1, p) for p in (0, 1, 2, 5, 7, 8, 8)], "id long, version long, place int")
    [row] = line_dedup.drop_bitmaps(dropped).collect()
    assert [tuple(r) for r in row.drops] == [(0, 2), (5, 5), (7, 8)]


def test_plan(spark):
    plan = line_dedup.dropped_lines(edge_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "rangepartitioning" in plan
    assert "hashpartitioning(k1" not in plan  # the range partitions serve the windows


def test_empty_table(spark):
    assert line_dedup.without_shared_lines(empty_docs(spark)).collect() == []
